"""Rules for columns that hold whole JSON or XML documents."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tramline.functions.numbers import cast_int_strict


def rows_to_json(*columns: Column) -> Column:
    """One JSON object per row; null fields are written, not left out."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def xml_total_count(document: Column, strict: bool = False) -> Column:
    """The promised row count of an XML page; null (or an error if ``strict``) when absent."""
    text = F.from_xml(document, "list_total_count string")["list_total_count"]
    return cast_int_strict(text) if strict else text.try_cast("int")
