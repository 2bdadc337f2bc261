"""Identifiers built from several columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tramline.constants import KEY_NULL_MARKER, KEY_SEPARATOR


def composite_id(line: Column, station: Column) -> Column:
    """``line - station``; null when either part is null."""
    return F.concat(line, F.lit(" - "), station)


def surrogate_key(*parts: Column) -> Column:
    """MD5 over the text form of the parts, with a marker in place of nulls.

    Pass text, whole numbers or dates; the text form of a double is not portable.
    """
    texts = [F.coalesce(part.cast("string"), F.lit(KEY_NULL_MARKER)) for part in parts]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *texts))
