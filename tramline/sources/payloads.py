"""Documents held in a column: API envelopes, bare arrays and XML pages.

A page holds at most a page's worth of rows, so one document always fits in a task.
``strict`` makes an unreadable document stop the job; otherwise it gives no rows, and the
totals report it as lacking its key.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from tramline.functions.payload import xml_total_count
from tramline.schemas import envelope


def _inline(documents: DataFrame, keep: Sequence[str], rows: Column) -> DataFrame:
    return documents.select(*keep, F.inline(rows))


def _mode(strict: bool) -> dict[str, str]:
    return {"mode": "FAILFAST" if strict else "PERMISSIVE"}


def unwrap_json_envelope(
    documents: DataFrame,
    payload: str,
    service: str,
    row: StructType,
    keep: Sequence[str] = (),
    strict: bool = False,
) -> DataFrame:
    """Rows of ``{service: {list_total_count, row: [...]}}``; a document without them gives none."""
    parsed = F.from_json(F.col(payload), envelope(service, row), _mode(strict))
    return _inline(documents, keep, parsed[service]["row"])


def envelope_totals(
    documents: DataFrame, payload: str, service: str, keep: Sequence[str] = ()
) -> DataFrame:
    """Per document: the promised total and whether the service key was there at all."""
    parsed = F.from_json(F.col(payload), envelope(service, StructType([])))
    return documents.select(
        *keep,
        parsed[service]["list_total_count"].alias("list_total_count"),
        parsed[service].isNull().alias("key_absent"),
    )


def unwrap_json_list(
    documents: DataFrame,
    payload: str,
    key: str,
    row: StructType,
    keep: Sequence[str] = (),
    strict: bool = False,
) -> DataFrame:
    """Rows of ``{key: [...]}``; an absent key gives none."""
    shape = StructType([StructField(key, ArrayType(row))])
    return _inline(documents, keep, F.from_json(F.col(payload), shape, _mode(strict))[key])


def array_position_seq(
    documents: DataFrame,
    payload: str,
    row: StructType,
    keep: Sequence[str] = (),
    name: str = "seq_no",
    strict: bool = True,
) -> DataFrame:
    """Rows of a JSON array with their 1-based place in it, counted before any filter."""
    items = F.from_json(F.col(payload), ArrayType(row), _mode(strict))
    placed = documents.select(*keep, F.posexplode(items).alias("_at", "_item"))
    return placed.select(*keep, "_item.*", (F.col("_at") + 1).alias(name))


def unwrap_xml(
    documents: DataFrame,
    payload: str,
    row: StructType,
    keep: Sequence[str] = (),
    strict: bool = False,
) -> DataFrame:
    """Rows of an XML page held in a column; a page without ``<row>`` gives none.

    Text keeps its spaces; an absent or empty child is null.
    """
    shape = StructType([StructField("row", ArrayType(row))])
    options = {"ignoreSurroundingSpaces": "false", "nullValue": "", **_mode(strict)}
    parsed = F.from_xml(F.col(payload), shape, options)
    return _inline(documents, keep, parsed["row"])


def xml_totals(documents: DataFrame, payload: str, keep: Sequence[str] = ()) -> DataFrame:
    """Per XML page: the promised total and whether it was there."""
    total = xml_total_count(F.col(payload))
    return documents.select(
        *keep, total.alias("list_total_count"), total.isNull().alias("key_absent")
    )


def scan_xml_pages(spark: SparkSession, path: str, row: StructType) -> DataFrame:
    """(file, list_total_count, rows) of each landed XML page, in one read.

    A file is a page, of at most a page's rows. The total is null if the page lacks one or
    cannot be read; ``rows`` is empty then or if it has none.
    """
    shape = StructType([StructField("list_total_count", StringType()), StructField("row", ArrayType(row))])
    options = {"ignoreSurroundingSpaces": "false", "nullValue": "", **_mode(False)}
    read = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("file"), F.from_xml("value", shape, options).alias("page")
    )
    rows = F.coalesce(F.col("page.row"), F.array().cast(ArrayType(row)))
    total = F.trim("page.list_total_count").try_cast("int")
    return read.select("file", total.alias("list_total_count"), rows.alias("rows"))


def promised_by_day(pages: DataFrame, day: Callable[[Column], Column], name: str = "usage_date") -> DataFrame:
    """(day, list_total_count, pages) of landed XML pages; ``day`` is the rule for a row's day.

    A day's pages must agree: the total is null if one lacks it or two differ. A page without
    rows belongs to the day its folder names (``name=yyyy-mm-dd``), or to none.
    """
    folder = F.regexp_extract("file", f"/{name}=([0-9-]+)/", 1).try_cast("date")
    days = F.array_distinct(F.transform("rows", day))
    each = pages.select("file", "list_total_count", F.explode(F.when(F.size("rows") > 0, days).otherwise(F.array(folder))).alias(name))
    total = F.col("list_total_count")
    agreed = F.when(F.count(F.when(total.isNull(), 1)) + F.count_distinct(total) == 1, F.max(total))
    return each.where(F.col(name).isNotNull()).groupBy(name).agg(agreed.alias("list_total_count"), F.count("*").alias("pages"))
