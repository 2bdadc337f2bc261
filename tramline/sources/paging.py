"""Page plans: which row ranges to ask a paged source for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tramline.constants import PAGE_ROWS

_BLOCK_PAGES = 10_000


def page_plan(totals: DataFrame, total: str = "total", page_rows: int = PAGE_ROWS) -> DataFrame:
    """Split 1..total into inclusive ranges, one output row per page.

    The ranges are made in two steps, blocks of pages and then pages, with the blocks spread
    over tasks in between: no array grows past a block, however large one total is.
    """
    block_rows = page_rows * _BLOCK_PAGES
    last = F.col(total).cast("bigint")
    blocks = (
        totals.where(last >= 1)
        .withColumn("_block", F.explode(F.sequence(F.lit(1).cast("bigint"), last, F.lit(block_rows))))
        .repartition(*totals.columns, "_block")
    )
    block_end = F.least(F.col("_block") + (block_rows - 1), last)
    pages = blocks.withColumn(
        "start_index", F.explode(F.sequence(F.col("_block"), block_end, F.lit(page_rows)))
    )
    end = F.least(F.col("start_index") + (page_rows - 1), last)
    return pages.withColumn("end_index", end).drop("_block")


def missing_pages(
    totals: DataFrame, landed: DataFrame, keys: Sequence[str], total: str = "total"
) -> DataFrame:
    """(keys, start_index, end_index): the row ranges of 1..total that no landed page covers.

    ``landed`` has the keys and the inclusive ranges that came, in any order, overlapping or
    repeated; ranges of a key without a total, and what lies beyond the total, do not count. A
    range that is missing as a whole comes back as one row, however many pages it holds: ranges
    are swept in order, with the furthest end so far, and never listed row by row. Keys
    with a null are matched like others.
    """
    last = F.col(total).cast("bigint")
    # Behind the last row stands an empty range, so a gap at the end is a gap before it.
    plan = totals.groupBy(*keys).agg(F.max(last).alias("_last")).where("_last >= 1")
    ends = plan.select(*keys, (F.col("_last") + 1).alias("start_index"), F.col("_last").alias("end_index"), F.lit(True).alias("_behind"))
    came = landed.where("start_index <= end_index AND end_index >= 1").select(
        *keys,
        F.greatest(F.col("start_index").cast("bigint"), F.lit(1)).alias("start_index"),
        F.col("end_index").cast("bigint").alias("end_index"),
        F.lit(False).alias("_behind"),
    )
    order = Window.partitionBy(*keys).orderBy("start_index", "_behind", "end_index")
    swept = came.unionByName(ends).select(
        *keys,
        "start_index",
        F.max(F.when(F.col("_behind"), F.col("end_index"))).over(Window.partitionBy(*keys)).alias("_last"),
        F.coalesce(F.max("end_index").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_reached"),
    )
    start, end = F.col("_reached") + 1, F.least(F.col("start_index") - 1, F.col("_last"))
    return swept.where(F.col("_last").isNotNull() & (start <= end)).select(*keys, start.alias("start_index"), end.alias("end_index"))
