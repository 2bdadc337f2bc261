"""Did everything that was promised arrive?"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

DONE = ["complete", "empty"]


class IncompleteLanding(Exception):
    """At least one cell of the grid is not complete."""


def landing_audit(
    landed: DataFrame,
    promised: DataFrame,
    grid: DataFrame,
    keys: Sequence[str],
    total: str = "list_total_count",
) -> DataFrame:
    """Promised against landed rows for every cell of ``grid``, e.g. day x hour.

    The three inputs are stacked and grouped once: a hot cell is summed before the only
    shuffle, and a cell known to a single input still shows up.

    status: complete, empty (0 promised, 0 landed), short, excess, unpromised (rows without a
    total), missing (never collected).
    """
    none = F.lit(None).cast("bigint")
    stacked = (
        landed.select(*keys, F.lit(1).cast("bigint").alias("_landed"), none.alias("_promised"))
        .unionByName(
            promised.select(*keys, none.alias("_landed"), F.col(total).cast("bigint").alias("_promised"))
        )
        .unionByName(grid.select(*keys, none.alias("_landed"), none.alias("_promised")))
    )
    cells = stacked.groupBy(*keys).agg(
        F.max("_promised").alias("promised_rows"),
        F.coalesce(F.sum("_landed"), F.lit(0)).alias("landed_rows"),
    )
    want, got = F.col("promised_rows"), F.col("landed_rows")
    status = (
        F.when(want.isNull() & (got == 0), "missing")
        .when(want.isNull(), "unpromised")
        .when((want == 0) & (got == 0), "empty")
        .when(got < want, "short")
        .when(got > want, "excess")
        .otherwise("complete")
    )
    return cells.withColumn("status", status)


def require_complete(audit: DataFrame, allow_empty: bool = True) -> None:
    """Raise unless every cell is complete."""
    fine = DONE if allow_empty else DONE[:1]
    bad = audit.where(~F.col("status").isin(fine))
    examples = bad.limit(5).collect()
    if examples:
        raise IncompleteLanding(f"incomplete, for example: {[row.asDict() for row in examples]}")
