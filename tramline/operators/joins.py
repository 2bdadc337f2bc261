"""Inner equi-joins of a large side with a dimension, safe for any size and any skew."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, FloatType

from tramline.operators.filters import filter_not_null

# A side is broadcast only if it stays within both.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 128 * 1024 * 1024
# A key holding more than this share of the large side is cut into pieces of at most this share.
HOT_SHARE = 0.001


def fits(
    side: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Whether a side is small enough to broadcast, measured, not estimated.

    Every task sums what it reads, so a side too large to broadcast is no single task's work.
    """
    widths = [
        F.coalesce(F.octet_length(F.col(f"`{name}`").cast("string")), F.lit(0)) + 16
        for name in side.columns
    ]
    size = side.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(sum(widths, F.lit(0))), F.lit(0)).alias("bytes"),
    )
    found = size.first()
    return found["rows"] <= max_rows and found["bytes"] <= max_bytes


def attach(
    rows: DataFrame, dimension: DataFrame, keys: Sequence[str], max_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Inner join on same-named columns. Null keys never match; duplicate keys fan out.

    A dimension counted to be small is broadcast, so the large side does not move. Any other
    is shuffled by :func:`skew_join`. Keys must be of one type and not fractions at any size.
    """
    _check_keys(rows, dimension, list(keys))
    if fits(dimension, max_rows):
        return rows.join(F.broadcast(dimension), list(keys))
    return skew_join(rows, dimension, keys)


def skew_join(
    rows: DataFrame, dimension: DataFrame, keys: Sequence[str], share: float = HOT_SHARE
) -> DataFrame:
    """Shuffled inner join in which no key sends more than about ``share`` of the rows to one task.

    A frequent-items sketch over the key columns finds the hot keys in one pass, without
    shuffling keys; at most ``1/share`` of them come back. Rows of a hot key are spread over as
    many slots as it takes, and its dimension rows are copied to each of them. The sketch only
    decides how rows spread: the result is exact whatever it reports.
    """
    keys = list(keys)
    _check_keys(rows, dimension, keys)
    rows = filter_not_null(rows, *keys)
    most = math.floor(1 / share)
    # The sketch misjudges a count by at most 3.5 / tracked of the rows, well below the share.
    tracked = 16 * most
    found = (
        rows.select(F.xxhash64(*keys).alias("_print"))
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.expr(f"approx_top_k(_print, {most}, {tracked})").alias("top"),
        )
        .first()
    )
    ceiling = found["rows"] * share
    hot = [(it["item"], math.ceil(it["count"] / ceiling)) for it in found["top"] if it["count"] > ceiling]
    if not hot:
        return rows.join(dimension, keys)

    slots = F.broadcast(rows.sparkSession.createDataFrame(hot, "_print bigint, _slots int"))
    count = F.coalesce("_slots", F.lit(1))
    # Same slot again if a task is repeated; copies of one row differ by input partition.
    slot = F.pmod(F.pmod(F.xxhash64(*rows.columns), count) + F.spark_partition_id(), count).cast("int")
    each_slot = F.explode(F.sequence(F.lit(0), count - 1))
    spread = _with_slots(rows, keys, slots).withColumn("_slot", slot).drop("_print", "_slots")
    copied = _with_slots(dimension, keys, slots).withColumn("_slot", each_slot).drop("_print", "_slots")
    return spread.join(copied, [*keys, "_slot"]).drop("_slot")


def _with_slots(side: DataFrame, keys: list[str], slots: DataFrame) -> DataFrame:
    return side.withColumn("_print", F.xxhash64(*keys)).join(slots, "_print", "left")


def _check_keys(rows: DataFrame, dimension: DataFrame, keys: list[str]) -> None:
    """Equal keys must have equal hashes: one type on both sides, and no fractions."""
    for key in keys:
        kinds = {rows.schema[key].dataType, dimension.schema[key].dataType}
        if len(kinds) > 1 or kinds & {DoubleType(), FloatType()}:
            raise TypeError(f"cannot join on {key}: {sorted(map(str, kinds))}")


def join_distinct(
    usage: DataFrame,
    places: DataFrame,
    keys: Sequence[str],
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """DISTINCT of an inner join, with the duplicates removed before the join.

    Both inputs must already hold only output columns. Distinct inputs that share the join key
    as an output column join to distinct rows, so nothing is left to remove afterwards, and
    what moves is one row per station and task instead of every usage row. The size check
    counts the places before their own DISTINCT, an upper bound that costs no shuffle.
    """
    _check_keys(usage, places, list(keys))
    stations, spots = usage.distinct(), places.distinct()
    if fits(places, max_rows):
        return stations.join(F.broadcast(spots), list(keys))
    return skew_join(stations, spots, keys)
