"""Distinct, grouping and union. All combine on the map side before they shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def distinct_pairs(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.select(*columns).distinct()


def group_ordinals(rows: DataFrame, *columns: str) -> DataFrame:
    """``GROUP BY`` the listed columns without an aggregate: one row per combination."""
    return rows.select(*columns).dropDuplicates()


def distinct_sets(rows: DataFrame, *sets: Sequence[str]) -> DataFrame:
    """The distinct combinations of several column lists, by one read of ``rows``.

    One row per combination and list, with the list's place in ``_set`` and nulls for the columns
    of other lists; :func:`one_set` takes a list out again. Combined on the map side.
    """
    columns = list(dict.fromkeys(name for one in sets for name in one))
    numbers = [sum(1 << (len(columns) - 1 - at) for at, name in enumerate(columns) if name not in one) for one in sets]
    found = rows.groupingSets([list(one) for one in sets], *columns).agg(F.grouping_id().alias("_id"))
    place = F.array_position(F.array(*(F.lit(number).cast("bigint") for number in numbers)), F.col("_id").cast("bigint"))
    return found.withColumn("_set", (place - 1).cast("int")).drop("_id")


def one_set(found: DataFrame, place: int, *columns: str) -> DataFrame:
    """The combinations of one list of :func:`distinct_sets`."""
    return found.where(F.col("_set") == place).select(*columns)


def union_distinct(*frames: DataFrame) -> DataFrame:
    """``UNION`` by position of frames whose columns already have the same types."""
    first = frames[0].dtypes
    for frame in frames[1:]:
        if [kind for _, kind in frame.dtypes] != [kind for _, kind in first]:
            raise TypeError(f"cannot unite {frame.dtypes} with {first}")
    return reduce(DataFrame.union, frames).distinct()


def union_all_conformed(frames: list[DataFrame], columns: Mapping[str, str]) -> DataFrame:
    """``UNION ALL`` by name after casting every frame to the given column types."""
    conformed = [
        frame.select(*[_typed(frame, name, kind) for name, kind in columns.items()])
        for frame in frames
    ]
    return reduce(DataFrame.unionByName, conformed)


def _typed(frame: DataFrame, name: str, kind: str) -> Column:
    return frame[name].cast(kind).alias(name)


def sample_head(rows: DataFrame, *order: str | Column, n: int = 5) -> DataFrame:
    """The first ``n`` rows by an order, for a log line."""
    return rows.orderBy(*order).limit(n)
