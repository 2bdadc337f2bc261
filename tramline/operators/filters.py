"""Predicates. Columns are compared bare wherever possible, so Parquet can use them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F


def _all_present(columns: Sequence[str]) -> Column:
    """One IS NOT NULL per column, the form Parquet and partition pruning understand."""
    return reduce(Column.__and__, [F.col(f"`{name}`").isNotNull() for name in columns])


def filter_not_null(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.where(_all_present(columns))


def filter_not_like(rows: DataFrame, column: str, pattern: str) -> DataFrame:
    """``NOT LIKE``; a null value fails the predicate and is dropped too."""
    return rows.where(~F.col(column).cast("string").like(pattern))


def filter_in_list(rows: DataFrame, column: str, values: Sequence[Any]) -> DataFrame:
    return rows.where(F.col(column).isin(list(values)))


def require_fields(rows: DataFrame, *columns: str) -> DataFrame:
    """Drop a record that lacks any of the fields."""
    return filter_not_null(rows, *columns)


def high_water_mark(rows: DataFrame, stamp: str) -> str | None:
    """The newest stamp as text, a single value; None for an empty table.

    Reads that column only. Text in the session zone keeps the microseconds and is not
    shifted by the zone of the driver process.
    """
    return rows.agg(F.max(stamp).cast("string").alias("mark")).first()["mark"]


def filter_hwm(rows: DataFrame, stamp: str, mark: str | None) -> DataFrame:
    """Stamped rows strictly newer than ``mark``; all stamped rows when there is no mark.

    The mark is a constant of the column's own type, so the comparison reaches the Parquet
    statistics and old row groups are not read.
    """
    stamped = rows.where(F.col(stamp).isNotNull())
    if mark is None:
        return stamped
    return stamped.where(F.col(stamp) > F.lit(mark).cast(rows.schema[stamp].dataType))
