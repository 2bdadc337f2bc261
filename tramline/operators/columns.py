"""Projections."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from tramline.functions.dates import run_date_minus_one


def project_columns(rows: DataFrame, *columns: str | Column) -> DataFrame:
    return rows.select(*columns)


def drop_strict(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop columns that must be there."""
    absent = [name for name in columns if name not in rows.columns]
    if absent:
        raise KeyError(f"cannot drop {absent}: not in {rows.columns}")
    return rows.drop(*columns)


def drop_if_exists(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.drop(*columns)


def rename_positional(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """Give every column a new name by its place."""
    if len(names) != len(rows.columns):
        raise ValueError(f"{len(names)} names for {len(rows.columns)} columns")
    return rows.toDF(*names)


def rename_map(rows: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Keep exactly the mapped columns, renamed, in the order of the map."""
    return rows.select(*[F.col(f"`{old}`").alias(new) for old, new in names.items()])


def audit_stamp(rows: DataFrame, run: datetime, *columns: str) -> DataFrame:
    """Stamp rows with the day a run is responsible for: the run time minus one day.

    A ``run`` without a zone is UTC, as is the session.
    """
    if run.tzinfo is not None:
        run = run.astimezone(timezone.utc).replace(tzinfo=None)
    stamp = run_date_minus_one(F.lit(run.isoformat(" ")).cast("timestamp"))
    return rows.withColumns({name: stamp for name in columns or ("_updated_at", "_loaded_at")})


def literal_columns(rows: DataFrame, values: Mapping[str, Any]) -> DataFrame:
    """Add constant columns; a None becomes a null text column."""
    return rows.withColumns(
        {
            name: F.lit(None).cast("string") if value is None else F.lit(value)
            for name, value in values.items()
        }
    )
