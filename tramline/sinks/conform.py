"""Fit a batch to the columns and types of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    DecimalType,
    IntegralType,
    NumericType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

_REJECTED, _ORIGIN = "_rejected_columns", "_origin"


class SchemaDrift(Exception):
    """A batch and its table disagree about columns or types."""


def _sources(rows: DataFrame, target: StructType) -> list[tuple[StructField, Column | None]]:
    """Each target field with the batch column of that name in any case, if there is one."""
    by_name: dict[str, list[int]] = {}
    for place, name in enumerate(rows.columns):
        by_name.setdefault(name.lower(), []).append(place)
    pairs = []
    for field in target:
        places = by_name.get(field.name.lower(), [])
        if len(places) > 1:
            raise SchemaDrift(f"{field.name} matches several columns of {rows.columns}")
        pairs.append((field, F.col(f"`{rows.columns[places[0]]}`") if places else None))
    return pairs


def _fitted(source: Column, have: DataType, want: DataType) -> Column:
    """The value in the wanted type; null if it does not fit or would change on the way."""
    value = source.try_cast(want)
    exact = isinstance(want, (IntegralType, DecimalType, DateType))
    if exact and isinstance(have, (NumericType, TimestampType, TimestampNTZType)):
        value = F.when(value.try_cast(have) == source, value)
    return value


def align_by_name(rows: DataFrame, target: StructType) -> DataFrame:
    """The target's columns, found by name in any case: a missing one is null, an extra one is
    ignored, a value that does not fit its type, or would change in it, stops the job."""
    columns = []
    for field, source in _sources(rows, target):
        kind = field.dataType
        if source is None:
            value = F.lit(None).cast(kind)
        elif (have := rows.select(source).schema[0].dataType) == kind:
            value = source
        else:
            bad = F.raise_error(F.concat(F.lit(f"{field.name}: bad value "), source.cast("string")))
            value = F.when(source.isNotNull(), F.coalesce(_fitted(source, have, kind), bad))
        columns.append(value.alias(field.name))
    return rows.select(*columns)


def load_continue(rows: DataFrame, target: StructType, origin: Sequence[str] = ()) -> DataFrame:
    """As :func:`align_by_name`, but a bad value marks its row instead of stopping the job.

    One pass gives all outcomes; read them with :func:`accepted`, :func:`rejected` and
    :func:`load_report`. ``origin`` names columns that say where a row comes from (a file, a place
    in it); they stay aside, in ``_origin``, and are no part of the table.
    """
    aside = [F.struct(*(f"`{name}`" for name in origin)).alias(_ORIGIN)] if origin else []
    whole, rows = rows, rows.drop(*origin)
    columns, faults = [], []
    for field, source in _sources(rows, target):
        if source is None:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        value = _fitted(source, rows.select(source).schema[0].dataType, field.dataType)
        columns.append(value.alias(field.name))
        faults.append(F.when(source.isNotNull() & value.isNull(), F.lit(field.name)))
    raw = F.to_json(F.struct(*(f"`{name}`" for name in rows.columns))).alias("_raw")
    return whole.select(*columns, F.array_compact(F.array(*faults)).alias(_REJECTED), raw, *aside)


def accepted(loaded: DataFrame) -> DataFrame:
    """Rows of a continued load whose every value fits."""
    return loaded.where(F.size(_REJECTED) == 0).drop(_REJECTED, "_raw", _ORIGIN)


def rejected(loaded: DataFrame) -> DataFrame:
    """Rows of a continued load with a value that does not fit: the row as landed, and why."""
    return loaded.where(F.size(_REJECTED) > 0).select("_raw", _REJECTED)


def load_report(loaded: DataFrame) -> DataFrame:
    """(file, status, rows_parsed, rows_loaded, errors_seen, first_error, first_error_column, first_error_row) by file.

    ``loaded`` comes from :func:`load_continue` with ``origin=["file", "at"]``: the file and an
    ascending place in it. ``status`` is loaded, partially_loaded or load_failed. Counts and the
    first error are partial minima and sums before the only shuffle, so a large file is no single
    task's work. Judge once and write it, then read both the rows and the report from that table.
    """
    bad = F.size(_REJECTED) > 0
    first = F.min(F.when(bad, F.struct(F.col("_origin.at").alias("at"), F.col(_REJECTED).alias("columns"), F.col("_raw").alias("raw"))))
    counts = loaded.groupBy(F.col("_origin.file").alias("file")).agg(
        F.count("*").alias("rows_parsed"), F.count(F.when(~bad, 1)).alias("rows_loaded"),
        F.sum(F.size(_REJECTED)).alias("errors_seen"), first.alias("first"),
    )
    status = (
        F.when(F.col("first").isNull(), "loaded").when(F.col("rows_loaded") > 0, "partially_loaded").otherwise("load_failed")
    )
    column = F.col("first.columns")[0]
    return counts.select(
        "file", status.alias("status"), "rows_parsed", "rows_loaded", "errors_seen",
        F.concat(column, F.lit(": value does not fit")).alias("first_error"),
        column.alias("first_error_column"), F.col("first.raw").alias("first_error_row"),
    )


def schema_guard(rows: DataFrame, target: StructType) -> DataFrame:
    """The batch in the target's column order; any difference in names or types raises."""
    have = {field.name: field.dataType for field in rows.schema}
    want = {field.name: field.dataType for field in target}
    if have != want:
        extra = {name: kind.simpleString() for name, kind in have.items() if want.get(name) != kind}
        lacking = {name: kind.simpleString() for name, kind in want.items() if have.get(name) != kind}
        raise SchemaDrift(f"batch has {extra}, table has {lacking}")
    return rows.select(*[f"`{field.name}`" for field in target])
