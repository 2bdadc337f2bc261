"""Table-write protocols on Parquet tables: replace days, full refresh, append, increment.

A table is a folder. Writes go through Spark's commit protocol, so a lost executor costs a
repeated task, not wrong rows. Every protocol but the plain append can be repeated.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from tramline.operators.filters import filter_hwm, high_water_mark
from tramline.session import place_of
from tramline.sinks.conform import schema_guard
from tramline.sources.audit import DONE


def read_if_present(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None before its first load (no folder, or one without files)."""
    place, fs = place_of(spark, path)
    if not fs.exists(place):
        return None
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return None
        raise


def replace_by_date(batch: DataFrame, path: str, day: date, column: str = "usage_date") -> None:
    """Make ``batch`` the whole content of one day of the table; repeating it changes nothing."""
    replace_days(batch, path, [day], column)


def only_days(rows: DataFrame, days: Sequence[date], column: str) -> DataFrame:
    """``rows``, in which a row of any other day stops the job."""
    stray = F.raise_error(
        F.concat(F.lit("row of another day: "), F.coalesce(F.col(column).cast("string"), F.lit("null")))
    )
    return rows.withColumn(column, F.when(F.col(column).isin(list(days)), F.col(column)).otherwise(stray))


def replace_days(
    batch: DataFrame, path: str, days: Sequence[date], column: str = "usage_date"
) -> None:
    """Make ``batch`` the whole content of the given days; other days are not touched.

    * A row of any other day stops the job before anything is replaced.
    * Old files go only when the new ones are complete (dynamic partition overwrite), so a
      failed batch leaves the table as it was.
    * That mode ignores days without rows, so those are emptied afterwards on their own.

    Rows are not shuffled: each task writes its part of a day, whatever the day's size.
    """
    written = Observation()
    (
        only_days(batch, days, column)
        .observe(written, F.collect_set(column).alias("days"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .parquet(path)
    )
    empty = batch.sparkSession.createDataFrame([], batch.drop(column).schema)
    for day in sorted(set(days) - set(written.get["days"])):
        empty.write.mode("overwrite").parquet(f"{path}/{column}={day.isoformat()}")


def full_refresh(rows: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Make ``rows`` the whole table.

    The new table is written next to the old one and takes its place by rename once it is
    complete. A failed run leaves the old table, and ``rows`` may be computed from it. If a
    driver died between the two renames, :func:`restore` brings the old table back first.
    """
    folder, _, name = path.rstrip("/").rpartition("/")
    mark = f"{folder}/_{name}-{uuid.uuid4().hex}"
    place, fs = place_of(rows.sparkSession, path)
    restore(rows.sparkSession, path)
    rows.write.partitionBy(*partition_by).parquet(f"{mark}-new")
    fresh, _ = place_of(rows.sparkSession, f"{mark}-new")
    former, _ = place_of(rows.sparkSession, f"{mark}-old")
    replacing = fs.exists(place)
    if replacing and not fs.rename(place, former):
        raise OSError(f"cannot set {path} aside")
    if not fs.rename(fresh, place):
        if replacing:
            fs.rename(former, place)
        raise OSError(f"cannot move the new table to {path}")
    if replacing:
        fs.delete(former, True)


def restore(spark: SparkSession, path: str) -> bool:
    """Bring back the table a broken-off full refresh had set aside; whether there was one."""
    folder, _, name = path.rstrip("/").rpartition("/")
    place, fs = place_of(spark, path)
    if fs.exists(place):
        return False
    pattern, _ = place_of(spark, f"{folder}/_{name}-*-old")
    aside = [found.getPath() for found in fs.globStatus(pattern) or []]
    if len(aside) > 1:
        raise OSError(f"several old tables of {path}: {[str(x) for x in aside]}")
    return bool(aside) and bool(fs.rename(aside[0], place))


def append_load(
    rows: DataFrame, path: str, partition_by: Sequence[str] = (), gather: bool = False
) -> None:
    """Add all rows, without any check for repeats; the schema must be the table's.

    ``gather`` brings the rows of a folder together first, for loads of many folders at once;
    a large folder is still written by several tasks.
    """
    target = read_if_present(rows.sparkSession, path)
    if target is not None:
        rows = schema_guard(rows, target.schema)
    if gather and partition_by:
        rows = rows.hint("rebalance", *partition_by)
    rows.write.mode("append").partitionBy(*partition_by).parquet(path)


def incremental_append(
    rows: DataFrame, path: str, stamp: str = "_loaded_at", partition_by: Sequence[str] = ()
) -> str | None:
    """Append the rows stamped later than anything in the table; return the mark used.

    A first run (no table, or an empty one) takes all stamped rows. Rows stamped at or below
    the mark are skipped by design; :func:`late_rows` shows them.
    """
    target = read_if_present(rows.sparkSession, path)
    mark = None if target is None else high_water_mark(target, stamp)
    append_load(filter_hwm(rows, stamp, mark), path, partition_by, gather=mark is None)
    return mark


def late_rows(rows: DataFrame, mark: str, stamp: str = "_loaded_at") -> DataFrame:
    """Rows an increment above ``mark`` leaves out."""
    return rows.where(F.col(stamp) <= F.lit(mark).cast(rows.schema[stamp].dataType))


def materialize(
    rows: DataFrame,
    kind: str,
    name: str,
    path: str | None = None,
    stamp: str = "_loaded_at",
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Keep a model the way its kind says, and return it ready to read.

    ephemeral: the lazy frame itself; view: a temporary view; table: rebuilt on every run;
    incremental: appended above its high-water mark.
    """
    spark = rows.sparkSession
    if kind == "ephemeral":
        return rows
    if kind == "view":
        rows.createOrReplaceTempView(name)
        return spark.table(name)
    if path is None:
        raise ValueError(f"a model of kind {kind!r} needs a path")
    if kind == "table":
        full_refresh(rows, path, partition_by)
    elif kind == "incremental":
        incremental_append(rows, path, stamp, partition_by)
    else:
        raise ValueError(f"unknown kind {kind!r}")
    return spark.read.parquet(path)


def ingest_days_if_complete(
    batch: DataFrame, audit: DataFrame, path: str, column: str = "usage_date"
) -> list[date]:
    """Replace the days whose every audited cell is complete; leave all others as they are.

    Returns the replaced days. Only days are collected, never rows.
    """
    days = complete_days(audit, column)
    if days:
        replace_days(batch.where(F.col(column).isin(days)), path, days, column)
    return days


def complete_days(audit: DataFrame, column: str = "usage_date") -> list[date]:
    """The days whose every audited cell is complete, sorted."""
    done = F.every(F.col("status").isin(DONE))
    whole = audit.groupBy(column).agg(done.alias("done")).where("done").select(column)
    return sorted(row[column] for row in whole.collect())
