"""Session settings the results and plans rely on, and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from typing import TypeVar

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession

T = TypeVar("T")

SETTINGS = {
    # Load stamps are UTC instants; every date is cut in UTC.
    "spark.sql.session.timeZone": "UTC",
    # INT64 micros carry min/max statistics, so the high-water-mark filter skips row groups.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # Write a day without sorting it first; a task that meets more days falls back to a sort.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    # HotSpot never compiles a method above 8000 bytes; let Spark split such a projection.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings; safe to call on a session somebody else built."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


_scope: ContextVar[str | None] = ContextVar("scratch folder of the step under way", default=None)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Scratch paths taken inside lie below one folder, which goes at the end.

    For a step whose result is written, outside that folder, before the end: what it was made
    from is not needed then, whatever executors are lost later.
    """
    folder = scratch_path(spark, "step")
    token = _scope.set(folder)
    try:
        yield
    finally:
        _scope.reset(token)
        remove(spark, folder)


def together(steps: Mapping[str, Callable[[], T]]) -> dict[str, T]:
    """The results of independent steps that run side by side, by name; a few, for each is a thread.

    Spark gives each step's jobs the cores that the others leave idle. The first error is raised
    when all have ended.
    """
    with ThreadPoolExecutor(max(len(steps), 1)) as pool:
        begun = {name: pool.submit(copy_context().run, step) for name, step in steps.items()}
    return {name: step.result() for name, step in begun.items()}


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder, if it is there."""
    place, fs = place_of(spark, path)
    fs.delete(place, True)


def scratch_path(spark: SparkSession, label: str = "scratch") -> str:
    """A fresh path below the folder all executors share (``spark.checkpoint.dir``).

    Without that setting it lies below the warehouse, never in a machine-local temporary folder.
    """
    base = _scope.get() or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return f"{base.rstrip('/')}/tramline-{label}-{uuid.uuid4().hex}"


def place_of(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """A Hadoop path and its file system."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())
