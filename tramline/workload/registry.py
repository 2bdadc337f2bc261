"""The query registry and access to the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import TimestampType

from tramline import sinks
from tramline.session import configure, scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The driver's tables at one scale, and fresh scratch paths for queries that write."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = configure(spark)
        self.folder = folder.rstrip("/")
        self._read: dict[str, DataFrame] = {}

    def location(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._read:
            self._read[name] = self.spark.read.parquet(self.location(name))
        return self._read[name]

    def scratch(self, label: str) -> str:
        return scratch_path(self.spark, label)

    def kept(self, name: str, rows: DataFrame) -> DataFrame:
        """A dimension is a table: written once, then measured and joined from its files."""
        return sinks.materialize(rows, "table", name, self.scratch(name))


def query(key: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``key``, with its SQL twin if there is one."""

    def add(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return zoneless(fn(Tables(spark, folder)))

        run.__name__ = key
        run.__doc__ = fn.__doc__
        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = sql.strip()
        return fn

    return add


def zoneless(rows: DataFrame) -> DataFrame:
    """Load stamps as plain UTC wall time, the form SQL timestamps compare in."""
    stamps = [field.name for field in rows.schema if isinstance(field.dataType, TimestampType)]
    return rows.withColumns({name: F.col(name).cast("timestamp_ntz") for name in stamps})
