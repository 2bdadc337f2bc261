"""Plain file writes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tramline.constants import CHUNK_ROWS
from tramline.functions import compact_date, compact_date_parts, pad_number


def write_json(rows: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Overwrite ``path`` with JSON lines, which later scans can split; nulls are written."""
    writer = rows.write.mode("overwrite").option("ignoreNullFields", False)
    writer.partitionBy(*partition_by).json(path)


def write_parquet(
    rows: DataFrame, path: str, partition_by: Sequence[str] = (), gather: bool = False
) -> None:
    """Overwrite ``path`` with Parquet, foldered by ``partition_by``.

    ``gather`` brings the rows of a folder together first, for input in which every task holds
    many days. It uses the rebalance hint, by which Spark still splits a folder that is too
    large for one task.
    """
    if gather and partition_by:
        rows = rows.hint("rebalance", *partition_by)
    rows.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_date_folders(rows: DataFrame, path: str, day: str, hour: str | None = None) -> None:
    """Overwrite ``path`` with JSON lines in ``yyyy=/mm=/dd=[/hh=]`` folders, all zero-padded."""
    pieces = compact_date_parts(compact_date(F.col(day)))
    if hour is not None:
        pieces["hh"] = pad_number(F.col(hour), 2)
    write_json(rows.withColumns(pieces), path, list(pieces))


def write_parquet_chunked(rows: DataFrame, path: str, max_rows: int = CHUNK_ROWS) -> None:
    """Overwrite ``path`` with Parquet files of at most ``max_rows`` rows each."""
    rows.write.mode("overwrite").option("maxRecordsPerFile", max_rows).parquet(path)
