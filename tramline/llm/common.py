"""What the text operators share: written intermediate tables and word rules."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tramline.session import scratch_path

#: Bytes of a batch that goes to a Python worker; one longer row is a batch of its own.
BATCH_BYTES = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(rows: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """``rows`` as a table in the shared folder (at ``path`` if one was chosen), read back.

    It cuts the lineage: a lost executor costs at most the step since the last written table.
    The step's shuffle files go as soon as its table is complete.
    """
    spark = rows.sparkSession
    path = path or scratch_path(spark, label)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        rows.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    return spark.read.schema(rows.schema).parquet(path)


def in_small_batches(rows: DataFrame) -> DataFrame:
    """``rows``, in a session that hands its texts to Python workers ``BATCH_BYTES`` at a time.

    The default counts rows, so a batch of whole texts has no bound on either side. The setting
    stays, for the plan that uses it runs later.
    """
    rows.sparkSession.conf.set(_BATCH, str(BATCH_BYTES))
    return rows


def give_back() -> None:
    """Give a worker's unused memory back; the process lives on after its task.

    Spark keeps more workers than run at a time, and what each was once given adds up. The C
    library's free memory goes too, where it has a call for that.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def parallelism(spark: SparkSession) -> int:
    """How many partitions an exchange with a stated number gets: what the session gives others."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def whole(text: Column) -> Column:
    """Null text counts as empty."""
    return F.coalesce(text.cast("string"), F.lit(""))


def one_text_each(texts: DataFrame, chosen: DataFrame) -> DataFrame:
    """(doc_id, label, text) of the few ``chosen`` (doc_id, label), one text an id however many rows share it.

    The text with the least hash, so partial minima bound what each task sends.
    """
    text = whole(F.col("text"))
    joined = texts.select("doc_id", text.alias("text")).join(F.broadcast(chosen.distinct()), "doc_id")
    return joined.groupBy("doc_id", "label").agg(F.min(F.struct(F.xxhash64("text"), F.col("text"))).alias("least")).select("doc_id", "label", F.col("least.text").alias("text"))


def words_of(text: str | None) -> list[bytes]:
    """The words between spaces and the control characters 9 to 13, as UTF-8, unchanged."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def pieces(batches: Iterable[pa.RecordBatch], size: int, weigh: str) -> Iterator[pa.RecordBatch]:
    """The batches in slices whose texts (column ``weigh``) have about ``size`` characters.

    A single longer text is a slice of its own, so memory follows the longest text.
    """
    for batch in batches:
        lengths = pa.compute.binary_length(batch.column(weigh)).fill_null(0).to_pylist()
        start = total = 0
        for at, length in enumerate(lengths):
            if at > start and total + length > size:
                yield batch.slice(start, at - start)
                start, total = at, 0
            total += length
        if batch.num_rows > start:
            yield batch.slice(start)
