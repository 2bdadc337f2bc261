"""Sharding by extendible hashing: only a bucket that is too large looks at one more bit."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from tramline.llm.common import parallelism, whole, written

#: Bytes of text a shard may hold.
SHARD_BYTES = 16 << 20
#: Bits of a code: 32 of the id's hash, then 31 that tell rows with one id apart.
_BITS, _ID_BITS = 63, 32
#: Bits by which a round looks deeper than an even spread would need.
_MARGIN = 3
#: A directory of up to this many cells (48 bytes each) is broadcast.
BROADCAST_CELLS = 200_000


def _sized(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(own, bytes, code): the hash of the id above the hash of the row's number."""
    of_id = F.conv(F.substring(F.md5(F.coalesce(F.col(id_column).cast("string"), F.lit(""))), 1, 8), 16, 10).cast("long")
    of_row = F.shiftrightunsigned(F.xxhash64(F.monotonically_increasing_id()), 33)
    return docs.select(
        F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("own"),
        F.octet_length(whole(F.col(text_column))).cast("long").alias("bytes"),
        F.shiftleft(of_id, _BITS - _ID_BITS).bitwiseOR(of_row).alias("code"),
    )


def directory(rows: DataFrame, limit: int) -> DataFrame:
    """(cell_depth, cell, depth, bucket, shard_bytes) that covers every ``code`` of ``rows``.

    A bucket of ``depth`` leading bits is split on the next bit while it holds more than
    ``limit`` bytes; so a row's bucket is that of the least depth that fits. Rows are counted by
    cells, a few bits finer than an even spread needs, and sums of all shorter prefixes follow
    from the cells. Cells that are still too large are looked at again, deeper, alone. What all
    bits do not split is one row: its bucket exceeds the limit by itself.
    """
    spark = rows.sparkSession
    total = rows.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    known: DataFrame | None = None
    least = 0
    left = rows.select("code", "bytes")
    while True:
        deep = min(_BITS, (least or max(0, math.ceil(math.log2(max(total / limit, 1))))) + (8 if least else _MARGIN))
        cells = written(
            left.groupBy(F.shiftrightunsigned("code", _BITS - deep).alias("cell")).agg(F.sum("bytes").alias("bytes")), "cells"
        )
        levels = cells.select("cell", "bytes", F.explode(F.sequence(F.lit(least), F.lit(deep))).alias("depth")).withColumn(
            "bucket", F.expr(f"shiftrightunsigned(cell, {deep} - depth)")
        )
        sums = levels.groupBy("depth", "bucket").agg(F.sum("bytes").alias("shard_bytes"))
        fits = sums.filter((F.col("shard_bytes") <= limit) | (F.col("depth") == _BITS))
        chosen = (
            levels.select("cell", "depth", "bucket")
            .join(fits, ["depth", "bucket"])
            .groupBy("cell")
            .agg(F.min(F.struct("depth", "bucket", "shard_bytes")).alias("to"))
            .select(F.lit(deep).alias("cell_depth"), "cell", "to.*")
        )
        chosen = written(chosen, "directory")
        known = chosen if known is None else known.union(chosen)
        if chosen.count() == cells.count():
            return known
        over = cells.select("cell").join(chosen.select("cell"), "cell", "left_anti")
        left = written(
            left.withColumn("cell", F.shiftrightunsigned("code", _BITS - deep)).join(over, "cell", "left_semi").select("code", "bytes"),
            "oversized",
        )
        least = deep


def assign_shards(
    docs: DataFrame, limit: int = SHARD_BYTES, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The rows of ``docs`` with ``shard`` = (depth, bucket, shard_bytes, bytes) added.

    ``bucket`` is the number made of the first ``depth`` bits of a row's code, so shards are the
    leaves of a binary tree and no row outside an oversized bucket moves when it splits. Rows
    that share an id, and null ids, which share one, are told apart by later bits from the row's
    number. Null text has no bytes; a row above the limit by itself is a shard alone at full
    depth; an empty table gives no rows. A column ``shard`` is replaced.
    """
    rows = written(_sized(docs.drop("shard"), id_column, text_column), "sized")
    cells = written(directory(rows, limit), "cells")
    depths = [row.cell_depth for row in cells.select("cell_depth").distinct().orderBy("cell_depth").collect()]
    small = cells.count() <= BROADCAST_CELLS
    at = F.explode(F.array(*(F.struct(F.lit(d).alias("cell_depth"), F.shiftrightunsigned("code", _BITS - d).alias("cell")) for d in depths)))
    if not depths:
        at = F.explode(F.array(F.struct(F.lit(0).alias("cell_depth"), F.lit(0).cast("long").alias("cell"))))
    named = rows.select("own", "bytes", at.alias("at")).select("own", "bytes", "at.*")
    placed = named.join(F.broadcast(cells) if small else cells, ["cell_depth", "cell"])
    return placed.select("own.*", F.struct("depth", "bucket", "shard_bytes", "bytes").alias("shard"))


def write_shards(docs: DataFrame, path: str, limit: int = SHARD_BYTES, id_column: str = "doc_id", text_column: str = "text") -> None:
    """Write each shard as a folder ``depth=/bucket=`` below ``path``."""
    own = assign_shards(docs, limit, id_column, text_column)
    flat = own.select(*docs.columns, "shard.depth", "shard.bucket")
    flat.repartition(parallelism(docs.sparkSession), "depth", "bucket").write.partitionBy("depth", "bucket").parquet(path)


def shard_digest(docs: DataFrame, limit: int = SHARD_BYTES) -> DataFrame:
    """(doc_id, bytes, depth, bucket, shard_bytes) of every row."""
    done = assign_shards(docs.select("doc_id", "text"), limit)
    return done.select("doc_id", "shard.bytes", "shard.depth", "shard.bucket", "shard.shard_bytes")
