"""Token-id files: patched frame-of-reference blocks in pages of whole documents.

File format (version 2). A file is a Parquet file, so that any cluster file system can hold it;
its rows are pages. A page holds the ids of consecutive documents, one behind the other:

==============  ======  =====================================================================
shard, page     int     the range partition of the page, and its place there
first           long    ids before the page in its shard
n_ids           long    ids in the page
nulls           int     documents at the page's beginning that have no id; ``docs`` holds 0 for them
docs            binary  the documents' ids, little-endian int64, ascending over the whole file
lengths         binary  ids of each document, little-endian int64
index           binary  start of each block in ``blocks``, little-endian uint32
blocks          binary  the blocks, 128 ids each but for the last
==============  ======  =====================================================================

A block is: minimum (uint32), ids (uint16), width in bits (uint8), exceptions (uint8), then the
low ``width`` bits of every id less the minimum, then each exception's place (uint8) and its
high bits (uint32). The width holds ``PERCENTILE`` of a block's ids; the rest are exceptions.
The index lets a reader open any block without its neighbours.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tramline.llm.common import give_back, in_small_batches, parallelism, pieces, whole
from tramline.llm.tokens import encoded
from tramline.session import scratch_path

BLOCK = 128
PERCENTILE = 0.9
#: Ids after which a page ends; a longer document is a page of its own.
PAGE_IDS = 1 << 16
#: Characters tokenized at a time in one task; what is made on the way is several times as large.
SLICE_CHARS = 1 << 20

#: Blocks packed or unpacked at a time; a long document's page has many more.
_TOGETHER = 512

_HEAD = struct.Struct("<IHBB")
_PAGE = (
    "shard int, page int, first long, n_ids long, "
    "nulls int, docs binary, lengths binary, index binary, blocks binary"
)


# --- blocks


def _packed(values: np.ndarray, width: int) -> np.ndarray:
    """The low ``width`` bits of each row's values, rows padded to whole bytes."""
    octets = values.astype("<u2" if width <= 16 else "<u4")
    bits = np.unpackbits(octets.view(np.uint8).reshape(*values.shape, octets.itemsize), axis=2, bitorder="little")
    return np.packbits(bits[:, :, :width].reshape(len(values), -1), axis=1, bitorder="little")


def _block_bytes(block: np.ndarray, low: int, width: int, packed: bytes) -> bytes:
    """One block from its values above the minimum."""
    places = np.flatnonzero(block >> width) if width < 32 else np.empty(0, np.intp)
    return b"".join(
        (
            _HEAD.pack(low, len(block), width, len(places)),
            packed,
            places.astype(np.uint8).tobytes(),
            (block[places] >> width).astype("<u4").tobytes(),
        )
    )


def _widths(blocks: np.ndarray) -> np.ndarray:
    """Bits that hold the percentile of each row."""
    at = min(blocks.shape[1] - 1, int(np.ceil(blocks.shape[1] * PERCENTILE)) - 1)
    value = np.partition(blocks, at, axis=1)[:, at]
    return np.ceil(np.log2(value.astype(np.float64) + 1)).astype(np.int64)


def _full_blocks(blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sizes, bytes) of full blocks, one behind the other."""
    low = blocks.min(axis=1)
    above = blocks - low[:, None]
    width = _widths(above)
    high = (above.astype(np.uint64) >> width[:, None].astype(np.uint64)).astype("<u4")
    row, place = np.nonzero(high)
    outside = np.bincount(row, minlength=len(blocks))
    sizes = _HEAD.size + BLOCK // 8 * width + 5 * outside
    starts = np.cumsum(sizes) - sizes
    made = np.empty(int(sizes.sum()), np.uint8)
    heads = np.empty(len(blocks), np.dtype([("low", "<u4"), ("ids", "<u2"), ("width", "u1"), ("outside", "u1")]))
    heads["low"], heads["ids"], heads["width"], heads["outside"] = low, BLOCK, width, outside
    made[starts[:, None] + np.arange(_HEAD.size)] = heads.view(np.uint8).reshape(-1, _HEAD.size)
    for bits in map(int, np.unique(width)):
        rows = np.flatnonzero(width == bits)
        made[starts[rows][:, None] + (_HEAD.size + np.arange(BLOCK // 8 * bits))] = _packed(above[rows], bits)
    nth = np.arange(len(row)) - (np.cumsum(outside) - outside)[row]
    at = (starts + sizes - 5 * outside)[row]
    made[at + nth] = place
    made[(at + outside[row] + 4 * nth)[:, None] + np.arange(4)] = high[row, place].view(np.uint8).reshape(-1, 4)
    return sizes, made


def encode_blocks(ids: np.ndarray) -> tuple[bytes, bytes]:
    """(index, blocks) of a run of unsigned 32-bit ids."""
    ids = np.ascontiguousarray(ids, dtype=np.uint32)
    full = ids[: len(ids) // BLOCK * BLOCK].reshape(-1, BLOCK)
    parts = [_full_blocks(full[at : at + _TOGETHER]) for at in range(0, len(full), _TOGETHER)]
    rest = ids[full.size :][None, :]
    if rest.size:
        low = rest.min()
        above = rest - low
        width = int(_widths(above)[0])
        last = _block_bytes(above[0], int(low), width, _packed(above, width).tobytes())
        parts.append((np.asarray([len(last)]), np.frombuffer(last, np.uint8)))
    sizes = np.concatenate([np.zeros(0, np.int64), *(sizes for sizes, _ in parts)])
    return (np.cumsum(sizes) - sizes).astype("<u4").tobytes(), b"".join(made.tobytes() for _, made in parts)


def decode_block(blocks: bytes, start: int) -> np.ndarray:
    """The ids of the block at ``start``."""
    low, count, width, outside = _HEAD.unpack_from(blocks, start)
    at = start + _HEAD.size
    size = (count * width + 7) // 8
    bits = np.unpackbits(np.frombuffer(blocks, np.uint8, size, at), count=count * width, bitorder="little")
    values = bits.reshape(count, width).astype(np.uint32) @ (np.uint32(1) << np.arange(width, dtype=np.uint32))
    if outside:
        places = np.frombuffer(blocks, np.uint8, outside, at + size)
        values[places] |= np.frombuffer(blocks, "<u4", outside, at + size + outside) << np.uint32(width)
    return (values + np.uint32(low)).astype(np.uint32)


def decode_blocks(index: bytes, blocks: bytes) -> np.ndarray:
    """All ids of a page; full blocks of one width are unpacked together."""
    starts = np.frombuffer(index, "<u4").astype(np.int64)
    if not len(starts):
        return np.empty(0, np.uint32)
    raw = np.frombuffer(blocks, np.uint8)
    width, outside = raw[starts + 6], raw[starts + 7]
    full = starts[:-1]
    out = np.empty((len(starts), BLOCK), np.uint32)
    low = raw[starts[:, None] + np.arange(4)].copy().view("<u4")[:, 0]
    for bits in map(int, np.unique(width[:-1])):
        size, octets = BLOCK * bits // 8, 2 if bits <= 16 else 4
        alike = np.flatnonzero(width[:-1] == bits)
        for rows in (alike[at : at + _TOGETHER] for at in range(0, len(alike), _TOGETHER)):
            data = raw[full[rows][:, None] + (_HEAD.size + np.arange(size))]
            whole_bits = np.zeros((len(rows), BLOCK, 8 * octets), np.uint8)
            whole_bits[:, :, :bits] = np.unpackbits(data, axis=1, bitorder="little").reshape(len(rows), BLOCK, bits)
            out[rows] = np.packbits(whole_bits.reshape(len(rows), -1), axis=1, bitorder="little").view(f"<u{octets}")
    more = outside[:-1].astype(np.int64)
    row = np.repeat(np.arange(len(more)), more)
    nth = np.arange(len(row)) - (np.cumsum(more) - more)[row]
    at = (full + _HEAD.size + BLOCK // 8 * width[:-1].astype(np.int64))[row]
    high = raw[(at + more[row] + 4 * nth)[:, None] + np.arange(4)].view("<u4")[:, 0]
    out[row, raw[at + nth]] |= (high.astype(np.uint64) << width[row].astype(np.uint64)).astype(np.uint32)
    out += low[:, None]
    last = decode_block(blocks, int(starts[-1]))
    return np.concatenate([out[:-1].ravel(), last])


# --- files


def tokenize(
    docs: DataFrame, tokenizer: str, end_id: int, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(doc, ids): each whole text's ids, little-endian uint32, with ``end_id`` behind them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, SLICE_CHARS, "text"):
            ids, ends = encoded(tokenizer, part.column("text"), end_id)
            spans = pa.py_buffer(np.concatenate([[0], ends * 4]).astype(np.int32))
            held = pa.Array.from_buffers(pa.binary(), part.num_rows, [None, spans, pa.py_buffer(ids)])
            yield pa.RecordBatch.from_arrays([part.column("doc"), held], ["doc", "ids"])
        give_back()

    rows = in_small_batches(docs).select(F.col(id_column).cast("long").alias("doc"), whole(F.col(text_column)).alias("text"))
    return rows.mapInArrow(run, "doc long, ids binary")


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> None:
    """Write the ids of ``docs`` in ascending document id to files below ``path``.

    Null text counts as empty: its document has the end id alone. Rows with a null id come
    first and keep it; rows that share an id stay separate, in no stated order. An empty table
    gives files without pages. A range exchange on the id gives each task one shard, whatever
    the order of the input; rows of one id, or of none, may spread over several. The task
    tokenizes as it writes, so ids never move. To find the ranges ``docs`` is read twice: pass a
    table, not a costly plan.
    """
    spark = docs.sparkSession

    def pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, page, first = TaskContext.get().partitionId(), 0, 0
        doc_ids: list[int | None] = []
        held: list[np.ndarray] = []
        size = 0

        def close() -> pa.RecordBatch:
            nonlocal page, first, size
            index, blocks = encode_blocks(np.concatenate(held))
            row = {
                "shard": shard, "page": page, "first": first, "n_ids": size,
                "nulls": doc_ids.count(None), "docs": np.asarray([doc or 0 for doc in doc_ids], "<i8").tobytes(),
                "lengths": np.asarray([len(x) for x in held], "<i8").tobytes(),
                "index": index, "blocks": blocks,
            }
            page, first, size = page + 1, first + size, 0
            doc_ids.clear()
            held.clear()
            return pa.RecordBatch.from_pylist([row], schema=_PAGE_ARROW)

        for part in pieces(batches, SLICE_CHARS, "text"):
            ids, ends = encoded(tokenizer, part.column("text"), end_id)
            for doc, own in zip(part.column("doc").to_pylist(), np.split(ids, ends[:-1])):
                if held and size + len(own) > PAGE_IDS:
                    yield close()
                doc_ids.append(doc)
                held.append(own)
                size += len(own)
        if held:
            yield close()
        give_back()

    (
        docs.select(F.col(id_column).cast("long").alias("doc"), whole(F.col(text_column)).alias("text"))
        # By content and input partition, so a repeated task sends its rows to the same place.
        .withColumn("spread", F.xxhash64("text", F.spark_partition_id()))
        .repartitionByRange(parallelism(spark), "doc", "spread")
        .sortWithinPartitions("doc")
        .mapInArrow(pages, _PAGE)
        .write.option("compression", "none")
        .parquet(path)
    )


_PAGE_ARROW = pa.schema(
    [
        ("shard", pa.int32()), ("page", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int64()),
        ("nulls", pa.int32()), ("docs", pa.binary()), ("lengths", pa.binary()), ("index", pa.binary()), ("blocks", pa.binary()),
    ]
)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, ids) of every document: ``start`` counts the ids of all before it, null ids first.

    Starts need only each shard's total, one row a shard; ids are decoded page by page.
    """
    pages = spark.read.schema(_PAGE).parquet(path)
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        pages.groupBy("shard")
        .agg(F.sum("n_ids").alias("total"))
        .select("shard", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    )

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                page = {name: batch.column(name)[row].as_py() for name in batch.schema.names}
                ids = decode_blocks(page["index"], page["blocks"])
                docs = np.frombuffer(page["docs"], "<i8")
                ends = np.cumsum(np.frombuffer(page["lengths"], "<i8"))
                starts = ends - np.frombuffer(page["lengths"], "<i8")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(docs, mask=np.arange(len(docs)) < page["nulls"]),
                        pa.array(starts + page["first"] + page["base"]),
                        pa.array([ids[a:b].astype("<u4").tobytes() for a, b in zip(starts, ends)], pa.binary()),
                    ],
                    ["doc_id", "start", "ids"],
                )

    return pages.join(F.broadcast(bases), "shard").mapInArrow(documents, "doc_id long, start long, ids binary")


def token_file_digest(spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Write the files, read them back, and tell what they hold of each document."""
    path = scratch_path(spark, "token-files")
    write_token_files(docs, path, tokenizer, end_id)
    return read_token_files(spark, path).select(
        "doc_id",
        "start",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )
