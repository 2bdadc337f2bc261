"""SimHash near-duplicates: a grid of segment bit counts, Manhattan distance as the lower bound.

A fingerprint of 64 bits is embedded as the bit counts of its 16 segments of 4 bits. Two
fingerprints that differ in d bits differ by at most d in the sum of absolute differences of
their counts, so all links lie between grid points at Manhattan distance 2 or less. Such points
share a point in the middle, at distance 1 or less from both; every fingerprint is entered at
its own point and at the points one step up or down in one segment, points are joined by
equality, and each candidate is verified on the fingerprints themselves.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from tramline.llm.common import in_small_batches, written
from tramline.llm.components import components

SHINGLE = 3
MAX_BITS = 2
_SEGMENTS, _SEGMENT_BITS = 16, 4
_FIELD = 3  # bits of a packed count: 0 to 4, 5 is never reached
#: Entries at one grid point that are still compared with each other.
CROWDED = 256
_CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The SimHash of a whole text, as a signed 64-bit number; no words give 0."""
    words = [] if not text else text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A to Z only
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) < shingle:
        hashes = np.array([xxhash.xxh64_intdigest(line, 42)], dtype=np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate(([0], ends[: len(words) - shingle])).tolist()
        stops = (ends[shingle - 1 :] - 1).tolist()
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter((digest(line[a:b], 42) for a, b in zip(starts, stops)), np.uint64, len(starts))
    ones = np.zeros(64, np.int64)
    for start in range(0, len(hashes), _CHUNK):
        part = hashes[start : start + _CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    set_bits = np.packbits(ones * 2 > len(hashes), bitorder="little")
    return int(set_bits.view("<i8")[0])


def fingerprints(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle: int = SHINGLE,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """(doc_id, fp, own) of every row; null text has the fingerprint 0."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(text, shingle) for text in texts], dtype="int64")

    own = F.struct(*(F.col(f"`{name}`") for name in keep)) if keep else F.lit(True)
    return in_small_batches(docs).select(
        F.col(id_column).alias("doc_id"), of(F.col(text_column).cast("string")).alias("fp"), own.alias("own")
    )


def _count(segment: int) -> Column:
    mask = (1 << _SEGMENT_BITS) - 1
    return F.bit_count(F.shiftright("fp", segment * _SEGMENT_BITS).bitwiseAND(F.lit(mask))).cast("long")


def _entries(prints: DataFrame) -> DataFrame:
    """(fp, step, point): own point (step 0), one up in segment s (s + 1), one down (-s - 1)."""
    own = reduce(lambda x, y: x + y, (F.shiftleft(_count(s), s * _FIELD) for s in range(_SEGMENTS)))
    counts = prints.select("fp", own.alias("own"))
    steps = [F.struct(F.lit(0).alias("step"), F.col("own").alias("point"))]
    for s in range(_SEGMENTS):
        one = 1 << (s * _FIELD)
        field = F.shiftright("own", s * _FIELD).bitwiseAND(F.lit((1 << _FIELD) - 1))
        up = F.struct(F.lit(s + 1).alias("step"), (F.col("own") + one).alias("point"))
        down = F.struct(F.lit(-s - 1).alias("step"), (F.col("own") - one).alias("point"))
        steps += [F.when(field < _SEGMENT_BITS, up), F.when(field > 0, down)]
    return counts.select("fp", F.inline(F.filter(F.array(*steps), lambda x: x.isNotNull())))


def near_links(prints: DataFrame) -> DataFrame:
    """(a, b): links that connect all distinct fingerprints ``fp`` within two bits of each other.

    Points with one entry drop out first. Entries of a point are compared pairwise, each pair
    from the one or two points of its kind of difference. Points with more than ``CROWDED``
    entries are refined instead: segments of one bit, where the bit counts are the bits and
    Manhattan distance is the exact distance. At most 65 fingerprints meet there, and all
    of them link, so a star to the smallest connects them without listing pairs.
    """
    entries = written(_entries(prints), "grid")
    sizes = entries.groupBy("point").agg(F.count("*").alias("n")).filter("n > 1")
    shared = written(entries.join(sizes, "point"), "grid-shared")
    left = shared.filter(F.col("n") <= CROWDED).drop("n")
    right = left.select("point", F.col("fp").alias("other"), F.col("step").alias("step2"))
    kinds = F.expr(
        "(step = 0 and step2 >= 0) or (step > 0 and step2 <= 0) or (step < 0 and step2 > 0)"
        " or (step > 0 and step2 > 0 and step <> step2)"
    )
    exact = F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= MAX_BITS
    pairs = left.join(right, "point").filter((F.col("fp") < F.col("other")) & kinds & exact)
    bits = [F.lit(np.int64(-(1 << 63)) if bit == 63 else 1 << bit).cast("long") for bit in range(64)]
    hubs = (
        shared.filter(F.col("n") > CROWDED)
        .select("fp")
        .distinct()
        .select("fp", F.explode(F.array(F.col("fp"), *(F.col("fp").bitwiseXOR(bit) for bit in bits))).alias("hub"))
    )
    stars = (
        hubs.groupBy("hub")
        .agg(F.collect_set("fp").alias("fps"))
        .filter(F.size("fps") > 1)
        .select(F.array_min("fps").alias("a"), F.explode("fps").alias("b"))
        .filter("a <> b")
    )
    return pairs.select(F.col("fp").alias("a"), F.col("other").alias("b")).union(stars)


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle: int = SHINGLE,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """(doc_id, fingerprint, component_id, root, own) of every row.

    ``component_id`` is the smallest id the row reaches by links, ``root`` names the component
    itself, ``own`` holds the columns ``keep`` of the row. Rows with the same fingerprint are one
    class; only classes are compared, so copies cost no pairs. Null and empty texts have
    fingerprint zero and link like any other. A null id keeps its row but names a component only
    if all ids in it are null. Rows that share an id stay separate. An empty table gives no rows.
    """
    prints = written(fingerprints(docs, id_column, text_column, shingle, keep), "prints")
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(near_links(classes.select("fp")))
    rooted = classes.join(roots, classes["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    rooted = written(rooted, "classes")
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(names, "root").select("fp", "component_id", "root")
    return prints.join(named, "fp", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "root", "own"
    )


def without_near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row of each component of ``docs``, with all its columns: that of the smallest id.

    Of rows that share this id, the one with the least fingerprint stays, then the least text.
    """
    found = near_duplicates(docs, id_column, text_column, keep=tuple(docs.columns))
    first = Window.partitionBy("root").orderBy("fingerprint", F.col("own").getField(text_column))
    named = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    return named.withColumn("nth", F.row_number().over(first)).filter("nth = 1").select("own.*")
