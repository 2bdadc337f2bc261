"""Approximate nearest neighbours on shifted Hilbert curves.

Unit vectors are projected to subspaces of a few dimensions, shifted, and put in the order of a
Hilbert curve in each. Near vectors are often near in some order, so a query looks at a window
of vectors on either side of it in every order and ranks them on the vectors themselves.

How far apart true neighbours stand depends on the vectors and on their number. So the window is
measured: the true neighbours of ``SAMPLE`` queries are found by comparing them with all vectors,
and the window is as wide as it takes to meet ``TARGET`` of them in some order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import FloatType

from tramline.llm.common import in_small_batches, parallelism, written

ROTATIONS = 8
DIMENSIONS = 10
#: Bits of a coordinate on the curve: groups whose vectors differ by 1e-7 are still in order.
BITS = 24
#: The least window; a measured one is wider where the vectors need it.
WINDOW = 256
#: Queries whose true neighbours set the window, and the share of these it must reach.
SAMPLE = 200
TARGET = 0.96
#: Scores a task holds at a time.
SCORES = 4 << 20
#: Candidates a query keeps of a window block, beyond the neighbours asked for.
SPARE = 3


def _hilbert_axes(cells: np.ndarray, bits: int) -> np.ndarray:
    """The transposed places on the Hilbert curve of points with coordinates of ``bits`` bits.

    The public axes-to-transpose method (Skilling 2004), for all points at once.
    """
    x = np.ascontiguousarray(cells.T, dtype=np.uint32)
    top = 1 << (bits - 1)
    size = top
    while size > 1:
        low = np.uint32(size - 1)
        for axis in range(len(x)):
            high = (x[axis] & np.uint32(size)) != 0
            swap = np.where(high, 0, (x[0] ^ x[axis]) & low).astype(np.uint32)
            x[axis] ^= swap
            x[0] ^= np.where(high, low, swap).astype(np.uint32)
        size >>= 1
    for axis in range(1, len(x)):
        x[axis] ^= x[axis - 1]
    flip, size = np.zeros_like(x[0]), top
    while size > 1:
        flip ^= np.where((x[-1] & np.uint32(size)) != 0, np.uint32(size - 1), np.uint32(0))
        size >>= 1
    return x ^ flip


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve as numbers (bits x dimensions <= 63)."""
    x = _hilbert_axes(cells, bits)
    key = np.zeros(x.shape[1], np.int64)
    for bit in range(bits - 1, -1, -1):
        for axis in x:
            key = (key << 1) | ((axis >> np.uint32(bit)) & 1)
    return key


def hilbert_bytes(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve as rows of bytes in the same order, for any bits x dimensions."""
    x = _hilbert_axes(cells, bits)
    return np.packbits(np.concatenate([(x >> np.uint32(bit)) & 1 for bit in range(bits - 1, -1, -1)]).astype(np.uint8).T, axis=1)


class Orders:
    """The projections and shifts; the same for every task, whatever the data."""

    def __init__(self, width: int, rotations: int = ROTATIONS, dimensions: int = DIMENSIONS, bits: int = BITS, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.bits, self.dimensions, self.spaces, self.shifts = bits, min(dimensions, width), [], []
        for _ in range(rotations):
            rotation = np.linalg.qr(rng.normal(size=(width, width)))[0]
            for first in range(0, width - self.dimensions + 1, self.dimensions):
                self.spaces.append(rotation[:, first : first + self.dimensions])
                self.shifts.append(rng.uniform(0, 1, self.dimensions))
        # A coordinate of a unit vector has a spread of about 1 / sqrt(width); four spreads each
        # way fill the grid, what is beyond goes to its edge.
        self.scale = np.sqrt(width) / 8

    def keys(self, unit: np.ndarray) -> list[np.ndarray]:
        """The place of each vector in each order; shifts are up to a sixteenth of the grid."""
        cells = 1 << self.bits
        return [
            hilbert_bytes(np.clip(np.floor(((unit @ space * self.scale + 0.5) * 15 + shift) / 16 * cells), 0, cells - 1), self.bits)
            for space, shift in zip(self.spaces, self.shifts)
        ]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows, padded with zeros to ``width``."""
    sizes = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(sizes) and (sizes == width).all():
        return values.reshape(-1, width)
    rows = np.zeros((len(sizes), width))
    rows[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return rows


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # no overflow in the squares
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _binary(rows: np.ndarray) -> pa.Array:
    """Each row's bytes."""
    rows = np.ascontiguousarray(rows)
    ends = np.arange(len(rows) + 1, dtype=np.int32) * (rows.shape[1] * rows.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(rows)])


def _usable(vector: Column) -> Column:
    """Neither null nor zero, nor with a null or non-finite component."""
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def _entries(orders: Orders, width: int, kind: type):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _matrix(batch.column("vector"), width)
            vector = _binary(rows.astype(kind))
            for order, key in enumerate(orders.keys(_unit(rows))):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(key), order, np.int32)), _binary(key), batch.column("ref"), batch.column("asked"), vector],
                    ["curve", "key", "ref", "asked", "vector"],
                )

    return run


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a sorted partition with the partition and the place in it."""
    part, at = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(name) for name in ("curve", "ref", "asked", "vector")), pa.array(np.full(n, part, np.int32)), pa.array(np.arange(at, at + n))],
            ["curve", "ref", "asked", "vector", "part", "at"],
        )
        at += n


def _closest(refs: np.ndarray, queries: np.ndarray, k: int):
    """The ``k`` best of all vectors of a task for each of a few queries (unit vectors)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score, other = np.empty((len(refs), 0)), np.empty((len(refs), 0), np.int64)
        for batch in batches:
            ref = batch.column("ref").to_numpy()
            now = queries @ _unit(_matrix(batch.column("vector"), queries.shape[1])).T
            now[refs[:, None] == ref[None, :]] = -2
            score, other = np.hstack([score, now]), np.hstack([other, np.broadcast_to(ref, now.shape)])
            top = np.argsort(-score, axis=1, kind="stable")[:, :k]
            score, other = np.take_along_axis(score, top, axis=1), np.take_along_axis(other, top, axis=1)
        found = score > -2
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.broadcast_to(refs[:, None], other.shape)[found]), pa.array(other[found]), pa.array(score[found])],
            ["ref", "other", "score"],
        )

    return run


def _measured_window(classes: DataFrame, ranked: DataFrame, width: int, k: int) -> int:
    """The window that meets ``TARGET`` of the true neighbours of a sample of queries.

    What comes to the driver is bounded by the sample, its neighbours and the number of orders.
    """
    sample = classes.filter("asked").orderBy(F.xxhash64("ref"), "ref").select("ref", "vector").limit(SAMPLE).collect()
    if not sample:
        return WINDOW
    rows = np.zeros((len(sample), width))
    for row, x in zip(rows, sample):
        row[: len(x.vector)] = x.vector
    refs = np.array([x.ref for x in sample], np.int64)
    best = Window.partitionBy("ref").orderBy(F.desc("score"), "other")
    truth = (
        classes.select("ref", "vector")
        .mapInArrow(_closest(refs, _unit(rows), k), "ref long, other long, score double")
        .withColumn("nth", F.row_number().over(best))
        .filter(F.col("nth") <= k)
        .select("ref", "other")
        .collect()
    )
    if not truth:
        return WINDOW
    wanted = classes.sparkSession.createDataFrame([(x,) for x in sorted({x for pair in truth for x in pair})], "ref long")
    place = {}
    for curve, ref, rank in ranked.join(F.broadcast(wanted), "ref").select("curve", "ref", "rank").collect():
        place.setdefault(ref, {})[curve] = rank
    gaps = sorted(min(abs(rank - place[other][curve]) for curve, rank in place[ref].items()) for ref, other in truth)
    return max(WINDOW, gaps[int(np.ceil(TARGET * len(gaps))) - 1])


def _best_in_blocks(width: int, window: int, most: int, kind: type):
    """Each query's best candidates of a block. Rows come sorted by block, a block's vectors first."""

    def best(rows: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        block, probe = rows.column("block").to_numpy(), rows.column("probe").to_numpy(zero_copy_only=False)
        curve, rank, ref = (rows.column(name).to_numpy() for name in ("curve", "rank", "ref"))
        unit = _unit(np.frombuffer(b"".join(rows.column("vector").to_pylist()), kind).reshape(-1, width).astype(np.float64))
        edges = np.flatnonzero(np.diff(block, prepend=block[0] - 1, append=block[-1] + 1))
        for a, b in zip(edges[:-1], edges[1:]):
            m = a + int(np.count_nonzero(~probe[a:b]))
            if m == a or m == b:
                continue
            step = max(1, SCORES // (m - a))
            for c in range(m, b, step):
                d = min(b, c + step)
                score = unit[c:d] @ unit[a:m].T
                near = (np.abs(rank[c:d, None] - rank[None, a:m]) <= window) & (curve[c:d, None] == curve[None, a:m])
                score[~near | (ref[c:d, None] == ref[None, a:m])] = -2
                top = np.argpartition(-score, min(most, score.shape[1]) - 1, axis=1)[:, :most]
                found = np.take_along_axis(score, top, axis=1) > -2
                yield np.broadcast_to(ref[c:d, None], top.shape)[found], ref[a:m][top][found]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def pairs(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            for query, other in best(rows):
                yield pa.RecordBatch.from_arrays([pa.array(query), pa.array(other)], ["ref", "other"])

        for batch in batches:
            rows = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            if not rows.num_rows:
                continue
            block = rows.column("block").to_numpy()
            done = int(np.searchsorted(block, block[-1]))
            if done:
                yield from pairs(rows.slice(0, done))
            held = rows.slice(done).combine_chunks()
        if held is not None and held.num_rows:
            yield from pairs(held)

    return run


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    rotations: int = ROTATIONS,
    window: int | None = None,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows with the largest cosine found for each query.

    Every usable row is indexed and a candidate for all queries but itself. Null and zero vectors
    and those with null or non-finite components take no part, nor do rows without an id; a
    shorter vector counts as padded with zeros. Vectors on one ray are one entry that carries its
    ``k`` + 1 smallest ids, so a vector that a third of all rows share costs one entry. Ties go
    to the smaller id, and rows that share an id are all candidates for the other ids. Without a
    ``window`` it is measured.
    """
    spark = vectors.sparkSession
    n = parallelism(spark)
    element = getattr(vectors.select(vector_column).schema[0].dataType, "elementType", None)
    kind, name = (np.float32, "float") if isinstance(element, FloatType) else (np.float64, "double")
    usable = vectors.select(
        F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast(f"array<{name}>").alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asked"),
    ).filter(F.col("id").isNotNull() & _usable(F.col("vector")))
    # Quotients are rounded once, so all vectors on one ray have the same.
    largest = F.array_max(F.transform("vector", lambda x: F.abs(x).cast("double")))
    usable = usable.withColumn("largest", largest).withColumn("ray", F.transform("vector", lambda x: x.cast("double") / F.col("largest")))
    usable = usable.withColumn("class", F.xxhash64("ray")).drop("largest")
    first = Window.partitionBy("class", "ray").orderBy("id")
    classes = (
        usable.select("class", "ray", "vector", "id")
        .withColumn("nth", F.row_number().over(first))
        .filter(F.col("nth") <= k + 1)
        .groupBy("class", "ray")
        .agg(F.sort_array(F.collect_list("id")).alias("ids"), F.min("vector").alias("vector"))
        .withColumn("ref", F.col("ids")[0])
    )
    # A reference is an id of the class, told apart by the ray's hash where ids repeat.
    classes = classes.withColumn("ref", F.xxhash64("ref", "class"))
    asked = usable.filter("asked").select("class", "ray", "id")
    has_query = asked.groupBy("class", "ray").agg(F.lit(True).alias("asked"))
    classes = written(
        classes.join(has_query, ["class", "ray"], "left").withColumn("asked", F.coalesce("asked", F.lit(False))),
        "classes",
    )
    width = classes.agg(F.max(F.size("vector"))).first()[0] or 1
    orders = Orders(width, rotations)
    entries = in_small_batches(classes).select("ref", "asked", "vector").mapInArrow(
        _entries(orders, width, kind), "curve int, key binary, ref long, asked boolean, vector binary"
    )
    placed = written(
        entries.repartitionByRange(n, "curve", "key", "ref")
        .sortWithinPartitions("curve", "key", "ref")
        .mapInArrow(_numbered, "curve int, ref long, asked boolean, vector binary, part int, at long"),
        "placed",
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = placed.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = placed.join(F.broadcast(bases), "part").withColumn("rank", F.col("base") + F.col("at"))
    window = window or _measured_window(classes, ranked, width, k)
    block = lambda rank: F.floor(rank / window)
    columns = ["block", "probe", "curve", "rank", "ref", "vector"]
    items = ranked.select(block(F.col("rank")).alias("block"), F.lit(False).alias("probe"), *columns[2:])
    probes = ranked.filter("asked").select(
        F.explode(F.sequence(block(F.col("rank") - window), block(F.col("rank") + window))).alias("block"),
        F.lit(True).alias("probe"), *columns[2:],
    )
    pairs = (
        items.union(probes)
        .repartition(n, "block")
        .sortWithinPartitions("block", "probe")
        .mapInArrow(_best_in_blocks(width, window, k + SPARE, kind), "ref long, other long")
        .distinct()
        .union(classes.filter("asked").select("ref", F.col("ref").alias("other")))
    )
    pairs = written(pairs, "pairs")

    @F.pandas_udf("double")
    def cosine(left: pd.Series, right: pd.Series) -> pd.Series:
        def one(a: np.ndarray, b: np.ndarray) -> float:
            m = min(len(a), len(b))
            x, y = a / np.abs(a).max(), b / np.abs(b).max()
            return float(np.dot(x[:m], y[:m]) / np.sqrt(np.dot(x, x) * np.dot(y, y)))

        return pd.Series([one(np.asarray(a, np.float64), np.asarray(b, np.float64)) for a, b in zip(left, right)], dtype="float64")

    own = classes.select("ref", F.col("vector").alias("own"))
    others = classes.select(F.col("ref").alias("other"), F.col("vector").alias("others"), "ids")
    scored = pairs.join(own, "ref").join(others, "other").select("ref", cosine("own", "others").alias("score"), F.explode("ids").alias("id"))
    best = Window.partitionBy("ref").orderBy(F.desc("score"), "id")
    lists = scored.withColumn("nth", F.row_number().over(best)).filter(F.col("nth") <= k + 1).groupBy("ref").agg(
        F.array_sort(F.collect_list(F.struct("nth", "id", "score"))).alias("found")
    )
    queries = asked.join(classes.select("class", "ray", "ref"), ["class", "ray"]).select(F.col("id").alias("query_id"), "ref")
    others_of = F.slice(F.filter("found", lambda x: x["id"] != F.col("query_id")), 1, k)
    return (
        queries.join(lists, "ref")
        .select("query_id", F.posexplode(others_of).alias("rank", "found"))
        .select("query_id", (F.col("rank") + 1).alias("rank"), F.col("found.id").alias("vec_id"), F.col("found.score").alias("score"))
    )
