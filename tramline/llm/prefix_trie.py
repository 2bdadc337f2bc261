"""The prefix trie of conversations, as a burst trie.

A conversation is the sequence of its turns' 128-bit ids; equal sequences are one, with a count.
All sequences start in one container under the root. A container with too many turns bursts: its
head follows what all its sequences begin with, and they go on, by their next turn id, to one
container each below. A container with few turns, or with one sequence, stays. Remaining
containers are sorted by Spark and swept once, with a stack as deep as one sequence, into nodes.
Totals of subtrees come up from the containers through the heads, one burst round after the
other. Texts do not travel beyond their turn's id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tramline.llm.common import in_small_batches, parallelism, written
from tramline.operators.joins import fits

#: Turns of a container; one with more, and of more than one sequence, bursts.
CONTAINER_TURNS = 2_000
#: Bytes of a turn id.
_ID = 16
_ROOT = "root"

# ``above`` is the head that a container's top hangs under, and null for its other nodes.
_NODE_DDL = "above string, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, seq string"
_NODE = pa.schema(
    [
        ("above", pa.string()), ("depth", pa.int64()), ("conv_id", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()),
        ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("seq", pa.string()),
    ]
)
_RESULT = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def sequences(turns: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """(conv_id, ids, sizes): of each conversation the ids of its turns, joined, and their bytes."""
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("role", "text"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    named = (
        turns.filter("conv_id is not null")
        .select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text"))
        .select(
            "conv_id",
            F.row_number().over(order).alias("n"),
            # The role's length keeps role and text apart.
            F.unhex(F.md5(F.concat_ws(":", F.octet_length("role").cast("string"), "role", "text"))).alias("id"),
            F.octet_length("text").cast("long").alias("size"),
        )
    )
    rows = named.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("n", "id", "size"))).alias("turns"))
    rows = rows.select("conv_id", F.col("turns.id").alias("ids"), F.col("turns.size").alias("sizes"))
    if conversations is not None:
        bare = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).filter("conv_id is not null").distinct()
        rows = rows.join(bare, "conv_id", "full")
    joined = F.aggregate(F.coalesce("ids", F.array()), F.lit(b""), lambda done, one: F.concat(done, one))
    return rows.select("conv_id", joined.alias("ids"), F.coalesce("sizes", F.array()).alias("sizes"))


def _ends_digest(rows: DataFrame, many: DataFrame) -> DataFrame:
    """(seq, ends_sha256) of the sequences that several conversations have.

    The ids of one stream through in order; only the hash is kept.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest, out = None, None, []
        for batch in batches:
            for seq, conv in zip(batch.column("seq").to_pylist(), batch.column("conv_id").to_pylist()):
                if seq != now:
                    if now is not None:
                        out.append((now, digest.hexdigest()))
                    now, digest = seq, hashlib.sha256(b"%d" % conv)
                else:
                    digest.update(b",%d" % conv)
            yield pa.RecordBatch.from_arrays([pa.array([o[n] for o in out], pa.string()) for n in (0, 1)], ["seq", "ends_sha256"])
            out.clear()
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([digest.hexdigest()])], ["seq", "ends_sha256"])

    shared = rows.join(many, "seq", "left_semi").select("seq", "conv_id")
    return (
        shared.repartition(parallelism(rows.sparkSession), "seq")
        .sortWithinPartitions("seq", "conv_id")
        .mapInArrow(run, "seq string, ends_sha256 string")
    )


class _Open:
    """A node on the sweep's stack."""

    __slots__ = ("depth", "size", "conv", "convs", "seq", "children")

    def __init__(self, depth: int, size: int):
        self.depth, self.size = depth, size
        self.conv, self.convs, self.seq = None, 0, None
        self.children: list[tuple] = []

    def add(self, conv: int, convs: int) -> None:
        self.conv, self.convs = conv if self.conv is None else min(self.conv, conv), self.convs + convs


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of containers; rows come sorted by head and ids, so a node's rows are together.

    A child's row needs its parent's smallest conversation, known when the parent closes, and
    waits there until then.
    """
    out: list[tuple] = []
    stack: list[_Open] = []
    head, last, over = None, b"", (None, None)

    def close() -> None:
        node = stack.pop()
        leaves, saved = 0, (node.convs - 1) * node.size
        for depth, conv, *rest in node.children:
            out.append((None, depth, conv, node.conv, *rest))
            leaves, saved = leaves + rest[2], saved + rest[3]
        rest = (node.convs, len(node.children), leaves or 1, saved, node.seq)
        if stack:
            stack[-1].children.append((node.depth, node.conv, *rest))
            stack[-1].add(node.conv, node.convs)
        else:
            out.append((over[0], node.depth, node.conv, over[1], *rest))

    def made() -> pa.RecordBatch:
        columns = list(zip(*out)) or [()] * len(_NODE)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _NODE)], schema=_NODE)

    for batch in batches:
        names = ("head", "above", "depth", "size", "parent_conv", "ids", "sizes", "conv", "n", "seq")
        for now, above, depth, size, parent, ids, sizes, conv, n, seq in zip(*(batch.column(name).to_pylist() for name in names)):
            if now != head:
                while stack:
                    close()
                head, last, over = now, b"", (above, parent)
                stack.append(_Open(depth, size))
            common = 0
            while common < len(last) and last[common : common + _ID] == ids[common : common + _ID]:
                common += _ID
            while len(stack) > common // _ID + 1:
                close()
            for at in range(common // _ID, len(ids) // _ID):
                stack.append(_Open(depth + at + 1, sizes[at]))
            stack[-1].add(conv, n)
            stack[-1].seq = seq
            last = ids
        yield made()
        out.clear()
    while stack:
        close()
    yield made()


def _small(side: DataFrame) -> DataFrame:
    """Heads are few: at most the turns by a container's size. Broadcast where that measures small."""
    return F.broadcast(side) if fits(side) else side


def _oversized(rows: DataFrame, turns: int) -> DataFrame:
    """The heads of the containers that burst."""
    counts = rows.groupBy("head").agg(F.count("*").alias("rows"), F.sum(F.expr(f"length(ids) div {_ID} + 1")).alias("turns"))
    return counts.filter((F.col("turns") > turns) & (F.col("rows") > 1)).select("head")


def _burst(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(heads with the turns that all their sequences begin with, the sequences one turn below those)."""
    low, high = (f"substring({name}, i * {_ID} + 1, {_ID})" for name in ("low", "high"))
    many = f"cast(length(low) div {_ID} as int)"
    # Nothing sorts between the least and the greatest sequence that does not begin with what both do.
    shared = f"coalesce(array_min(filter(sequence(0, {many}), i -> i = {many} or {low} <> {high})), 0)"
    heads = written(
        rows.groupBy("head")
        .agg(
            F.min("ids").alias("low"), F.max("ids").alias("high"), F.min("conv").alias("conv_id"), F.sum("n").alias("n_convs"),
            *(F.any_value(name).alias(name) for name in ("above", "depth", "size", "parent_conv")),
        )
        .withColumn("skip", F.expr(shared))
        .drop("low", "high"),
        "heads",
    )
    moved = written(
        rows.select("head", "ids", "sizes", "conv", "n", "seq", "depth")
        .join(_small(heads.select("head", "skip", F.col("conv_id").alias("parent_conv"))), "head")
        .withColumn("ends", F.expr(f"length(ids) = skip * {_ID}")),
        "burst",
    )
    bottoms = moved.groupBy("head").agg(
        F.min(F.when(F.col("ends"), F.col("seq"))).alias("seq"), F.any_value(F.expr("slice(sizes, 1, skip)")).alias("path")
    )
    below = moved.filter("not ends").select(
        F.md5(F.concat(F.col("head").cast("binary"), F.expr(f"substring(ids, skip * {_ID} + 1, {_ID})"))).alias("head"),
        F.col("head").alias("above"), (F.col("depth") + F.col("skip") + 1).alias("depth"), F.expr("sizes[skip]").alias("size"),
        "parent_conv", F.expr(f"substring(ids, (skip + 1) * {_ID} + 1)").alias("ids"),
        F.expr("slice(sizes, skip + 2, size(sizes))").alias("sizes"), "conv", "n", "seq",
    )
    return written(heads.join(bottoms, "head"), "heads"), written(below, "suffixes")


def _head_nodes(heads: DataFrame, tops: DataFrame) -> DataFrame:
    """The nodes of burst heads: the turns that all sequences begin with, in a row; ``tops`` hang below the last."""
    sums = tops.groupBy("above").agg(
        F.count("*").alias("n"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved")
    )
    rows = heads.join(sums.withColumnRenamed("above", "head"), "head")
    each = rows.select(
        "head", "above", "depth", "skip", "conv_id", "parent_conv", "n_convs", "n", "n_leaves", "saved", "seq",
        F.posexplode(F.concat(F.array("size"), "path")).alias("at", "bytes"),
    )
    upward = Window.partitionBy("head").orderBy(F.desc("at"))
    top, last = F.col("at") == 0, F.col("at") == F.col("skip")
    return each.select(
        F.when(top, F.col("above")).alias("above"),
        (F.col("depth") + F.col("at")).alias("depth"),
        "conv_id",
        F.when(top, F.col("parent_conv")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        "n_convs",
        F.when(last, F.col("n")).otherwise(F.lit(1)).cast("long").alias("n_children"),
        "n_leaves",
        (F.col("saved") + F.sum((F.col("n_convs") - 1) * F.col("bytes")).over(upward)).alias("saved_tokens"),
        F.when(last, F.col("seq")).alias("seq"),
    )


def prefix_trie(
    turns: DataFrame, conversations: DataFrame | None = None, container_turns: int = CONTAINER_TURNS
) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of each node.

    ``turns`` has (conv_id, turn, role, text); turns are in the order of ``turn``, null first, rows
    of one turn in the order of role and text. Null role and text are empty. Each distinct
    sequence of first turns is a node, told by its smallest conversation and its depth; the root
    has depth 0 and no parent. ``n_leaves`` and ``saved_tokens`` are of the subtree, its top
    included: a node saves its text's bytes for each conversation but one. ``ends_sha256`` hashes
    the ids of the conversations that end there, ascending. ``conversations`` (conv_id) may
    name more, which have no turns: they end at the root. Rows without a conversation are left
    out; repeated rows are turns of their own; other columns are ignored; without any
    conversation there is no node.

    One conversation's ids (24 bytes a turn) are one row, and the digest of the conversations
    with one and the same sequence is one stream, for it is a hash over them in order.
    """
    spark = turns.sparkSession
    everyone = written(sequences(in_small_batches(turns), conversations).withColumn("seq", F.md5("ids")), "sequences")
    if everyone.isEmpty():
        return spark.createDataFrame([], _RESULT)
    firsts = written(everyone.groupBy("seq").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n")), "distinct")
    none = F.lit(None)
    rows = written(
        everyone.join(firsts, ["seq", "conv_id"]).select(
            F.lit(_ROOT).alias("head"), none.cast("string").alias("above"), F.lit(0).cast("long").alias("depth"),
            F.lit(0).cast("long").alias("size"), none.cast("long").alias("parent_conv"), "ids", "sizes", F.col("conv_id").alias("conv"), "n", "seq",
        ),
        "suffixes",
    )

    containers, bursts = [], []
    while not (large := written(_oversized(rows, container_turns), "oversized")).isEmpty():
        large = _small(large)
        containers.append(rows.join(large, "head", "left_anti"))
        heads, rows = _burst(rows.join(large, "head"))
        bursts.append(heads)
    containers.append(rows)
    swept = (
        reduce(DataFrame.union, containers)
        .repartition(parallelism(spark), "head")
        .sortWithinPartitions("head", "ids")
        .mapInArrow(_sweep, _NODE_DDL)
    )
    nodes = written(swept, "nodes")
    parts, tops = [nodes], nodes.filter("above is not null")
    for heads in reversed(bursts):
        made = written(_head_nodes(heads, tops), "nodes")
        parts.append(made)
        tops = tops.union(made.filter("above is not null"))
    return _with_ends(reduce(DataFrame.union, parts), everyone, firsts)


def _with_ends(nodes: DataFrame, everyone: DataFrame, firsts: DataFrame) -> DataFrame:
    """The nodes with the digest of the conversations that end there."""
    alone = firsts.filter("n = 1").select("seq", F.sha2(F.col("conv_id").cast("string"), 256).alias("ends_sha256"))
    ends = alone.union(_ends_digest(everyone, firsts.filter("n > 1").select("seq")))
    columns = [name.split()[0] for name in _RESULT.split(", ")]
    inner = nodes.filter("seq is null").withColumn("ends_sha256", F.sha2(F.lit(""), 256)).select(*columns)
    return nodes.filter("seq is not null").join(ends, "seq").select(*columns).union(inner)
