"""Best-fit packing, planned over counts of lengths.

How many pieces have each length is at most one row a token of the sequence, whatever the
corpus. Best-fit runs over these counts, longest first, on runs of sequences that are alike, and
its plan says for every length which ranks of its pieces go to which sequences. Pieces then take
their places by their rank within their length.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tramline.llm.common import give_back, written
from tramline.llm.token_files import tokenize

#: Bytes and rows of the pieces of one length that share a ranking group, on average.
RANK_BYTES = 4 << 20
RANK_ROWS = 500


class Slots(NamedTuple):
    """Ranks from ``rank`` on of one length: ``each`` to a sequence, from ``sequence`` on."""

    rank: int
    sequence: int
    each: int
    offset: int


def best_fit(counts: dict[int, int], capacity: int) -> dict[int, list[Slots]]:
    """The plan: best-fit decreasing, with all pieces of a length at a time.

    ``room`` holds runs of sequences with the same space left. A piece goes to the least space
    that holds it, so a run takes as many pieces to each sequence as fit before the next run is
    looked at; a part-used run is split. The work and the plan depend on the number of lengths
    alone: at most two runs are split for each length.
    """
    room: dict[int, list[tuple[int, int]]] = {}  # space left -> runs (first sequence, sequences)
    spaces: list[int] = []
    plan: dict[int, list[Slots]] = {}
    opened = 0

    def keep(space: int, first: int, many: int) -> None:
        if many and space:
            if space not in room:
                room[space] = []
                bisect.insort(spaces, space)
            room[space].append((first, many))

    for length in sorted(counts, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of {length} tokens does not fit a sequence of {capacity}")
        rank, left, slots = 0, counts[length], []
        while left:
            at = bisect.bisect_left(spaces, length)
            if at < len(spaces):
                space = spaces[at]
                first, many = room[space].pop()
                if not room[space]:
                    del room[space], spaces[at]
            else:
                space, first = capacity, opened
                many = -(-left // (capacity // length))
                opened += many
            each = space // length
            slots.append(Slots(rank, first, each, capacity - space))
            full = min(many, left // each)
            rest = min(left - full * each, each - 1) if full < many else 0
            keep(space - each * length, first, full)
            if rest:
                keep(space - rest * length, first + full, 1)
            keep(space, first + full + bool(rest), many - full - bool(rest))
            rank += full * each + rest
            left -= full * each + rest
        plan[length] = slots
    return plan


def cut(ids: DataFrame, capacity: int) -> DataFrame:
    """(doc, piece, start, length, ids): documents in pieces of ``capacity`` ids, the last shorter."""
    step = 4 * capacity
    each = F.sequence(F.lit(0), F.floor((F.octet_length("ids") - 1) / step).cast("int"))
    return (
        ids.filter(F.octet_length("ids") > 0)
        .select("doc", "ids", F.explode(each).alias("piece"))
        .select(
            "doc",
            "piece",
            (F.col("piece").cast("long") * capacity).alias("start"),
            F.least(F.lit(capacity), (F.octet_length("ids") / 4).cast("long") - F.col("piece") * capacity)
            .cast("int")
            .alias("length"),
            F.substring("ids", F.col("piece") * step + 1, F.lit(step)).alias("ids"),
        )
    )


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    capacity: int = 4096,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(doc_id, piece, start, length, ids, sequence_id, offset): every piece and its place.

    ``ids`` are little-endian uint32. Null text counts as empty and is the end id alone; a null
    id stays null; rows that share an id are separate documents. An empty table has no pieces.
    Texts are tokenized once, into a written table, in which every piece has a number of its own.
    Ranks come in two steps, so that a length with a third of all pieces is no single group:
    pieces of a length are dealt by their number to groups of bounded size, counted, and numbered
    within a group from where the groups before it end. Equal rows are dealt apart like others.
    """
    cuts = cut(tokenize(docs, tokenizer, end_id, id_column, text_column), capacity)
    pieces = written(cuts.withColumn("row", F.monotonically_increasing_id()), "pieces")
    counts = {row.length: row.n for row in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = best_fit(counts, capacity)
    # At most one row a length; as an Arrow table, for rows of Python objects start workers of another kind.
    groups = [max(-(-n // RANK_ROWS), -(-n * 4 * length // RANK_BYTES)) for length, n in counts.items()]
    columns = {"length": pa.array(list(counts), pa.int32()), "groups": pa.array(groups, pa.int64())}
    many = F.broadcast(docs.sparkSession.createDataFrame(pa.table(columns)))
    dealt = pieces.join(many, "length").withColumn("part", F.pmod(F.xxhash64("row"), F.col("groups")))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        dealt.groupBy("length", "part")
        .agg(F.count("*").alias("n"))
        .select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    )
    own = Window.partitionBy("length", "part").orderBy("row")
    ranked = dealt.withColumn("own", F.row_number().over(own) - 1).join(bases, ["length", "part"])
    return _placed(ranked, plan)


def _placed(ranked: DataFrame, plan: dict[int, list[Slots]]) -> DataFrame:
    """Look each piece's rank up in the plan of its length; the plan's size follows the capacity."""
    tables = {length: np.asarray(slots, dtype=np.int64) for length, slots in plan.items()}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            for value in np.unique(length):
                slots, rows = tables[int(value)], np.flatnonzero(length == value)
                slot = slots[np.searchsorted(slots[:, 0], rank[rows], side="right") - 1]
                nth = rank[rows] - slot[:, 0]
                sequence[rows] = slot[:, 1] + nth // slot[:, 2]
                offset[rows] = slot[:, 3] + nth % slot[:, 2] * value
            kept = [batch.column(name) for name in ("doc", "piece", "start", "length", "ids")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequence), pa.array(offset)],
                ["doc_id", "piece", "start", "length", "ids", "sequence_id", "offset"],
            )
        give_back()

    rows = ranked.select(
        "doc", "piece", "start", F.col("length").cast("long").alias("length"), "ids",
        (F.col("base") + F.col("own")).cast("long").alias("rank"),
    )
    return rows.mapInArrow(
        place, "doc_id long, piece int, start long, length long, ids binary, sequence_id long, offset long"
    )
