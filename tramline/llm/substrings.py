"""Repeated passages, by suffix trees over groups of suffixes with a common prefix.

A suffix is a window start in a document; it matters to the depth of ``depth`` words and beyond,
as far as its stretch goes. Suffixes are split by prefixes until every group fits a task:

* The first prefix is the least (by hash) of the ``PREFIX``-word runs in a suffix's first ``depth``
  words. Equal suffixes agree in it, and neighbouring suffixes mostly share it, so a run of
  neighbours travels once, as one stretch of words, and not word by word. A prefix that occurs
  once has no repeat: its suffixes are dropped before any text moves.
* A prefix with more than ``CROWDED`` occurrences is made longer. Its equal stretches become one
  first, so that a passage in a third of all documents is no single group; the suffixes of the
  different ones are split by their own first words, 8, 12, 16 and at last all ``depth``, the
  next length only where a group is still too large. At full depth a group is one node.

A task builds the suffix tree of its groups: suffixes sorted by doubling, with the lengths of the
prefixes that neighbours share. The internal nodes at ``depth`` or deeper are the maximal
repeats; below the topmost of them, all leaves but the first in the order of (document, place)
start a repeat. Words stand for themselves there; stretches and full-depth groups are told apart
by 128-bit hashes.

Crowded prefixes are settled without going back from nodes to suffixes: all their suffixes count
as repeats, and the trees of the different ones tell which few are first and stay.

Documents whose whole text an earlier one has, and rows that repeat a document, are settled
before: they bring no suffixes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import DataFrame, functions as F

from tramline.llm.common import give_back, in_small_batches, parallelism, pieces, whole, words_of, written
from tramline.llm.words import split_words
from tramline.operators.joins import fits

DEPTH = 20
PREFIX = 8
#: Occurrences of a prefix in one group; more make the prefix longer.
CROWDED = 2_000
#: Words of the longer prefixes, before all ``depth`` words.
LONGER = (8, 12, 16)
SLICE_CHARS = 4 << 20
#: The run of all windows of a document.
_ALL = 0xFFFFFFFF
_REMEMBERED = 150_000


class _WordHashes(dict):
    """Hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > _REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word, 7)
        return value


_HASHES = _WordHashes()


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A hash of two neighbouring runs."""
    value = left * np.uint64(0x9E3779B97F4A7C15) + right
    value ^= value >> np.uint64(29)
    value *= np.uint64(0xBF58476D1CE4E5B9)
    return value ^ (value >> np.uint64(32))


def _run_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of the run of ``length`` words (at least 1) from each word on."""
    done, value, single, size = 0, None, words, 1
    while length:
        if length & size:
            value = single if value is None else _joined(value[: len(single) - done if done else None], single[done:])
            done += size
            length -= size
        if length:
            single = _joined(single[:-size], single[size:])
            size *= 2
    return value


def anchors(hashes: np.ndarray, ends: np.ndarray, depth: int, prefix: int) -> tuple[np.ndarray, ...]:
    """(hash, first window, windows, place) of each prefix that windows belong to.

    ``hashes`` are the words of several documents, one after the other; ``ends`` where each ends.
    """
    if len(hashes) < depth:
        return tuple(np.empty(0, np.int64) for _ in range(4))
    runs = _run_hashes(hashes, prefix)
    span = depth - prefix + 1
    at = np.lib.stride_tricks.sliding_window_view(runs, span).argmin(axis=1) + np.arange(len(runs) - span + 1)
    owner = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    starts = np.flatnonzero(owner[: len(at)] == owner[depth - 1 : depth - 1 + len(at)])
    at = at[starts]
    new = np.flatnonzero((np.diff(at, prepend=-1) != 0) | (np.diff(starts, prepend=-2) != 1))
    many = np.diff(np.append(new, len(at)))
    return runs[at[new]].view(np.int64), starts[new], many, at[new]


def _find_anchors(depth: int, prefix: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, SLICE_CHARS, "text"):
            words = [words_of(text) for text in part.column("text").to_pylist()]
            ends = np.cumsum([len(own) for own in words])
            hashes = np.concatenate(
                [np.fromiter(map(_HASHES.__getitem__, own), np.uint64, len(own)) for own in words]
            )
            gram, first, many, _ = anchors(hashes, ends, depth, prefix)
            row = np.searchsorted(ends, first, side="right")
            place = first - (ends - np.diff(ends, prepend=0))[row]
            doc, mark = (part.column(name).take(pa.array(row)) for name in ("doc", "mark"))
            yield pa.RecordBatch.from_arrays(
                [pa.array(gram), doc, mark, pa.array(place * 256 + many)], ["gram", "doc", "mark", "run"]
            )
        _HASHES.clear()
        give_back()

    return run


def _stretches(depth: int):
    """The words of each run of suffixes; a crowded prefix gives way to the whole run's hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, SLICE_CHARS, "text"):
            out: dict[str, list] = {name: [] for name in _STRETCH.names}
            docs, marks = part.column("doc").to_pylist(), part.column("mark").to_pylist()
            texts, found = part.column("text").to_pylist(), part.column("runs")
            for doc, mark, text, runs in zip(docs, marks, texts, found):
                words = words_of(text)
                for gram, packed, crowded in zip(*(runs.values.field(name).to_pylist() for name in ("gram", "run", "crowded"))):
                    first, many = packed >> 8, packed & 255
                    stretch, more = b" ".join(words[first : first + many + depth - 1]), 0
                    if crowded:
                        gram, more = _hash128(stretch)
                    for name, value in zip(_STRETCH.names, (doc, mark, gram, more, first, many, crowded, stretch)):
                        out[name].append(value)
            yield pa.RecordBatch.from_pydict(out, schema=_STRETCH)

    return run


def _hash128(data: bytes) -> tuple[int, int]:
    return tuple(np.frombuffer(xxhash.xxh128_digest(data), "<i8").tolist())


def _suffixes(depth: int, longer: tuple[int, ...]):
    """Each suffix of a stretch by itself, with the hashes of its prefixes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {name: [] for name in _SUFFIX.names}
            for doc, mark, first, data in zip(*(batch.column(name).to_pylist() for name in ("doc", "mark", "first", "words"))):
                words = data.split()
                for step in range(len(words) - depth + 1):
                    window = words[step : step + depth]
                    text = b" ".join(window)
                    keys = [xxhash.xxh64_intdigest(b" ".join(window[:size])) - (1 << 63) for size in longer]
                    for name, value in zip(_SUFFIX.names, (keys, *_hash128(text), doc, mark, first + step, 1, text)):
                        out[name].append(value)
            yield pa.RecordBatch.from_pydict(out, schema=_SUFFIX)

    return run


_STRETCH = pa.schema(
    [
        ("doc", pa.int64()), ("mark", pa.int64()), ("gram", pa.int64()), ("more", pa.int64()),
        ("first", pa.int64()), ("many", pa.int64()), ("crowded", pa.bool_()), ("words", pa.binary()),
    ]
)
_STRETCH_DDL = "doc long, mark long, gram long, more long, first long, many long, crowded boolean, words binary"
_SUFFIX = pa.schema(
    [
        ("keys", pa.list_(pa.int64())), ("high", pa.int64()), ("low", pa.int64()), ("doc", pa.int64()), ("mark", pa.int64()),
        ("first", pa.int64()), ("many", pa.int64()), ("words", pa.binary()),
    ]
)
_SUFFIX_DDL = "keys array<long>, high long, low long, doc long, mark long, first long, many long, words binary"


class SuffixTree(NamedTuple):
    """The leaves of a suffix tree in order, and the words each shares with the leaf before it."""

    leaves: np.ndarray
    shared: np.ndarray

    def below(self, depth: int) -> np.ndarray:
        """For each leaf, the number of the subtree it is in when the tree is cut at ``depth``.

        A subtree of several leaves hangs under an internal node at that depth or deeper; the least
        of their shared lengths is that node's depth.
        """
        return np.cumsum(self.shared < depth)


def suffix_tree(words: np.ndarray, starts: np.ndarray, longest: int) -> SuffixTree:
    """The suffixes of ``words`` at ``starts``, sorted and compared to ``longest`` words.

    ``words`` are numbers; a number of its own behind each stretch ends its suffixes there.
    """
    ranks, size = [np.unique(words, return_inverse=True)[1]], 1
    while 2 * size <= longest:
        ranks.append(_doubled(ranks[-1], size))
        size *= 2
    order = np.lexsort((_at(ranks[-1], starts + size), ranks[-1][starts]))
    leaves = starts[order]
    shared = np.zeros(len(leaves), np.int64)
    left, right = leaves[:-1].copy(), leaves[1:].copy()
    for rank in reversed(ranks):
        same = _at(rank, left) == _at(rank, right)
        same &= left < len(words)
        left, right = left + same * size, right + same * size
        shared[1:] += same * size
        size //= 2
    return SuffixTree(order, shared)


def _at(ranks: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Ranks at places; behind the last word stands the least."""
    return np.where(places < len(ranks), ranks[np.minimum(places, len(ranks) - 1)], -1)


def _doubled(ranks: np.ndarray, size: int) -> np.ndarray:
    """The ranks of runs twice as long, in the order of their words."""
    second = _at(ranks, np.arange(len(ranks)) + size) + 1
    return np.unique(ranks.astype(np.int64) * (int(second.max(initial=0)) + 1) + second, return_inverse=True)[1]


def _leaves(rows: pa.Table, depth: int) -> tuple[np.ndarray, ...]:
    """(doc, mark, place, is first below its deep node) of each suffix of complete groups."""
    many, first = (rows.column(name).to_numpy() for name in ("many", "first"))
    doc, mark = rows.column("doc").to_numpy(), rows.column("mark").to_numpy()
    found, ends = split_words(rows.column("words").combine_chunks())
    # One number more behind each stretch, which no other place has.
    ids = found.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    words = np.insert(ids, ends, np.arange(len(ends)) + int(ids.max(initial=0)) + 1)
    begins = np.concatenate([[0], ends[:-1]]) + np.arange(len(ends))
    step = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    tree = suffix_tree(words, np.repeat(begins, many) + step, int(many.max(initial=1)) + depth - 1)
    node = np.empty(len(step), np.int64)
    node[tree.leaves] = tree.below(depth)
    doc, mark, place = np.repeat(doc, many), np.repeat(mark, many), np.repeat(first, many) + step
    order = np.lexsort((place, mark, doc, node))
    node, doc, mark, place = node[order], doc[order], mark[order], place[order]
    heads = np.flatnonzero(np.diff(node, prepend=-1) != 0)
    head = np.repeat(heads, np.diff(np.append(heads, len(node))))
    return doc, mark, place, (doc == doc[head]) & (mark == mark[head]) & (place == place[head])


def _repeats(rows: pa.Table, depth: int) -> pa.RecordBatch:
    """Runs of windows of complete groups that also start earlier."""
    doc, mark, place, is_first = _leaves(rows, depth)
    doc, mark, place = doc[~is_first], mark[~is_first], place[~is_first]
    order = np.lexsort((place, mark, doc))
    doc, mark, place = doc[order], mark[order], place[order]
    cut = np.flatnonzero((np.diff(place, prepend=-2) != 1) | (np.diff(doc, prepend=0) != 0) | (np.diff(mark, prepend=0) != 0))
    many = np.diff(np.append(cut, len(place)))
    return pa.RecordBatch.from_arrays(
        [pa.array(doc[cut]), pa.array(mark[cut]), pa.array(place[cut] * (1 << 32) + many)], ["doc", "mark", "run"]
    )


def _firsts(rows: pa.Table, depth: int) -> pa.RecordBatch:
    """The windows of complete groups that start nowhere earlier."""
    doc, mark, place, is_first = _leaves(rows, depth)
    return pa.RecordBatch.from_arrays([pa.array(x[is_first]) for x in (doc, mark, place)], ["doc", "mark", "run"])


def _trees(depth: int, tell: Callable[[pa.Table, int], pa.RecordBatch]):
    """Rows come sorted by prefix; a batch's last group waits for the next batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            if held is not None:
                rows = pa.concat_tables([held, rows])
            grams = rows.column("gram").to_numpy()
            whole_groups = int(np.searchsorted(grams, grams[-1])) if len(grams) else 0
            if whole_groups:
                yield tell(rows.slice(0, whole_groups), depth)
            held = rows.slice(whole_groups).combine_chunks()
        if held is not None and held.num_rows:
            yield tell(held, depth)
        give_back()

    return run


def _grown(groups: DataFrame, depth: int, tell: Callable[[pa.Table, int], pa.RecordBatch]) -> DataFrame:
    """(doc, mark, run) that the trees of the groups (gram, doc, mark, first, many, words) tell."""
    return (
        groups.select("gram", "doc", "mark", "first", "many", "words")
        .repartition(parallelism(groups.sparkSession), "gram")
        .sortWithinPartitions("gram")
        .mapInArrow(_trees(depth, tell), "doc long, mark long, run long")
    )


def _small(side: DataFrame) -> DataFrame:
    """Broadcast where it measures small, else shuffled."""
    return F.broadcast(side) if fits(side) else side


def repeated_windows(docs: DataFrame, depth: int = DEPTH, prefix: int = PREFIX) -> DataFrame:
    """(doc, mark, runs, firsts): runs of window starts, place * 2**32 + number, less the places ``firsts``.

    What is left are the windows that also start earlier. ``docs`` has (doc, mark, text); doc and
    mark together tell documents apart and order them; equal rows are one document.
    """
    if not prefix <= depth <= 255 + prefix:
        raise ValueError(f"a depth of {depth} words: {prefix} to {255 + prefix} can be told")
    copies, again = _settled(docs)
    docs = _different(docs, copies, again)
    found = written(
        docs.mapInArrow(_find_anchors(depth, prefix), "gram long, doc long, mark long, run long"), "anchors"
    )
    counts = found.groupBy("gram").agg(F.count("*").alias("n")).filter("n > 1")
    counts = written(counts.select("gram", (F.col("n") > CROWDED).alias("crowded")), "prefixes")
    shared = written(
        found.join(counts, "gram")
        .groupBy("doc", "mark")
        .agg(F.collect_list(F.struct("gram", "run", "crowded")).alias("runs")),
        "shared",
    )
    stretches = written(
        docs.join(shared.hint("merge"), ["doc", "mark"])
        .select("doc", "mark", "text", "runs")
        .mapInArrow(_stretches(depth), _STRETCH_DDL),
        "stretches",
    )
    none = F.array().cast("array<bigint>")
    crowded = stretches.filter("crowded")
    parts = [
        _grown(stretches.filter("not crowded"), depth, _repeats).select("doc", "mark", F.array("run"), none),
        copies.select("doc", "mark", F.array(F.lit(_ALL)), none),
        crowded.select("doc", "mark", F.array(F.shiftleft("first", 32) + F.col("many")), none),
        *(rows.select("doc", "mark", none, F.array("run")) for rows in _firsts_of_crowded(crowded, depth)),
    ]
    return reduce(DataFrame.union, parts).toDF("doc", "mark", "runs", "firsts")


def _covered(starts: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    """Which of ``size`` places lie in one of the spans."""
    edges = np.zeros(size + 1, np.int64)
    np.add.at(edges, np.minimum(starts, size), 1)
    np.add.at(edges, np.minimum(ends, size), -1)
    return np.cumsum(edges[:-1]) > 0


def _settled(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc, mark) of the documents whose whole text an earlier one has, and of those in several rows.

    All windows of the former start earlier there, so no suffix of theirs has to be compared.
    """
    texts = docs.groupBy("doc", "mark", F.md5("text").alias("text")).agg(F.count("*").alias("rows"))
    texts = written(texts, "texts")
    firsts = texts.groupBy("text").agg(F.min(F.struct("doc", "mark")).alias("first"), F.count("*").alias("n"))
    later = texts.join(firsts.filter("n > 1").drop("n"), "text").filter("struct(doc, mark) <> first")
    again = texts.groupBy("doc", "mark").agg(F.sum("rows").alias("rows")).filter("rows > 1")
    return written(later.select("doc", "mark").distinct(), "copies"), written(again.select("doc", "mark"), "again")


def _different(docs: DataFrame, copies: DataFrame, again: DataFrame) -> DataFrame:
    """``docs`` without later copies, one row a document. Only repeated rows move."""
    own = docs.join(_small(copies), ["doc", "mark"], "left_anti")
    if again.isEmpty():
        return own
    again = _small(again)
    once = own.join(again, ["doc", "mark"], "left_semi").groupBy("doc", "mark").agg(F.first("text").alias("text"))
    return own.join(again, ["doc", "mark"], "left_anti").union(once)


def _firsts_of_crowded(stretches: DataFrame, depth: int) -> list[DataFrame]:
    """(doc, mark, run): the places of the windows of crowded prefixes that start nowhere earlier.

    Of equal stretches only the first can have such a window. Their suffixes are split by longer
    and longer prefixes of their own until a group fits; what is crowded at full depth is equal,
    and needs no more than a minimum.
    """
    different = stretches.groupBy("gram", "more").agg(
        F.min(F.struct("doc", "mark", "first")).alias("at"), F.min("words").alias("words")
    )
    longer = tuple(size for size in LONGER if size < depth)
    rest = written(different.select("at.*", "words").mapInArrow(_suffixes(depth, longer), _SUFFIX_DDL), "suffixes")
    told = []
    for place in range(len(longer)):
        rest = rest.withColumn("gram", F.col("keys")[place])
        large = written(rest.groupBy("gram").agg(F.count("*").alias("n")).filter(F.col("n") > CROWDED).select("gram"), "large")
        if large.isEmpty():
            return [*told, _grown(rest, depth, _firsts)]
        large = _small(large)
        told.append(_grown(rest.join(large, "gram", "left_anti"), depth, _firsts))
        rest = rest.join(large, "gram", "left_semi")
    equal = rest.groupBy("high", "low").agg(F.min(F.struct("doc", "mark", F.col("first").alias("run"))).alias("at"))
    return [*told, equal.select("at.*")]


def without_repeats(
    docs: DataFrame, depth: int = DEPTH, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The rows of ``docs`` with ``cut`` = (n_words, n_removed, kept) added.

    A word goes if a window of ``depth`` words over it also starts earlier, in a document with a
    smaller id or before in the same; ``kept`` are the other words, unchanged, joined by one
    space. Null text has no words. Rows with the same id and text are one document and get the
    same result; rows with one id and several texts are ordered by a hash of the text; a null id
    counts as the smallest. An empty table gives no rows. A column ``cut`` is replaced.
    """
    own = {name: F.col(f"`{name}`") for name in docs.columns if name != "cut"}
    known = in_small_batches(docs).select(
        F.coalesce(F.col(id_column).cast("long"), F.lit(-(2**63))).alias("doc"),
        F.xxhash64(whole(F.col(text_column))).alias("mark"),
        F.struct(*own.values()).alias("own"),
    )
    text = whole(F.col("own").getField(text_column))
    runs = (
        repeated_windows(known.select("doc", "mark", text.alias("text")), depth)
        .groupBy("doc", "mark")
        .agg(F.flatten(F.collect_list("runs")).alias("runs"), F.flatten(F.collect_list("firsts")).alias("firsts"))
    )
    runs = written(runs, "repeats")

    @F.pandas_udf("n_words long, n_removed long, kept string")
    def cut(texts: pd.Series, all_runs: pd.Series, all_firsts: pd.Series) -> pd.DataFrame:
        rows = []
        for text, found, firsts in zip(texts, all_runs, all_firsts):
            words = words_of(text)
            if found is None:
                rows.append((len(words), 0, b" ".join(words).decode("utf-8", "replace")))
                continue
            windows = max(len(words) - depth + 1, 0)
            repeat = _covered(found >> 32, (found >> 32) + (found & _ALL), windows)
            repeat[np.asarray(firsts if windows else [], np.int64)] = False
            starts = np.flatnonzero(repeat)
            keep = ~_covered(starts, starts + depth, len(words))
            kept = [word for word, stays in zip(words, keep.tolist()) if stays]
            rows.append((len(words), len(words) - len(kept), b" ".join(kept).decode("utf-8", "replace")))
        return pd.DataFrame(rows, columns=["n_words", "n_removed", "kept"])

    return (
        known.join(runs.hint("merge"), ["doc", "mark"], "left")
        .withColumn("cut", cut(text, "runs", "firsts"))
        .select("own.*", "cut")
    )


def substring_digest(docs: DataFrame) -> DataFrame:
    """The operator's result, counted and hashed."""
    done = without_repeats(docs.select("doc_id", "text")).select("doc_id", "cut.*")
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
