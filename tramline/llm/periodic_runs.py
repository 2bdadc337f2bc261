"""Periodic runs of words, proposed by a dictionary of basic factors.

A basic factor is a stretch of 2 ** k words. The dictionary names the factors of each document
level by level: equal factors get equal numbers, those of a level from pairs of the level below.
A factor and the next place it occurs at (its successor), if that is no further than twice its
length, propose the distance as a period. Places side by side with one distance are one
arithmetic progression and one proposal; it is extended to both sides as far as words stay equal
at that distance, and what several levels found alike is kept once, with its smallest period.

Nothing is lost: a run of period q and at least max(24, 3 q) words has, at the level with
q <= length < 2 q (8 words for q < 8), a first factor whose successor is exactly q words on. A
nearer one would give the run a smaller period, for two periods that fit into a factor together
have their greatest common divisor as a period.

Factors that occur once in a document go before the next level is named, so plain prose costs
little beyond its words. A document is worked on whole, in arrays; short ones share them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, functions as F

from tramline.llm.common import give_back, in_small_batches, pieces
from tramline.llm.words import joined_words, split_words

#: A run has at least this many words ...
LEAST_WORDS = 24
#: ... and this many times its period.
TIMES = 3
SLICE_CHARS = 4 << 20
_FIRST = 8  # the shortest factor that proposes

_SEEN = pa.struct(
    [
        ("n_words", pa.int64()),
        ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
        ("collapsed", pa.string()),
    ]
)
_SEEN_DDL = "struct<n_words:bigint,runs:array<struct<start:bigint,length:bigint,period:bigint>>,collapsed:string>"


def _numbered(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A number for each distinct pair of small numbers."""
    return pd.factorize(left * (int(right.max(initial=0)) + 1) + right)[0]


def _recurring(places: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places whose factor occurs again."""
    again = np.bincount(names)[names] > 1 if len(names) else np.empty(0, bool)
    return places[again], names[again]


def proposals(words: np.ndarray, ends: np.ndarray, least: int, times: int) -> Iterator[Iterator[tuple[int, int, int]]]:
    """For each level, (first place, words equal from there on, period) of its progressions by place.

    ``words`` are the words of several documents as numbers, one document behind the other.
    """
    sizes = np.diff(ends, prepend=0)
    owner = np.repeat(np.arange(len(ends)), sizes)
    places = np.flatnonzero(np.repeat(sizes >= least, sizes))
    longest = int(sizes.max(initial=0))
    # Names are of one document: a factor that others share, but that occurs once in its own, goes.
    places, names = _recurring(places, _numbered(owner[places], words[places].astype(np.int64)))
    size = 1
    while len(places) and size < 2 * max(_FIRST // 2, longest // times):
        if size >= _FIRST:
            order = np.argsort(names, kind="stable")
            gap = np.diff(places[order])
            near = (np.diff(names[order]) == 0) & (gap <= 2 * size)
            first, period = places[order[:-1][near]], gap[near]
            order = np.argsort(first, kind="stable")
            first, period = first[order], period[order]
            heads = np.flatnonzero((np.diff(first, prepend=-2) != 1) | (np.diff(period, prepend=-1) != 0))
            many = np.diff(np.append(heads, len(first)))
            yield zip(first[heads].tolist(), (many + size - 1).tolist(), period[heads].tolist())
        second = np.searchsorted(places, places + size)
        there = second < len(places)
        there[there] = places[second[there]] == places[there] + size
        there &= places + 2 * size <= ends[owner[places]]
        places, names = _recurring(places[there], _numbered(names[there], names[second[there]]))
        size *= 2


def _equal_run(left: np.ndarray, right: np.ndarray) -> int:
    """How many leading words are the same."""
    at, step = 0, 64
    while at < len(left):
        differ = left[at : at + step] != right[at : at + step]
        if differ.any():
            return at + int(differ.argmax())
        at, step = at + step, step * 4
    return len(left)


def find_runs(words: np.ndarray, ends: np.ndarray, least: int = LEAST_WORDS, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of all documents, by start, then period.

    ``least`` is at least 16 and ``times`` at least 3, for the factors to meet every run.
    """
    if least < 2 * _FIRST or times < 3:
        raise ValueError("runs of fewer than 16 words or 3 periods are not all found")
    found: dict[tuple[int, int], int] = {}
    for level in proposals(words, ends, least, times):
        reached: dict[tuple[int, int], int] = {}  # how far a period's stretches of a document are known
        for first, equal, period in level:
            doc = int(np.searchsorted(ends, first, side="right"))
            after = first + equal
            if after <= reached.get((doc, period), 0):
                continue
            begin, end = int(ends[doc - 1]) if doc else 0, int(ends[doc])
            after += _equal_run(words[after : end - period], words[after + period : end])
            first -= _equal_run(words[begin:first][::-1], words[begin + period : first + period][::-1])
            reached[doc, period] = after
            length = after - first + period
            if length >= max(least, times * period):
                found[first, length] = min(period, found.get((first, length), period))
    return sorted(((start, length, period) for (start, length), period in found.items()), key=lambda run: (run[0], run[2]))


def _collapse(least: int, times: int, text_column: str, own: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, SLICE_CHARS, text_column):
            words, ends = split_words(part.column(text_column))
            numbers = words.dictionary_encode().indices.to_numpy(zero_copy_only=False)
            runs = find_runs(numbers, ends, least, times)
            edges = np.zeros(len(words) + 1, np.int32)
            for start, length, period in runs:
                edges[start + period] += 1
                edges[start + length] -= 1
            keep = np.cumsum(edges[:-1]) == 0
            texts = joined_words(words.filter(pa.array(keep)), np.concatenate([[0], np.cumsum(keep)])[ends])
            of = np.array([r[0] for r in runs], np.int64)
            doc = np.searchsorted(ends, of, side="right")
            begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
            columns = [of - begins[doc], *(np.array([r[n] for r in runs], np.int64) for n in (1, 2))]
            structs = pa.StructArray.from_arrays([pa.array(c) for c in columns], ["start", "length", "period"])
            borders = pa.array(np.searchsorted(doc, np.arange(len(ends) + 1)), pa.int32())
            seen = pa.StructArray.from_arrays(
                [pa.array(np.diff(ends, prepend=0).astype(np.int64)), pa.ListArray.from_arrays(borders, structs), texts.cast(pa.string())],
                fields=list(_SEEN),
            )
            yield pa.RecordBatch.from_arrays([*(part.column(name) for name in own), seen], [*own, "periodic"])
        give_back()

    return run


def without_periodic_runs(
    docs: DataFrame, text_column: str = "text", least: int = LEAST_WORDS, times: int = TIMES
) -> DataFrame:
    """The rows of ``docs`` with ``periodic`` = (n_words, runs, collapsed) added.

    A run is a longest stretch of words with smallest period q, of at least ``least`` words and
    ``times`` periods; ``runs`` are sorted by start (from 0), then period. ``collapsed`` are the
    words, unchanged and joined by one space, without those that a run holds after its first
    period. Null and empty texts have no words, no runs and an empty ``collapsed``; repeated rows
    are each looked at; a column ``periodic`` is replaced; an empty table gives no rows. One
    text is one piece of work: it needs about 60 bytes of memory a word.
    """
    rows = in_small_batches(docs.drop("periodic"))
    fields = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in rows.schema)
    return rows.mapInArrow(_collapse(least, times, text_column, rows.columns), f"{fields}, periodic {_SEEN_DDL}")


def runs_digest(docs: DataFrame) -> DataFrame:
    """The operator's result for (doc_id, text), counted and hashed.

    The run of the greatest length / period, compared as fractions, is told; then the one with
    the smallest start, then period.
    """
    done = without_periodic_runs(docs.select("doc_id", "text")).select("doc_id", "periodic.*")
    better = lambda best, run: best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"])
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    best = F.aggregate("runs", none, lambda best, run: F.when(better(best, run), run).otherwise(best))
    line = lambda run: F.concat_ws(",", run["start"], run["length"], run["period"])
    listed = F.array_join(F.transform("runs", lambda run: F.concat(line(run), F.lit("\n"))), "")
    return done.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.*",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
