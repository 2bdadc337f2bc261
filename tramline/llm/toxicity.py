"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text.

Texts are folded first: lower case, look-alike letters of other scripts, and digits or signs that
stand for letters. All entries of the lexicon and all exception phrases are found in one pass;
an entry inside an exception phrase does not count. The sum of weights is normalised by a power
of the text's length. Entries, weights, exceptions and the power are learned from labels, and
entries and exceptions may also be given.
"""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from collections import Counter
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import accumulate, combinations

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tramline.llm.common import in_small_batches, one_text_each, whole

#: Labelled documents the lexicon is learned from, at most, of each label; the characters each may have.
SAMPLE_DOCUMENTS = 3_000
SAMPLE_CHARS = 50_000
#: An entry must stand in this many labelled documents, and almost only in toxic ones.
LEAST_DOCUMENTS = 3
LEAST_PRECISION = 0.99
#: How many entries chance alone may be expected to bring.
CHANCE = 0.01
_SPREADS = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93)

# Letters that look like Latin ones, in the order of the Latin letters.
_HOMOGLYPHS = {
    "а": "a", "α": "a", "в": "b", "β": "b", "с": "c", "ϲ": "c", "ԁ": "d", "е": "e", "ε": "e",
    "ғ": "f", "ɡ": "g", "һ": "h", "н": "h", "і": "i", "ι": "i", "ј": "j", "к": "k", "κ": "k",
    "ӏ": "l", "м": "m", "п": "n", "η": "n", "о": "o", "ο": "o", "р": "p", "ρ": "p", "ԛ": "q",
    "г": "r", "ѕ": "s", "т": "t", "τ": "t", "υ": "u", "ν": "v", "ѵ": "v", "ԝ": "w", "ω": "w",
    "х": "x", "χ": "x", "у": "y", "γ": "y", "ᴢ": "z",
}
# Digits and signs that stand for letters.
_STANDINS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i"}

_LOOKALIKE = str.maketrans(_HOMOGLYPHS)
_FOREIGN = re.compile("[Ͱ-ԯᴀ-ᵿ＀-￯\U0001d400-\U0001d7ff]")
_STANDIN = re.compile(r"(?<=[^\W\d_])[0134578@$!](?=[^\W_])|[0134578@$](?=[^\W\d_])")
_HIDDEN = re.compile("[­​-‏⁠﻿]")
_WORD = re.compile(r"[^\W\d_]+")


def fold(text: str | None) -> str:
    """The text in lower case, with look-alikes and stand-ins as the letters they stand for."""
    if not text:
        return ""
    text = text.lower()
    if not text.isascii():
        if _FOREIGN.search(text):
            text = unicodedata.normalize("NFKC", text).lower().translate(_LOOKALIKE)
        text = _HIDDEN.sub("", text)
    return _STANDIN.sub(lambda sign: _STANDINS[sign[0]], text)


@dataclass
class Lexicon:
    """Entries (a word, or a word's beginning marked by a trailing ``*``) with weights, exception
    phrases, the power of the length and the two numbers that turn a sum into a probability."""

    entries: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = ()
    power: float = 0.5
    slope: float = 1.0
    offset: float = -2.0

    def __post_init__(self) -> None:
        self._found = ahocorasick.Automaton()
        for phrase in self.exceptions:
            self._found.add_word(fold(phrase), (len(fold(phrase)), None, True))
        for entry, weight in self.entries.items():
            stem = entry.endswith("*")
            key = fold(entry.rstrip("*"))
            if key not in self._found:
                self._found.add_word(key, (len(key), weight, not stem))
        if len(self._found):
            self._found.make_automaton()

    def __getstate__(self):
        return self.entries, self.exceptions, self.power, self.slope, self.offset

    def __setstate__(self, state):
        self.__init__(*state)

    def matches(self, folded: str) -> list[tuple[int, int, float]]:
        """(start, end, weight) of the entries that count."""
        if not len(self._found):
            return []
        found, excused, last = [], [], len(folded)
        for stop, (length, weight, to_the_end) in self._found.iter(folded):
            start, stop = stop - length + 1, stop + 1
            if start and folded[start - 1].isalnum() or to_the_end and stop < last and folded[stop].isalnum():
                continue
            (excused if weight is None else found).append((start, stop, weight))
        if excused:
            # Of the phrases that begin no later than a match, does the one that goes furthest hold it?
            spans = sorted((start, stop) for start, stop, _ in excused)
            starts, reach = [start for start, _ in spans], list(accumulate((stop for _, stop in spans), max))
            found = [m for m in found if (k := bisect_right(starts, m[0])) == 0 or reach[k - 1] < m[1]]
        return found

    def total(self, folded: str) -> float:
        """The weights of the matched words; a word counts once, by its heaviest entry."""
        words: dict[int, float] = {}
        for start, _, weight in self.matches(folded):
            words[start] = max(weight, words.get(start, weight))
        return sum(words.values())

    def normalised(self, text: str | None) -> tuple[float, int]:
        folded = fold(text)
        return self.total(folded), max(1, len(folded.split()))

    def score(self, text: str | None) -> float:
        """Between 0 and 1; higher: more likely toxic."""
        total, words = self.normalised(text)
        z = self.slope * math.log1p(100 * total / words**self.power) + self.offset
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _distinct(rows: list[tuple[str, int]]) -> list[tuple[str, int]]:
    """One text of each group of near copies of one label: those that share two of four least hashes
    of their runs of three words. Else the chance words of one text look as if many had them."""
    seen: set[tuple] = set()
    kept = []
    for text, label in rows:
        words = text.split()
        runs = {zlib.crc32(" ".join(words[i : i + 3]).encode("utf-8", "replace")) for i in range(max(1, len(words) - 2))}
        hashes = np.fromiter(runs, np.uint64, len(runs))
        least = [int(((hashes * np.uint64(m)) >> np.uint64(16) & np.uint64(0xFFFFFFFF)).min()) for m in _SPREADS]
        marks = {(label, i, least[i], j, least[j]) for i, j in combinations(range(len(least)), 2)}
        if not marks & seen:
            kept.append((text, label))
        seen |= marks
    return kept


def _chance(toxic: int, clean: int, share: float) -> float:
    """The logarithm of a bound on how often chance puts this many of a term's texts among the toxic."""
    q = toxic / (toxic + clean)
    far = toxic * math.log(q / share) + (clean * math.log((1 - q) / (1 - share)) if clean else 0.0)
    return -far if q > share else 0.0


def learn(texts: Iterable[str], labels: Iterable[int], given: dict[str, float] | None = None, exceptions: tuple[str, ...] = ()) -> Lexicon:
    """A lexicon from labelled texts; equal texts count once, toxic if any copy is, near copies once.

    An entry is a word that stands almost only in toxic texts, and in so many that chance would not
    put a single one of all words tried there; then a beginning that does so by other words.
    """
    label_of: dict[str, int] = {}
    for text, label in zip(texts, labels):
        text = fold(text)
        label_of[text] = max(int(label), label_of.get(text, 0))
    rows = _distinct(sorted(label_of.items()))
    words = [(set(_WORD.findall(text)), label) for text, label in rows]
    n_toxic = sum(label for _, label in rows)
    n_clean, share = len(rows) - n_toxic, n_toxic / max(len(rows), 1)
    weights = dict(given or {})

    def admit(terms: list[tuple[set[str], int]]) -> None:
        toxic, clean = (Counter(term for own, label in terms if label == which for term in own) for which in (1, 0))
        rare = math.log(CHANCE / max(len(toxic), 1))
        for term, found in sorted(toxic.items()):
            rate, other = found / n_toxic, clean[term] / max(n_clean, 1)
            if found >= LEAST_DOCUMENTS and rate >= LEAST_PRECISION * (rate + other) and _chance(found, clean[term], share) <= rare:
                weight = math.log((found + 0.5) / (n_toxic + 1) / ((clean[term] + 0.5) / (n_clean + 1)))
                weights.setdefault(term, max(weight, 0.1))

    if n_toxic and n_clean:
        admit(words)
        for n in (6, 5, 4):  # the longest beginning first
            known = tuple(entry.rstrip("*") for entry in weights if entry.endswith("*"))
            admit([({w[:n] + "*" for w in own if len(w) > n and w not in weights and not w.startswith(known)}, label) for own, label in words])
    found = Lexicon(weights, exceptions)
    found = Lexicon(weights, exceptions + _learned_exceptions(found, rows))
    return _calibrated(found, rows)


def _learned_exceptions(lexicon: Lexicon, rows: list[tuple[str, int]]) -> tuple[str, ...]:
    """Phrases of an entry and a neighbouring word that stand mostly in clean texts."""
    seen: dict[str, list[int]] = {}
    for text, label in rows:
        phrases = set()
        for start, stop, _ in lexicon.matches(text):
            end = stop + len(_WORD.match(text, stop)[0]) if _WORD.match(text, stop) else stop
            before, after = re.search(r"([^\W\d_]+) $", text[max(0, start - 40) : start]), re.match(r" ([^\W\d_]+)", text[end : end + 40])
            if before:
                phrases.add(f"{before[1]} {text[start:end]}")
            if after:
                phrases.add(f"{text[start:end]} {after[1]}")
        for phrase in phrases:
            seen.setdefault(phrase, [0, 0])[label > 0] += 1
    return tuple(sorted(p for p, (clean, toxic) in seen.items() if clean >= 3 and toxic * 4 <= clean))


def _calibrated(lexicon: Lexicon, rows: list[tuple[str, int]]) -> Lexicon:
    """The power of the length, slope and offset with the least log loss; both labels weigh the same."""
    label = np.array([x for _, x in rows], float)
    if not len(rows) or label.min() == label.max():
        return lexicon
    sums = [lexicon.normalised(text) for text, _ in rows]
    total, words = np.array([s for s, _ in sums]), np.array([n for _, n in sums], float)
    share = np.where(label > 0, 0.5 / label.sum(), 0.5 / (len(label) - label.sum()))
    best = None
    for power in (0.25, 0.5, 1.0):
        x = np.column_stack((np.log1p(100 * total / words**power), np.ones(len(label))))
        w = np.array([0.0, 0.0])
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            slope = x.T @ (share * (p - label)) + 1e-3 * w * [1, 0]
            curve = (x * (share * p * (1 - p))[:, None]).T @ x + np.diag([1e-3, 1e-6])
            w = w - np.linalg.solve(curve, slope)
        loss = -(share * np.log(np.clip(np.where(label > 0, p, 1 - p), 1e-12, 1))).sum()
        if best is None or loss < best[0]:
            best = loss, power, w
    return Lexicon(lexicon.entries, lexicon.exceptions, best[1], float(best[2][0]), float(best[2][1]))


def train(docs: DataFrame, labels: DataFrame, usable: Column, label: str = "toxic") -> Lexicon:
    """Learn from ``SAMPLE_DOCUMENTS`` documents of each label at most, chosen by a hash of the id.

    The sample's size is fixed, so its ids may be broadcast and its texts come to the driver.
    """
    rows = labels.filter(usable & F.col(label).isNotNull() & F.col("doc_id").isNotNull()).select(
        "doc_id", (F.col(label) > 0).cast("int").alias("label")
    )
    order = (F.xxhash64("doc_id"), "doc_id")
    chosen = rows.filter("label = 1").orderBy(*order).limit(SAMPLE_DOCUMENTS).union(
        rows.filter("label = 0").orderBy(*order).limit(SAMPLE_DOCUMENTS)
    )
    texts = in_small_batches(docs).select("doc_id", "text").filter(F.length(whole(F.col("text"))) <= SAMPLE_CHARS)
    found = [(row.text, row.label) for row in one_text_each(texts, chosen).toLocalIterator()]
    return learn([text for text, _ in found], [label for _, label in found])


def toxicity_score(lexicon: Lexicon, text: Column) -> Column:
    """The lexicon's score of a whole text; null counts as empty."""

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series([lexicon.score(x) for x in part], dtype="float64")

    return score(whole(text))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``.

    Labels whose crc32(id) leaves 2 when divided by four are held out. Null and empty texts match
    nothing; rows that share an id are scored each; an empty table gives no rows.
    """
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    lexicon = train(docs, labels, ~held_out)
    scored = docs.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), toxicity_score(lexicon, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))
