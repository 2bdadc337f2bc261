"""Quality classifier: gated attention over the passages of a document.

Every passage of a text is encoded; a gate learns from document labels alone which passages
matter; the document's score is that of the weighted passage representation. The model is a few
thousand numbers, trained on a bounded sample of labelled documents and then applied to whole
texts, however many passages they have.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tramline.llm.common import give_back, in_small_batches, one_text_each, pieces, whole
from tramline.llm.words import split_words

#: Words of a passage.
PASSAGE = 64
#: Labelled documents the model is fitted on, at most, and the characters each may have.
SAMPLE_DOCUMENTS = 4_000
SAMPLE_CHARS = 50_000
#: Documents below this score are rejected.
THRESHOLD = 0.3
#: Characters scored at a time; one longer text is a slice of its own.
SLICE_CHARS = 4 << 20
_SHAPES, _WORDS = 256, 192
_STATS = 6
WIDTH = _SHAPES + _WORDS + _STATS
_HIDDEN, _GATE = 32, 16
_REMEMBERED = 150_000
_CHUNK = 2_048  # passages encoded at a time


_LOWER = re.compile(r"[^\W\d_]+")


def _shape(word: str) -> str:
    """Runs of letters as a, of capitals as A, of both as B, digits as 0; other characters as they are."""
    letters = _LOWER.sub(lambda run: "a" if run[0].islower() else "A" if run[0].isupper() else "B", word)
    return re.sub(r"\d+", "0", re.sub(r"([^\w\s])\1+", r"\1", letters))


class _WordFeatures(dict):
    """Shape bucket, word bucket, length and marks of a word in one number, remembered up to a bound."""

    def __init__(self) -> None:
        super().__init__()
        self.shapes: dict[str, int] = {}

    def __missing__(self, word: bytes) -> int:
        if len(self) > _REMEMBERED:
            self.clear()
        text = word.decode("utf-8", "replace")
        if text.isalpha():  # one run of letters, the usual word
            shape, marks = "a" if text.islower() else "A" if text.isupper() else "B", 0
        elif text[:-1].isalpha() and text[-1] in ".,;:!?":
            shape, marks = ("a" if text[:-1].islower() else "A" if text[:-1].isupper() else "B") + text[-1], 1
        else:
            shape = _shape(text)
            marks = 0 if text.isalnum() else min(sum(not c.isalnum() for c in text), 255)
        bucket = self.shapes.get(shape)
        if bucket is None:
            bucket = zlib.crc32(shape.encode()) % _SHAPES
            if len(shape) < 3:
                self.shapes[shape] = bucket
        value = self[word] = bucket | zlib.crc32(word, 1) % _WORDS << 8 | min(len(text), 255) << 16 | marks << 24
        return value


_FEATURES = _WordFeatures()


def _distinct(group: np.ndarray, words: np.ndarray, kinds: int, groups: int) -> np.ndarray:
    """How many different words each group has."""
    pairs = np.sort(group * kinds + words)
    return np.bincount(pairs[np.flatnonzero(np.diff(pairs, prepend=-1))] // kinds, minlength=groups)


def passages(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(features, text) of the passages of all texts in order, a row each, ``_CHUNK`` passages at a time.

    A text without words is one passage of zeros. Of a long text only its bytes, a number a word
    and its different words are held whole.
    """
    words, ends = split_words(texts)
    coded = words.dictionary_encode()
    ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    known = np.fromiter(map(_FEATURES.__getitem__, coded.dictionary.to_pylist()), np.int64, len(coded.dictionary))
    kinds, counts = max(len(known), 1), np.diff(ends, prepend=0)
    many = np.maximum(-(-counts // PASSAGE), 1)
    text = np.repeat(np.arange(len(ends)), many)
    begin = (ends - counts)[text] + (np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)) * PASSAGE
    stop = np.minimum(begin + PASSAGE, ends[text])
    different = _distinct(np.repeat(np.arange(len(ends)), counts), ids, kinds, len(ends))
    whole_text = np.column_stack([different / np.maximum(counts, 1), np.minimum(np.log1p(counts) / 10, 2)])
    for at in range(0, len(text), _CHUNK):
        own = text[at : at + _CHUNK]
        part, spans = ids[begin[at] : stop[at + len(own) - 1]], (stop - begin)[at : at + len(own)]
        each, n, size = known[part], len(own), np.maximum(spans, 1).astype(np.float32)
        passage = np.repeat(np.arange(n), spans)
        base = passage * WIDTH
        rows = np.bincount(np.concatenate((base + (each & 255), base + _SHAPES + (each >> 8 & 255))), minlength=n * WIDTH)
        rows = np.sqrt(rows.reshape(n, WIDTH).astype(np.float32) / size[:, None])
        distinct = _distinct(passage, part, kinds, n).astype(np.float32)
        length = np.bincount(passage, each >> 16 & 255, n) / size
        marks = np.bincount(passage, each >> 24, n) / size
        rows[:, -_STATS:] = np.column_stack(
            [np.minimum(length / 10, 3), np.minimum(marks, 3), distinct / size, whole_text[own, 0], size / PASSAGE, whole_text[own, 1]]
        )
        rows[spans == 0] = 0
        yield rows, own


def encode_passages(text: str | None) -> np.ndarray:
    """All passages of a text at once, for texts of bounded length."""
    return np.concatenate([rows for rows, _ in passages(pa.array([text], pa.string()))])


@dataclass
class AttentionModel:
    """Weights of the encoder (``w``), the gate (``v``, ``u``, ``a``) and the score (``c``)."""

    weights: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def fresh(cls, seed: int = 7) -> AttentionModel:
        rng = np.random.default_rng(seed)
        shapes = {"w": (WIDTH, _HIDDEN), "wb": (_HIDDEN,), "v": (_HIDDEN, _GATE), "u": (_HIDDEN, _GATE), "a": (_GATE,), "c": (_HIDDEN,), "cb": (1,)}
        return cls(
            {k: (rng.normal(0, 1 / np.sqrt(s[0]), s) if k not in ("wb", "cb") else np.zeros(s)).astype(np.float32) for k, s in shapes.items()}
        )

    def _encoded(self, rows: np.ndarray) -> tuple[np.ndarray, ...]:
        p = self.weights
        hidden = np.tanh(rows @ p["w"] + p["wb"])
        tanh, gate = np.tanh(hidden @ p["v"]), 1 / (1 + np.exp(-(hidden @ p["u"])))
        return hidden, tanh, gate, (tanh * gate) @ p["a"]

    def logits(self, parts: Iterable[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """The scores of texts before they are squeezed, from chunks of (features, text) in order."""
        encoded = [(*self._encoded(rows)[::3], text) for rows, text in parts]
        if not encoded:
            return np.empty(0)
        hidden, logit, text = (np.concatenate(columns) for columns in zip(*encoded))
        heads = np.flatnonzero(np.diff(text, prepend=-1))
        top = np.maximum.reduceat(logit, heads)
        weight = np.exp(logit - np.repeat(top, np.diff(np.append(heads, len(text)))))
        z = np.add.reduceat(weight[:, None] * hidden, heads) / np.add.reduceat(weight, heads)[:, None]
        return z @ self.weights["c"] + self.weights["cb"][0]

    def scores(self, texts: pa.Array) -> np.ndarray:
        """For each text between 0 and 1, higher: label 1 likelier. Passages are encoded in chunks."""
        return 1 / (1 + np.exp(-np.clip(self.logits(passages(texts)).astype(np.float64), -30, 30)))

    def score(self, text: str | None) -> float:
        """The score of one text."""
        return float(self.scores(pa.array([text], pa.string()))[0])

    def calibrate(self, bags: list[np.ndarray], labels: np.ndarray) -> AttentionModel:
        """Move the offset so that ``THRESHOLD`` is where the labels part best, both counted alike.

        Among equally good places the middle of the widest gap is taken. Nothing changes if a
        label is missing.
        """
        if len(np.unique(labels)) < 2:
            return self
        found = self.logits((rows, np.full(len(rows), n)) for n, rows in enumerate(bags))
        order = np.argsort(found)
        found, good = found[order], labels[order] > 0.5
        # Below place k: what is rejected there, as a share of each label.
        lost = np.concatenate([[0], np.cumsum(good)]) / good.sum()
        caught = np.concatenate([[0], np.cumsum(~good)]) / (~good).sum()
        worth = (caught - lost)[1:-1]
        gap = np.diff(found)
        best = max(range(len(gap)), key=lambda k: (round(float(worth[k]), 9), float(gap[k])))
        middle = (found[best] + found[best + 1]) / 2
        self.weights["cb"] = self.weights["cb"] + np.float32(np.log(THRESHOLD / (1 - THRESHOLD)) - middle)
        return self

    def step(self, bags: list[np.ndarray], labels: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the log loss of some documents."""
        p = self.weights
        rows = np.concatenate(bags)
        bag = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
        hidden, tanh, gate, logit = self._encoded(rows)
        top = np.full(len(bags), -np.inf, np.float32)
        np.maximum.at(top, bag, logit)
        weight = np.exp(logit - top[bag])
        weight /= np.bincount(bag, weight, len(bags))[bag]
        weight = weight.astype(np.float32)
        z = np.zeros((len(bags), _HIDDEN), np.float32)
        np.add.at(z, bag, weight[:, None] * hidden)
        error = ((1 / (1 + np.exp(-(z @ p["c"] + p["cb"][0])))) - labels).astype(np.float32) / len(bags)
        dz = error[:, None] * p["c"]
        pull = (hidden * dz[bag]).sum(axis=1)
        mean = np.bincount(bag, weight * pull, len(bags)).astype(np.float32)
        dlogit = weight * (pull - mean[bag])
        dgated = dlogit[:, None] * p["a"]
        dt, ds = dgated * gate * (1 - tanh**2), dgated * tanh * gate * (1 - gate)
        dhidden = weight[:, None] * dz[bag] + dt @ p["v"].T + ds @ p["u"].T
        dpre = dhidden * (1 - hidden**2)
        return {
            "w": rows.T @ dpre, "wb": dpre.sum(axis=0), "v": hidden.T @ dt, "u": hidden.T @ ds,
            "a": (tanh * gate).T @ dlogit, "c": z.T @ error, "cb": np.array([error.sum()], np.float32),
        }

    def fit(self, bags: list[np.ndarray], labels: np.ndarray, epochs: int = 12, batch: int = 32, rate: float = 3e-3, seed: int = 7) -> AttentionModel:
        """Adam on the log loss, the same result for the same input."""
        rng, moments, t = np.random.default_rng(seed), {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.weights.items()}, 0
        for epoch in range(epochs):
            order = rng.permutation(len(bags))
            now = rate * (1 - epoch / epochs)
            for start in range(0, len(order), batch):
                chosen, t = order[start : start + batch], t + 1
                for k, g in self.step([bags[i] for i in chosen], labels[chosen]).items():
                    g = g + 1e-4 * self.weights[k]
                    m, v = moments[k]
                    m[...] = 0.9 * m + 0.1 * g
                    v[...] = 0.999 * v + 0.001 * g * g
                    self.weights[k] -= now * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        return self


def train(docs: DataFrame, labels: DataFrame, usable: Column, label: str = "quality") -> AttentionModel:
    """Fit on ``SAMPLE_DOCUMENTS`` labelled documents at most, chosen by a hash of their id.

    ``usable`` says which labels may be learned from. The sample's size is fixed, so its ids may
    be broadcast and its texts, of ``SAMPLE_CHARS`` characters at most, come to the driver.
    Without a usable label the model stays as it starts.
    """
    chosen = (
        labels.filter(usable & F.col(label).isNotNull() & F.col("doc_id").isNotNull())
        .select("doc_id", F.col(label).cast("float").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label")
        .limit(SAMPLE_DOCUMENTS)
    )
    texts = in_small_batches(docs).select("doc_id", "text").filter(F.length(whole(F.col("text"))) <= SAMPLE_CHARS)
    rows = sorted(
        ((r.doc_id, r.label, r.text) for r in one_text_each(texts, chosen).toLocalIterator()),
    )
    model = AttentionModel.fresh()
    if not rows:
        return model
    bags, truth = [encode_passages(r[2]) for r in rows], np.array([r[1] for r in rows], np.float32)
    model.fit(bags, truth)
    return model.calibrate(bags, truth)


def quality_score(model: AttentionModel, text: Column) -> Column:
    """The model's score of a whole text; null counts as empty."""

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in texts:
            held = pa.RecordBatch.from_arrays([pa.array(part, pa.string())], ["text"])
            found = [model.scores(some.column("text")) for some in pieces([held], SLICE_CHARS, "text")]
            yield pd.Series(np.concatenate([np.empty(0), *found]))
        _FEATURES.clear()
        give_back()

    return score(whole(text))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``.

    Labels whose crc32(id) is divisible by five are held out. Null and empty texts are scored as
    a document without words; rows that share an id are scored each; an empty table gives none.
    """
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = train(docs, labels, ~held_out)
    scored = docs.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), quality_score(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
