"""Words of many texts at once, as Arrow arrays."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401


def split_words(
    texts: pa.Array, kinds: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None
) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts one behind the other, and where each text's words end.

    Words stand between spaces and the control characters 9 to 13. Null texts have none.
    ``kinds`` tells from all bytes and the texts' starts which are of kind 1 and 2, others 0; a
    word also ends between these two kinds.
    """
    texts = pa.compute.fill_null(texts.cast(pa.large_binary()), b"")
    _, offsets, data = texts.buffers()
    places = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    held = np.frombuffer(data, np.uint8)[places[0] : places[-1]] if data is not None else np.empty(0, np.uint8)
    places = places - places[0]
    inside = ~((held == 32) | ((held >= 9) & (held <= 13)))
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    cut = places[:-1][places[:-1] < len(held)]
    opens[cut] = inside[cut]
    if kinds:
        kind = kinds(held, cut)
        opens[1:] |= kind[1:] ^ kind[:-1] == 3
    starts = np.flatnonzero(opens)
    # A number for every word, not for every byte: a slice's bytes are many.
    closes = inside.copy()
    closes[:-1] &= ~inside[1:] | opens[1:]
    spans = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(np.flatnonzero(closes) + 1 - starts, out=spans[1:])
    buffers = [None, pa.py_buffer(spans), pa.py_buffer(held[inside])]
    return pa.Array.from_buffers(pa.large_binary(), len(starts), buffers), np.searchsorted(starts, places[1:])


def joined_words(words: pa.Array, ends: np.ndarray) -> pa.Array:
    """One text for each run of words up to ``ends``: the words joined by one space."""
    _, offsets, data = words.buffers()
    spans = np.frombuffer(offsets, np.int64)[words.offset : words.offset + len(words) + 1] if len(words) else np.zeros(1, np.int64)
    letters = np.frombuffer(data, np.uint8)[spans[0] : spans[-1]] if data is not None else np.empty(0, np.uint8)
    spans = spans - spans[0]
    said = np.full(len(letters) + len(words), 32, np.uint8)
    said[np.arange(len(letters)) + np.repeat(np.arange(len(words)), np.diff(spans))] = letters
    after = spans[ends] + ends  # the place behind the space behind a text's last word
    last = after[np.diff(after, prepend=0) > 0] - 1
    said = np.delete(said, last)
    after = after - np.cumsum(np.diff(after, prepend=0) > 0)
    buffers = [None, pa.py_buffer(np.concatenate([[0], after]).astype(np.int64)), pa.py_buffer(said)]
    return pa.Array.from_buffers(pa.large_binary(), len(ends), buffers)
