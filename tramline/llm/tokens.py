"""Token ids of whole texts, by the tokenizers library.

White space never reaches an id in the vocabularies used here, so a text's ids are those of its
words one after the other. Words repeat, so each process encodes a word once and keeps its ids;
marks beside a letter or digit are a word of their own, and words of plain letters are met in lower
case, where the vocabulary's rules allow it.
``by_words`` says whether that holds for a vocabulary file; without it, texts are encoded whole.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from functools import lru_cache
from itertools import compress, islice
from sys import byteorder

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer, pre_tokenizers

from tramline.llm.words import joined_words, split_words

#: Words a process remembers, about 170 bytes each; at the bound it keeps the first half and goes on.
REMEMBERED = 300_000
_CHUNK = 64
#: New words taken apart at a time.
_NEW = 8_000
_LINE = 1_000
#: Bytes told apart and words lowered at a time; one long text has many more.
_BYTES = 1 << 20
_WORDS = 1 << 17

#: A byte's classes, as bits. Behind ``_LEAD``, ``_SECOND`` makes a letter from U+00C0 to U+00FF.
_LETTER, _MARK, _DIGIT, _SECOND, _LEAD, _UPPER_SECOND, _UPPER = 1, 2, 4, 8, 16, 32, 64


def _classes(marks: str) -> bytes:
    """The classes of each byte."""
    made = []
    for byte in range(256):
        letter = _LETTER * (byte < 128 and chr(byte).isalpha()) | _UPPER * (65 <= byte <= 90)
        second = _SECOND * (0x80 <= byte <= 0xBF and byte not in (0x97, 0xB7))
        upper = _UPPER_SECOND * (second and byte <= 0x9E)
        sign = _MARK * (byte < 128 and chr(byte) in marks) | _DIGIT * (48 <= byte <= 57)
        made.append(letter | second | upper | sign | _LEAD * (byte == 0xC3))
    return bytes(made)


def ids_type(n_ids: int) -> str:
    """The narrowest little-endian type for ids below ``n_ids``."""
    return "<u2" if n_ids <= 1 << 16 else "<u4"


def _byte_letters() -> list[str]:
    """The public byte-level rule: a printable byte is its own letter, others follow from U+0100."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(byte) if byte in printable else chr(next(others)) for byte in range(256)]


def _letters(classes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(1 for bytes of letters of ASCII and Latin-1, ``_SECOND`` for those behind a lead byte); 0 for others.

    No letter goes beyond a start.
    """
    second = np.zeros_like(classes)
    second[1:] = (classes[:-1] >> 1) & classes[1:] & _SECOND
    second[starts] = 0
    letter = classes & _LETTER | second >> 3
    letter[:-1] |= second[1:] >> 3
    return letter, second


class WordEncoder:
    """Encodes texts to little-endian unsigned 32-bit ids."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        added = rules.get("added_tokens") or []
        self.plain = self._splits_words(rules) and not any(
            token["lstrip"] or token["rstrip"] or token["single_word"] or token["content"].split() != [token["content"]]
            for token in added
        )
        self.letters = {**dict(enumerate(_byte_letters())), 32: " "}
        self.codes = np.asarray([ord(self.letters[byte]) for byte in range(256)], "<u4")
        # Marks that end no added token may be cut off a word's end.
        self.marks = "".join(set(".,!?;:#$%&*") - set("".join(token["content"] for token in added)))
        # (letters, marks, other) of each of many words with one space between them.
        latin = "".join(chr(c) for c in range(0x250) if chr(c).isalpha() and c != 0x130)
        self.parted = re.compile(f"(?:([{latin}]+)([{re.escape(self.marks)}]*)|([^ ]+))(?: |$)").findall
        self.direct = (
            self.plain
            and not any(token["content"].isalpha() for token in added)
            and self._agrees("ProBe", [self._spelled("probe")])
            and self._agrees("Épreuveß", [self._spelled("épreuveß")])
        )
        self.classes = _classes(self.marks)
        self.apart = self.direct and all(self._agrees(f"a{mark}b1{mark}2", ["a", mark, "b", "1", mark, "2"]) for mark in self.marks)
        # The library with the model alone, for words that are spelled already; an id that ends
        # a word tells where the next begins.
        self.alone = Tokenizer(self.model)
        self.alone.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        suffix = rules["model"].get("end_of_word_suffix") or ""
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[n for token, n in vocabulary.items() if suffix and token.endswith(suffix)]] = True
        self.known: dict[bytes, bytes] = {}

    @staticmethod
    def _splits_words(rules: dict) -> bool:
        """Whether white space separates words and is dropped."""
        model, steps = rules["model"], (rules.get("pre_tokenizer") or {}).get("pretokenizers", [])
        return bool(
            model["type"] == "BPE"
            and model.get("end_of_word_suffix")
            and any(s["type"] == "Split" and s["behavior"] == "Removed" and s["invert"] for s in steps)
        )

    def _spelled(self, words: str) -> str:
        """Words of Latin letters as the model sees them: composed, lower case, a letter a byte.

        Words are apart by one space each.
        """
        if words.isascii():
            return words.lower()
        low = unicodedata.normalize("NFC", words).lower()
        return low.encode().decode("latin-1").translate(self.letters)

    def _agrees(self, word: str, spelled: list[str]) -> bool:
        """Whether the library takes the word apart like this."""
        steps = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        if None in steps:
            return False
        return [p for p, _ in steps[1].pre_tokenize_str(steps[0].normalize_str(word))] == spelled

    def _classed(self, held: np.ndarray) -> np.ndarray:
        return np.frombuffer(held.tobytes().translate(self.classes), np.uint8)

    def _kinds(self, held: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """1 for bytes of letters and digits, as far as Latin-1 goes, 2 for those of marks, 0 for others."""
        kinds = np.empty(len(held), np.uint8)
        for at in range(0, len(held), _BYTES):
            first = max(at - 1, 0)  # a byte's neighbours tell whether it belongs to a letter
            some = held[first : at + _BYTES + 1]
            low, high = np.searchsorted(starts, [first, first + len(some)])
            classes = self._classed(some)
            kind = _letters(classes, starts[low:high] - first)[0] | (classes & _DIGIT) >> 2 | classes & _MARK
            kinds[at : at + _BYTES] = kind[at - first :][:_BYTES]
        return kinds

    def _lowered(self, words: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The words, those of nothing but letters of ASCII and Latin-1 in lower case; which these are."""
        _, offsets, data = words.buffers()
        spans = np.frombuffer(offsets, np.int64, len(words) + 1)
        low, plain = np.frombuffer(data, np.uint8, spans[-1]).copy(), np.empty(len(words), bool)
        for at in range(0, len(words), _WORDS):
            ends = spans[at : at + _WORDS + 1]
            held, starts = low[ends[0] : ends[-1]], ends[:-1] - ends[0]
            classes = self._classed(held)
            letter, second = _letters(classes, starts)
            whole = np.bitwise_and.reduceat(letter, starts)
            # Lower case is one bit more, the same one in ASCII and behind a lead byte.
            held |= (classes >> 1 | classes & second << 2) & np.repeat(whole << 5, np.diff(ends))
            plain[at : at + _WORDS] = whole
        return pa.Array.from_buffers(pa.large_binary(), len(words), [None, offsets, pa.py_buffer(low)]), plain

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one behind the other, where each text's ids end); null and empty texts have none.

        New words of all the texts are learned together, which costs the library half as much;
        equal words are looked up once, and their ids gathered by place.
        """
        if not self.plain:
            each = [self.tokenizer.encode(text or "", add_special_tokens=False).ids for text in texts.to_pylist()]
            return np.asarray([one for ids in each for one in ids], "<u4"), np.cumsum([len(ids) for ids in each], dtype=np.int64)
        words, ends = split_words(texts, self._kinds if self.apart else None)
        words, plain = self._lowered(words) if self.direct and len(words) else (words, np.zeros(len(words), bool))
        coded = words.dictionary_encode()
        simple = np.zeros(len(coded.dictionary), bool)
        simple[coded.indices.to_numpy()] = plain
        del words, plain
        different = joined_words(coded.dictionary, np.asarray([len(coded.dictionary)]))[0].as_py().split()
        if len(self.known) > REMEMBERED:  # frequent words are met, and so stand, first
            self.known = dict(islice(self.known.items(), REMEMBERED // 2))
        held = list(map(self.known.get, different))
        new = np.asarray([ids is None for ids in held], bool)
        lower = list(compress(different, new & simple))
        for start in range(0, len(lower), _LINE):
            line = lower[start : start + _LINE]
            self._learn_line(line, self.codes[np.frombuffer(b" ".join(line), np.uint8)].tobytes().decode("utf-32-le"))
        others = list(compress(different, new & ~simple))
        for start in range(0, len(others), _NEW):
            self._learn(others[start : start + _NEW])
        for at in np.flatnonzero(new).tolist():
            held[at] = self.known[different[at]]
        found = pa.array(held, pa.large_binary()).take(coded.indices)
        _, offsets, data = found.buffers()
        spans = np.frombuffer(offsets, np.int64, len(found) + 1) // 4
        return np.frombuffer(data or b"", "<u4")[spans[0] : spans[-1]], (spans - spans[0])[ends]

    @staticmethod
    def _pack(ids: list[int]) -> bytes:
        return array("I", ids).tobytes() if byteorder == "little" else np.asarray(ids, "<u4").tobytes()

    def _learn(self, words: list[bytes]) -> None:
        """Remember the ids of new words.

        Marks behind a letter or digit are a word of their own to the rules, as long as the word
        still ends in one when it is normalised. A word of Latin letters goes straight to the
        library's model; the others take all its steps.
        """
        known, quick, slow, joined = self.known, {}, {}, []
        if not words:
            return
        line = b" ".join(words).decode("utf-8", "replace")
        for word, (letters, marks, other) in zip(words, self.parted(line)):
            if other or not self.direct:
                text = letters + marks + other
                base = text.rstrip(self.marks)
                ends = unicodedata.normalize("NFC", base).lower()[-1:]
                marks = text[len(base) :] if ends.isalnum() else ""
                part = base.encode() if marks else word
                if part not in known:
                    slow[part] = None
            else:
                part = letters.encode() if marks else word
                if part not in known:
                    quick[part] = letters
            if marks:
                behind = marks.encode()
                joined.append((word, part, behind))
                if behind not in known:
                    slow[behind] = None
        bases, letters = list(quick), list(quick.values())
        for start in range(0, len(bases), _LINE):
            self._learn_line(bases[start : start + _LINE], self._spelled(" ".join(letters[start : start + _LINE])))
        slow = list(slow)
        for start in range(0, len(slow), _CHUNK):
            self._learn_together(slow[start : start + _CHUNK])
        for word, base, marks in joined:
            known[word] = known[base] + known[marks]

    def _learn_line(self, words: list[bytes], line: str) -> None:
        """Words that only the model has to see; ``line`` spells them, one space between them."""
        ids = np.asarray(self.alone.encode_batch_fast([line], add_special_tokens=False)[0].ids, "<u4")
        stops = ((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()
        self.known.update(zip(words, map(ids.tobytes().__getitem__, map(slice, [0, *stops], stops))))

    def _learn_together(self, words: list[bytes]) -> None:
        """One call for several words; the offsets tell whose ids are whose."""
        texts = [word.decode("utf-8", "replace") for word in words]
        together = self.tokenizer.encode(" ".join(texts), add_special_tokens=False)
        ids, offsets, at, end = together.ids, together.offsets, 0, -1
        for word, text in zip(words, texts):
            end += 1 + len(text)
            first = at
            while at < len(ids) and offsets[at][1] <= end:
                at += 1
            self.known[word] = self._pack(ids[first:at])


@lru_cache(maxsize=4)
def encoder(path: str) -> WordEncoder:
    """The encoder of a vocabulary file, once per process."""
    return WordEncoder(path)


def encoded(path: str, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts, each with the end id behind them; where each text's ids end)."""
    ids, ends = encoder(path).encode(texts)
    behind = ends + np.arange(1, len(ends) + 1)
    full = np.empty(len(ids) + len(ends), "<u4")
    own = np.ones(len(full), bool)
    own[behind - 1] = False
    full[own], full[behind - 1] = ids, end_id
    return full, behind
