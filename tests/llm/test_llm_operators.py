"""The text operators on small fixtures, against brute force."""

from __future__ import annotations

import hashlib
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from conftest import plan_of
from public_tokenizers import path
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tramline.llm import chat, common, decontaminate, neighbours, packing, quality, sharding, simhash, substrings, token_files, tokens, toxicity
from tramline.llm.common import written
from tramline.llm.components import components
from tramline.llm.tokens import encoded, encoder
from tramline.llm.words import split_words

VOCABULARY = path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, words string, score double, shard string, cut string, row long"
ODD = [None, "", " ", "one", "A b  C.", "x" * 30_000, "wort " * 3_000, "Été İ Å Σς ab<|endoftext|>c 12.5, don't \U0001f600"]


@pytest.fixture
def docs(spark):
    """Odd texts, copies, shared passages, a null id, repeated rows, columns with clashing names."""
    rng = np.random.default_rng(3)
    words = ["w%d" % n for n in range(60)]
    said = [" ".join(rng.choice(words, int(n))) for n in rng.integers(1, 90, 30)]
    passage = " ".join(f"p{n}" for n in range(30))
    texts = ODD + said + said[:6] + [f"{a} {passage} {b}" for a, b in zip(said[:8], said[8:16])] + [passage + " " + passage]
    rows = [(n, t) for n, t in enumerate(texts)] + [(None, said[3]), (5, ODD[5]), (2, "one two")]
    return spark.createDataFrame([(n, t, None, "s", 1, "w", 0.5, "z", "c", 7) for n, t in rows], SCHEMA)


def pairs(docs):
    return [(row.doc_id, row.text) for row in docs.select("doc_id", "text").collect()]


# --- tokens


def test_ids_are_those_of_the_library():
    own, library = encoder(VOCABULARY), Tokenizer.from_file(VOCABULARY)
    texts = [t or "" for t in ODD] + ["##! # a.,b ...x", "12.5 it's IT'S 's. á ́ 가", "w\x1cq \u0085"]
    ids, ends = own.encode(pa.array(texts))
    assert [part.tolist() for part in np.split(ids, ends[:-1])] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_ids_of_every_character_beside_marks():
    """A character that decomposes under the vocabulary's rules keeps what the library joins to it."""
    own, library = encoder(VOCABULARY), Tokenizer.from_file(VOCABULARY)
    characters = [chr(c) for c in range(0x110) if c > 32] + [chr(c) for c in range(0x110, 0x10000) if not 0xD800 <= c < 0xE000]
    texts = []
    for at in range(0, len(characters), 64):
        some = characters[at : at + 64]
        texts += [" ".join(f"{c}{mark}" for c in some) for mark in ".,!?;:#$%&*"]
        texts += [" ".join(f"DEN{c},b {c}x! {c}" for c in some), " ".join(f";{c} 1{c}? ab{c}." for c in some)]
    ids, ends = own.encode(pa.array(texts))
    expected = library.encode_batch_fast(texts, add_special_tokens=False)
    wrong = [text for text, part, want in zip(texts, np.split(ids, ends[:-1]), expected) if part.tolist() != want.ids]
    assert not wrong


def test_words_are_known_in_one_form():
    """Case and marks make no new words; each would be another one for the library to encode."""
    own, library = tokens.WordEncoder(VOCABULARY), Tokenizer.from_file(VOCABULARY)
    text = "Été, été; ÉTÉ! Word word. WORD,word"
    assert own.encode(pa.array([text]))[0].tolist() == library.encode(text, add_special_tokens=False).ids
    assert set(own.known) == {word.encode() for word in ("été", "word", ",", ";", "!", ".")}


@pytest.mark.parametrize("together", [1, 5, 1 << 20])
def test_ids_of_letters_beside_anything(monkeypatch, together):
    """Letters that are lowered or cut from marks, among those that must not be, as the library has them."""
    monkeypatch.setattr(tokens, "_BYTES", together)
    monkeypatch.setattr(tokens, "_WORDS", together)
    own, library = encoder(VOCABULARY), Tokenizer.from_file(VOCABULARY)
    some = [*"aAéÉ×÷ßÿÀÞ.,!?;:#$%&*'\"-|<>(19 \t\n\u0085Σςąǰ가中क़", "'s", "'T", "İ", "\u0301", "H\u0331", "K", "<|endoftext|>", "<|ENDOFTEXT|>", "The", "THE"]
    rng = np.random.default_rng(8)
    texts = ["".join(some[n] for n in rng.integers(0, len(some), rng.integers(0, 40))) for _ in range(4_000)]
    ids, ends = own.encode(pa.array([*texts, None]).slice(5))
    expected = library.encode_batch_fast(texts[5:], add_special_tokens=False)
    wrong = [text for text, part, want in zip(texts[5:], np.split(ids, ends[:-1]), expected) if part.tolist() != want.ids]
    assert not wrong
    broken = [b"a\xc3", b"\xa9,b", b"\xc3,\xc3 A\xc3 ,\xc3\x97", b"\xc3\xc3\x89\x89Z"]
    ids, ends = own.encode(pa.array(broken, pa.binary()))
    for text, part in zip(broken, np.split(ids, ends[:-1])):
        assert part.tolist() == library.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids


def test_ids_of_little():
    ids, ends = encoder(VOCABULARY).encode(pa.array([], pa.string()))
    assert len(ids) == len(ends) == 0
    ids, ends = encoded(VOCABULARY, pa.array([None, "", "a b", " "]), 7)
    assert ids[ends - 1].tolist() == [7] * 4 and ends[[0, 1]].tolist() == [1, 2] and ends[3] == ends[2] + 1


def test_other_vocabularies_are_encoded_whole():
    own, library = encoder(path("byte_bpe_50k.json")), Tokenizer.from_file(path("byte_bpe_50k.json"))
    assert not own.plain
    assert own.encode(pa.array(["a  b\nc"]))[0].tolist() == library.encode("a  b\nc", add_special_tokens=False).ids


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 1000])
@pytest.mark.parametrize("high", [1, 3, 49_408, 2**32])
def test_blocks_round_trip(n, high):
    ids = np.random.default_rng(n).integers(0, high, n, dtype=np.uint64).astype(np.uint32)
    ids[: min(n, 3)] = 2**32 - 1
    index, blocks = token_files.encode_blocks(ids)
    assert (token_files.decode_blocks(index, blocks) == ids).all()
    for at, start in enumerate(np.frombuffer(index, "<u4")):
        assert (token_files.decode_block(blocks, int(start)) == ids[at * 128 : at * 128 + 128]).all()


def test_token_files(spark, docs):
    """Null ids come first and stay null, beside ids of 0 and of the least number."""
    more = [(-(2**63), "least"), (0, "zero"), *((None, f"nobody's {n % 3}") for n in range(20))]
    docs = written(docs.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string")), "more")
    library, start, expected = Tokenizer.from_file(VOCABULARY), 0, []
    got = sorted((tuple(r) for r in token_files.token_file_digest(spark, docs, VOCABULARY, 2).collect()), key=lambda r: (r[1], r[2]))
    ids = {}
    for doc, text in pairs(docs):
        ids.setdefault(doc, []).append(np.array(library.encode(text or "", add_special_tokens=False).ids + [2], "<u4"))
    for doc in sorted(ids, key=lambda d: (d is not None, d or 0)):
        expected.append((doc, sorted((len(x), zlib.crc32(x.tobytes())) for x in ids[doc])))
    seen = {}
    for doc, at, n, crc in got:
        assert at == start
        start += n
        seen.setdefault(doc, []).append((n, crc))
    assert [(d, sorted(v)) for d, v in seen.items()] == expected and expected[:2] == [(None, expected[0][1]), (-(2**63), expected[1][1])]
    assert token_files.token_file_digest(spark, docs.limit(0), VOCABULARY, 2).count() == 0


@pytest.mark.parametrize("seed", range(30))
def test_plan_is_best_fit_decreasing(seed):
    rng = np.random.default_rng(seed)
    capacity = int(rng.choice([10, 50, 200]))
    lengths = rng.integers(1, capacity + 1, int(rng.integers(0, 300))).tolist()
    counts = {n: lengths.count(n) for n in set(lengths)}
    plan, places = packing.best_fit(counts, capacity), {}
    for length, many in counts.items():
        for rank in range(many):
            slot = [s for s in plan[length] if s.rank <= rank][-1]
            nth = rank - slot.rank
            places.setdefault(slot.sequence + nth // slot.each, []).append((slot.offset + nth % slot.each * length, length))
    for held in places.values():
        ends = [0, *np.cumsum([n for _, n in sorted(held)])]
        assert [at for at, _ in sorted(held)] == ends[:-1] and ends[-1] <= capacity
    room = []
    for length in sorted(lengths, reverse=True):
        fits = [n for n, left in enumerate(room) if left >= length]
        if fits:
            room[min(fits, key=room.__getitem__)] -= length
        else:
            room.append(capacity - length)
    assert len(places) == len(room)


def test_packing(docs, monkeypatch):
    monkeypatch.setattr(packing, "RANK_BYTES", 700)
    library, held = Tokenizer.from_file(VOCABULARY), {}
    rows = packing.pack(docs, VOCABULARY, 1, capacity=64).collect()
    made = {}
    for r in sorted(rows, key=lambda r: (r.doc_id is None, r.doc_id or 0, r.piece)):
        assert r.start == r.piece * 64 and len(r.ids) == 4 * r.length <= 256
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
        made.setdefault(r.doc_id, []).append(bytes(r.ids))
    for doc, text in pairs(docs):
        if doc not in (2, 5):  # these ids are repeated
            ids = library.encode(text or "", add_special_tokens=False).ids + [1]
            assert b"".join(made[doc]) == np.array(ids, "<u4").tobytes()
    for places in held.values():
        ends = [0, *np.cumsum([n for _, n in sorted(places)])]
        assert [at for at, _ in sorted(places)] == ends[:-1] and ends[-1] <= 64
    assert packing.pack(docs.limit(0), VOCABULARY, 1).count() == 0


# --- near duplicates and repeats


def test_components(spark):
    chain = [(n, n + 1) for n in range(0, 40)] + [(100, 101), (101, 102), (102, 100), (7, 7), (-5, 200)]
    star = [(1000, 1000 + n) for n in range(1, 300)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain + star, "a long, b long")).collect()}
    assert {got[n] for n in range(41)} == {0} and {got[n] for n in (100, 101, 102)} == {100}
    assert got[200] == -5 and {got[n] for n in range(1000, 1300)} == {1000}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    runs = [b" ".join(words[n : n + 3]) for n in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(run, 42) for run in runs]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def reach(values, near):
    root = list(range(len(values)))

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for i in range(len(values)):
        for j in range(i):
            if near(values[i], values[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(n) for n in range(len(values))]


def test_simhash(docs):
    rows = pairs(docs)
    prints = [brute_fingerprint(text) for _, text in rows]
    groups = reach(prints, lambda a, b: (a ^ b).bit_count() <= 2)
    least = {g: min((d for (d, _), own in zip(rows, groups) if own == g and d is not None), default=None) for g in groups}
    expected = sorted((repr(d), f"{p:016x}", least[g]) for (d, _), p, g in zip(rows, prints, groups))
    found = simhash.near_duplicates(docs).collect()
    assert sorted((repr(r.doc_id), r.fingerprint, r.component_id) for r in found) == expected
    kept = simhash.without_near_duplicates(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(groups))
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("crowded", [256, 2])
def test_near_links_lose_no_link(spark, monkeypatch, crowded):
    monkeypatch.setattr(simhash, "CROWDED", crowded)
    rng = np.random.default_rng(5)
    base = [int(x) for x in rng.integers(-(2**63), 2**63, 6)] + [0, -1]
    values = {b ^ int(np.int64(np.uint64(sum(1 << int(bit) for bit in rng.choice(64, n, replace=False))))) for b in base for n in (0, 1, 1, 2, 2, 3, 4, 5)}
    values = sorted(values)
    links = simhash.near_links(spark.createDataFrame([(v,) for v in values], "fp long")).collect()
    mask = 2**64 - 1
    assert all(((r.a ^ r.b) & mask).bit_count() <= 2 for r in links)
    found = {frozenset((r.a, r.b)) for r in links}
    same = reach(values, lambda a, b: ((a ^ b) & mask).bit_count() <= 2)
    assert reach(values, lambda a, b: frozenset((a, b)) in found) == same


def brute_repeats(rows, depth):
    seen, removed = set(), {}
    for doc, text in sorted(rows):
        words = text.split()
        for at in range(len(words) - depth + 1):
            run = tuple(words[at : at + depth])
            if run in seen:
                removed.setdefault(doc, set()).update(range(at, at + depth))
            seen.add(run)
    return {doc: (len(t.split()), " ".join(w for n, w in enumerate(t.split()) if n not in removed.get(doc, ()))) for doc, t in rows}


@pytest.mark.parametrize("crowded", [2_000, 3, 1])
def test_repeats(spark, docs, monkeypatch, crowded):
    monkeypatch.setattr(substrings, "CROWDED", crowded)
    own = docs.filter("doc_id is not null").dropDuplicates(["doc_id"])
    own = written(own.withColumn("text", F.regexp_replace("text", " ", " ")), "own")
    expected = brute_repeats([(d, t or "") for d, t in pairs(own)], 20)
    got = substrings.without_repeats(own)
    assert got.columns == [*(c for c in own.columns if c != "cut"), "cut"]
    rows = got.select("doc_id", "cut.*").collect()
    assert {r.doc_id: (r.n_words, r.kept) for r in rows} == expected
    assert all(r.n_removed == r.n_words - len(r.kept.split()) for r in rows)
    assert substrings.without_repeats(own.limit(0)).count() == 0


@pytest.mark.parametrize("longest", [1, 2, 8, 16, 20, 33])
def test_suffix_tree(longest):
    """Leaves in the order of their words, and what neighbours share, against comparison."""
    rng = np.random.default_rng(longest)
    for _ in range(40):
        stretches = [rng.integers(0, rng.integers(1, 4), rng.integers(1, longest + 1)).tolist() for _ in range(rng.integers(1, 12))]
        words, starts = [], []
        for n, stretch in enumerate(stretches):
            starts += range(len(words), len(words) + len(stretch))
            words += [*stretch, 1_000 + n]
        tree = substrings.suffix_tree(np.array(words), np.array(starts), longest)
        told = [words[starts[leaf]:] for leaf in tree.leaves]
        assert told == sorted(told)
        for left, right, shared in zip(told, told[1:], tree.shared[1:]):
            alike = next(n for n, (a, b) in enumerate(zip(left, right)) if a != b)
            assert shared == alike or (alike >= 2 * longest - 1)
        for depth in {1, longest}:
            node = tree.below(depth)
            assert [tuple(t[:depth]) for t in told] == sorted(tuple(t[:depth]) for t in told)
            for a, b, x, y in zip(told, told[1:], node, node[1:]):
                assert (x == y) == (a[:depth] == b[:depth])


@pytest.mark.parametrize("depth,crowded", [(8, 1), (9, 2_000), (16, 4), (20, 5), (40, 2), (40, 2_000)])
def test_repeats_of_any_depth(spark, monkeypatch, depth, crowded):
    """Few different words, so windows recur in every way: within a text, across texts, overlapping."""
    monkeypatch.setattr(substrings, "CROWDED", crowded)
    rng = np.random.default_rng(depth + crowded)
    blocks = [" ".join(f"v{n}" for n in rng.integers(0, 4, int(size))) for size in rng.integers(3, 60, 12)]
    texts = [" ".join(rng.choice(blocks, int(n))) for n in rng.integers(0, 6, 60)]
    texts += [texts[3], texts[4], blocks[0] + " " + " ".join(["x"] * 90), " ".join(["x"] * 50)]
    rows = written(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "own")
    got = substrings.without_repeats(rows, depth).select("doc_id", "cut.*").collect()
    assert {r.doc_id: (r.n_words, r.kept) for r in got} == brute_repeats(list(enumerate(texts)), depth)


def test_depths_that_cannot_be_told(spark):
    rows = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    for depth in (5, 300):
        with pytest.raises(ValueError):
            substrings.without_repeats(rows, depth)


@pytest.mark.parametrize("doc", [None, 7])
def test_equal_rows_cost_no_more_than_their_number(spark, monkeypatch, doc):
    """Four times the equal rows: at most five times the stretches, and one row a document among them."""
    passage = " ".join(f"q{n}" for n in range(60))
    counts = []

    def counting(rows, label):
        kept = written(rows, label)
        if label == "stretches":
            counts.append(kept.count())
        return kept

    monkeypatch.setattr(substrings, "written", counting)
    for many in (50, 200):
        rows = spark.createDataFrame([(doc, passage)] * many + [(8, passage + " end")] * many, "doc_id long, text string")
        got = [r.n_removed for r in substrings.without_repeats(rows).select("cut.*").collect()]
        assert sorted(got) == [0] * many + [60] * many
    assert 0 < counts[1] <= 5 * counts[0] and counts[1] < 60


def test_repeated_rows_are_one_document(spark):
    text = " ".join(f"a{n}" for n in range(25))
    rows = spark.createDataFrame([(1, text), (1, text), (None, text), (2, text + " end")], "doc_id long, text string")
    got = sorted(((r.doc_id or -1, r.n_removed) for r in substrings.without_repeats(rows).select("doc_id", "cut.*").collect()))
    assert got == [(-1, 0), (1, 25), (1, 25), (2, 25)]


def test_texts_of_one_id_with_equal_short_hashes(spark):
    """These two texts have the same 32-bit hash; only the first repeats a passage."""
    passage, other = (" ".join(f"{x}{n}" for n in range(30)) for x in "po")
    texts = [passage + " x40325", other + " y206414"]
    rows = spark.createDataFrame([(1, passage)] + [(2, t) for t in texts], "doc_id long, text string")
    assert rows.filter("doc_id = 2").select(F.hash("text")).distinct().count() == 1
    got = {r.text: (r.n_removed, r.kept) for r in substrings.without_repeats(rows).select("text", "cut.*").collect()}
    assert got == {passage: (0, passage), texts[0]: (30, "x40325"), texts[1]: (0, texts[1])}


# --- benchmark, chat, shards


def test_decontamination(spark, docs):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def split(text):
        return pattern.findall((text or "").translate(lower))

    said = [text for _, text in pairs(docs) if text and len(text.split()) > 40][:2]
    items = [(1, " ".join(said[0].split()[3:17]).upper()), (2, "One"), (3, None), (4, "..."), (None, " ".join(said[1].split()[:12])), (1, "a b"), (5, "p1 p2 p3 p4 p5 p6 p7 p8 p9 p10 p11")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    grams = {}
    for item, text in items:
        words = split(text)
        size = min(10, len(words))
        for at in range(len(words) - size + 1) if words else ():
            grams.setdefault(tuple(words[at : at + size]), set()).add(item)
    expected = []
    for doc, text in pairs(docs):
        words, hit, found = split(text), set(), set()
        for size in {len(g) for g in grams}:
            for at in range(len(words) - size + 1):
                own = grams.get(tuple(words[at : at + size]))
                if own:
                    hit.update(range(at, at + size))
                    found |= own
        names = sorted(str(x) for x in found if x is not None)
        expected.append((repr(doc), len(words), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    got = decontaminate.contamination_digest(docs, bench).collect()
    assert sorted((repr(r[0]), *r[1:]) for r in got) == sorted(expected)
    clean = decontaminate.clean_documents(docs, bench)
    assert clean.columns == docs.columns and clean.count() == sum(not e[-1] for e in expected)
    assert decontaminate.clean_documents(docs, bench.limit(0)).count() == docs.count()
    assert decontaminate.contamination_digest(docs.limit(0), bench).count() == 0


def test_shuffled_grams_give_the_same(spark, docs, monkeypatch):
    bench = spark.createDataFrame([(1, "one"), (2, "p3 p4 p5 p6 p7 p8 p9 p10 p11 p12 p13")], "item_id long, text string")
    before = sorted(map(repr, decontaminate.contamination_digest(docs, bench).collect()))
    monkeypatch.setattr(decontaminate, "BROADCAST_GRAMS", 0)
    assert sorted(map(repr, decontaminate.contamination_digest(docs, bench).collect())) == before


@pytest.mark.parametrize("text", ["", "\\", "a\\\\", "### ", "\\### x", "</turn>", "\\\\</turn>\\", "### a: b</turn>\n### b: c", r"\### Assistant: </turn> ok", ": "])
def test_turns_round_trip(text):
    for role in ("user", "", "a: b", "### x\\"):
        made, start, end = chat.render_turn(role, text)
        assert chat.parse(made + made) == [(role, text)] * 2
        assert chat._until(made[start:end] + chat.CLOSE, 0, chat._TEXT, chat.CLOSE)[0] == text
    plain = chat.render_turn("user", "nothing to escape: here")[0]
    assert plain == "### user: nothing to escape: here</turn>\n"


def test_conversations(spark):
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", None), (1, 2, "assistant", "### é</turn>"), (2, None, None, "x"), (None, 0, "user", "n"), (1, 0, "user", "hi")]
    rows = spark.createDataFrame([(*t, 1) for t in turns], "conv_id long, turn long, role string, text string, formatted int")
    got = {r.conv_id: r for r in chat.formatted_digest(rows).collect()}
    said = "user\nhi\nuser\nhi\nassistant\n\nassistant\n### é</turn>\n"
    assert got[1].n_turns == 4 and got[1].turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert got[1].loss_chars == 12 and got[1].loss_sha256 == hashlib.sha256("### é</turn>".encode()).hexdigest()
    assert got[2].n_turns == 1 and got[None].loss_chars == 0
    assert chat.formatted_digest(rows.limit(0)).count() == 0


@pytest.mark.parametrize("limit", [200, 4_000, 10**9])
def test_shards_fit(docs, limit):
    got = sharding.assign_shards(docs, limit)
    assert got.columns == [*(c for c in docs.columns if c != "shard"), "shard"]
    rows = got.select("doc_id", "text", "shard.*").collect()
    assert sorted(repr((r.doc_id, r.text)) for r in rows) == sorted(map(repr, pairs(docs)))
    held = {}
    for r in rows:
        held.setdefault((r.depth, r.bucket), []).append(r)
    for (depth, bucket), own in held.items():
        size = sum(len((r.text or "").encode()) for r in own)
        assert all(r.shard_bytes == size for r in own)
        assert size <= limit or (len(own) == 1 and depth == 63)
        inside = [r for r in rows if depth and r.depth >= depth and r.bucket >> (r.depth - depth) == bucket]
        assert not depth or len(inside) == len(own)  # no shard lies in another
        above = [r for r in rows if depth and r.depth >= depth - 1 and r.bucket >> (r.depth - depth + 1) == bucket >> 1]
        assert not depth or sum(len((r.text or "").encode()) for r in above) > limit  # it had to be split
    assert sharding.assign_shards(docs.limit(0), limit).count() == 0


# --- neighbours


def test_hilbert_steps_are_neighbours():
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    key = neighbours.hilbert_keys(grid, 3)
    assert sorted(key) == list(range(512))
    assert (np.abs(np.diff(grid[np.argsort(key)], axis=0)).sum(axis=1) == 1).all()


def vectors(spark, n=3_000, width=16):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=width)], None) for i in range(n)]
    same = rows[10][1]
    rows += [(n + i, same, 1) for i in range(300)]
    rows += [(9000, None, 1), (9050, [0.0] * width, 1), (9100, [float("nan")] * width, 1), (9150, [None] * width, 1), (None, same, 1), (9200, [1e300] * width, 1)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int"), rows


def test_neighbours(spark):
    frame, rows = vectors(spark)
    good = [(i, np.array(v)) for i, v, _ in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    ids = np.array([i for i, _ in good])
    unit = np.array([v / np.abs(v).max() for _, v in good])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    got = {}
    for r in sorted(neighbours.nearest(frame, F.col("vec_id") % 50 == 0, 5, window=128).collect(), key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    right = total = 0
    assert sorted(got) == [i for i in ids.tolist() if i % 50 == 0]
    for query, found in got.items():
        score = unit @ unit[ids == query][0]
        order = [n for n in np.lexsort((ids, -np.round(score, 12))) if ids[n] != query][:5]
        assert len(found) == 5 and query not in dict(found)
        for vec, own in found:
            assert abs(own - score[ids == vec][0]) < 1e-12
        assert found == sorted(found, key=lambda x: (-x[1], x[0]))
        right += len({ids[n] for n in order} & set(dict(found)))
        total += 5
    assert right >= 0.9 * total


def test_few_vectors(spark):
    frame = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0]), (2, [0.0, -2.0])], "vec_id long, embedding array<float>")
    rows = sorted(tuple(r) for r in neighbours.nearest(frame, F.col("vec_id") == 0, 5).collect())
    assert rows == [(0, 1, 1, 1.0), (0, 2, 2, 0.0)]
    assert neighbours.nearest(frame.limit(0), F.col("vec_id") == 0).count() == 0


def recall_of(found, ids, unit, queries, k=5):
    """The share of the true neighbours that ``found`` (query_id, rank, vec_id, score) has."""
    got = {}
    for r in found:
        got.setdefault(r.query_id, set()).add(r.vec_id)
    right = 0
    for query in queries:
        score = unit @ unit[query]
        score[query] = -2
        right += len(got[ids[query]] & set(ids[np.argsort(-score)[:k]].tolist()))
    return right / (k * len(queries))


def structureless(seed, n, width=64):
    rows = np.random.default_rng(seed).normal(size=(n, width)).astype(np.float32)
    unit = rows.astype(np.float64)
    return rows, unit / np.linalg.norm(unit, axis=1, keepdims=True)


def test_window_follows_the_vectors(spark):
    """Six orders with windows of 256 meet at most a quarter of these vectors."""
    rows, unit = structureless(4, 12_000)
    frame = spark.createDataFrame([(i, x) for i, x in enumerate(rows.tolist())], "vec_id long, embedding array<float>").repartition(4)
    found = neighbours.nearest(frame, F.col("vec_id") % 100 == 0, 5, rotations=1).collect()
    assert recall_of(found, np.arange(len(rows)), unit, range(0, len(rows), 100)) >= 0.9


def test_tight_group_larger_than_the_window(spark):
    rng = np.random.default_rng(6)
    rows, _ = structureless(5, 5_000)
    rows[1_000:] = rng.normal(size=64) + rng.normal(size=(4_000, 64)) * 0.014
    unit = rows.astype(np.float64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    frame = spark.createDataFrame([(i, x) for i, x in enumerate(rows.tolist())], "vec_id long, embedding array<float>").repartition(4)
    asked = range(1_000, 5_000, 50)
    found = neighbours.nearest(frame, (F.col("vec_id") % 50 == 0) & (F.col("vec_id") >= 1_000), 5).collect()
    assert recall_of(found, np.arange(len(rows)), unit, asked) >= 0.9


def test_vectors_on_one_ray_are_one_entry(spark):
    base = np.random.default_rng(7).integers(-9, 10, 16).astype(float)
    rows = [(i, [float(x) for x in base * (i + 1)]) for i in range(1_500)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = neighbours.nearest(frame, F.col("vec_id") % 500 == 0, 5).collect()
    assert sorted((r.query_id, r.vec_id) for r in found) == [
        (query, vec) for query in (0, 500, 1000) for vec in [x for x in range(6) if x != query][:5]
    ]


# --- classifiers


def labelled(spark):
    rng = np.random.default_rng(2)
    words, rows, labels = [f"{a}{b}{c}" for a in "bdgk" for b in "aeou" for c in "lmnr"], [], []
    for n in range(600):
        text = list(rng.choice(words, int(rng.integers(20, 200))))
        bad, toxic = n % 4 == 0, n % 5 == 0
        if bad:
            at = int(rng.integers(0, len(text) - 10))
            text[at : at + 10] = [w.upper() + "!!" for w in text[at : at + 10]]
        if toxic:
            text[int(rng.integers(0, len(text)))] = str(rng.choice(["zorkish", "gr1mblar", "рugnort"]))
        rows.append((n, " ".join(text)))
        labels.append((n, 0 if bad else 1, int(toxic)))
    rows += [(1000, None), (1001, ""), (None, "x"), (1002, "ok " * 20_000)]
    labels += [(None, 1, 1), (5000, 1, None)]
    return (
        spark.createDataFrame([(*r, 0.1) for r in rows], "doc_id long, text string, score double"),
        spark.createDataFrame([(*r, "x") for r in labels], "doc_id long, quality int, toxic int, text string"),
    )


@pytest.mark.parametrize("module, learner", [(quality, "AttentionModel.fit"), (toxicity, "learn")])
def test_a_repeated_id_sends_one_text(spark, monkeypatch, module, learner):
    """An id that many rows share costs the driver one text, whatever their texts."""
    rows = [(1, f"good words {n}") for n in range(500)] + [(2, "bad words")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1)], "doc_id long, quality int, toxic int")
    sent = []
    owner = module.AttentionModel if "." in learner else module
    monkeypatch.setattr(owner, learner.split(".")[-1], lambda *a: sent.append(a[-1]))
    module.train(docs, labels, F.lit(True))
    assert len(sent[0]) == 2


def test_quality(spark):
    docs, labels = labelled(spark)
    rows = {r.doc_id: r for r in quality.score_documents(docs, labels).collect()}
    assert len(rows) == 604 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows.values())
    truth = {r.doc_id: r.quality for r in labels.collect() if r.doc_id is not None}
    held = [i for i in range(600) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(rows[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i in range(600))
    assert sum(rows[i].predicted == truth[i] for i in held) >= 0.9 * len(held)
    assert rows[1000].score == rows[1001].score
    assert quality.score_documents(docs.limit(0), labels).count() == 0
    assert quality.score_documents(docs, labels.limit(0)).count() == 604


def test_quality_gradients():
    rng = np.random.default_rng(0)
    model = quality.AttentionModel.fresh()
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}
    bags, labels = [rng.normal(size=(n, quality.WIDTH)) * 0.1 for n in (1, 3, 5)], np.array([1.0, 0.0, 1.0])

    def loss():
        total = 0.0
        for rows, label in zip(bags, labels):
            hidden, _, _, logit = model._encoded(rows)
            weight = np.exp(logit - logit.max())
            z = weight / weight.sum() @ hidden @ model.weights["c"] + model.weights["cb"][0]
            total += np.log1p(np.exp(-z if label else z)) / len(bags)
        return total

    found = model.step(bags, labels)
    for name, place in (("w", (3, 2)), ("wb", (1,)), ("v", (4, 5)), ("u", (4, 5)), ("a", (2,)), ("c", (7,)), ("cb", (0,))):
        own, kept = model.weights[name], model.weights[name][place]
        own[place] = kept + 1e-4
        high = loss()
        own[place] = kept - 1e-4
        low = loss()
        own[place] = kept
        assert abs((high - low) / 2e-4 - found[name][place]) < 1e-4


def test_toxicity(spark):
    docs, labels = labelled(spark)
    rows = {r.doc_id: r for r in toxicity.score_documents(docs, labels).collect()}
    truth = {r.doc_id: r.toxic for r in labels.collect() if r.doc_id is not None}
    held = [i for i in range(600) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(rows[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i in range(600))
    assert all(rows[i].predicted == truth[i] for i in held)
    assert rows[1000].score == rows[1001].score and rows[1000].predicted == 0
    assert toxicity.score_documents(docs.limit(0), labels).count() == 0
    assert toxicity.score_documents(docs, labels.limit(0)).filter("predicted = 1").count() == 0


def test_folding_and_exceptions():
    assert toxicity.fold("1D10T sсum l0ser $tup1d 123 x!") == "idiot scum loser stupid 123 x!"
    lexicon = toxicity.Lexicon({"scum": 2.0, "lowe*": 1.0}, exceptions=("pond scum",))
    assert [m[2] for m in lexicon.matches(toxicity.fold("Pond scum, SCUM! scummy lowei slowe"))] == [2.0, 1.0]
    assert lexicon.score("scum") > lexicon.score("scum " + "fine " * 200) > lexicon.score("fine")


def brute_matches(folded, entries, exceptions):
    """Every entry tried at every place."""

    def places(text, stem):
        for at in range(len(folded) - len(text) + 1):
            end = at + len(text)
            before = at == 0 or not folded[at - 1].isalnum()
            after = stem or end == len(folded) or not folded[end].isalnum()
            if folded.startswith(text, at) and before and after:
                yield at, end

    excused = [span for phrase in exceptions for span in places(phrase, False)]
    found = [(*span, weight) for entry, weight in entries.items() for span in places(entry.rstrip("*"), entry.endswith("*"))]
    return sorted(m for m in found if not any(a <= m[0] and m[1] <= b for a, b in excused))


@pytest.mark.parametrize("seed", range(30))
def test_lexicon_matches_are_those_of_brute_force(seed):
    rng = np.random.default_rng(seed)
    word = lambda: "".join(rng.choice(list("abß"), int(rng.integers(1, 4))))
    entries = {word() + rng.choice(["", "", "*"]): float(n + 1) for n in range(6)}
    entries = {k: v for k, v in entries.items() if k.endswith("*") or k + "*" not in entries}
    phrases = {f"{word()} {word()}" for _ in range(4)} - {entry.rstrip("*") for entry in entries}
    lexicon = toxicity.Lexicon(entries, tuple(phrases))
    for _ in range(20):
        text = "".join(rng.choice([word(), " ", " ", ".", word() + " " + word(), *phrases]) for _ in range(int(rng.integers(0, 30))))
        assert sorted(lexicon.matches(toxicity.fold(text))) == brute_matches(toxicity.fold(text), entries, phrases)


def test_quality_is_the_model_on_plain_passages():
    """Scores against a loop over passages, in chunks of any size."""
    model = quality.AttentionModel.fresh()
    text = " ".join(f"Wort{n % 97}, x{n % 13}" for n in range(5_000))
    whole_rows = quality.encode_passages(text)
    for size in (1, 3, 2_048):
        parts = [(whole_rows[at : at + size], np.zeros(len(whole_rows[at : at + size]), int)) for at in range(0, len(whole_rows), size)]
        assert abs(model.logits(parts)[0] - model.logits([(whole_rows, np.zeros(len(whole_rows), int))])[0]) < 1e-4
    words, p = text.split(), model.weights
    assert len(whole_rows) == -(-len(words) // quality.PASSAGE)
    total, weights = np.zeros(len(p["c"])), 0.0
    for row in whole_rows:
        hidden = np.tanh(row @ p["w"] + p["wb"])
        gate = np.tanh(hidden @ p["v"]) / (1 + np.exp(-(hidden @ p["u"])))
        weight = np.exp(float(gate @ p["a"]))
        total, weights = total + weight * hidden, weights + weight
    z = float(total / weights @ p["c"] + p["cb"][0])
    assert abs(model.score(text) - 1 / (1 + np.exp(-z))) < 1e-4
    assert 0 <= model.score(None) == model.score("  ") <= 1
    others = [None, text, "", "ein Wort", " ", text + " mehr", *(" ".join(["Wort"] * n) for n in (63, 64, 65, 128))]
    assert np.allclose(model.scores(pa.array(others)), [model.score(other) for other in others], atol=1e-6)
    assert len(model.scores(pa.array([], pa.string()))) == 0


# --- pipeline


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """The small tables, with odd texts, copies, repeated rows, a null id and shared passages among the documents."""
    folder, given = tmp_path_factory.mktemp("corpus"), "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{given}/documents.parquet")
    passage = " ".join(f"passage{n}" for n in range(30))
    asked = spark.read.parquet(f"{given}/benchmark.parquet").filter("text is not null").orderBy("item_id").first().text
    plain = docs.filter("length(text) > 400").orderBy("doc_id").first().text
    texts = [*ODD, plain, plain, f"{plain} {passage}", f"{plain[:300]} {passage} {plain[300:]}", f"{plain} {asked}", passage, passage + " " + passage]
    more = [(10_000 + n, text) for n, text in enumerate(texts)] + [(None, plain + " null"), (10_003, texts[3]), (10_008, "two texts of one id " * 9)]
    extra = spark.createDataFrame(more, "doc_id long, text string")
    extra = extra.select("doc_id", "text", F.lit("en").alias("lang"), F.lit(None).cast("string").alias("source"), F.lit(1).cast("long").alias("n_chars"))
    docs.unionByName(extra.select(docs.columns)).coalesce(2).write.parquet(f"{folder}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{given}/{name}.parquet").coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def brute_pipeline(spark, folder):
    """The pipeline's rows by plain loops behind the trained scores: (doc_id, ids) of every packed document."""
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    usable = F.crc32(F.col("doc_id").cast("string")) % 5 != 0
    model = quality.train(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"), usable)
    docs = [(doc, text) for doc, text in docs if model.score(text) >= 0.3]
    docs.sort(key=lambda row: (row[0] is not None, row[0] or 0, row[1] or ""))
    prints = [brute_fingerprint(text) for _, text in docs]
    kept, seen = [], set()
    for group, row in zip(reach(prints, lambda a, b: (a ^ b).bit_count() <= 2), docs):
        if group not in seen:
            seen.add(group)
            kept.append(row)
    lost, runs = {}, set()
    for at, (_, text) in enumerate(kept):
        words = (text or "").encode().split()
        for start in range(len(words) - 19):
            run = tuple(words[start : start + 20])
            lost.setdefault(at, set()).update(range(start, start + 20)) if run in runs else runs.add(run)
    cut = []
    for at, (doc, text) in enumerate(kept):
        words = (text or "").encode().split()
        left = [word for n, word in enumerate(words) if n not in lost.get(at, ())]
        if len(left) == len(words):
            cut.append((doc, text))
        elif left:
            cut.append((doc, b" ".join(left).decode()))
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    grams = set()
    for (item,) in spark.read.parquet(f"{folder}/benchmark.parquet").select("text").collect():
        words = pattern.findall((item or "").translate(lower))
        size = min(len(words), 10)
        grams |= {tuple(words[n : n + size]) for n in range(len(words) - size + 1)} if size else set()
    sizes, clean = {len(gram) for gram in grams}, []
    for doc, text in cut:
        words = pattern.findall((text or "").translate(lower))
        if not any(tuple(words[n : n + size]) in grams for size in sizes for n in range(len(words) - size + 1)):
            clean.append((doc, text))
    library = Tokenizer.from_file(VOCABULARY)
    return [(doc, library.encode(text or "", add_special_tokens=False).ids + [1]) for doc, text in clean]


def test_pipeline_is_that_of_brute_force(spark, corpus):
    rows = corpus_pipeline.run(spark, corpus).collect()
    pieces = sorted(
        (repr(doc), at // 4096, min(4096, len(ids) - at), zlib.crc32(np.array(ids[at : at + 4096], "<u4").tobytes()))
        for doc, ids in brute_pipeline(spark, corpus) for at in range(0, len(ids), 4096)
    )
    assert sorted((repr(r.doc_id), r.piece, r.length, r.ids_crc32) for r in rows) == pieces
    given = spark.read.parquet(f"{corpus}/documents.parquet").count()
    assert 150 < len({r.doc_id for r in rows}) < given
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in places.values():
        ends = [0, *np.cumsum([n for _, n in sorted(held)])]
        assert [at for at, _ in sorted(held)] == ends[:-1] and ends[-1] <= 4096


def test_stages_keep_the_columns_of_documents(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), corpus).count() == 0
        after = written(stage(spark, docs, corpus), name)
        if name != "packing":
            assert after.schema.simpleString() == docs.schema.simpleString() and 0 < after.count() <= docs.count()
            docs = after


def test_splitting_words_needs_little_beside_the_text():
    text = pa.array([" ".join(["seven77"] * 250_000)])
    tracemalloc.start()
    try:
        words, ends = split_words(text)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(words) == 250_000 and ends.tolist() == [250_000]
    assert most < 8 * text.nbytes  # a number of eight bytes for every byte of text is more


def test_packing_starts_no_workers_of_another_kind(docs):
    assert "ExistingRDD" not in plan_of(packing.pack(docs, VOCABULARY, 1, capacity=64))


def test_words_are_remembered_within_bounds(monkeypatch):
    texts = [f"w{n} again, w{n + 1}. X{n}" for n in range(300)]
    want = [Tokenizer.from_file(VOCABULARY).encode(text, add_special_tokens=False).ids for text in texts]
    monkeypatch.setattr(tokens, "REMEMBERED", 40)
    monkeypatch.setattr(tokens, "_NEW", 7)
    own = tokens.WordEncoder(VOCABULARY)
    for at in range(0, 300, 30):
        ids, ends = own.encode(pa.array(texts[at : at + 30]))
        assert [part.tolist() for part in np.split(ids, ends[:-1])] == want[at : at + 30]
        assert len(own.known) < 40 + 30 * 6


def test_workers_give_memory_back(monkeypatch):
    before = []
    monkeypatch.setattr(common.pa, "default_memory_pool", lambda: type("Pool", (), {"release_unused": lambda self: before.append(1)})())
    monkeypatch.setattr(common.ctypes, "CDLL", lambda name: type("Lib", (), {"malloc_trim": lambda self, pad: before.append(2)})())
    common.give_back()
    assert before == [1, 2]
