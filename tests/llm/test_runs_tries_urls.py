"""Periodic runs, the prefix trie and URL filters against brute force."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from tramline.llm import periodic_runs, prefix_trie, url_rules
from tramline.llm.words import joined_words, split_words

# --- periodic runs


def brute_runs(words, least=24, times=3):
    found = {}
    for period in range(1, len(words) // times + 1):
        equal = [words[at] == words[at + period] for at in range(len(words) - period)] + [False]
        start = None
        for at, same in enumerate(equal):
            if same and start is None:
                start = at
            elif not same and start is not None:
                length = at - start + period
                if length >= max(least, times * period):
                    found.setdefault((start, length), period)
                start = None
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda run: (run[0], run[2]))


def odd_words(rng):
    letters, words = rng.choice([1, 2, 2, 3, 5, 50]), []
    while len(words) < rng.randint(0, 260):
        block = [rng.randrange(letters) for _ in range(rng.randint(1, 25))]
        words += (block * rng.randint(1, 8))[: rng.randint(1, 150)]
    return words


@pytest.mark.parametrize("seed", range(8))
def test_runs_are_those_of_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(60):
        docs = [odd_words(rng) for _ in range(rng.randint(1, 4))]
        ends = np.cumsum([len(words) for words in docs])
        expected = []
        for words, end in zip(docs, ends):
            expected += [(s + end - len(words), n, q) for s, n, q in brute_runs(words)]
        assert periodic_runs.find_runs(np.array(sum(docs, []), np.int32), ends) == expected


def test_one_period_in_two_places():
    """A stretch that only a later level proposes stands before one that is known by then."""
    rng = random.Random(7)
    block = [rng.randrange(9) for _ in range(12)]
    fill = lambda: [100 + rng.randrange(10**6) for _ in range(40)]
    inner = [200] * 12 + fill()[:1]
    words = fill() + inner * 3 + fill() + block * 3 + fill() + inner * 4
    assert periodic_runs.find_runs(np.array(words), np.array([len(words)])) == brute_runs(words)
    with pytest.raises(ValueError):
        periodic_runs.find_runs(np.array(words), np.array([len(words)]), least=10)


@pytest.mark.parametrize("texts", [["a b  c\t\nd", None, "", "  x y ", "\u00e9 \u00f1\x0bz\x1cq"], [], [""], [" "], ["a"], [None]])
def test_words_are_split_and_joined(texts):
    words, ends = split_words(pa.array(texts, pa.string()))
    split = [(text or "").encode().split() for text in texts]
    assert words.to_pylist() == sum(split, []) and ends.tolist() == np.cumsum([len(w) for w in split]).tolist()
    assert joined_words(words, ends).to_pylist() == [b" ".join(w) for w in split]
    part = pa.array(["x x", *texts, "y"], pa.string()).slice(1, len(texts))
    assert split_words(part)[0].to_pylist() == sum(split, [])


def test_collapsed_documents(spark):
    rng = random.Random(3)
    texts = [None, "", " ", "one", "x" * 30_000, "wort " * 3_000, "\u00c9t\u00e9 \u0130 " * 20 + "end"]
    texts += [" ".join(f"w{n}" for n in odd_words(rng)) for _ in range(40)]
    texts.append(" ".join(f"v{rng.randrange(50_000)}" for _ in range(60_000)) + " a b c" * 9)
    given = [(n, text, "clash", 1) for n, text in enumerate(texts)] + [(None, texts[5], None, 2), (5, texts[5], "clash", 1)]
    docs = spark.createDataFrame(given, "doc_id long, text string, periodic string, n_words long")
    rows = periodic_runs.without_periodic_runs(docs).collect()
    assert len(rows) == len(given) and rows[0].asDict().keys() == {"doc_id", "text", "n_words", "periodic"}
    known = {text: brute_runs((text or "").split()) if len(text or "") < 100_000 else [(60_000, 27, 3)] for text in texts}
    for row in rows:
        words, runs = (row.text or "").encode().split(), known[row.text]
        gone = {at for s, n, q in runs for at in range(s + q, s + n)}
        assert [tuple(run) for run in row.periodic.runs] == runs and row.periodic.n_words == len(words)
        assert row.periodic.collapsed == b" ".join(w for at, w in enumerate(words) if at not in gone).decode()
    for row in periodic_runs.runs_digest(docs).collect():
        runs = known[texts[5 if row.doc_id is None else row.doc_id]]
        best = min(runs, key=lambda r: (Fraction(-r[1], r[2]), r[0], r[2]), default=(None,) * 3)
        assert (row.n_runs, row.start, row.length, row.period) == (len(runs), *best)
        assert row.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert row.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
    assert periodic_runs.without_periodic_runs(docs.limit(0)).count() == 0


# --- prefix trie


def brute_trie(rows, bare=()):
    conversations = {conv: [] for conv in bare if conv is not None}
    order = lambda row: (row[1] is not None, row[1] or 0, row[2] or "", row[3] or "")
    for conv, _, role, text in sorted((row for row in rows if row[0] is not None), key=order):
        conversations.setdefault(conv, []).append((role or "", text or ""))
    members = {}
    for conv, turns in conversations.items():
        for depth in range(len(turns) + 1):
            members.setdefault(tuple(turns[:depth]), []).append(conv)
    children = Counter(path[:-1] for path in members if path)
    result = []
    for path, held in members.items():
        below = [other for other in members if other[: len(path)] == path]
        saved = sum((len(members[other]) - 1) * len(other[-1][1].encode()) for other in below if other)
        ends = ",".join(str(conv) for conv in sorted(held) if len(conversations[conv]) == len(path))
        result.append((
            min(held), len(path), min(members[path[:-1]]) if path else None, len(held), children[path],
            sum(not children[other] for other in below), saved, hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(result, key=repr)


TURNS = "conv_id long, turn long, role string, text string, head string"


@pytest.mark.parametrize("size", [1, 60, 100_000])
def test_trie_is_that_of_brute_force(spark, size):
    """Containers of every size, from heads all the way down to one container."""
    rng = random.Random(size)
    rows = []
    stem = [("user", f"stem {n}") for n in range(6)]
    for conv in range(90):
        turns = stem[: rng.choice([0, 0, 3, 6])] + [(rng.choice(["user", "assistant", None]), rng.choice(["", None, "\u00e9", "a", "b" * 50])) for _ in range(rng.randint(1, 5))]
        rows += [(conv - 40, n, role, text) for n, (role, text) in enumerate(turns)]
    rows += [(conv, n, *turn) for conv in range(200, 230) for n, turn in enumerate(stem)]  # copies
    rows += [(300, None, "user", "z"), (300, None, "user", "a"), (300, 1, "user", "a"), (300, 1, "user", "a")]
    rows += [(301, n, "user", f"{n}") for n in range(300)] + [(302, n, "user", f"{n}") for n in range(299)]
    rows += [(None, 0, "user", "nobody's")]
    bare = [-40, 300, 500, 501, None]
    turns = spark.createDataFrame([(*row, "clash") for row in rows], TURNS)
    more = spark.createDataFrame([(conv,) for conv in bare], "conv_id long")
    got = prefix_trie.prefix_trie(turns, more, container_turns=size)
    assert sorted(map(tuple, got.collect()), key=repr) == brute_trie(rows, bare)


def test_trie_of_little(spark):
    none = spark.createDataFrame([], TURNS)
    assert prefix_trie.prefix_trie(none).count() == 0
    only = spark.createDataFrame([(4,), (9,), (10,)], "conv_id long")
    assert sorted(map(tuple, prefix_trie.prefix_trie(none, only, 1).collect()), key=repr) == brute_trie([], [4, 9, 10])
    long = [(n, 0, "user", "x" * 1_000_000) for n in (1, 2)] + [(1, 1, None, "y")]
    got = prefix_trie.prefix_trie(spark.createDataFrame([(*row, "") for row in long], TURNS), container_turns=1)
    assert sorted(map(tuple, got.collect()), key=repr) == brute_trie(long)


# --- URL filters

URLS = [
    "http://a.example.net/en/1", "https://EXAMPLE.NET/en/2?x=1#t", "http://net/", "http://net", "http://b.net?/en/", "http://xnet/a",
    "http://example.com/de/", "http://m.example.com/de", "ftp://shop.example.com/de/a/b.PDF?ref", "http://org/fr/9", "http://w.org/fr", "http://notexample.net/en/",
    None, "", "no scheme", "://", "http://", "http://h#a://b.net/", "x://\u00c4B.Org/fr/\n?q", "http://a.example.net/EN/", "http://u@a.org:80/fr/x", "a://b://c.net/x",
]


def parts_of(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(mark) for mark in "/?#" if mark in rest], default=len(rest))
    host, path = rest[:cut], rest[cut:]
    end = min([path.find(mark) for mark in "?#" if mark in path], default=len(path))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path[:end]


def test_fixed_rules(spark):
    pages = spark.createDataFrame([(n, url, "clash") for n, url in enumerate(URLS)] * 2, "page_id long, url string, judged string")
    rows = url_rules.judge_urls(pages).collect()
    assert len(rows) == 2 * len(URLS)
    for row in rows:
        host, path = parts_of(row.url)
        fits = [(len(h + p), h + p, v) for v, h, p in url_rules.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        assert (row.judged.host, row.judged.path) == (host, path)
        assert row.judged.rule == (max(fits)[1] if fits else None)
        assert not fits or row.judged.verdict == max(fits)[2]
    assert url_rules.judge_urls(pages.limit(0)).count() == 0
    lone = spark.createDataFrame([("gopher://far.edu/x",)], "url string")
    assert url_rules.judge_urls(lone).first().judged.verdict == url_rules.DEFAULT


def brute_rules(labelled, support, confidence):
    """Every token set of the labelled rows, counted."""
    fits, hits = Counter(), Counter()
    for tokens, verdict in labelled:
        for size in range(1, len(tokens) + 1):
            for part in itertools.combinations(sorted(tokens), size):
                fits[part] += 1
                hits[part, verdict] += 1
    least = math.ceil(support * len(labelled))
    return {key: (n / fits[key[0]], n) for key, n in hits.items() if n >= least and n / fits[key[0]] >= confidence}


@pytest.mark.parametrize("seed", range(2))
def test_mined_rules_are_those_of_brute_force(spark, seed):
    rng = random.Random(seed)
    make = lambda: [f"{place}={rng.choice('abc')}" for place in rng.sample(url_rules.PLACES, rng.randint(1, 5))]
    labelled = [(make(), rng.choice(["block", "block", "allow"])) for _ in range(120)]
    every = brute_rules(labelled, 0.03, 0.7)
    rows = spark.createDataFrame([*labelled, ([], "allow"), (["tld=a"], None)], "tokens array<string>, verdict string")
    mined = url_rules.mine_rules(rows, 0.03, 0.7)
    got = {(tuple(r.tokens), r.verdict): r.confidence for r in mined.collect()}
    dominated = {
        key for key, (sure, _) in every.items()
        if any(key[1] == v and set(p) < set(key[0]) and every[p, v][0] >= sure for p, v in every)
    }
    assert got == {key: pytest.approx(sure) for key, (sure, _) in every.items() if key not in dominated} and got
    asked = [(n, make()) for n in range(80)]
    found = {r.row: r.verdict for r in url_rules.matching(spark.createDataFrame(asked, "row long, tokens array<string>"), mined).collect()}
    for n, tokens in asked:
        fitting = [(-sure, -hits, len(p), v, p) for (p, v), (sure, hits) in every.items() if set(p) <= set(tokens)]
        assert found.get(n) == (min(fitting)[3] if fitting else None)


def test_labels_of_a_column(spark):
    pages = [(f"http://shop{n}.example.edu/{'buy' if n % 2 else 'read'}/{n}", "block" if n % 2 else "allow") for n in range(60)]
    rows = spark.createDataFrame([*pages, ("http://new.example.edu/buy/7", None), ("http://new.example.edu/read/7", None)], "url string, label string")
    got = {r.url: r.judged.verdict for r in url_rules.judge_urls(rows, labels="label").collect()}
    assert got["http://new.example.edu/buy/7"] == "block" and got["http://new.example.edu/read/7"] == "allow"
