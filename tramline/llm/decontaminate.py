"""Benchmark decontamination: a broadcast hash set of test n-grams against training windows.

Everything here is DataFrame functions. A bitmap of fixed size, folded into the plan, screens
each window of a text by its hash; what passes is verified as words by a hash join with the
n-grams, which are broadcast where their measured number allows it and shuffled otherwise.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tramline.llm.common import whole, written

WINDOW = 10
#: The bitmap has 64 bits for each of these; its size does not depend on the benchmark.
BITMAP_LONGS = 1 << 14
#: N-grams up to this many are broadcast (each a text of at most ``WINDOW`` words and its items).
BROADCAST_GRAMS = 200_000
BROADCAST_BYTES = 32 << 20

_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def normalised(text: Column) -> Column:
    """A to Z in lower case, and one space between words of other than ASCII marks."""
    low = F.translate(whole(text), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.trim(F.regexp_replace(low, _SEPARATORS, " "))


def words(text: Column) -> Column:
    """The normalised words; null and empty texts have none."""
    line = normalised(text)
    return F.when(line == "", F.array().cast("array<string>")).otherwise(F.split(line, " "))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _windows(hashes: Column, length: int) -> Column:
    """Start (from 1) and hash of each window of ``length`` words."""
    many = F.size(hashes)
    starts = F.when(many >= length, F.sequence(F.lit(1), many - length + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(
        starts, lambda at: F.struct(at.alias("at"), F.xxhash64(F.slice(hashes, at, length)).alias("hash"))
    )


def _place(value: Column) -> tuple[Column, Column]:
    """Where a hash stands in the bitmap: which long, which bit."""
    return value.bitwiseAND(F.lit(BITMAP_LONGS - 1)).cast("int"), F.shiftrightunsigned(value, 58).cast("int")


def _candidates(all_words: Column, hashes: Column, length: int, passes: Callable[[Column], Column]) -> Column:
    """Place, length and words of the windows of one length that pass the screen."""

    def spelled(window: Column) -> Column:
        gram = F.array_join(F.slice(all_words, window["at"], length), " ")
        return F.struct(window["at"].alias("at"), F.lit(length).alias("length"), gram.alias("gram"))

    return F.transform(F.filter(_windows(hashes, length), passes), spelled)


def benchmark_grams(benchmark: DataFrame, id_column: str = "item_id", text_column: str = "text") -> DataFrame:
    """(gram, length, hash, items): the distinct windows of the items and the items they are in.

    An item of fewer words than a window, but not none, is one window. Items without an id count
    for words but are in no list.
    """
    split = benchmark.select(F.col(id_column).cast("string").alias("item"), words(F.col(text_column)).alias("w"))
    each = split.filter(F.size("w") > 0).select("item", "w", F.least(F.size("w"), F.lit(WINDOW)).alias("length"))
    grams = each.select(
        "item", "length", F.explode(F.expr("transform(sequence(1, size(w) - length + 1), i -> slice(w, i, length))")).alias("g")
    )
    hashed = grams.select(
        "item", "length", F.array_join("g", " ").alias("gram"),
        F.xxhash64(F.transform("g", lambda word: F.xxhash64(word))).alias("hash"),
    )
    return hashed.groupBy("gram", "length", "hash").agg(F.collect_set("item").alias("items"))


def _bitmap(grams: DataFrame) -> Column:
    """The fixed-size bitmap of the grams' hashes as a constant."""
    word, bit = _place(F.col("hash"))
    rows = grams.select(word.alias("word"), bit.alias("b")).select("word", F.expr("shiftleft(1L, b)").alias("bits"))
    longs = [0] * BITMAP_LONGS
    for row in rows.groupBy("word").agg(F.bit_or("bits").alias("bits")).collect():
        longs[row.word] = row.bits
    return F.split(F.lit(",".join(map(str, longs))), ",").cast("array<bigint>")


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """(doc_id, n_words, spans, items) of every row of ``docs``; ``kept`` holds its columns ``keep``.

    ``spans`` are the merged runs of hit words, from 1, end included; ``items`` the sorted ids of
    the items that share a window with the text. A text without hits has empty lists, and so has
    every text if the benchmark is empty. Rows that share an id, or have none, stay separate.
    """
    kept = F.struct(*(F.col(f"`{name}`") for name in keep)) if keep else F.lit(True)
    grams = written(benchmark_grams(benchmark, item_column, item_text), "grams")
    lengths = sorted(row.length for row in grams.select("length").distinct().collect())  # 1 to WINDOW
    bitmap = _bitmap(grams)

    def passes(window: Column) -> Column:
        word, bit = _place(window["hash"])
        return F.getbit(F.element_at(bitmap, word + 1), bit) == 1

    def screen(all_words: Column) -> Column:
        found: Column = F.array().cast("array<struct<at:int,length:int,gram:string>>")
        if lengths:
            hashes = F.transform(all_words, lambda word: F.xxhash64(word))
            found = _let(hashes, lambda h: F.concat(*(_candidates(all_words, h, length, passes) for length in lengths)))
        return F.struct(F.size(all_words).alias("n_words"), found.alias("found"))

    screened = written(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.struct(F.col(id_column).alias("id"), kept.alias("kept")).alias("own"),
            _let(words(F.col(text_column)), screen).alias("seen"),
        ),
        "screened",
    ).select("row", "own", "seen.*")
    n, size = grams.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("gram") + 16 * F.size("items") + 32), F.lit(0))).first()
    known = grams.select("gram", "items")
    if n <= BROADCAST_GRAMS and size <= BROADCAST_BYTES:
        known = F.broadcast(known)
    hits = (
        screened.filter(F.size("found") > 0)
        .select("row", F.inline("found"))
        .join(known, "gram")
        .groupBy("row")
        .agg(
            F.array_sort(F.collect_set(F.struct("at", (F.col("at") + F.col("length") - 1).alias("end")))).alias("runs"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        )
        .select("row", _merged("runs").alias("spans"), "items")
    )
    none = F.array().cast("array<struct<at:int,end:int>>")
    return screened.join(hits, "row", "left").select(
        F.col("own.id").alias("doc_id"),
        "n_words",
        F.coalesce("spans", none).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        *([F.col("own.kept")] if keep else []),
    )


def _merged(runs: str) -> Column:
    """Sorted runs of words with those that touch or overlap made one."""
    empty = F.array().cast("array<struct<at:int,end:int>>")

    def add(done: Column, run: Column) -> Column:
        last = F.element_at(done, -1)
        joined = F.struct(last["at"].alias("at"), F.greatest(last["end"], run["end"]).alias("end"))
        return F.when(
            (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] >= run["at"] - 1),
            F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(joined)),
        ).otherwise(F.concat(done, F.array(run)))

    return F.aggregate(runs, empty, add)


def clean_documents(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text"):
    """The rows of ``docs``, with all their columns, whose text shares no window with the benchmark.

    Null and empty texts share none and stay; rows are judged each, equal ones alike.
    """
    found = find_contamination(docs, benchmark, id_column, text_column, keep=tuple(docs.columns))
    return found.filter(F.size("spans") == 0).select("kept.*")


def contamination_digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The result of the operator, counted."""
    found = find_contamination(docs, benchmark)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["at"] + 1)
    return found.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
