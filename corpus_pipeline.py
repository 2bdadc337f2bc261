"""From raw documents to packed training sequences, in five stages.

A stage takes (spark, documents, folder of the tables) and returns the documents it keeps, with
the columns they came with; the last returns packed pieces. Each stage's result is written and
read again as the next one's input, so a lost executor repeats one stage at most.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tramline.llm import quality
from tramline.llm.common import table, written
from tramline.llm.decontaminate import clean_documents
from tramline.llm.packing import pack
from tramline.llm.simhash import without_near_duplicates
from tramline.llm.substrings import without_repeats
from tramline.session import configure, remove, scratch_path, scratch_scope

#: The vocabulary file of the packed ids.
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
#: Documents below this score go.
LEAST_QUALITY = 0.3
SEQUENCE = 4096
END_ID = 1


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier does not reject.

    Null and empty texts are judged as texts without words; rows that share an id, or have none,
    are judged each by its own text. An empty table stays empty.
    """
    usable = F.crc32(F.col("doc_id").cast("string")) % 5 != 0
    model = quality.train(docs, table(spark, sf_dir, "labels"), usable)
    return docs.filter(quality.quality_score(model, F.col("text")) >= LEAST_QUALITY)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id."""
    return without_near_duplicates(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that also start earlier.

    Only a text that loses words changes; a document of which nothing is left goes.
    """
    done = without_repeats(docs)
    changed = F.col("cut.n_removed") > 0
    new = {"text": F.when(changed, F.col("cut.kept")).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        length = F.char_length("cut.kept").cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.when(changed, length).otherwise(F.col("n_chars"))
    left = done.filter(~changed | (F.col("cut.n_removed") < F.col("cut.n_words")))
    return left.withColumns(new).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of words with the benchmark.

    Null and empty texts have no words and stay; equal rows stay or go together.
    """
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document that is left.

    A null or empty text is the end id alone; a null id stays null; rows that share an id are
    documents of their own.
    """
    rows = pack(docs, VOCABULARY, END_ID, SEQUENCE)
    return rows.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES = [
    ("quality", keep_good),
    ("near_duplicates", drop_near_duplicates),
    ("repeats", cut_repeats),
    ("decontamination", decontaminate),
    ("packing", pack_sequences),
]

#: A trained classifier, hashes and token ids have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the table ``documents``.

    The tables a stage works with go when its result is written, and that when the next one is.
    """
    docs = table(configure(spark), sf_dir, "documents")
    *earlier, (_, last) = STAGES
    before = None
    for name, stage in earlier:
        place = scratch_path(spark, name)
        with scratch_scope(spark):
            docs = written(stage(spark, docs, sf_dir), name, place)
        if before:
            remove(spark, before)
        before = place
    return last(spark, docs, sf_dir)
