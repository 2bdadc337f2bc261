"""The text operators on the given tables, and the SQL that must give the same rows."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

import corpus_pipeline
from tramline.llm import quality, toxicity
from tramline.llm.chat import formatted_digest
from tramline.llm.common import table
from tramline.llm.decontaminate import contamination_digest
from tramline.llm.neighbours import nearest
from tramline.llm.packing import pack
from tramline.llm.periodic_runs import runs_digest
from tramline.llm.prefix_trie import prefix_trie
from tramline.llm.sharding import SHARD_BYTES, shard_digest
from tramline.llm.simhash import near_duplicates
from tramline.llm.substrings import substring_digest
from tramline.llm.token_files import token_file_digest
from tramline.llm.url_rules import CONFIDENCE, SUPPORT, judge_urls
from tramline.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

VOCABULARY = corpus_pipeline.VOCABULARY


_ROOT = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))


def _importable(spark: SparkSession) -> SparkSession:
    """Let Python workers import the package from where the driver did, if they share that folder."""
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if _ROOT not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, (known, _ROOT)))
    return spark


def query(key: str, sql: str | None = None):
    def add(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(configure(_importable(spark)), folder)

        run.__name__, run.__doc__ = key, fn.__doc__
        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = sql.strip()
        return fn

    return add


@query("op1_quality")
def quality_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every document."""
    return quality.score_documents(table(spark, folder, "documents"), table(spark, folder, "labels"))


CHAT_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
spelled AS (
  SELECT *, length(text) + coalesce(list_sum(list_transform(
           regexp_extract_all(text, '\\*### '), lambda x: length(x) - 3)), 0)
         + coalesce(list_sum(list_transform(
           regexp_extract_all(text, '\\*</turn>'), lambda x: length(x) - 6)), 0)
         + length(regexp_extract(text, '\\*$')) AS n
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(4 + length(role) + 2 + n + 8) AS BIGINT) AS formatted_chars
FROM spelled GROUP BY conv_id
"""


@query("op2_chat", CHAT_SQL)
def chat(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation formatted, written, and parsed again."""
    given = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    hard = r"\### Assistant: </turn> ok"
    more = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(hard).alias("text"),
    )
    return formatted_digest(given.union(more))


@query("op3_token_files")
def token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Token files of all documents, written and read back."""
    return token_file_digest(spark, table(spark, folder, "documents"), VOCABULARY, end_id=2)


SUBSTRINGS_SQL = r"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS g
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 19)) AS i FROM texts WHERE len(w) >= 20)),
later AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS r FROM windows) WHERE r > 1),
gone AS (
  SELECT doc_id, list(DISTINCT p) AS places
  FROM (SELECT doc_id, unnest(generate_series(i, i + 19)) AS p FROM later) GROUP BY doc_id),
kept AS (
  SELECT t.doc_id, t.w, CASE WHEN g.places IS NULL THEN t.w ELSE k.words END AS k
  FROM texts t LEFT JOIN gone g USING (doc_id)
  LEFT JOIN (
    SELECT doc_id, list(word ORDER BY p) AS words
    FROM (SELECT doc_id, unnest(w) AS word, unnest(generate_series(1, len(w))) AS p FROM texts)
    WHERE (doc_id, p) NOT IN (SELECT doc_id, unnest(places) FROM gone) GROUP BY doc_id) k USING (doc_id))
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
       CAST(len(w) - coalesce(len(k), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(k, ' '), '')) AS kept_sha256
FROM kept
"""


@query("op4_substrings", SUBSTRINGS_SQL)
def substrings(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of every document without passages that also start earlier."""
    return substring_digest(table(spark, folder, "documents"))


@query("op5_neighbours")
def neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The five nearest vectors of every fiftieth."""
    return nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@query("op6_simhash")
def simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return near_duplicates(table(spark, folder, "documents")).select("doc_id", "fingerprint", "component_id")


_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

DECONTAMINATION_SQL = rf"""
WITH item_words AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id,
         regexp_extract_all({_LOWER.format("text")}, '{_WORDS}') AS w FROM benchmark),
grams AS (
  SELECT item_id, least(len(w), 10) AS m,
         unnest(list_transform(generate_series(1, len(w) - least(len(w), 10) + 1),
                lambda i: array_to_string(w[i:i + least(len(w), 10) - 1], ' '))) AS gram
  FROM item_words WHERE len(w) > 0),
sizes AS (SELECT DISTINCT m FROM grams),
texts AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("text")}, '{_WORDS}') AS w FROM documents),
windows AS (
  SELECT doc_id, m, unnest(generate_series(1, len(w) - m + 1)) AS i, w
  FROM texts, sizes WHERE len(w) >= m),
hits AS (
  SELECT v.doc_id, v.i, v.m, g.item_id
  FROM (SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS gram FROM windows) v
  JOIN grams g ON g.gram = v.gram AND g.m = v.m),
counted AS (SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(i, i + m - 1)) AS p FROM hits) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT t.doc_id, CAST(len(t.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM texts t LEFT JOIN counted USING (doc_id) LEFT JOIN named USING (doc_id)
"""


@query("op7_decontamination", DECONTAMINATION_SQL)
def decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark windows found in every document."""
    return contamination_digest(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


SHARDING_SQL = f"""
WITH sized AS (
  SELECT doc_id, CAST(strlen(coalesce(text, '')) AS BIGINT) AS bytes,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS code
  FROM documents),
levels AS (SELECT doc_id, bytes, depth, code >> (32 - depth) AS bucket
           FROM sized, (SELECT CAST(unnest(generate_series(0, 32)) AS INTEGER) AS depth)),
sums AS (SELECT depth, bucket, CAST(sum(bytes) AS BIGINT) AS shard_bytes
         FROM levels GROUP BY depth, bucket HAVING sum(bytes) <= {SHARD_BYTES})
SELECT doc_id, bytes, depth, bucket, shard_bytes
FROM levels JOIN sums USING (depth, bucket)
QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY depth) = 1
"""


@query("op8_sharding", SHARDING_SQL)
def sharding(spark: SparkSession, folder: str) -> DataFrame:
    """The shard of every document."""
    return shard_digest(table(spark, folder, "documents"))


@query("op9_toxicity")
def toxicity_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity.score_documents(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op10_packing")
def packing(spark: SparkSession, folder: str) -> DataFrame:
    """The place of every piece of every document."""
    rows = pack(table(spark, folder, "documents"), VOCABULARY, end_id=1, capacity=4096)
    return rows.select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset"
    )


def _crc32_sql(text: str) -> str:
    """CRC-32 of an ASCII text: the polynomial on each bit of each byte."""
    step = "CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END"
    byte = f"list_reduce([xor(c, b)] || [0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: {step})"
    codes = f"list_transform(string_split({text}, ''), lambda s: CAST(ascii(s) AS BIGINT))"
    return f"xor(list_reduce([4294967295] || {codes}, lambda c, b: {byte}), 4294967295)"


RUNS_SQL = rf"""
WITH given AS (
  SELECT doc_id, w, len(w) AS n, {_crc32_sql("CAST(doc_id AS VARCHAR)")} AS h
  FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents)),
cycles AS (SELECT *, (h // 10) % greatest(n, 1) AS a, h // 10 AS g FROM given),
texts AS (
  SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(generate_series(0, n - 1), lambda i:
           CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % (1 + (n - a) // (3 + g % 8)) + 1] END) ELSE w END AS w
  FROM cycles),
grams AS (
  SELECT doc_id, i, array_to_string(w[i + 1:i + 8], ' ') AS gram
  FROM (SELECT doc_id, w, unnest(generate_series(0, n - 8)) AS i FROM texts WHERE n >= 24)),
pairs AS (
  SELECT doc_id, x.i, y.i - x.i AS q, x.i - row_number() OVER (PARTITION BY doc_id, y.i - x.i ORDER BY x.i) AS island
  FROM grams x JOIN grams y USING (doc_id, gram) WHERE x.i < y.i),
stretches AS (
  SELECT doc_id, min(i) AS start, count(*) + 7 + q AS length, q AS period
  FROM pairs GROUP BY doc_id, q, island HAVING count(*) + 7 + q >= greatest(24, 3 * q)),
runs AS (SELECT doc_id, start, length, min(period) AS period FROM stretches GROUP BY doc_id, start, length),
gone AS (SELECT doc_id, unnest(generate_series(start + period, start + length - 1)) AS p FROM runs),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS words
  FROM (SELECT doc_id, unnest(w) AS word, unnest(generate_series(0, n - 1)) AS p FROM texts WHERE n > 0)
  WHERE (doc_id, p) NOT IN (SELECT doc_id, p FROM gone) GROUP BY doc_id),
best AS (
  SELECT x.* FROM runs x WHERE NOT EXISTS (
    SELECT 1 FROM runs y WHERE y.doc_id = x.doc_id AND (y.length * x.period > x.length * y.period
      OR y.length * x.period = x.length * y.period AND (y.start, y.period) < (x.start, x.period)))),
listed AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS l
  FROM runs GROUP BY doc_id)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, length * 1000 // period AS exponent_milli,
       sha256(coalesce(l, '')) AS runs_sha256, sha256(coalesce(words, '')) AS collapsed_sha256
FROM texts LEFT JOIN listed USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


def _with_cycles(docs: DataFrame) -> DataFrame:
    """(doc_id, text): the documents, some of them with a stretch of words said again and again."""
    drawn = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda word: word != "")
    rows = docs.select("doc_id", "text", (drawn % 10 == 0).alias("chosen"), F.floor(drawn / 10).alias("g"))
    rows = rows.withColumn("w", F.when(F.col("chosen"), words)).withColumn("n", F.size("w"))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    rows = rows.withColumn("p", F.expr("cast(1 + (n - a) div (3 + g % 8) as int)"))
    cycle = "slice(flatten(array_repeat(slice(w, a + 1, p), cast((n - a) div p + 1 as int))), 1, n - a)"
    said = F.expr(f"array_join(concat(slice(w, 1, a), {cycle}), ' ')")
    return rows.select("doc_id", F.when(F.col("chosen") & (F.col("n") > 0), said).otherwise(F.col("text")).alias("text"))


@query("op11_periodic_runs", RUNS_SQL)
def periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of repeated words in every document, and what is left without the repeats."""
    return runs_digest(_with_cycles(table(spark, folder, "documents")))


TRIE_SQL = f"""
WITH numbered AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS n
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT conv_id, {_crc32_sql("CAST(conv_id AS VARCHAR)")} % 9 AS h FROM (SELECT DISTINCT conv_id FROM numbered)),
rebuilt AS (
  SELECT i.conv_id, role, text, n FROM ids i JOIN numbered t ON t.conv_id = i.conv_id - i.conv_id % 5 WHERE n <= h
  UNION ALL SELECT conv_id, role, text, n FROM ids JOIN numbered USING (conv_id) WHERE n > h),
lists AS (
  SELECT conv_id, coalesce(turns, []) AS turns FROM ids LEFT JOIN (
    SELECT conv_id, list(sha256(length(role) || ':' || role || text) ORDER BY n) AS turns FROM rebuilt GROUP BY conv_id) USING (conv_id)),
sizes AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY n) AS depth, strlen(text) AS size FROM rebuilt),
prefixes AS (
  SELECT conv_id, len(turns) AS whole, depth, array_to_string(turns[1:depth], ',') AS path, array_to_string(turns[1:depth - 1], ',') AS up
  FROM (SELECT conv_id, turns, unnest(generate_series(0, len(turns))) AS depth FROM lists)),
nodes AS (
  SELECT path, depth, min(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (whole = depth), '')) AS ends_sha256
  FROM prefixes GROUP BY path, depth),
counted AS (
  SELECT n.*, (SELECT count(*) FROM nodes c WHERE c.up = n.path AND c.depth = n.depth + 1) AS n_children,
         (n_convs - 1) * coalesce(s.size, 0) AS own
  FROM nodes n LEFT JOIN sizes s ON s.conv_id = n.conv_id AND s.depth = n.depth),
sums AS (
  SELECT p.path, p.depth, count(*) FILTER (c.n_children = 0) AS n_leaves, CAST(sum(c.own) AS BIGINT) AS saved_tokens
  FROM counted c JOIN prefixes p ON p.conv_id = c.conv_id AND p.depth <= c.depth GROUP BY p.path, p.depth)
SELECT c.conv_id, c.depth, u.conv_id AS parent_conv_id, c.n_convs, c.n_children, n_leaves, saved_tokens, c.ends_sha256
FROM counted c JOIN sums USING (path, depth) LEFT JOIN nodes u ON u.path = c.up AND u.depth = c.depth - 1
"""


def _with_borrowed_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations): every conversation begins with the first turns of another."""
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    given = conversations.filter("conv_id is not null").select(
        "conv_id", "turn", *(F.coalesce(name, F.lit("")).alias(name) for name in ("role", "text"))
    )
    numbered = given.withColumn("n", F.row_number().over(order))
    ids = given.select("conv_id").distinct().withColumn("h", F.crc32(F.col("conv_id").cast("string")) % 9)
    first = numbered.filter("n <= 8").withColumnRenamed("conv_id", "base")
    borrowed = ids.withColumn("base", F.expr("conv_id - conv_id % 5")).join(first, "base").filter("n <= h")
    own = numbered.filter(F.col("n") > F.crc32(F.col("conv_id").cast("string")) % 9)
    columns = ["conv_id", F.col("n").alias("turn"), "role", "text"]
    return borrowed.select(*columns).union(own.select(*columns)), ids.select("conv_id")


@query("op12_prefix_trie", TRIE_SQL)
def trie(spark: SparkSession, folder: str) -> DataFrame:
    """The nodes of the trie of all conversations."""
    return prefix_trie(*_with_borrowed_turns(table(spark, folder, "conversations")))


_URL_PARTS = r"'(?s)^(.*?)://([^/?#]*)([^?#]*)(.*)$'"
_URL_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

URL_SQL = rf"""
WITH urls AS (
  SELECT page_id, {_URL_LOWER.format(f"regexp_extract(url, {_URL_PARTS}, 1)")} AS scheme,
         {_URL_LOWER.format(f"regexp_extract(url, {_URL_PARTS}, 2)")} AS host,
         regexp_extract(url, {_URL_PARTS}, 3) AS path, regexp_extract(url, {_URL_PARTS}, 4) AS rest
  FROM (SELECT page_id, coalesce(url, '') AS url FROM pages)),
fixed AS (
  SELECT *, row_number() OVER () AS row, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule,
    list_reverse(string_split(host, '.')) AS l, string_split(regexp_replace(path, '[0-9]+', '0', 'g'), '/') AS d
  FROM urls),
judged AS (
  SELECT row, page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow' END AS given,
    list_sort(list_filter([
      CASE WHEN scheme <> '' THEN 'scheme=' || scheme END, CASE WHEN l[1] <> '' THEN 'tld=' || l[1] END,
      CASE WHEN len(l) > 1 THEN 'site=' || l[2] || '.' || l[1] END, CASE WHEN l[3] <> '' THEN 'name=' || l[3] END,
      CASE WHEN l[4] <> '' THEN 'sub=' || l[4] END, CASE WHEN d[2] <> '' THEN 'dir=' || d[2] END,
      CASE WHEN d[3] <> '' THEN 'page=' || d[3] END, 'ext=' || nullif(regexp_extract(path, '\.([A-Za-z0-9]{{1,5}})$', 1), ''),
      'key=' || nullif(regexp_extract(rest, '^\?([^=&#]*)', 1), ''), CASE WHEN contains(rest, '#') THEN 'mark=#' END],
      lambda t: t IS NOT NULL)) AS tokens
  FROM fixed),
parts AS (
  SELECT row, given, list_filter(tokens, lambda t, i: (m >> (i - 1)) & 1 = 1) AS part
  FROM (SELECT row, given, tokens, unnest(range(1, CAST(pow(2, len(tokens)) AS BIGINT))) AS m FROM judged)),
total AS (SELECT count(*) AS n FROM judged WHERE given IS NOT NULL AND len(tokens) > 0),
counts AS (
  SELECT part, given, count(*) AS hits, sum(count(*)) OVER (PARTITION BY part) AS fits
  FROM parts WHERE given IS NOT NULL GROUP BY part, given),
rules AS (
  SELECT part, given AS verdict, hits / fits AS confidence, hits
  FROM counts, total WHERE hits >= ceil({SUPPORT!r}::DOUBLE * n) AND hits / fits >= {CONFIDENCE!r}::DOUBLE),
found AS (
  SELECT row, verdict, row_number() OVER (PARTITION BY row ORDER BY confidence DESC, hits DESC, len(part), verdict, part) AS r
  FROM parts JOIN rules USING (part) WHERE given IS NULL)
SELECT page_id, host, path, rule, coalesce(given, verdict, 'allow') AS verdict
FROM judged LEFT JOIN (SELECT * FROM found WHERE r = 1) USING (row)
"""


@query("op13_url_filters", URL_SQL)
def url_filters(spark: SparkSession, folder: str) -> DataFrame:
    """The verdict on the url of every page."""
    return judge_urls(table(spark, folder, "pages").select("page_id", "url")).select("page_id", "judged.*")


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    """All stages of the corpus pipeline, one after the other."""
    return corpus_pipeline.run(spark, folder)
