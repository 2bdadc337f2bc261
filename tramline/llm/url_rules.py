"""URL filters: fixed host and path rules first, mined token combinations for the rest.

Everything here is DataFrame functions and Spark's FP-growth. A URL has at most one token for
each of ``PLACES``, so at most 2 ** len(PLACES) combinations, however long it is; with a least
support of s no more than 2 ** (len(PLACES) + 1) / s combinations can be frequent, whatever the
number of URLs. That bounds the rules, and so what is broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F

from tramline.llm.common import written

#: (verdict, host, path): the host and its subdomains, paths from there on. The longest wins.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: The places of a URL that give a token each.
PLACES = ("scheme", "tld", "site", "name", "sub", "dir", "page", "ext", "key", "mark")
#: A combination counts from this share of the labelled URLs on, a rule from this confidence on.
SUPPORT = 0.01
CONFIDENCE = 0.8
DEFAULT = "allow"

_PARTS = r"(?s)^(.*?)://([^/?#]*)([^?#]*)(.*)$"


def _part(url: Column, group: int) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, group), F.lit(""))


def _ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and ``/``, ``?``, ``#`` or the end; else empty."""
    return _ascii_lower(_part(url, 2))


def path_of(url: Column) -> Column:
    """What stands between the host and ``?``, ``#`` or the end; else empty."""
    return _part(url, 3)


def fixed_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """(rule, verdict) of the longest rule that fits, or null."""
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, own, start in sorted(rules, key=lambda rule: len(rule[1]) + len(rule[2])):
        fits = ((host == own) | F.endswith(host, F.lit(f".{own}"))) & F.startswith(path, F.lit(start))
        chosen = F.when(fits, F.struct(F.lit(own + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """The tokens of a URL, ``place=value``: at most one a place, none for what it does not have.

    ``site`` are the last two labels of the host, ``name`` and ``sub`` the labels before them;
    ``dir`` and ``page`` the first two steps of the path, numbers as 0; ``key`` the first query
    parameter's name; ``mark`` tells a fragment.
    """
    labels = F.reverse(F.split(host, r"\."))
    steps = F.split(F.regexp_replace(path, "[0-9]+", "0"), "/")
    rest = _part(url, 4)
    label = lambda n: F.try_element_at(labels, F.lit(n))
    values = {
        "scheme": _ascii_lower(_part(url, 1)),
        "tld": label(1),
        "site": F.concat(label(2), F.lit("."), label(1)),
        "name": label(3),
        "sub": label(4),
        "dir": F.try_element_at(steps, F.lit(2)),
        "page": F.try_element_at(steps, F.lit(3)),
        "ext": F.regexp_extract(path, r"\.([A-Za-z0-9]{1,5})$", 1),
        "key": F.regexp_extract(rest, r"^\?([^=&#]*)", 1),
        "mark": F.when(F.contains(rest, F.lit("#")), F.lit("#")),
    }
    tokens = [F.when(values[place] != "", F.concat(F.lit(f"{place}="), values[place])) for place in PLACES]
    return F.array_compact(F.array(*tokens))


def mine_rules(labelled: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """(tokens, verdict, confidence, support): the association rules of ``labelled`` (tokens, verdict).

    ``tokens`` are sorted. A rule goes if one with fewer of its tokens, the same verdict and at
    least its confidence is there, for that one fits wherever it does. Rows without tokens or
    verdict are not used; no rows give no rules.
    """
    spark = labelled.sparkSession
    verdict = F.concat(F.lit("verdict="), F.col("verdict"))
    items = labelled.filter("verdict is not null and size(tokens) > 0").select(F.concat("tokens", F.array(verdict)).alias("items"))
    items = written(items, "labelled")
    if items.isEmpty():
        return spark.createDataFrame([], "tokens array<string>, verdict string, confidence double, support double")
    mined = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(items).associationRules
    rules = written(
        mined.filter("consequent[0] like 'verdict=%' and not exists(antecedent, t -> t like 'verdict=%')").select(
            F.array_sort("antecedent").alias("tokens"), F.expr("substr(consequent[0], 9)").alias("verdict"), "confidence", "support"
        ),
        "rules",
    )
    parts = "transform(sequence(1, shiftleft(1, size(tokens)) - 2), m -> filter(tokens, (t, i) -> getbit(m, i) = 1))"
    smaller = (
        rules.filter("size(tokens) > 1")
        .select("tokens", "verdict", "confidence", F.explode(F.expr(parts)).alias("part"))
        .join(rules.select(F.col("tokens").alias("part"), "verdict", F.col("confidence").alias("better")), ["part", "verdict"])
        .filter("better >= confidence")
        .select("tokens", "verdict")
        .distinct()
    )
    return written(rules.join(smaller, ["tokens", "verdict"], "left_anti"), "rules")


def matching(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(row, verdict) of the rows of ``urls`` (row, tokens) that a mined rule fits.

    Each rule is listed under its least frequent token only, so a URL meets the rules of its own
    tokens and few of those; the listed rules are checked for all their tokens. The most
    confident wins, then the best supported, the shortest, and the first by name.
    """
    one = rules.select(F.explode("tokens").alias("token"), "support").groupBy("token").agg(F.max("support").alias("often"))
    rank = F.struct(
        (-F.col("confidence")).alias("confidence"), (-F.col("support")).alias("support"), F.size("tokens").alias("n"), "verdict", "tokens"
    )
    index = (
        rules.withColumn("token", F.explode("tokens"))
        .join(F.broadcast(one), "token")
        .groupBy("tokens", "verdict", "confidence", "support")
        .agg(F.min(F.struct("often", "token")).getField("token").alias("token"))
        .select("token", rank.alias("rank"))
    )
    return (
        urls.select("row", F.col("tokens").alias("own"), F.explode("tokens").alias("token"))
        .join(F.broadcast(index), "token")
        .filter("size(array_except(rank.tokens, own)) = 0")
        .groupBy("row")
        .agg(F.min("rank").getField("verdict").alias("verdict"))
    )


def judge_urls(
    pages: DataFrame,
    url_column: str = "url",
    rules: Sequence[tuple[str, str, str]] = RULES,
    labels: str | None = None,
    support: float = SUPPORT,
    confidence: float = CONFIDENCE,
) -> DataFrame:
    """The rows of ``pages`` with ``judged`` = (host, path, rule, verdict).

    A URL that a fixed rule fits has that rule and its verdict. For the others, token
    combinations are mined from the labelled URLs and the best rule that fits decides;
    ``DEFAULT`` where none does. Labels are the column ``labels`` (block, allow or null) where
    one is named, else what the fixed rules say of the URLs they fit. A null URL, or one without
    ``://``, has an empty host and path and no tokens. Repeated rows stay; a column ``judged`` is
    replaced; an empty table gives no rows.
    """
    own = [F.col(f"`{name}`") for name in pages.columns if name != "judged"]
    url = F.coalesce(F.col(f"`{url_column}`").cast("string"), F.lit(""))
    read = pages.select(F.struct(*own).alias("own"), url.alias("url")).withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    known = written(
        read.select(
            F.monotonically_increasing_id().alias("row"), "own", "host", "path",
            fixed_rule(F.col("host"), F.col("path"), rules).alias("fixed"),
            url_tokens(F.col("url"), F.col("host"), F.col("path")).alias("tokens"),
        ),
        "urls",
    )
    label = F.col("own").getField(labels) if labels else F.col("fixed.verdict")
    mined = mine_rules(known.select("tokens", label.alias("verdict")), support, confidence)
    found = matching(known.filter("fixed is null").select("row", "tokens"), mined)
    return known.join(found, "row", "left").select(
        "own.*",
        F.struct(
            "host", "path", F.col("fixed.rule").alias("rule"),
            F.coalesce("fixed.verdict", "verdict", F.lit(DEFAULT)).alias("verdict"),
        ).alias("judged"),
    )
