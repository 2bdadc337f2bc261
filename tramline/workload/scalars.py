"""The column rules, each over a whole table, with faults put in by row key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tramline import functions as fx
from tramline.constants import CITY, WHITESPACE
from tramline.sources.ranges import date_hour_spine
from tramline.workload.registry import Tables, query
from tramline.workload.standins import PAGE, WEEKDAY_SQL, md5_key_sql, pages


def _applied(rows: DataFrame, key: str, **results: Column) -> DataFrame:
    return rows.select(key, *[value.alias(name) for name, value in results.items()])


# --- dates ----------------------------------------------------------------------------------


@query(
    "to_date_strict",
    """
    SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL
        ELSE CAST(o_orderdate AS DATE) END AS usage_date
    FROM orders
    """,
)
def to_date_strict(t: Tables) -> DataFrame:
    """Compact, dashed and missing date texts."""
    text = F.expr(
        "CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN date_format(o_orderdate, 'yyyyMMdd') "
        "ELSE date_format(o_orderdate, 'yyyy-MM-dd') END"
    )
    return _applied(t["orders"], "o_orderkey", usage_date=fx.to_date_strict(text))


_MIXED_DATES = """CASE o_orderkey % 6 WHEN 0 THEN NULL WHEN 1 THEN '20251331' WHEN 2 THEN '2025013'
    WHEN 3 THEN {iso} ELSE {compact} END"""


@query(
    "normalize_compact_date",
    f"""
    SELECT o_orderkey, CASE WHEN length(x) = 8 AND try_strptime(x, '%Y%m%d') IS NOT NULL
        THEN strftime(strptime(x, '%Y%m%d'), '%Y-%m-%d') ELSE x END AS usage_date
    FROM (SELECT o_orderkey, {_MIXED_DATES.format(
        iso="strftime(o_orderdate, '%Y-%m-%d')", compact="strftime(o_orderdate, '%Y%m%d')"
    )} AS x FROM orders) o
    """,
)
def normalize_compact_date(t: Tables) -> DataFrame:
    text = F.expr(
        _MIXED_DATES.format(
            iso="date_format(o_orderdate, 'yyyy-MM-dd')",
            compact="date_format(o_orderdate, 'yyyyMMdd')",
        )
    )
    return _applied(t["orders"], "o_orderkey", usage_date=fx.normalize_compact_date(text))


@query(
    "date_parts",
    """
    SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year,
        CAST(month(o_orderdate) AS INTEGER) AS month,
        CAST(day(o_orderdate) AS INTEGER) AS day_of_month,
        CAST(quarter(o_orderdate) AS INTEGER) AS quarter
    FROM orders
    """,
)
def date_parts(t: Tables) -> DataFrame:
    return _applied(t["orders"], "o_orderkey", **fx.date_parts(F.col("o_orderdate")))


@query(
    "weekday_name_kr",
    f"SELECT o_orderkey, {WEEKDAY_SQL.format(day='o_orderdate')} AS day_of_week_kr FROM orders",
)
def weekday_name_kr(t: Tables) -> DataFrame:
    name = fx.weekday_name_kr(F.col("o_orderdate"))
    return _applied(t["orders"], "o_orderkey", day_of_week_kr=name)


@query(
    "weekend_flag",
    "SELECT o_orderkey, dayofweek(o_orderdate) IN (0, 6) AS is_weekend FROM orders",
)
def weekend_flag(t: Tables) -> DataFrame:
    return _applied(t["orders"], "o_orderkey", is_weekend=fx.weekend_flag(F.col("o_orderdate")))


@query("year_month", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS year_month FROM orders")
def year_month(t: Tables) -> DataFrame:
    return _applied(t["orders"], "o_orderkey", year_month=fx.year_month(F.col("o_orderdate")))


@query(
    "run_date_minus_one",
    """
    SELECT event_id, ts - INTERVAL 1 DAY AS logical_time,
        CAST(CAST(ts AS DATE) - 1 AS DATE) AS logical_date
    FROM events
    """,
)
def run_date_minus_one(t: Tables) -> DataFrame:
    return _applied(
        t["events"],
        "event_id",
        logical_time=fx.run_date_minus_one(F.col("ts")),
        logical_date=fx.run_date_minus_one(F.col("ts").cast("date")).cast("date"),
    )


@query("compact_date", "SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS ymd FROM orders")
def compact_date(t: Tables) -> DataFrame:
    return _applied(t["orders"], "o_orderkey", ymd=fx.compact_date(F.col("o_orderdate")))


@query(
    "compact_date_parts",
    """
    SELECT o_orderkey, strftime(o_orderdate, '%Y') AS yyyy, strftime(o_orderdate, '%m') AS mm,
        strftime(o_orderdate, '%d') AS dd
    FROM orders
    """,
)
def compact_date_parts(t: Tables) -> DataFrame:
    text = fx.compact_date(F.col("o_orderdate"))
    return _applied(t["orders"], "o_orderkey", **fx.compact_date_parts(text))


@query("pad_number", "SELECT event_id, lpad(CAST(hour(ts) AS VARCHAR), 2, '0') AS hh FROM events")
def pad_number(t: Tables) -> DataFrame:
    return _applied(t["events"], "event_id", hh=fx.pad_number(F.hour("ts"), 2))


@query(
    "month_start",
    "SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start FROM orders",
)
def month_start(t: Tables) -> DataFrame:
    return _applied(t["orders"], "o_orderkey", month_start=fx.month_start(F.col("o_orderdate")))


@query(
    "date_hour_spine",
    """
    SELECT CAST(d AS DATE) AS usage_date, CAST(h AS INTEGER) AS usage_time
    FROM (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS d
          FROM orders) days, (SELECT unnest(range(24)) AS h) hours
    """,
)
def spine(t: Tables) -> DataFrame:
    """Every hour between the first and the last order."""
    placed = F.col("o_orderdate").cast("date")
    return date_hour_spine(t["orders"].agg(F.min(placed).alias("start"), F.max(placed).alias("end")))


# --- numbers --------------------------------------------------------------------------------


@query("cast_int_strict", "SELECT p_partkey, p_size AS size FROM part")
def cast_int_strict(t: Tables) -> DataFrame:
    text = F.expr("CASE WHEN p_partkey % 3 = 0 THEN ' ' || p_size || ' ' ELSE CAST(p_size AS STRING) END")
    return _applied(t["part"], "p_partkey", size=fx.cast_int_strict(text))


@query(
    "cast_double_strict",
    "SELECT p_partkey, CASE WHEN p_partkey % 4 <> 0 THEN p_retailprice END AS price FROM part",
)
def cast_double_strict(t: Tables) -> DataFrame:
    text = F.expr("CASE WHEN p_partkey % 4 <> 0 THEN CAST(p_retailprice AS STRING) END")
    return _applied(t["part"], "p_partkey", price=fx.cast_double_strict(text))


_LOOSE_NUMBER = """CASE event_id % 9 WHEN 0 THEN 'x' WHEN 1 THEN NULL WHEN 2 THEN ''
    WHEN 3 THEN user_id || '.0' WHEN 4 THEN '3x' WHEN 5 THEN '-' || user_id
    ELSE CAST(user_id AS {text}) END"""
_LOOSE_SQL = _LOOSE_NUMBER.format(text="VARCHAR")


@query(
    "coerce_int",
    f"SELECT event_id, CAST(try_cast(x AS DOUBLE) AS BIGINT) AS amount "
    f"FROM (SELECT event_id, {_LOOSE_SQL} AS x FROM events) e",
)
def coerce_int(t: Tables) -> DataFrame:
    text = F.expr(_LOOSE_NUMBER.format(text="STRING"))
    return _applied(t["events"], "event_id", amount=fx.coerce_int(text))


@query(
    "coerce_double",
    "SELECT event_id, CASE event_id % 7 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN NULL "
    "ELSE value END AS amount FROM events",
)
def coerce_double(t: Tables) -> DataFrame:
    text = F.expr(
        "CASE event_id % 7 WHEN 0 THEN 'x' WHEN 1 THEN NULL WHEN 2 THEN value || 'd' "
        "ELSE CAST(value AS STRING) END"
    )
    return _applied(t["events"], "event_id", amount=fx.coerce_double(text))


@query(
    "coerce_int_or_zero",
    """
    SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN 0 WHEN 1 THEN 0
        WHEN 2 THEN CAST(trunc(-c_acctbal) AS INTEGER)
        ELSE CAST(trunc(c_acctbal) AS INTEGER) END AS calories
    FROM customer
    """,
)
def coerce_int_or_zero(t: Tables) -> DataFrame:
    text = F.expr(
        "CASE c_custkey % 5 WHEN 0 THEN 'x' WHEN 1 THEN NULL WHEN 2 THEN CAST(-c_acctbal AS STRING) "
        "ELSE CAST(c_acctbal AS STRING) END"
    )
    return _applied(t["customer"], "c_custkey", calories=fx.coerce_int_or_zero(text))


@query(
    "zero_to_null",
    "SELECT l_orderkey, nullif(l_discount, 0.0::DOUBLE) AS discount FROM lineitem",
)
def zero_to_null(t: Tables) -> DataFrame:
    return _applied(t["lineitem"], "l_orderkey", discount=fx.zero_to_null(F.col("l_discount")))


@query(
    "nan_to_null",
    "SELECT c_custkey, CASE WHEN c_custkey % 10 > 1 THEN c_acctbal END AS balance FROM customer",
)
def nan_to_null(t: Tables) -> DataFrame:
    value = F.expr("CASE c_custkey % 10 WHEN 0 THEN double('NaN') WHEN 1 THEN NULL ELSE c_acctbal END")
    return _applied(t["customer"], "c_custkey", balance=fx.nan_to_null(value))


@query(
    "coalesce_zero",
    "SELECT l_orderkey, CASE WHEN l_orderkey % 6 = 0 THEN 0 ELSE l_linenumber END AS getoff FROM lineitem",
)
def coalesce_zero(t: Tables) -> DataFrame:
    value = F.expr("CASE WHEN l_orderkey % 6 <> 0 THEN l_linenumber END")
    return _applied(t["lineitem"], "l_orderkey", getoff=fx.coalesce_zero(value))


@query(
    "falsy_default",
    """
    SELECT c_custkey, CASE WHEN c_nationkey IN (0, 7) THEN -1 ELSE c_nationkey END AS number_code,
        CASE WHEN c_nationkey IN (3, 7) THEN '-1' ELSE CAST(c_nationkey AS VARCHAR) END AS text_code,
        CASE WHEN c_nationkey IN (0, 7) THEN '-1' ELSE CAST(c_nationkey AS VARCHAR) END AS json_code
    FROM customer
    """,
)
def falsy_default(t: Tables) -> DataFrame:
    """Number, text and JSON-typed input; the text 0 is a value, the number 0 is not."""
    number = F.expr("CASE WHEN c_nationkey <> 7 THEN c_nationkey END")
    text = F.expr("CASE c_nationkey WHEN 7 THEN NULL WHEN 3 THEN '' ELSE CAST(c_nationkey AS STRING) END")
    json = F.parse_json(
        F.expr("CASE WHEN c_nationkey = 7 THEN '\"\"' ELSE CAST(c_nationkey AS STRING) END")
    )
    return _applied(
        t["customer"],
        "c_custkey",
        number_code=fx.falsy_number(number),
        text_code=fx.falsy_text(text),
        json_code=fx.falsy_variant(json),
    )


# --- text -----------------------------------------------------------------------------------

_DOTTED = "CASE p_partkey % 4 WHEN 0 THEN p_name WHEN 1 THEN NULL ELSE p_partkey || '. ' || p_name || '.x' END"


@query(
    "name_split_second",
    "SELECT p_partkey, CASE WHEN p_partkey % 4 > 1 THEN p_name END AS name FROM part",
)
def name_split_second(t: Tables) -> DataFrame:
    return _applied(t["part"], "p_partkey", name=fx.name_split_second(F.expr(_DOTTED)))


@query(
    "name_strip_prefix",
    "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_name WHEN 1 THEN NULL "
    "ELSE p_name || '.x' END AS name FROM part",
)
def name_strip_prefix(t: Tables) -> DataFrame:
    return _applied(t["part"], "p_partkey", name=fx.name_strip_prefix(F.expr(_DOTTED)))


@query("strip_ws", "SELECT p_partkey, p_name AS name FROM part")
def strip_ws(t: Tables) -> DataFrame:
    padded = F.concat(F.lit(WHITESPACE), F.col("p_name"), F.lit("\t\r\n　 "))
    return _applied(t["part"], "p_partkey", name=fx.strip_ws(padded))


@query(
    "zfill5",
    """
    SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN NULL
        WHEN c_custkey % 10 = 1 THEN '1234' || (1000 + c_custkey)
        WHEN c_custkey < 10000 THEN lpad(CAST(c_custkey AS VARCHAR), 5, '0')
        ELSE CAST(c_custkey AS VARCHAR) END AS ars_id
    FROM customer
    """,
)
def zfill5(t: Tables) -> DataFrame:
    text = F.expr(
        "CASE c_custkey % 10 WHEN 0 THEN NULL WHEN 1 THEN '1234' || (1000 + c_custkey) "
        "ELSE CAST(c_custkey AS STRING) END"
    )
    return _applied(t["customer"], "c_custkey", ars_id=fx.zfill(text, 5))


@query(
    "composite_id",
    "SELECT c_custkey, CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END || ' - ' || c_name AS source_id "
    "FROM customer",
)
def composite_id(t: Tables) -> DataFrame:
    line = F.expr("CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END")
    return _applied(t["customer"], "c_custkey", source_id=fx.composite_id(line, F.col("c_name")))


@query(
    "surrogate_key",
    f"""
    SELECT c_custkey, {md5_key_sql("city", "c_mktsegment", "nation")} AS surrogate_key
    FROM (SELECT c_custkey, '{CITY}' AS city, c_mktsegment,
              CASE WHEN c_nationkey % 3 <> 0 THEN c_nationkey END AS nation FROM customer) c
    """,
)
def surrogate_key(t: Tables) -> DataFrame:
    nation = F.expr("CASE WHEN c_nationkey % 3 <> 0 THEN c_nationkey END")
    key = fx.surrogate_key(F.lit(CITY), F.col("c_mktsegment"), nation)
    return _applied(t["customer"], "c_custkey", surrogate_key=key)


# --- payloads -------------------------------------------------------------------------------


@query(
    "rows_to_json",
    """
    SELECT c_custkey, CAST(to_json({'c_name': c_name, 'c_nationkey': c_nationkey,
        'segment': CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END}) AS VARCHAR) AS json
    FROM customer
    """,
)
def rows_to_json(t: Tables) -> DataFrame:
    segment = F.expr("CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END").alias("segment")
    json = fx.rows_to_json(F.col("c_name"), F.col("c_nationkey"), segment)
    return _applied(t["customer"], "c_custkey", json=json)


@query(
    "xml_total_count",
    f"""
    SELECT CAST(floor(event_id / {PAGE}.0) AS BIGINT) AS page,
        CASE WHEN floor(event_id / {PAGE}.0) % 5 <> 4 THEN CAST(count(*) AS INTEGER) END AS total_count
    FROM events GROUP BY 1, floor(event_id / {PAGE}.0)
    """,
)
def xml_total_count(t: Tables) -> DataFrame:
    """Pages of events as XML; every fifth page lacks its total."""
    paged = pages(t["events"], "event_id", "event_type")
    whole = F.to_xml(F.struct("list_total_count", "row"))
    bare = F.to_xml(F.struct("row"))
    document = F.when(F.col("page") % 5 != 4, whole).otherwise(bare)
    return _applied(paged, "page", total_count=fx.xml_total_count(document))
