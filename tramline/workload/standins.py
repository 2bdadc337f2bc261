"""Transport data made from the driver's tables, as DataFrames and as SQL.

bike usage     events      (user_id as station)      bike stations    supplier
bus usage      orders      (o_custkey as stop)       bus stops        customer
subway usage   lineitem    (l_suppkey as station)    metro stations   supplier

``landed_*`` is the text an API would deliver, with the faults the cleaning rules are about;
``*_SQL`` is what cleaning must make of it. ``bike_usage`` and its like are loaded tables, from
which models are built. Every row of a driver table is used.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, functions as F

from tramline import constants as const
from tramline.workload.registry import Tables

RUN = datetime(2024, 2, 1)
RUN_STAMP_SQL = "TIMESTAMP '2024-01-31 00:00:00'"
CREATED = date(2024, 2, 1)
PAGE = 100


def md5_key_sql(*columns: str) -> str:
    parts = [f"coalesce(CAST({c} AS VARCHAR), '{const.KEY_NULL_MARKER}')" for c in columns]
    return f"md5(concat_ws('-', {', '.join(parts)}))"


def day(column: str) -> Column:
    return F.col(column).cast("date")


def _selected(rows: DataFrame, fields: dict[str, str]) -> DataFrame:
    return rows.select(*[F.expr(text).alias(name) for name, text in fields.items()])


def pages(rows: DataFrame, key: str, *fields: str) -> DataFrame:
    """Rows gathered into pages by a unique whole-number key, so a page has at most PAGE rows."""
    item = F.struct(key, *[f"`{field}`" for field in fields])
    grouped = rows.groupBy(F.floor(F.col(key) / PAGE).alias("page")).agg(
        F.sort_array(F.collect_list(item)).alias("items")
    )
    kept = F.transform("items", lambda row: F.struct(*[row[field].alias(field) for field in fields]))
    return grouped.select("page", F.size("items").alias("list_total_count"), kept.alias("row"))


def json_envelopes(paged: DataFrame, service: str) -> DataFrame:
    body = F.struct(F.struct("list_total_count", "row").alias(service))
    return paged.select("page", F.to_json(body).alias("payload"))


# --- bike usage: events -------------------------------------------------------------------


def landed_bike_usage(t: Tables, faults: bool = True) -> DataFrame:
    """Hourly rentals as text; ``faults=False`` keeps only faults the strict variants accept."""
    k = "get_json_object(props, '$.k')"
    station = "CAST(user_id AS STRING)"
    duration = "CAST(event_id % 60 AS STRING)"
    if faults:
        station = (
            f"CASE event_id % 50 WHEN 0 THEN 'x' WHEN 1 THEN '0' || user_id WHEN 2 THEN NULL "
            f"WHEN 3 THEN ' ' || user_id || ' ' ELSE {station} END"
        )
        duration = f"CASE WHEN event_id % 17 = 0 THEN '' ELSE {duration} END"
    fields = {
        "RENT_DT": "date_format(ts, 'yyyy-MM-dd')",
        "RENT_HR": "CAST(hour(ts) AS STRING)",
        "RENT_ID": station,
        "RENT_NM": "CASE WHEN event_id % 50 = 4 THEN 'nodot' "
        "ELSE user_id || '. Stop ' || user_id % 40 || '.A' END",
        "RENT_TYPE": "event_type",
        "GENDER_CD": "CASE user_id % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' END",
        "AGE_TYPE": "CAST(user_id % 7 * 10 AS STRING)",
        "USE_CNT": "CAST(1 + event_id % 5 AS STRING)",
        "EXER_AMT": f"CASE event_id % 11 WHEN 0 THEN 'x' WHEN 1 THEN NULL "
        f"WHEN 2 THEN '-' || {k} || '.7' ELSE {k} || '.25' END",
        "CARBON_AMT": "CAST(value AS STRING)",
        "MOVE_METER": "CASE WHEN event_id % 19 = 0 THEN NULL ELSE user_id || '.5' END",
        "MOVE_TIME": duration,
        "START_INDEX": "'1'",
        "END_INDEX": "'1000'",
        "RNUM": "CAST(event_id AS STRING)",
    }
    return _selected(t["events"], fields)


_K_SQL = "json_extract_string(props, '$.k')"
_BIKE_COMMON_SQL = f"""
    CAST(ts AS DATE) AS usage_date,
    CAST(hour(ts) AS INTEGER) AS usage_time,
    event_type AS rental_type_code,
    CASE user_id % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' END AS gender,
    CAST(user_id % 7 * 10 AS VARCHAR) AS age_group,
    CAST(1 + event_id % 5 AS INTEGER) AS usage_count,
    value AS carbon_emission,
    CASE WHEN event_id % 19 = 0 THEN NULL ELSE user_id + 0.5::DOUBLE END AS distance"""
_CALORIES_SQL = (
    f"CASE event_id % 11 WHEN 0 THEN NULL WHEN 1 THEN NULL "
    f"WHEN 2 THEN -(CAST({_K_SQL} || '.7' AS DOUBLE)) ELSE CAST({_K_SQL} || '.25' AS DOUBLE) END"
)
CLEAN_BIKE_SQL = f"""
SELECT {_BIKE_COMMON_SQL},
    CASE event_id % 50 WHEN 0 THEN NULL WHEN 2 THEN NULL WHEN 1 THEN '0' || user_id
        ELSE CAST(user_id AS VARCHAR) END AS station_id,
    CASE WHEN event_id % 50 = 4 THEN NULL ELSE 'Stop ' || user_id % 40 END AS station_name,
    {_CALORIES_SQL} AS calories,
    CASE WHEN event_id % 17 = 0 THEN NULL ELSE CAST(event_id % 60 AS INTEGER) END AS duration
FROM events"""
STRICT_BIKE_SQL = f"""
SELECT {_BIKE_COMMON_SQL},
    {{station_id}} AS station_id,
    {{station_name}} AS station_name,
    CAST(coalesce(trunc({_CALORIES_SQL}), 0) AS INTEGER) AS calories,
    CAST(event_id % 60 AS INTEGER) AS duration
FROM events"""


def bike_usage(t: Tables) -> DataFrame:
    """The loaded table, each row stamped with its own day."""
    k = "get_json_object(props, '$.k')"
    fields = {
        "usage_date": "CAST(ts AS DATE)",
        "usage_time": "hour(ts)",
        "station_id": "CASE event_id % 50 WHEN 0 THEN NULL WHEN 2 THEN NULL WHEN 1 THEN '0' || user_id "
        "ELSE CAST(user_id AS STRING) END",
        "station_name": "CASE WHEN event_id % 50 <> 4 THEN 'Stop ' || user_id % 40 END",
        "rental_type_code": "event_type",
        "gender": "CASE user_id % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' END",
        "age_group": "CAST(user_id % 7 * 10 AS STRING)",
        "usage_count": "CAST(1 + event_id % 5 AS INT)",
        "calories": f"CASE event_id % 11 WHEN 0 THEN NULL WHEN 1 THEN NULL "
        f"WHEN 2 THEN CAST('-' || {k} || '.7' AS DOUBLE) ELSE CAST({k} || '.25' AS DOUBLE) END",
        "carbon_emission": "value",
        "distance": "CASE WHEN event_id % 19 <> 0 THEN user_id + 0.5D END",
        "duration": "CASE WHEN event_id % 17 <> 0 THEN CAST(event_id % 60 AS INT) END",
        "_loaded_at": "CAST(CAST(ts AS DATE) AS TIMESTAMP)",
    }
    return _selected(t["events"], fields)


# --- bus usage: orders --------------------------------------------------------------------


def landed_bus_usage(t: Tables) -> DataFrame:
    fields = {
        "o_orderkey": "o_orderkey",
        "USE_YMD": "date_format(o_orderdate, 'yyyyMMdd')",
        "RTE_ID": "o_orderstatus",
        "RTE_NO": "o_orderpriority",
        "RTE_NM": "o_orderpriority || ' line'",
        "STOPS_ID": "CAST(o_custkey AS STRING)",
        "STOPS_ARS_NO": "CAST(o_custkey AS STRING)",
        "SBWY_STNS_NM": "'Stop <' || o_custkey || '>'",
        "GTON_TNOPE": "CAST(o_orderkey % 200 AS STRING)",
        "GTOFF_TNOPE": "CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(o_orderkey % 150 AS STRING) END",
        "REG_YMD": "date_format(o_orderdate, 'yyyyMMdd')",
    }
    return _selected(t["orders"], fields)


CLEAN_BUS_SQL = """
SELECT CAST(o_orderdate AS DATE) AS usage_date,
    o_orderpriority AS route_number,
    o_orderpriority || ' line' AS route_name,
    CAST(o_custkey AS VARCHAR) AS node_id,
    CAST(o_custkey AS VARCHAR) AS ars_id,
    'Stop <' || o_custkey || '>' AS station_name,
    CAST(o_orderkey % 200 AS INTEGER) AS boarding_count,
    CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(o_orderkey % 150 AS INTEGER) END AS getoff_count
FROM orders"""


def bus_usage(t: Tables) -> DataFrame:
    """The loaded table, each row stamped with its own day."""
    fields = {
        "usage_date": "CAST(o_orderdate AS DATE)",
        "route_number": "o_orderpriority",
        "route_name": "o_orderpriority || ' line'",
        "node_id": "CAST(o_custkey AS STRING)",
        "ars_id": "CAST(o_custkey AS STRING)",
        "station_name": "'Stop <' || o_custkey || '>'",
        "boarding_count": "CAST(o_orderkey % 200 AS INT)",
        "getoff_count": "CASE WHEN o_orderkey % 9 <> 0 THEN CAST(o_orderkey % 150 AS INT) END",
        "_loaded_at": "CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP)",
    }
    return _selected(t["orders"], fields)


# --- subway usage: lineitem ---------------------------------------------------------------


_SUBWAY_FIELDS = {
    "USE_YMD": "CASE WHEN l_orderkey % 41 = 0 THEN NULL "
    "WHEN l_orderkey % 2 = 0 THEN date_format(l_shipdate, 'yyyyMMdd') "
    "ELSE date_format(l_shipdate, 'yyyy-MM-dd') END",
    "LINE": f"(1 + l_suppkey % 9) || '{const.LINE_SUFFIX}'",
    "STATION": "CASE WHEN l_orderkey % 31 = 0 THEN NULL ELSE 'S' || l_suppkey END",
    "GT_ON": "CASE WHEN l_orderkey % 23 = 0 THEN NULL ELSE CAST(l_quantity AS INT) END",
    "GT_OFF": "l_linenumber",
}


def landed_subway_usage(t: Tables) -> DataFrame:
    """As collected, with the registration date the clean step drops."""
    fields = {**_SUBWAY_FIELDS, "REG_DATE": "date_format(l_shipdate, 'yyyyMMdd')"}
    return _selected(t["lineitem"], fields)


RAW_SUBWAY_SQL = f"""
SELECT CASE WHEN l_orderkey % 41 = 0 THEN NULL
        WHEN l_orderkey % 2 = 0 THEN strftime(l_shipdate, '%Y%m%d')
        ELSE strftime(l_shipdate, '%Y-%m-%d') END AS use_ymd,
    (1 + l_suppkey % 9) || '{const.LINE_SUFFIX}' AS line,
    CASE WHEN l_orderkey % 31 = 0 THEN NULL ELSE 'S' || l_suppkey END AS station,
    CASE WHEN l_orderkey % 23 = 0 THEN NULL ELSE CAST(l_quantity AS INTEGER) END AS gt_on,
    l_linenumber AS gt_off,
    l_shipdate AS _loaded_at
FROM lineitem"""


def subway_usage(t: Tables) -> DataFrame:
    """The loaded table, each row stamped with its own day."""
    fields = [F.expr(text).alias(name.lower()) for name, text in _SUBWAY_FIELDS.items()]
    return t["lineitem"].select(*fields, F.col("l_shipdate").cast("timestamp").alias("_loaded_at"))


# --- places -------------------------------------------------------------------------------


def landed_bike_station(t: Tables) -> DataFrame:
    fields = {
        "RENT_NO": "CAST(s_suppkey AS STRING)",
        "STA_ADD1": "s_name",
        "STA_ADD2": "CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE s_name || ' gate' END",
        "STA_LAT": "CASE WHEN s_suppkey % 10 = 0 THEN '0.0' ELSE CAST(s_acctbal AS STRING) END",
        "STA_LONG": "CASE WHEN s_suppkey % 10 = 1 THEN '0' ELSE s_nationkey || '.25' END",
    }
    return _selected(t["supplier"], fields)


CLEAN_BIKE_STATION_SQL = """
SELECT CAST(s_suppkey AS VARCHAR) AS station_id,
    s_name AS address1,
    CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE s_name || ' gate' END AS address2,
    CASE WHEN s_suppkey % 10 = 0 THEN NULL ELSE nullif(s_acctbal, 0.0::DOUBLE) END AS latitude,
    CASE WHEN s_suppkey % 10 = 1 THEN NULL ELSE s_nationkey + 0.25::DOUBLE END AS longitude
FROM supplier"""


def bike_location(t: Tables) -> DataFrame:
    """The loaded table."""
    fields = {
        "station_id": "CAST(s_suppkey AS STRING)",
        "address1": "s_name",
        "address2": "CASE WHEN s_suppkey % 4 <> 0 THEN s_name || ' gate' END",
        "latitude": "CASE WHEN s_suppkey % 10 <> 0 THEN nullif(s_acctbal, 0.0D) END",
        "longitude": "CASE WHEN s_suppkey % 10 <> 1 THEN s_nationkey + 0.25D END",
    }
    return _selected(t["supplier"], fields)


def landed_bus_stop(t: Tables) -> DataFrame:
    fields = {
        "NODE_ID": "CAST(c_custkey AS STRING)",
        "STOPS_NO": "CASE c_custkey % 20 WHEN 0 THEN NULL WHEN 1 THEN '12' || (100000 + c_custkey) "
        "ELSE CAST(c_custkey AS STRING) END",
        "STOPS_NM": "'Stop ' || c_custkey % 500",
        "YCRD": "CASE WHEN c_custkey % 10 = 0 THEN '0.0' ELSE CAST(c_acctbal AS STRING) END",
        "XCRD": "CASE WHEN c_custkey % 10 = 1 THEN '0' ELSE c_nationkey || '.25' END",
        "STOPS_TYPE": "c_mktsegment",
    }
    return _selected(t["customer"], fields)


CLEAN_BUS_STOP_SQL = """
SELECT CAST(c_custkey AS VARCHAR) AS node_id,
    CASE c_custkey % 20 WHEN 0 THEN NULL WHEN 1 THEN '12' || (100000 + c_custkey)
        ELSE CASE WHEN c_custkey < 10000 THEN lpad(CAST(c_custkey AS VARCHAR), 5, '0')
             ELSE CAST(c_custkey AS VARCHAR) END END AS ars_id,
    'Stop ' || c_custkey % 500 AS stop_name_kr,
    CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE nullif(c_acctbal, 0.0::DOUBLE) END AS latitude,
    CASE WHEN c_custkey % 10 = 1 THEN NULL ELSE c_nationkey + 0.25::DOUBLE END AS longitude,
    c_mktsegment AS stop_type
FROM customer"""


def bus_stop_location(t: Tables) -> DataFrame:
    """The loaded table."""
    fields = {
        "node_id": "CAST(c_custkey AS STRING)",
        "ars_id": "CASE c_custkey % 20 WHEN 0 THEN NULL WHEN 1 THEN '12' || (100000 + c_custkey) "
        "ELSE CASE WHEN c_custkey < 10000 THEN lpad(CAST(c_custkey AS STRING), 5, '0') "
        "ELSE CAST(c_custkey AS STRING) END END",
        "stop_name_kr": "'Stop ' || c_custkey % 500",
        "latitude": "CASE WHEN c_custkey % 10 <> 0 THEN nullif(c_acctbal, 0.0D) END",
        "longitude": "CASE WHEN c_custkey % 10 <> 1 THEN c_nationkey + 0.25D END",
        "stop_type": "c_mktsegment",
    }
    return _selected(t["customer"], fields)


def landed_metro_pages(t: Tables) -> DataFrame:
    """Arrays of station records; a record of which one field is missing keeps its place."""
    records = t["supplier"].select(
        "s_suppkey",
        F.expr("'S' || s_suppkey").alias("역명"),
        F.expr("CASE WHEN s_suppkey % 7 <> 3 THEN s_acctbal END").alias("위도"),
        F.expr("s_nationkey + 0.25D").alias("경도"),
        F.expr("CAST(1 + s_suppkey % 9 AS STRING)").alias("호선"),
        F.col("s_nationkey").alias("고유역번호(외부역코드)"),
    )
    paged = pages(records, "s_suppkey", *[name for name in records.columns if name != "s_suppkey"])
    return paged.select("page", F.to_json("row").alias("payload"))


CLEAN_METRO_SQL = f"""
SELECT 'S' || s_suppkey AS station_name,
    CASE WHEN s_nationkey = 0 THEN '-1' ELSE CAST(s_nationkey AS VARCHAR) END AS external_station_code,
    s_acctbal AS latitude,
    s_nationkey + 0.25::DOUBLE AS longitude,
    CAST(1 + s_suppkey % 9 AS VARCHAR) AS line_no,
    CAST(1 + s_suppkey % {PAGE} AS INTEGER) AS seq_no,
    DATE '{CREATED}' AS created_date
FROM supplier
WHERE s_suppkey % 7 <> 3"""


def subway_location(t: Tables) -> DataFrame:
    """The loaded table, with some stations that lack a coordinate."""
    fields = {
        "station_name": "'S' || s_suppkey",
        "external_station_code": "CASE WHEN s_nationkey = 0 THEN '-1' ELSE CAST(s_nationkey AS STRING) END",
        "latitude": "CASE WHEN s_suppkey % 7 <> 3 THEN s_acctbal END",
        "longitude": "s_nationkey + 0.25D",
        "line_no": "CAST(1 + s_suppkey % 9 AS STRING)",
        "created_date": f"DATE '{CREATED}'",
    }
    return _selected(t["supplier"], fields)


# --- staging and dimensions as SQL --------------------------------------------------------

SRC_BIKE_SQL = f"""
SELECT usage_date, usage_time, station_id, station_name, rental_type_code, gender, age_group,
    usage_count, calories, carbon_emission, distance, duration,
    CAST(usage_date AS TIMESTAMP) AS _loaded_at
FROM ({CLEAN_BIKE_SQL}) b WHERE station_id NOT LIKE '0%'"""
SRC_BIKE_LOCATION_SQL = f"""
SELECT * FROM ({CLEAN_BIKE_STATION_SQL}) l WHERE latitude IS NOT NULL AND longitude IS NOT NULL"""
SRC_BUS_SQL = f"""
SELECT *, CAST(usage_date AS TIMESTAMP) AS _loaded_at FROM ({CLEAN_BUS_SQL}) b"""
SRC_BUS_STOP_SQL = f"""
SELECT * FROM ({CLEAN_BUS_STOP_SQL}) l WHERE latitude IS NOT NULL AND longitude IS NOT NULL"""
SRC_SUBWAY_SQL = f"""
SELECT CASE WHEN length(use_ymd) = 8 AND try_strptime(use_ymd, '%Y%m%d') IS NOT NULL
        THEN strftime(strptime(use_ymd, '%Y%m%d'), '%Y-%m-%d') ELSE use_ymd END AS usage_date,
    line, station, line || ' - ' || station AS source_station_id, gt_on, gt_off, _loaded_at
FROM ({RAW_SUBWAY_SQL}) s WHERE use_ymd IS NOT NULL"""
SRC_SUBWAY_LOCATION_SQL = f"""
SELECT line_no, external_station_code, station_name, latitude, longitude,
    created_date AS _loaded_at
FROM ({CLEAN_METRO_SQL}) l"""

STAGING_CTES = f"""
WITH bike AS ({SRC_BIKE_SQL}),
bike_loc AS ({SRC_BIKE_LOCATION_SQL}),
bus AS ({SRC_BUS_SQL}),
bus_loc AS ({SRC_BUS_STOP_SQL}),
subway AS ({SRC_SUBWAY_SQL}),
subway_loc AS ({SRC_SUBWAY_LOCATION_SQL})"""

_weekday_sql = " ".join(f"WHEN {n} THEN '{name}'" for n, name in enumerate(const.WEEKDAYS_KR))
WEEKDAY_SQL = f"CASE dayofweek({{day}}) {_weekday_sql} END"
DIM_DATE_SQL = f"""
SELECT d AS date_id,
    CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
    CAST(day(d) AS INTEGER) AS day_of_month, {WEEKDAY_SQL.format(day="d")} AS day_of_week_kr,
    dayofweek(d) IN (0, 6) AS is_weekend, CAST(quarter(d) AS INTEGER) AS quarter,
    strftime(d, '%Y-%m') AS year_month
FROM (SELECT d FROM (
        SELECT usage_date AS d FROM bike GROUP BY ALL
        UNION ALL SELECT usage_date FROM bus GROUP BY ALL
        UNION ALL SELECT CAST(usage_date AS DATE) FROM subway GROUP BY ALL) seen
    GROUP BY d) days"""
DIM_USER_SQL = f"""
SELECT {md5_key_sql("gender", "age_group")} AS user_id, gender, age_group
FROM (SELECT gender, age_group FROM bike GROUP BY ALL) segments"""
_lines_sql = ", ".join(f"'{line}'" for line in const.SUBWAY_LINES)
# Each side is first reduced to its distinct keys; then places meet the keys that were used.
DIM_STATION_SQL = f"""
SELECT {md5_key_sql("source_station_id", "station_name")} AS station_id, source_station_id, station_name,
    station_type, address, '{const.CITY}' AS city, latitude, longitude
FROM (
    WITH rented AS (SELECT station_id, station_name, TRY_CAST(station_id AS BIGINT) AS number FROM bike GROUP BY ALL),
    docks AS (SELECT TRY_CAST(station_id AS BIGINT) AS number, address1, latitude, longitude FROM bike_loc GROUP BY ALL),
    stops AS (SELECT node_id, stop_name_kr, latitude, longitude FROM bus_loc GROUP BY ALL),
    platforms AS (SELECT line_no || '{const.LINE_SUFFIX}' AS line, station_name AS station, latitude, longitude FROM subway_loc)
    SELECT 'BIKE' AS station_type, station_id AS source_station_id, station_name, address1 AS address, latitude, longitude
    FROM docks JOIN rented USING (number)
    UNION ALL BY NAME
    SELECT 'BUS' AS station_type, node_id AS source_station_id, stop_name_kr AS station_name, latitude, longitude
    FROM stops WHERE node_id IN (SELECT node_id FROM bus)
    UNION ALL BY NAME
    SELECT 'SUBWAY' AS station_type, line || ' - ' || station AS source_station_id, station AS station_name, latitude, longitude
    FROM platforms SEMI JOIN subway USING (line, station) WHERE line IN ({_lines_sql})
) s"""
STAR_CTES = f"""{STAGING_CTES},
dates AS ({DIM_DATE_SQL}),
users AS ({DIM_USER_SQL}),
stations AS ({DIM_STATION_SQL})"""
