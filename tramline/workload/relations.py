"""Projections, filters, joins, grouping and unions over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tramline import constants as const, functions as fx, plans
from tramline.operators import columns, filters, sets
from tramline.plans import dims
from tramline.sources.payloads import array_position_seq
from tramline.workload import standins as mock
from tramline.workload.registry import Tables, query

# --- projections ----------------------------------------------------------------------------


@query("project_columns", "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders")
def project_columns(t: Tables) -> DataFrame:
    return columns.project_columns(t["orders"], "o_orderkey", "o_orderdate", "o_totalprice")


@query("drop_strict", "SELECT event_id, ts, user_id, event_type FROM events")
def drop_strict(t: Tables) -> DataFrame:
    return columns.drop_strict(t["events"], ["value", "props"])


@query("drop_if_exists", "SELECT event_id, ts, user_id, event_type, value FROM events")
def drop_if_exists(t: Tables) -> DataFrame:
    return columns.drop_if_exists(t["events"], "props", "REG_DATE")


@query(
    "rename_positional",
    "SELECT s_suppkey AS station_id, s_name AS station_name, s_nationkey AS area, "
    "s_acctbal AS latitude FROM supplier",
)
def rename_positional(t: Tables) -> DataFrame:
    return columns.rename_positional(t["supplier"], ["station_id", "station_name", "area", "latitude"])


@query(
    "rename_map",
    "SELECT s_acctbal AS latitude, s_suppkey AS station_id, s_name AS station_name FROM supplier",
)
def rename_map(t: Tables) -> DataFrame:
    names = {"s_acctbal": "latitude", "s_suppkey": "station_id", "s_name": "station_name"}
    return columns.rename_map(t["supplier"], names)


@query(
    "audit_stamp",
    f"SELECT o_orderkey, {mock.RUN_STAMP_SQL} AS _updated_at, {mock.RUN_STAMP_SQL} AS _loaded_at FROM orders",
)
def audit_stamp(t: Tables) -> DataFrame:
    return columns.audit_stamp(t["orders"].select("o_orderkey"), mock.RUN)


@query(
    "literal_columns",
    f"SELECT s_suppkey, 'BIKE' AS station_type, CAST(NULL AS VARCHAR) AS address, "
    f"'{const.CITY}' AS city FROM supplier",
)
def literal_columns(t: Tables) -> DataFrame:
    constant = {"station_type": const.BIKE, "address": None, "city": const.CITY}
    return columns.literal_columns(t["supplier"].select("s_suppkey"), constant)


# --- filters --------------------------------------------------------------------------------


@query(
    "filter_not_null",
    f"SELECT * FROM ({mock.CLEAN_BUS_STOP_SQL}) l WHERE latitude IS NOT NULL AND longitude IS NOT NULL",
)
def filter_not_null(t: Tables) -> DataFrame:
    return filters.filter_not_null(mock.bus_stop_location(t), "latitude", "longitude")


@query(
    "filter_not_like",
    f"SELECT station_id, usage_date FROM ({mock.CLEAN_BIKE_SQL}) b WHERE 1 = 1 AND station_id NOT LIKE '0%'",
)
def filter_not_like(t: Tables) -> DataFrame:
    rows = mock.bike_usage(t).where(F.lit(1) == F.lit(1))
    return filters.filter_not_like(rows, "station_id", "0%").select("station_id", "usage_date")


_lines_sql = ", ".join(f"'{line}'" for line in const.SUBWAY_LINES)


@query(
    "filter_in_list",
    f"SELECT line, station, gt_off FROM ({mock.RAW_SUBWAY_SQL}) s WHERE line IN ({_lines_sql})",
)
def filter_in_list(t: Tables) -> DataFrame:
    rows = filters.filter_in_list(mock.subway_usage(t), "line", const.SUBWAY_LINES)
    return rows.select("line", "station", "gt_off")


@query(
    "require_fields",
    f"SELECT station_id, gender, distance FROM ({mock.CLEAN_BIKE_SQL}) b "
    "WHERE station_id IS NOT NULL AND gender IS NOT NULL AND distance IS NOT NULL",
)
def require_fields(t: Tables) -> DataFrame:
    fields = ["station_id", "gender", "distance"]
    return filters.require_fields(mock.bike_usage(t), *fields).select(*fields)


@query(
    "filter_hwm",
    "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate > "
    "(SELECT max(o_orderdate) FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01 00:00:00')",
)
def filter_hwm(t: Tables) -> DataFrame:
    """Orders newer than the newest one of an earlier load."""
    orders = t["orders"].select("o_orderkey", "o_orderdate")
    earlier = orders.where("o_orderdate < TIMESTAMP_NTZ '1999-01-01 00:00:00'")
    mark = filters.high_water_mark(earlier, "o_orderdate")
    return filters.filter_hwm(orders, "o_orderdate", mark)


# --- joins ----------------------------------------------------------------------------------


@query(
    "join_distinct",
    f"""{mock.STAGING_CTES}
    SELECT DISTINCT u.station_id AS source_station_id, u.station_name, 'BIKE' AS station_type,
        l.address1 AS address, '{const.CITY}' AS city, l.latitude, l.longitude
    FROM bike u JOIN bike_loc l ON CAST(u.station_id AS BIGINT) = CAST(l.station_id AS BIGINT)""",
)
def join_distinct(t: Tables) -> DataFrame:
    usage, places = plans.src_bike_usage(mock.bike_usage(t)), mock.bike_location(t)
    return dims.bike_stations(usage, plans.src_bike_location(places))


@query(
    "join_distinct_right_name",
    f"""{mock.STAGING_CTES}
    SELECT DISTINCT u.node_id AS source_station_id, l.stop_name_kr AS station_name,
        'BUS' AS station_type, CAST(NULL AS VARCHAR) AS address, '{const.CITY}' AS city,
        l.latitude, l.longitude
    FROM bus u JOIN bus_loc l USING (node_id)""",
)
def join_distinct_right_name(t: Tables) -> DataFrame:
    usage, places = plans.src_bus_usage(mock.bus_usage(t)), mock.bus_stop_location(t)
    return dims.bus_stops(usage, plans.src_bus_stop_location(places))


@query(
    "join_computed_key",
    f"""{mock.STAGING_CTES}
    SELECT u.line || ' - ' || u.station AS source_station_id, u.station AS station_name,
        'SUBWAY' AS station_type, CAST(NULL AS VARCHAR) AS address, '{const.CITY}' AS city,
        l.latitude, l.longitude
    FROM (SELECT DISTINCT line, station FROM subway WHERE line IN ({_lines_sql})) u
    JOIN subway_loc l ON u.line = l.line_no || '{const.LINE_SUFFIX}' AND u.station = l.station_name""",
)
def join_computed_key(t: Tables) -> DataFrame:
    usage, places = plans.src_subway_usage(mock.subway_usage(t)), mock.subway_location(t)
    return dims.subway_stations(usage, plans.src_subway_location(places))


@query(
    "join_dim_date",
    """
    SELECT CAST(l_shipdate AS DATE) AS date_id, l_orderkey, l_linenumber FROM lineitem
    WHERE CAST(l_shipdate AS DATE) IN (SELECT CAST(o_orderdate AS DATE) FROM orders)
    """,
)
def join_dim_date(t: Tables) -> DataFrame:
    """Text dates of shipments against the days on which anything was ordered."""
    text = F.date_format("l_shipdate", "yyyy-MM-dd")
    usage = t["lineitem"].select(text.cast("date").alias("date_id"), "l_orderkey", "l_linenumber")
    dates = t["orders"].select(mock.day("o_orderdate").alias("date_id")).distinct()
    return plans.join_dim_date(usage, t.kept("dim_date", dates))


@query(
    "join_dim_station",
    f"""
    SELECT o_orderkey, {mock.md5_key_sql("CAST(c_custkey AS VARCHAR)", "name")} AS station_id
    FROM orders JOIN (
        SELECT c_custkey, c_name AS name FROM customer
        UNION ALL SELECT c_custkey, c_name || ' (old)' FROM customer WHERE c_nationkey = 3) s
    ON o_custkey = c_custkey
    """,
)
def join_dim_station(t: Tables) -> DataFrame:
    """Stops of one nation have two dimension rows, so their usage rows double."""
    stops = t["customer"].select(
        F.col("c_custkey").cast("string").alias("source_station_id"),
        F.explode(
            F.expr("CASE WHEN c_nationkey = 3 THEN array(c_name, c_name || ' (old)') ELSE array(c_name) END")
        ).alias("station_name"),
        F.lit(const.BUS).alias("station_type"),
    )
    key = fx.surrogate_key(F.col("source_station_id"), F.col("station_name"))
    usage = t["orders"].select(
        "o_orderkey", F.col("o_custkey").cast("string").alias("source_station_id")
    )
    return plans.join_dim_station(usage, stops.withColumn("station_id", key), const.BUS)


@query(
    "join_dim_user",
    f"""
    SELECT event_id, {mock.md5_key_sql("gender", "age_group")} AS user_id, gender, age_group
    FROM (SELECT event_id, CASE user_id % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' END AS gender,
              CAST(user_id % 7 * 10 AS VARCHAR) AS age_group FROM events) e
    WHERE gender IS NOT NULL
    """,
)
def join_dim_user(t: Tables) -> DataFrame:
    """The segment without a gender is a dimension row that no usage row can match."""
    usage = t["events"].select(
        "event_id",
        F.expr("CASE user_id % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' END").alias("gender"),
        F.expr("CAST(user_id % 7 * 10 AS STRING)").alias("age_group"),
    )
    return plans.join_dim_user(usage, t.kept("dim_user", plans.dim_user(usage)))


# --- grouping, unions, order ----------------------------------------------------------------


@query("distinct_pairs", "SELECT DISTINCT l_returnflag, l_suppkey FROM lineitem")
def distinct_pairs(t: Tables) -> DataFrame:
    return sets.distinct_pairs(t["lineitem"], "l_returnflag", "l_suppkey")


@query("group_ordinals", "SELECT l_linestatus, l_partkey FROM lineitem GROUP BY 1, 2")
def group_ordinals(t: Tables) -> DataFrame:
    return sets.group_ordinals(t["lineitem"], "l_linestatus", "l_partkey")


@query(
    "union_distinct",
    """
    SELECT CAST(ts AS DATE) AS usage_date FROM events UNION SELECT CAST(o_orderdate AS DATE) FROM orders
    UNION SELECT CAST(l_shipdate AS DATE) FROM lineitem
    """,
)
def union_distinct(t: Tables) -> DataFrame:
    dated = {"events": "ts", "orders": "o_orderdate", "lineitem": "l_shipdate"}
    return sets.union_distinct(
        *[t[name].select(mock.day(column).alias("usage_date")) for name, column in dated.items()]
    )


@query(
    "union_all_conformed",
    """
    SELECT CAST(c_custkey AS VARCHAR) AS source_id, c_name AS name, c_acctbal AS balance FROM customer
    UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_name, s_acctbal FROM supplier
    UNION ALL SELECT CAST(p_partkey AS VARCHAR), p_name, CAST(p_size AS DOUBLE) FROM part
    """,
)
def union_all_conformed(t: Tables) -> DataFrame:
    """Ids of different kinds and numbers of different types, in columns of one type."""
    frames = [
        t["customer"].select(F.col("c_custkey").alias("source_id"), F.col("c_name").alias("name"),
                             F.col("c_acctbal").alias("balance")),
        t["supplier"].select(F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"),
                             F.col("s_suppkey").alias("source_id")),
        t["part"].select(F.col("p_partkey").alias("source_id"), F.col("p_name").alias("name"),
                         F.col("p_size").alias("balance")),
    ]
    return sets.union_all_conformed(
        frames, {"source_id": "string", "name": "string", "balance": "double"}
    )


@query(
    "array_position_seq",
    f"""
    SELECT CAST(floor(event_id / {mock.PAGE}.0) AS BIGINT) AS page, CAST(event_id AS VARCHAR) AS event_id,
        event_type, CAST(row_number() OVER (
            PARTITION BY floor(event_id / {mock.PAGE}.0) ORDER BY events.event_id) AS INTEGER) AS seq_no
    FROM events
    """,
)
def array_positions(t: Tables) -> DataFrame:
    """Places of the records inside the JSON array of their page."""
    events = t["events"].withColumn("id", F.col("event_id").cast("string"))
    paged = mock.pages(events, "event_id", "id", "event_type")
    documents = paged.select("page", F.to_json("row").alias("payload"))
    shape = t["events"].select(F.lit("").alias("id"), F.lit("").alias("event_type")).schema
    rows = array_position_seq(documents, "payload", shape, ["page"])
    return rows.withColumnRenamed("id", "event_id")


@query("sample_head", "SELECT event_id, ts, event_type FROM events ORDER BY event_id LIMIT 5")
def sample_head(t: Tables) -> DataFrame:
    return sets.sample_head(t["events"].select("event_id", "ts", "event_type"), "event_id", n=5)


@query(
    "star_join",
    f"""{mock.STAR_CTES}
    SELECT b.usage_date AS date_id, s.station_id, u.user_id, b.usage_time, b.usage_count, b.distance
    FROM bike b JOIN dates d ON d.date_id = b.usage_date
    JOIN stations s ON s.station_type = 'BIKE'
        AND TRY_CAST(s.source_station_id AS BIGINT) = CAST(b.station_id AS BIGINT)
    JOIN users u ON u.gender = b.gender AND u.age_group = b.age_group""",
)
def star_join(t: Tables) -> DataFrame:
    bike = plans.src_bike_usage(mock.bike_usage(t))
    dates = bike.select(F.col("usage_date").alias("date_id")).distinct()
    stations = dims.bike_stations(bike, plans.src_bike_location(mock.bike_location(t)))
    key = fx.surrogate_key(F.col("source_station_id"), F.col("station_name"))
    joined = plans.star_join(
        bike,
        t.kept("dim_date", dates),
        t.kept("dim_station", stations.withColumn("station_id", key)),
        t.kept("dim_user", plans.dim_user(bike)),
    )
    return joined.select("date_id", "station_id", "user_id", "usage_time", "usage_count", "distance")
