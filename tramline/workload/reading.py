"""Scans, page plans, audits and date ranges. Files are written from a table, then read back."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tramline import schemas, sinks, sources
from tramline.constants import BIKE_USAGE_SERVICE
from tramline.workload import standins as mock
from tramline.workload.registry import Tables, query

ORDER_ROW = schemas.text_fields("o_orderkey", "o_orderstatus", "o_orderpriority")
ORDER_ROWS_SQL = """
    SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus,
        CASE WHEN o_orderkey % 8 <> 0 THEN o_orderpriority END AS o_orderpriority
    FROM orders"""


def order_rows(t: Tables) -> DataFrame:
    """Orders as text rows, some without a priority."""
    return t["orders"].select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        "o_orderstatus",
        F.expr("CASE WHEN o_orderkey % 8 <> 0 THEN o_orderpriority END").alias("o_orderpriority"),
    )


def event_days(t: Tables, *fields: str) -> DataFrame:
    return t["events"].select(mock.day("ts").alias("usage_date"), *fields)


@query("scan_json_rows", ORDER_ROWS_SQL)
def scan_json_rows(t: Tables) -> DataFrame:
    path = t.scratch("json")
    sinks.write_json(order_rows(t), path)
    return sources.scan_json_rows(t.spark, path, ORDER_ROW)


@query(
    "scan_hourly_json",
    """
    SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, CAST(hour(ts) AS INTEGER) AS usage_time
    FROM events WHERE hour(ts) <> 6
    """,
)
def scan_hourly_json(t: Tables) -> DataFrame:
    """Array files in a folder per hour; those of hour 6 are cut off and must be skipped whole."""
    path = t.scratch("hourly")
    hourly = t["events"].withColumn("usage_time", F.hour("ts"))
    item = F.struct(F.col("event_id").cast("string").alias("event_id"), "event_type")
    # A file holds the events of one hour within a range of ids, so its size is bounded.
    files = (
        hourly.groupBy("usage_time", F.floor(F.col("event_id") / 20_000))
        .agg(F.to_json(F.collect_list(item)).alias("array"))
    )
    cut = F.expr("CASE WHEN usage_time = 6 THEN left(array, length(array) - 1) ELSE array END")
    files.select("usage_time", cut.alias("value")).write.option("maxRecordsPerFile", 1).partitionBy(
        "usage_time"
    ).text(path)
    return sources.scan_hourly_json(t.spark, path, schemas.text_fields("event_id", "event_type"))


@query(
    "unwrap_json_envelope",
    "SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, CAST(value AS VARCHAR) AS value FROM events",
)
def unwrap_json_envelope(t: Tables) -> DataFrame:
    """Pages of events as API answers, and as many answers without the service key."""
    events = t["events"].select(
        F.col("event_id").alias("id"),
        F.col("event_id").cast("string").alias("event_id"),
        "event_type",
        F.col("value").cast("string").alias("value"),
    )
    paged = mock.pages(events, "id", "event_id", "event_type", "value")
    answers = mock.json_envelopes(paged, BIKE_USAGE_SERVICE).withColumn(
        "payload", F.explode(F.array("payload", F.lit('{"RESULT": {"CODE": "INFO-200"}}')))
    )
    row = schemas.text_fields("event_id", "event_type", "value")
    return sources.unwrap_json_envelope(answers, "payload", BIKE_USAGE_SERVICE, row)


@query("scan_xml_rows", ORDER_ROWS_SQL)
def scan_xml_rows(t: Tables) -> DataFrame:
    path = t.scratch("xml")
    order_rows(t).write.format("xml").option("rowTag", "row").save(path)
    return sources.scan_xml_rows(t.spark, path, ORDER_ROW)


@query(
    "scan_parquet_day",
    """
    SELECT CAST(ts AS DATE) AS usage_date, event_id, value FROM events
    WHERE CAST(ts AS DATE) = DATE '2024-01-05'
    """,
)
def scan_parquet_day(t: Tables) -> DataFrame:
    path = t.scratch("day")
    sinks.write_parquet(event_days(t, "event_id", "value"), path, ["usage_date"], gather=True)
    return sources.scan_parquet_day(t.spark, path, "usage_date", date(2024, 1, 5))


@query(
    "backfill_range",
    """
    SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
    WHERE o_orderdate BETWEEN TIMESTAMP '1997-05-01' AND TIMESTAMP '1998-05-31'
    """,
)
def backfill_range(t: Tables) -> DataFrame:
    orders = t["orders"].select("o_orderkey", "o_orderdate", "o_totalprice")
    return sources.backfill_range(orders, "o_orderdate", date(1997, 5, 1), date(1998, 5, 31))


_NARROW, _TEXT_DAY, _BROKEN_DAY = "dayofmonth(usage_date) % 3 = 0", date(2024, 1, 5), date(2024, 1, 9)


@query(
    "backfill_range_by_schema",
    f"""
    SELECT event_id, CAST(event_id % 1000 AS BIGINT) AS boardings, CAST(ts AS DATE) AS usage_date
    FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-03' AND DATE '2024-01-16'
        AND CAST(ts AS DATE) NOT IN (DATE '{_TEXT_DAY}', DATE '{_BROKEN_DAY}')
    """,
)
def backfill_range_by_schema(t: Tables) -> DataFrame:
    """Days of int and of bigint counts, one of text counts and one with a broken file."""
    path = t.scratch("range")
    rows = event_days(t, "event_id", (F.col("event_id") % 1000).alias("boardings"))
    kinds = {"int": _NARROW, "bigint": f"NOT {_NARROW}"}
    for kind, days in kinds.items():
        part = rows.where(F.expr(days) & (F.col("usage_date") != F.lit(_TEXT_DAY)))
        part.withColumn("boardings", F.col("boardings").cast(kind)).write.mode("append").partitionBy("usage_date").parquet(path)
    text = rows.where(F.col("usage_date") == F.lit(_TEXT_DAY)).withColumn("boardings", F.col("boardings").cast("string"))
    text.write.mode("append").partitionBy("usage_date").parquet(path)
    t["region"].limit(1).select("r_name").write.mode("append").text(f"{path}/usage_date={_BROKEN_DAY}")
    wanted = StructType([StructField("event_id", t["events"].schema["event_id"].dataType), StructField("boardings", LongType())])
    return sources.read_range(t.spark, path, "usage_date", date(2024, 1, 3), date(2024, 1, 16), wanted)[0]


@query(
    "previous_month",
    """
    SELECT o_orderkey, o_orderdate FROM orders
    WHERE o_orderdate >= TIMESTAMP '1997-12-01' AND o_orderdate < TIMESTAMP '1998-01-01'
    """,
)
def previous_month(t: Tables) -> DataFrame:
    """A January run reads December of the year before."""
    orders = t["orders"].select("o_orderkey", "o_orderdate")
    return sources.previous_month(orders, "o_orderdate", date(1998, 1, 10))


@query("full_scan_chunked", "SELECT * FROM lineitem")
def full_scan_chunked(t: Tables) -> DataFrame:
    path = t.scratch("chunks")
    sinks.write_parquet_chunked(t["lineitem"], path, max_rows=25_000)
    return sources.full_scan(t.spark, path)


@query("scan_glob", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def scan_glob(t: Tables) -> DataFrame:
    """Parquet parts next to JSON copies of the same rows; only the parts match."""
    path = t.scratch("glob")
    rows = t["customer"].select("c_custkey", "c_name", "c_acctbal")
    sinks.write_parquet_chunked(rows, path, max_rows=5_000)
    rows.write.mode("append").json(path)
    return sources.scan_glob(t.spark, path, "part-*.parquet")


@query(
    "register_sources",
    """
    SELECT n_name, c_mktsegment, count(*) AS orders FROM orders
    JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    GROUP BY n_name, c_mktsegment
    """,
)
def register_sources(t: Tables) -> DataFrame:
    """Three logical names, queried by SQL."""
    names = ["orders", "customer", "nation"]
    sources.register_sources(t.spark, {name: t.location(name) for name in names}, prefix="raw_")
    return t.spark.sql(
        """
        SELECT n_name, c_mktsegment, count(*) AS orders FROM raw_orders
        JOIN raw_customer ON o_custkey = c_custkey JOIN raw_nation ON c_nationkey = n_nationkey
        GROUP BY n_name, c_mktsegment
        """
    )


@query(
    "partitioned_layout",
    """
    SELECT event_id, value, strftime(ts, '%Y') AS yyyy, strftime(ts, '%m') AS mm, strftime(ts, '%d') AS dd
    FROM events
    """,
)
def partitioned_layout(t: Tables) -> DataFrame:
    """A folder per year, month and day, whose names come back as columns."""
    path = t.scratch("layout")
    rows = event_days(t, "event_id", "value")
    sinks.write_date_folders(rows, path, "usage_date")
    names = "event_id bigint, value double, yyyy string, mm string, dd string"
    return t.spark.read.schema(names).json(path)


@query(
    "page_plan",
    """
    SELECT usage_date, total, CAST(start_index AS BIGINT) AS start_index,
        CAST(least(start_index + 99, total) AS BIGINT) AS end_index
    FROM (SELECT usage_date, total, unnest(generate_series(1, total, 100)) AS start_index
          FROM (SELECT CAST(ts AS DATE) AS usage_date, count(*) AS total FROM events GROUP BY 1) d) p
    """,
)
def page_plan(t: Tables) -> DataFrame:
    totals = event_days(t).groupBy("usage_date").agg(F.count(F.lit(1)).alias("total"))
    return sources.page_plan(totals, page_rows=100)


_LANDED = "page % 4 <> 1 AND NOT (dayofmonth(usage_date) % 5 = 0) AND NOT (dayofmonth(usage_date) % 3 = 0 AND page = pages - 1)"


@query(
    "missing_pages",
    """
    WITH totals AS (SELECT CAST(ts AS DATE) AS usage_date, CAST(hour(ts) // 6 AS INTEGER) AS quarter, count(*) AS total
        FROM events GROUP BY 1, 2),
    numbers AS (SELECT usage_date, quarter, total, unnest(range(1, total + 1)) AS row FROM totals),
    pages AS (SELECT *, (row - 1) // 10 AS page, (total + 9) // 10 AS pages FROM numbers),
    missing AS (SELECT usage_date, quarter, row,
            row - row_number() OVER (PARTITION BY usage_date, quarter ORDER BY row) AS island
        FROM pages WHERE page % 4 = 1 OR day(usage_date) % 5 = 0 OR (day(usage_date) % 3 = 0 AND page = pages - 1))
    SELECT usage_date, quarter, min(row) AS start_index, max(row) AS end_index
    FROM missing GROUP BY usage_date, quarter, island
    """,
)
def missing_pages(t: Tables) -> DataFrame:
    """Every fourth page, the last pages of some days and all pages of others never came; some came twice."""
    keys = ["usage_date", "quarter"]
    seen = event_days(t, F.expr("CAST(hour(ts) DIV 6 AS INT)").alias("quarter"))
    totals = seen.groupBy(*keys).agg(F.count("*").alias("total"))
    pages = sources.page_plan(totals, page_rows=10).withColumns(
        {"page": F.expr("(start_index - 1) DIV 10"), "pages": F.expr("(total + 9) DIV 10")}
    )
    came = pages.where(_LANDED).select(*keys, "start_index", "end_index")
    # Asked for again from its middle on: overlaps, and the same range twice.
    again = came.where("start_index % 30 = 1").withColumn("start_index", F.expr("start_index + (end_index - start_index) DIV 2"))
    return sources.missing_pages(totals, came.union(again).union(again), keys)


_PROMISED = """CASE usage_time WHEN 7 THEN n + 3 WHEN 8 THEN n - 1 WHEN 9 THEN NULL ELSE n END"""


@query(
    "landing_audit",
    f"""
    WITH landed AS (SELECT CAST(ts AS DATE) AS usage_date, CAST(hour(ts) AS INTEGER) AS usage_time,
                        count(*) AS n FROM events GROUP BY 1, 2),
    grid AS (SELECT CAST(d AS DATE) AS usage_date, CAST(h AS INTEGER) AS usage_time
        FROM (SELECT unnest(generate_series(min(CAST(ts AS DATE)), max(CAST(ts AS DATE)) + 2,
                  INTERVAL 1 DAY)) AS d FROM events) days, (SELECT unnest(range(24)) AS h) hours),
    cells AS (SELECT usage_date, usage_time, CAST({_PROMISED} AS BIGINT) AS promised_rows,
            CAST(coalesce(n, 0) AS BIGINT) AS landed_rows
        FROM grid LEFT JOIN landed USING (usage_date, usage_time))
    SELECT *, CASE WHEN promised_rows IS NULL AND landed_rows = 0 THEN 'missing'
        WHEN promised_rows IS NULL THEN 'unpromised'
        WHEN promised_rows = 0 AND landed_rows = 0 THEN 'empty'
        WHEN landed_rows < promised_rows THEN 'short'
        WHEN landed_rows > promised_rows THEN 'excess' ELSE 'complete' END AS status
    FROM cells
    """,
)
def landing_audit(t: Tables) -> DataFrame:
    """Promises wrong for some hours, and two days after the last one that never arrived."""
    landed = event_days(t, F.hour("ts").alias("usage_time"))
    counts = landed.groupBy("usage_date", "usage_time").agg(F.count(F.lit(1)).alias("n"))
    promised = counts.withColumn("list_total_count", F.expr(_PROMISED))
    bounds = landed.agg(
        F.min("usage_date").alias("start"), F.date_add(F.max("usage_date"), 2).alias("end")
    )
    grid = sources.date_hour_spine(bounds)
    return sources.landing_audit(landed, promised, grid, ["usage_date", "usage_time"])
