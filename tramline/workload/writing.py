"""Table-write protocols: each query writes a fresh table, reads it back and returns it."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from tramline import sinks
from tramline.plans import Warehouse, clean_bus_usage
from tramline.schemas import RAW_BUS_USAGE
from tramline.sinks import align_by_name
from tramline.sources import landing_audit
from tramline.workload import standins as mock
from tramline.workload.reading import ORDER_ROW, ORDER_ROWS_SQL, event_days, order_rows
from tramline.workload.registry import Tables, query

# --- files ----------------------------------------------------------------------------------


@query("write_json", ORDER_ROWS_SQL)
def write_json(t: Tables) -> DataFrame:
    """Written twice; the second write replaces the first."""
    path = t.scratch("json")
    sinks.write_json(t["region"], path)
    sinks.write_json(order_rows(t), path)
    return t.spark.read.schema(ORDER_ROW).json(path)


@query("write_parquet", "SELECT event_id, value, CAST(ts AS DATE) AS usage_date FROM events")
def write_parquet(t: Tables) -> DataFrame:
    path = t.scratch("parquet")
    sinks.write_parquet(event_days(t, "event_id", "value"), path, ["usage_date"], gather=True)
    return t.spark.read.parquet(path)


@query("write_parquet_chunked", "SELECT * FROM orders")
def write_parquet_chunked(t: Tables) -> DataFrame:
    path = t.scratch("chunked")
    sinks.write_parquet_chunked(t["orders"], path, max_rows=10_000)
    return t.spark.read.parquet(path)


# --- conforming a batch ---------------------------------------------------------------------


def _order_table() -> StructType:
    return StructType.fromDDL("order_id bigint, order_date date, price double, note string")



@query(
    "align_by_name",
    """
    SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS order_date, o_totalprice AS price,
        CAST(NULL AS VARCHAR) AS note
    FROM orders
    """,
)
def align_rows_by_name(t: Tables) -> DataFrame:
    """Other case, other order, text for numbers, one column too many and one too few."""
    batch = t["orders"].select(
        F.col("o_totalprice").cast("string").alias("PRICE"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("Order_Date"),
        F.col("o_orderstatus").alias("EXTRA"),
        F.col("o_orderkey").cast("string").alias("ORDER_ID"),
    )
    return sinks.align_by_name(batch, _order_table())


def _faulty_orders(t: Tables, *more: Column) -> DataFrame:
    return t["orders"].select(
        *more,
        F.col("o_orderkey").alias("ORDER_ID"),
        F.expr("CASE WHEN o_orderkey % 17 = 0 THEN 'soon' ELSE date_format(o_orderdate, 'yyyy-MM-dd') END")
        .alias("ORDER_DATE"),
        F.expr(
            "CASE o_orderkey % 13 WHEN 0 THEN 'much' WHEN 1 THEN NULL ELSE CAST(o_totalprice AS STRING) END"
        ).alias("PRICE"),
    )


@query(
    "load_continue",
    """
    SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS order_date,
        CASE WHEN o_orderkey % 13 <> 1 THEN o_totalprice END AS price, CAST(NULL AS VARCHAR) AS note
    FROM orders WHERE o_orderkey % 13 <> 0 AND o_orderkey % 17 <> 0
    """,
)
def load_continue(t: Tables) -> DataFrame:
    """Rows with a value that does not fit are left out; a missing value fits."""
    return sinks.accepted(sinks.load_continue(_faulty_orders(t), _order_table()))


@query(
    "load_continue_rejects",
    """
    SELECT o_orderkey AS order_id,
        CASE WHEN o_orderkey % 17 <> 0 THEN 'price' WHEN o_orderkey % 13 <> 0 THEN 'order_date'
            ELSE 'order_date,price' END AS faults
    FROM orders WHERE o_orderkey % 13 = 0 OR o_orderkey % 17 = 0
    """,
)
def load_continue_rejects(t: Tables) -> DataFrame:
    """The rows the load left out, with the columns at fault."""
    out = sinks.rejected(sinks.load_continue(_faulty_orders(t), _order_table()))
    return out.select(
        F.get_json_object("_raw", "$.ORDER_ID").cast("bigint").alias("order_id"),
        F.array_join("_rejected_columns", ",").alias("faults"),
    )


@query(
    "load_continue_report",
    """
    WITH judged AS (
        SELECT o_orderkey, o_orderstatus, o_orderkey % 17 = 0 AS no_date, o_orderkey % 13 = 0 AS no_price FROM orders)
    SELECT o_orderstatus, CASE WHEN count(*) FILTER (no_date OR no_price) = 0 THEN 'loaded'
            WHEN count(*) FILTER (NOT no_date AND NOT no_price) > 0 THEN 'partially_loaded' ELSE 'load_failed' END AS status,
        count(*) AS rows_parsed, count(*) FILTER (NOT no_date AND NOT no_price) AS rows_loaded,
        CAST(sum(no_date::INT + no_price::INT) AS BIGINT) AS errors_seen,
        min_by(CASE WHEN no_date THEN 'order_date' ELSE 'price' END, o_orderkey) FILTER (no_date OR no_price) AS first_error_column,
        min(o_orderkey) FILTER (no_date OR no_price) AS first_error_key
    FROM judged GROUP BY o_orderstatus
    """,
)
def load_continue_report(t: Tables) -> DataFrame:
    """A report by landed file: one file a status, judged in one pass that also gives the rows."""
    path, place = t.scratch("landed"), t.scratch("judged")
    rows = _faulty_orders(t, F.col("o_orderstatus").alias("status"))
    files = rows.repartition("status").sortWithinPartitions("status", "ORDER_ID")
    files.write.partitionBy("status").json(path)
    landed = t.spark.read.schema("ORDER_ID bigint, ORDER_DATE string, PRICE string").json(f"{path}/*/*.json")
    # Lines of a file keep their order: by the block they are read from, then as they come.
    at = F.struct("_metadata.file_block_start", F.monotonically_increasing_id())
    marked = landed.withColumns({"file": F.col("_metadata.file_path"), "at": at})
    sinks.load_continue(marked, _order_table(), ["file", "at"]).write.parquet(place)
    report = sinks.load_report(t.spark.read.parquet(place))
    return report.select(
        F.regexp_extract("file", "/status=([^/]*)/", 1).alias("o_orderstatus"), "status", "rows_parsed", "rows_loaded",
        "errors_seen", "first_error_column", F.get_json_object("first_error_row", "$.ORDER_ID").cast("bigint").alias("first_error_key"),
    )


@query("schema_guard", "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders")
def schema_guard(t: Tables) -> DataFrame:
    """Same columns in another order pass, and come out in the table's order."""
    target = t["orders"].select("o_orderkey", "o_orderdate", "o_totalprice")
    batch = t["orders"].select("o_totalprice", "o_orderkey", "o_orderdate")
    return sinks.schema_guard(batch, target.schema)


# --- tables ---------------------------------------------------------------------------------

_REPLACED, _EMPTIED = date(2024, 1, 10), date(2024, 1, 20)


@query(
    "replace_by_date",
    f"""
    SELECT event_id, CASE WHEN CAST(ts AS DATE) = DATE '{_REPLACED}' THEN value * 2 ELSE value END AS value,
        CAST(ts AS DATE) AS usage_date
    FROM events WHERE CAST(ts AS DATE) <> DATE '{_EMPTIED}'
    """,
)
def replace_by_date(t: Tables) -> DataFrame:
    """One day replaced twice by the same batch, one day replaced by an empty batch."""
    path = t.scratch("replace")
    rows = event_days(t, "event_id", "value")
    sinks.write_parquet(rows, path, ["usage_date"], gather=True)
    batch = rows.where(F.col("usage_date") == F.lit(_REPLACED)).withColumn("value", F.col("value") * 2)
    sinks.replace_by_date(batch, path, _REPLACED)
    sinks.replace_by_date(batch, path, _REPLACED)
    sinks.replace_by_date(batch.where(F.lit(False)), path, _EMPTIED)
    return t.spark.read.parquet(path)


@query("full_refresh", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def full_refresh(t: Tables) -> DataFrame:
    path = t.scratch("refresh")
    rows = t["customer"].select("c_custkey", "c_name", "c_acctbal")
    sinks.full_refresh(rows.withColumn("c_acctbal", F.lit(0.0)), path)
    sinks.full_refresh(rows, path)
    return t.spark.read.parquet(path)


@query(
    "append_load",
    """
    SELECT o_orderkey, o_totalprice FROM orders
    UNION ALL SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01'
    """,
)
def append_load(t: Tables) -> DataFrame:
    """Rows loaded a second time are there twice."""
    path = t.scratch("append")
    orders = t["orders"].select("o_orderkey", "o_totalprice")
    recent = t["orders"].where("o_orderdate >= TIMESTAMP_NTZ '2000-01-01 00:00:00'")
    sinks.append_load(orders, path)
    sinks.append_load(recent.select("o_totalprice", "o_orderkey"), path)
    return t.spark.read.parquet(path)


_CUT = "2000-01-01 00:00:00"


@query(
    "incremental_append",
    f"""
    SELECT o_orderkey, CASE WHEN o_orderdate <= TIMESTAMP '{_CUT}' THEN o_totalprice
        ELSE o_totalprice + 1 END AS o_totalprice, o_orderdate AS _loaded_at
    FROM orders WHERE o_orderkey % 97 <> 0
    """,
)
def incremental_append(t: Tables) -> DataFrame:
    """The second batch repeats every earlier order with another price: all of those are late."""
    path = t.scratch("increment")
    stamped = t["orders"].select(
        "o_orderkey",
        "o_totalprice",
        F.when(F.col("o_orderkey") % 97 != 0, F.col("o_orderdate").cast("timestamp")).alias("_loaded_at"),
    )
    sinks.incremental_append(stamped.where(F.col("_loaded_at") <= F.lit(_CUT).cast("timestamp")), path)
    sinks.incremental_append(stamped.withColumn("o_totalprice", F.col("o_totalprice") + 1), path)
    return t.spark.read.parquet(path)


@query(
    "materialize",
    """
    SELECT kind, s_suppkey, s_acctbal FROM supplier,
        (SELECT unnest(['ephemeral', 'view', 'table', 'incremental']) AS kind) k
    """,
)
def materialize(t: Tables) -> DataFrame:
    """One model kept in each of the four ways and run twice."""
    model = t["supplier"].select(
        "s_suppkey", "s_acctbal", F.lit("2024-01-01").cast("timestamp").alias("_loaded_at")
    )
    kept = []
    for kind in ("ephemeral", "view", "table", "incremental"):
        path = t.scratch(kind)
        sinks.materialize(model, kind, f"model_{kind}", path)
        again = sinks.materialize(model, kind, f"model_{kind}", path)
        kept.append(again.select(F.lit(kind).alias("kind"), "s_suppkey", "s_acctbal"))
    first, *others = kept
    for rows in others:
        first = first.unionByName(rows)
    return first


# --- tables with commit records ----------------------------------------------------------------


def _broken_off(table: sinks.CommittedTable, rows: DataFrame, folder: str) -> None:
    """What a run leaves that stops before its commit: files, and nothing to find them by."""
    rows.write.partitionBy(folder).parquet(f"{table.path}/batch=broken")


@query(
    "replace_days_at_once",
    f"""
    SELECT event_id, CASE WHEN day(ts) % 3 = 0 THEN value * 2 ELSE value END AS value, CAST(ts AS DATE) AS usage_date
    FROM events WHERE CAST(ts AS DATE) <> DATE '{_EMPTIED}'
    """,
)
def replace_days_at_once(t: Tables) -> DataFrame:
    """Many days replaced and one emptied by one commit, twice; a run between them broke off."""
    rows = event_days(t, "event_id", "value")
    table = sinks.CommittedTable(t.spark, t.scratch("days"), rows.schema, "usage_date")
    table.append(rows, gather=True)
    batch = rows.where(f"dayofmonth(usage_date) % 3 = 0 AND usage_date <> DATE '{_EMPTIED}'").withColumn("value", F.col("value") * 2)
    days = [row.usage_date for row in batch.select("usage_date").distinct().collect()]
    table.replace_days(batch, [*days, _EMPTIED])
    _broken_off(table, rows.withColumn("value", F.lit(0.0)), "usage_date")
    table.replace_days(batch, [*days, _EMPTIED])
    return table.read()


@query(
    "incremental_append_committed",
    f"""
    SELECT o_orderkey, CASE WHEN o_orderdate <= TIMESTAMP '{_CUT}' THEN o_totalprice
        ELSE o_totalprice + 1 END AS o_totalprice, o_orderdate AS _loaded_at, CAST(o_orderkey % 7 AS INTEGER) AS slice
    FROM orders WHERE o_orderkey % 97 <> 0
    """,
)
def incremental_append_committed(t: Tables) -> DataFrame:
    """An increment that broke off loses nothing; the next one takes its mark from the record."""
    stamped = t["orders"].select(
        "o_orderkey",
        "o_totalprice",
        F.when(F.col("o_orderkey") % 97 != 0, F.col("o_orderdate").cast("timestamp")).alias("_loaded_at"),
        (F.col("o_orderkey") % 7).cast("int").alias("slice"),
    )
    table = sinks.CommittedTable(t.spark, t.scratch("increment"), stamped.schema, "slice")
    table.append_above_mark(stamped.where(F.col("_loaded_at") <= F.lit(_CUT).cast("timestamp")))
    _broken_off(table, stamped.where("slice < 3").withColumn("o_totalprice", F.lit(0.0)), "slice")
    for _ in range(2):
        table.append_above_mark(stamped.withColumn("o_totalprice", F.col("o_totalprice") + 1))
    return table.read()


@query("append_load_once", "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")
def append_load_once(t: Tables) -> DataFrame:
    """Landed files loaded three times, with more files before the last."""
    landing = t.scratch("landing")
    rows = t["orders"].select("o_orderkey", "o_totalprice", "o_orderstatus")
    table = sinks.CommittedTable(t.spark, t.scratch("once"), rows.schema)
    early = F.col("o_orderkey") % 5 != 0
    sinks.write_parquet_chunked(rows.where(early), f"{landing}/a", max_rows=5_000)
    for folder in (None, None, "b"):
        if folder:
            rows.where(~early).write.parquet(f"{landing}/{folder}")
        table.load_files(landing, lambda files: t.spark.read.parquet(*files), "part-*.parquet")
    return table.read()


@query(
    "ingest_bus_days_if_complete",
    """
    SELECT CAST(ts AS DATE) AS usage_date, event_type AS route_number, CAST(user_id AS VARCHAR) AS node_id,
        CAST(CASE WHEN day(ts) % 5 = 0 OR day(ts) % 7 = 0 THEN -1 ELSE event_id % 100 END AS INTEGER) AS boarding_count
    FROM events
    """,
)
def ingest_bus_days_if_complete(t: Tables) -> DataFrame:
    """XML pages of many days in one landing: days with a missing page or one that came twice keep what they had."""
    landing = t.scratch("bus-pages")
    day = F.dayofmonth("usage_date")
    rows = t["events"].select(
        mock.day("ts").alias("usage_date"), "event_id",
        F.struct(
            F.date_format("ts", "yyyyMMdd").alias("USE_YMD"), F.col("event_type").alias("RTE_NO"),
            F.col("user_id").cast("string").alias("STOPS_ID"), (F.col("event_id") % 100).cast("string").alias("GTON_TNOPE"),
        ).alias("item"),
    )
    numbered = rows.withColumn("page", F.expr("(row_number() OVER (PARTITION BY usage_date ORDER BY event_id) - 1) DIV 500"))
    totals = rows.groupBy("usage_date").agg(F.count("*").alias("total"))
    pages = numbered.groupBy("usage_date", "page").agg(F.collect_list("item").alias("row")).join(totals, "usage_date")
    body = F.struct(F.col("total").alias("list_total_count"), "row")
    text = pages.select("usage_date", "page", F.to_xml(body, {"rowTag": "CardBus"}).alias("value"))
    came = text.where(~((day % 5 == 0) & (F.col("page") == 0)))
    twice = text.where((day % 7 == 0) & (F.col("page") == 0)).withColumn("page", F.lit(-1).cast("bigint"))
    came.union(twice).repartition("usage_date", "page").write.partitionBy("usage_date", "page").text(landing)

    house = Warehouse(t.spark, t.scratch("house"))
    before = rows.select("item.*").withColumn("GTON_TNOPE", F.lit("-1"))
    missing = [F.lit(None).cast("string").alias(name) for name in RAW_BUS_USAGE.names if name not in before.columns]
    run = datetime(2024, 3, 1)
    base = align_by_name(clean_bus_usage(before.select("*", *missing).select(*RAW_BUS_USAGE.names), run), house.table("bus_usage").schema)
    house.table("bus_usage").append(base, gather=True)
    house.load_bus_days_if_complete(f"{landing}/*/*", run)
    return house.read("bus_usage").select("usage_date", "route_number", "node_id", "boarding_count")


_SHORT_DAY = "dayofmonth(usage_date) % 5 = 0 AND usage_time = 7"


@query(
    "ingest_day_if_complete",
    """
    SELECT event_id, CASE WHEN usage_date IN (SELECT CAST(ts AS DATE) FROM events
            WHERE day(ts) % 5 = 0 AND hour(ts) = 7) THEN value ELSE value + 1 END AS value, usage_date
    FROM (SELECT event_id, value, CAST(ts AS DATE) AS usage_date FROM events) e
    """,
)
def ingest_day_if_complete(t: Tables) -> DataFrame:
    """Days of which one hour came short keep their earlier rows; all others are replaced."""
    path = t.scratch("ingest")
    rows = event_days(t, "event_id", "value")
    sinks.write_parquet(rows, path, ["usage_date"], gather=True)
    keys = ["usage_date", "usage_time"]
    landed = event_days(t, F.hour("ts").alias("usage_time"))
    promised = landed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).withColumn(
        "list_total_count", F.expr(f"CASE WHEN {_SHORT_DAY} THEN n + 1 ELSE n END")
    )
    audit = landing_audit(landed, promised, promised.select(*keys), keys)
    sinks.ingest_days_if_complete(rows.withColumn("value", F.col("value") + 1), audit, path)
    return t.spark.read.parquet(path)
