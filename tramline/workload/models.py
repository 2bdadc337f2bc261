"""The cleaning jobs, staging models, dimensions and facts on the stand-in data."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, functions as F

from tramline import plans, schemas, sources
from tramline.constants import BIKE_STATION_SERVICE, BUS_STOP_SERVICE
from tramline.session import together
from tramline.workload import standins as mock
from tramline.workload.registry import Tables, query

# --- cleaning -------------------------------------------------------------------------------


@query(
    "clean_bike_usage",
    f"SELECT *, {mock.RUN_STAMP_SQL} AS _updated_at, {mock.RUN_STAMP_SQL} AS _loaded_at "
    f"FROM ({mock.CLEAN_BIKE_SQL}) b",
)
def clean_bike_usage(t: Tables) -> DataFrame:
    return plans.clean_bike_usage(mock.landed_bike_usage(t), mock.RUN)


@query(
    "clean_bike_usage_strict",
    mock.STRICT_BIKE_SQL.format(
        station_id="CAST(user_id AS VARCHAR)",
        station_name="CASE WHEN event_id % 50 = 4 THEN 'nodot' "
        "ELSE user_id || '. Stop ' || user_id % 40 || '.A' END",
    ),
)
def clean_bike_usage_strict(t: Tables) -> DataFrame:
    return plans.clean_bike_usage_strict(mock.landed_bike_usage(t, faults=False))


@query(
    "clean_bike_usage_bulk",
    mock.STRICT_BIKE_SQL.format(
        station_id="CAST(user_id AS INTEGER)",
        station_name="CASE WHEN event_id % 50 = 4 THEN 'nodot' ELSE 'Stop ' || user_id % 40 || '.A' END",
    ),
)
def clean_bike_usage_bulk(t: Tables) -> DataFrame:
    return plans.clean_bike_usage_bulk(mock.landed_bike_usage(t, faults=False))


@query("clean_bike_station", mock.CLEAN_BIKE_STATION_SQL)
def clean_bike_station(t: Tables) -> DataFrame:
    """From API answers, page by page."""
    landed = mock.landed_bike_station(t).withColumn("key", F.col("RENT_NO").cast("bigint"))
    names = schemas.RAW_BIKE_STATION.names
    answers = mock.json_envelopes(mock.pages(landed, "key", *names), BIKE_STATION_SERVICE)
    raw = sources.unwrap_json_envelope(
        answers, "payload", BIKE_STATION_SERVICE, schemas.RAW_BIKE_STATION
    )
    return plans.clean_bike_station(raw)


@query("clean_bus_stop", mock.CLEAN_BUS_STOP_SQL)
def clean_bus_stop(t: Tables) -> DataFrame:
    """From API answers, page by page."""
    landed = mock.landed_bus_stop(t).withColumn("key", F.col("NODE_ID").cast("bigint"))
    names = schemas.RAW_BUS_STOP.names
    answers = mock.json_envelopes(mock.pages(landed, "key", *names), BUS_STOP_SERVICE)
    raw = sources.unwrap_json_envelope(answers, "payload", BUS_STOP_SERVICE, schemas.RAW_BUS_STOP)
    return plans.clean_bus_stop(raw)


@query(
    "clean_bus_usage",
    f"SELECT *, {mock.RUN_STAMP_SQL} AS _updated_at, {mock.RUN_STAMP_SQL} AS _loaded_at "
    f"FROM ({mock.CLEAN_BUS_SQL}) b",
)
def clean_bus_usage(t: Tables) -> DataFrame:
    """From XML pages."""
    paged = mock.pages(mock.landed_bus_usage(t), "o_orderkey", *schemas.RAW_BUS_USAGE.names)
    documents = paged.select(F.to_xml(F.struct("list_total_count", "row")).alias("payload"))
    raw = sources.unwrap_xml(documents, "payload", schemas.RAW_BUS_USAGE)
    return plans.clean_bus_usage(raw, mock.RUN)


@query("clean_metro_station", mock.CLEAN_METRO_SQL)
def clean_metro_station(t: Tables) -> DataFrame:
    """From JSON arrays whose records are numbered before the incomplete ones go."""
    raw = sources.array_position_seq(
        mock.landed_metro_pages(t), "payload", schemas.RAW_METRO_STATION
    )
    return plans.clean_metro_station(raw, mock.CREATED)


@query(
    "clean_subway_usage",
    f"SELECT use_ymd AS USE_YMD, line AS LINE, station AS STATION, gt_on AS GT_ON, gt_off AS GT_OFF, "
    f"{mock.RUN_STAMP_SQL} AS _loaded_at FROM ({mock.RAW_SUBWAY_SQL}) s",
)
def clean_subway_usage(t: Tables) -> DataFrame:
    return plans.clean_subway_usage(mock.landed_subway_usage(t), mock.RUN)


# --- staging --------------------------------------------------------------------------------


def _staged(t: Tables) -> dict[str, DataFrame]:
    return {
        "bike": plans.src_bike_usage(mock.bike_usage(t)),
        "bike_locations": plans.src_bike_location(mock.bike_location(t)),
        "bus": plans.src_bus_usage(mock.bus_usage(t)),
        "bus_locations": plans.src_bus_stop_location(mock.bus_stop_location(t)),
        "subway": plans.src_subway_usage(mock.subway_usage(t)),
        "subway_locations": plans.src_subway_location(mock.subway_location(t)),
    }


@query("src_bike_usage", mock.SRC_BIKE_SQL)
def src_bike_usage(t: Tables) -> DataFrame:
    return _staged(t)["bike"]


@query("src_bike_location", mock.SRC_BIKE_LOCATION_SQL)
def src_bike_location(t: Tables) -> DataFrame:
    return _staged(t)["bike_locations"]


@query("src_bus_usage", mock.SRC_BUS_SQL)
def src_bus_usage(t: Tables) -> DataFrame:
    return _staged(t)["bus"]


@query("src_bus_stop_location", mock.SRC_BUS_STOP_SQL)
def src_bus_stop_location(t: Tables) -> DataFrame:
    return _staged(t)["bus_locations"]


@query("src_subway_usage", mock.SRC_SUBWAY_SQL)
def src_subway_usage(t: Tables) -> DataFrame:
    return _staged(t)["subway"]


@query("src_subway_location", mock.SRC_SUBWAY_LOCATION_SQL)
def src_subway_location(t: Tables) -> DataFrame:
    return _staged(t)["subway_locations"]


# --- dimensions -----------------------------------------------------------------------------


@query("dim_date", mock.STAGING_CTES + mock.DIM_DATE_SQL)
def dim_date(t: Tables) -> DataFrame:
    src = _staged(t)
    return plans.dim_date(src["bike"], src["bus"], src["subway"])


@query("dim_user", mock.STAGING_CTES + mock.DIM_USER_SQL)
def dim_user(t: Tables) -> DataFrame:
    return plans.dim_user(_staged(t)["bike"])


@query("dim_station", mock.STAGING_CTES + mock.DIM_STATION_SQL)
def dim_station(t: Tables) -> DataFrame:
    return plans.dim_station(**_staged(t))


def _from_keys(t: Tables, *names: str) -> list[DataFrame]:
    """Dimensions as tables, from one read of each usage table."""
    src = _staged(t)
    found = {kind: plans.usage_keys(kind, src[kind]) for kind in plans.USAGE_SETS}
    keys = together({kind: partial(t.kept, f"{kind}_keys", rows) for kind, rows in found.items()})
    made = plans.dimensions(keys, {name: rows for name, rows in src.items() if name.endswith("_locations")})
    return list(together({name: partial(t.kept, name, made[name]) for name in names}).values())


@query("dim_date_from_keys", mock.STAGING_CTES + mock.DIM_DATE_SQL)
def dim_date_from_keys(t: Tables) -> DataFrame:
    """The days of all usage, from the pass that also finds its segments and stations."""
    return _from_keys(t, "dim_date")[0]


@query("dim_station_from_keys", mock.STAGING_CTES + mock.DIM_STATION_SQL)
def dim_station_from_keys(t: Tables) -> DataFrame:
    """The stations, from the pass that also finds days and segments."""
    return _from_keys(t, "dim_station")[0]


@query("dim_user_from_keys", mock.STAGING_CTES + mock.DIM_USER_SQL)
def dim_user_from_keys(t: Tables) -> DataFrame:
    """The segments, null ones included, although other lists leave those columns null too."""
    return _from_keys(t, "dim_user")[0]


# --- facts ----------------------------------------------------------------------------------


@query(
    "fact_bike_usage",
    f"""{mock.STAR_CTES}
    SELECT s.station_id, u.user_id, b.rental_type_code, b.usage_time, b.usage_count, b.calories,
        b.carbon_emission, b.distance, b.duration, b._loaded_at, d.date_id
    FROM bike b JOIN dates d ON d.date_id = b.usage_date
    JOIN stations s ON s.station_type = 'BIKE'
        AND TRY_CAST(s.source_station_id AS BIGINT) = TRY_CAST(b.station_id AS BIGINT)
    JOIN users u ON u.gender = b.gender AND u.age_group = b.age_group
    WHERE b._loaded_at IS NOT NULL""",
)
def fact_bike_usage(t: Tables) -> DataFrame:
    src = _staged(t)
    return plans.fact_bike_usage(src["bike"], *_from_keys(t, "dim_date", "dim_station", "dim_user"))


@query(
    "fact_bus_usage",
    f"""{mock.STAR_CTES}
    SELECT s.station_id, b.route_number, b.boarding_count, b.getoff_count, b._loaded_at, d.date_id
    FROM bus b JOIN dates d ON d.date_id = b.usage_date
    JOIN stations s ON s.station_type = 'BUS' AND s.source_station_id = b.node_id""",
)
def fact_bus_usage(t: Tables) -> DataFrame:
    src = _staged(t)
    return plans.fact_bus_usage(src["bus"], *_from_keys(t, "dim_date", "dim_station"))


@query(
    "fact_subway_usage",
    f"""{mock.STAR_CTES}
    SELECT s.station_id, w.line, coalesce(w.gt_on, 0) AS boarding_count,
        coalesce(w.gt_off, 0) AS getoff_count, w._loaded_at, d.date_id
    FROM subway w JOIN dates d ON d.date_id = CAST(w.usage_date AS DATE)
    JOIN stations s ON s.station_type = 'SUBWAY' AND s.source_station_id = w.source_station_id""",
)
def fact_subway_usage(t: Tables) -> DataFrame:
    src = _staged(t)
    return plans.fact_subway_usage(src["subway"], *_from_keys(t, "dim_date", "dim_station"))
