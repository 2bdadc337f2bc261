"""Date, user-segment and station dimensions, rebuilt on every run.

Each usage table is reduced to its distinct keys before anything moves, so the shuffles carry
days, segments and stations, not usage rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tramline import constants as const, functions as fx
from tramline.operators.columns import literal_columns
from tramline.operators.filters import filter_in_list
from tramline.operators.joins import BROADCAST_ROWS, attach, join_distinct
from tramline.operators.sets import (
    distinct_pairs,
    distinct_sets,
    group_ordinals,
    one_set,
    union_all_conformed,
    union_distinct,
)

STATION_COLUMNS = {
    "source_station_id": "string",
    "station_name": "string",
    "station_type": "string",
    "address": "string",
    "city": "string",
    "latitude": "double",
    "longitude": "double",
}


#: What the dimensions need of each usage table: its days, its segments, its stations.
USAGE_SETS = {
    "bike": (["usage_date"], ["station_id", "station_name"], ["gender", "age_group"]),
    "bus": (["usage_date"], ["node_id"]),
    "subway": (["usage_date"], ["line", "station"]),
}


def usage_keys(kind: str, usage: DataFrame) -> DataFrame:
    """All a usage table contributes to the dimensions, by one read of it. Keep it as a table."""
    return distinct_sets(usage, *USAGE_SETS[kind])


def dimensions(keys: Mapping[str, DataFrame], locations: Mapping[str, DataFrame], dedupe: bool = False) -> dict[str, DataFrame]:
    """The three dimensions from :func:`usage_keys` of each usage table, and the locations."""
    part = {
        (kind, place): one_set(keys[kind], place, *columns)
        for kind, sets in USAGE_SETS.items()
        for place, columns in enumerate(sets)
    }
    stations = {kind: part[kind, 1] for kind in USAGE_SETS}
    return {
        "dim_date": dim_date(*(part[kind, 0] for kind in USAGE_SETS)),
        "dim_user": dim_user(part["bike", 2]),
        "dim_station": dim_station(**stations, **locations, dedupe=dedupe),
    }


def bike_number(station_id: Column) -> Column:
    """The number behind a bike station id: ids are text, but ``0102`` and ``102`` are one."""
    return station_id.try_cast("bigint")


def dim_date(bike: DataFrame, bus: DataFrame, subway: DataFrame) -> DataFrame:
    """One row per day used anywhere.

    Text dates are parsed, and calendar columns computed, once per distinct day.
    """
    days = union_distinct(
        *[
            distinct_pairs(usage, "usage_date").select(
                fx.to_date_strict(F.col("usage_date")).alias("date_id")
            )
            for usage in (bike, bus, subway)
        ]
    )
    day = F.col("date_id")
    parts = fx.date_parts(day)
    return days.select(
        day,
        parts["year"].alias("year"),
        parts["month"].alias("month"),
        parts["day_of_month"].alias("day_of_month"),
        fx.weekday_name_kr(day).alias("day_of_week_kr"),
        fx.weekend_flag(day).alias("is_weekend"),
        parts["quarter"].alias("quarter"),
        fx.year_month(day).alias("year_month"),
    )


def dim_user(bike: DataFrame) -> DataFrame:
    """One row per gender and age group, null ones included."""
    segments = distinct_pairs(bike, "gender", "age_group")
    key = fx.surrogate_key(F.col("gender"), F.col("age_group"))
    return segments.select(key.alias("user_id"), "gender", "age_group")


def bike_stations(
    usage: DataFrame, locations: DataFrame, max_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Named as in the usage rows, placed as in the locations."""
    named = usage.select(
        bike_number(F.col("station_id")).alias("_number"),
        F.col("station_id").alias("source_station_id"),
        "station_name",
    )
    placed = locations.select(
        bike_number(F.col("station_id")).alias("_number"),
        F.col("address1").alias("address"),
        "latitude",
        "longitude",
    )
    joined = join_distinct(named, placed, ["_number"], max_rows).drop("_number")
    return literal_columns(joined, {"station_type": const.BIKE, "city": const.CITY})


def bus_stops(
    usage: DataFrame, locations: DataFrame, max_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Named and placed as in the locations."""
    used = usage.select(F.col("node_id").alias("source_station_id"))
    placed = locations.select(
        F.col("node_id").alias("source_station_id"),
        F.col("stop_name_kr").alias("station_name"),
        "latitude",
        "longitude",
    )
    joined = join_distinct(used, placed, ["source_station_id"], max_rows)
    return literal_columns(
        joined, {"station_type": const.BUS, "address": None, "city": const.CITY}
    )


def subway_stations(
    usage: DataFrame, locations: DataFrame, max_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Stations of the numbered lines, matched on line and name. Locations are not deduplicated."""
    used = group_ordinals(filter_in_list(usage, "line", const.SUBWAY_LINES), "line", "station")
    placed = locations.select(
        F.concat("line_no", F.lit(const.LINE_SUFFIX)).alias("line"),
        F.col("station_name").alias("station"),
        "latitude",
        "longitude",
    )
    named = attach(used, placed, ["line", "station"], max_rows).select(
        fx.composite_id(F.col("line"), F.col("station")).alias("source_station_id"),
        F.col("station").alias("station_name"),
        "latitude",
        "longitude",
    )
    return literal_columns(
        named, {"station_type": const.SUBWAY, "address": None, "city": const.CITY}
    )


def dim_station(
    bike: DataFrame,
    bike_locations: DataFrame,
    bus: DataFrame,
    bus_locations: DataFrame,
    subway: DataFrame,
    subway_locations: DataFrame,
    dedupe: bool = False,
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """All stations of all kinds, under one key over source id and name.

    A station known under several names or places keeps a row for each, and facts fan out over
    them; ``dedupe`` keeps one row per kind and source id instead (the smallest).
    """
    stations = union_all_conformed(
        [
            bike_stations(bike, bike_locations, max_rows),
            bus_stops(bus, bus_locations, max_rows),
            subway_stations(subway, subway_locations, max_rows),
        ],
        STATION_COLUMNS,
    )
    if dedupe:
        stations = _one_per_source(stations)
    key = fx.surrogate_key(F.col("source_station_id"), F.col("station_name"))
    return stations.select(key.alias("station_id"), *STATION_COLUMNS)


def _one_per_source(stations: DataFrame) -> DataFrame:
    identity = ["station_type", "source_station_id"]
    rest = [name for name in STATION_COLUMNS if name not in identity]
    first = F.min(F.struct(*rest)).alias("_first")
    return stations.groupBy(*identity).agg(first).select(*identity, "_first.*")


def fan_out(stations: DataFrame) -> DataFrame:
    """Source ids with more than one dimension row, which multiply their fact rows."""
    return (
        stations.groupBy("station_type", "source_station_id")
        .agg(F.count(F.lit(1)).alias("dimension_rows"))
        .where("dimension_rows > 1")
    )
