"""Usage facts: every usage row with the keys of its date, station and user segment.

Dimensions that are counted to be small are broadcast, so a fact build is one scan, a chain of
hash lookups and one write, with no shuffle of usage rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tramline import constants as const, functions as fx
from tramline.operators.filters import filter_hwm
from tramline.operators.joins import BROADCAST_ROWS, attach
from tramline.plans.dims import bike_number


def join_dim_date(
    usage: DataFrame, dates: DataFrame, max_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Usage rows (with a ``date_id`` of type date) whose day is in the date dimension."""
    return attach(usage, dates.select("date_id"), ["date_id"], max_rows)


def join_dim_station(
    usage: DataFrame,
    stations: DataFrame,
    kind: str,
    source: str = "source_station_id",
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Replace a source id by the station key, among the stations of one kind.

    A source id with several dimension rows repeats the usage row once for each.
    """
    read = bike_number if kind == const.BIKE else lambda text: text
    keyed = stations.where(F.col("station_type") == kind).select(
        "station_id", read(F.col("source_station_id")).alias("_source")
    )
    rows = usage.withColumn("_source", read(F.col(source))).drop(source)
    return attach(rows, keyed, ["_source"], max_rows).drop("_source")


def join_dim_user(
    usage: DataFrame, users: DataFrame, max_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Add the segment key; a null gender or age group equals nothing, so its rows drop out."""
    return attach(usage, users, ["gender", "age_group"], max_rows)


def star_join(
    bike: DataFrame,
    dates: DataFrame,
    stations: DataFrame,
    users: DataFrame,
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Bike usage with its three dimensions; rows without a match in any of them drop out.

    Stations come last: theirs is the dimension that can outgrow a broadcast, and a shuffled
    join should not be followed by others that measure its result again.
    """
    usage = bike.withColumnsRenamed({"usage_date": "date_id", "station_id": "source_station_id"})
    dated = join_dim_date(usage, dates, max_rows)
    known = join_dim_user(dated, users, max_rows)
    return join_dim_station(known, stations, const.BIKE, max_rows=max_rows)


def fact_bike_usage(
    bike: DataFrame,
    dates: DataFrame,
    stations: DataFrame,
    users: DataFrame,
    mark: str | None = None,
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Bike fact rows stamped later than ``mark`` (all stamped rows without one)."""
    joined = star_join(filter_hwm(bike, "_loaded_at", mark), dates, stations, users, max_rows)
    return joined.select(
        "station_id", "user_id", "rental_type_code", "usage_time", "usage_count", "calories",
        "carbon_emission", "distance", "duration", "_loaded_at", "date_id",
    )


def fact_bus_usage(
    bus: DataFrame,
    dates: DataFrame,
    stations: DataFrame,
    mark: str | None = None,
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Bus fact rows stamped later than ``mark`` (all stamped rows without one)."""
    usage = filter_hwm(bus, "_loaded_at", mark).select(
        F.col("usage_date").alias("date_id"), F.col("node_id").alias("source_station_id"),
        "route_number", "boarding_count", "getoff_count", "_loaded_at",
    )
    dated = join_dim_date(usage, dates, max_rows)
    joined = join_dim_station(dated, stations, const.BUS, max_rows=max_rows)
    return joined.select(
        "station_id", "route_number", "boarding_count", "getoff_count", "_loaded_at", "date_id"
    )


def fact_subway_usage(
    subway: DataFrame,
    dates: DataFrame,
    stations: DataFrame,
    mark: str | None = None,
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Subway fact rows stamped later than ``mark``; a missing count is 0."""
    usage = filter_hwm(subway, "_loaded_at", mark).select(
        fx.to_date_strict(F.col("usage_date")).alias("date_id"),
        "source_station_id",
        "line",
        fx.coalesce_zero(F.col("gt_on")).alias("boarding_count"),
        fx.coalesce_zero(F.col("gt_off")).alias("getoff_count"),
        "_loaded_at",
    )
    dated = join_dim_date(usage, dates, max_rows)
    joined = join_dim_station(dated, stations, const.SUBWAY, max_rows=max_rows)
    return joined.select(
        "station_id", "line", "boarding_count", "getoff_count", "_loaded_at", "date_id"
    )
