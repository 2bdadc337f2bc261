"""Logical source names and where their rows are."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# Logical name -> physical table of the raw layer.
RAW_SOURCES = {
    "bike_hour": "bike_rentals_by_hour",
    "bike_location": "bike_station_coordinates",
    "bus": "bus_usage",
    "bus_location": "bus_stop_coordinates",
    "subway": "subway_info",
    "subway_location": "seoul_metro_station_coordinates",
}


def register_sources(
    spark: SparkSession, locations: Mapping[str, str], prefix: str = ""
) -> dict[str, DataFrame]:
    """Make each logical name a temporary view over the Parquet path (or table) it maps to."""
    frames = {}
    for name, location in locations.items():
        is_path = "/" in location
        frame = spark.read.parquet(location) if is_path else spark.table(location)
        frame.createOrReplaceTempView(prefix + name)
        frames[name] = frame
    return frames
