"""Raw tables to model inputs: the needed columns of the usable rows.

Lazy frames; the predicates and the column lists end up in the Parquet scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tramline import functions as fx
from tramline.operators.columns import project_columns
from tramline.operators.filters import filter_not_like, filter_not_null


def src_bike_usage(raw: DataFrame) -> DataFrame:
    """Dated rows of real stations; ids that start with 0 are test stations."""
    rows = filter_not_like(filter_not_null(raw, "usage_date"), "station_id", "0%")
    return project_columns(
        rows,
        "usage_date", "usage_time", "station_id", "station_name", "rental_type_code", "gender",
        "age_group", "usage_count", "calories", "carbon_emission", "distance", "duration",
        "_loaded_at",
    )


def src_bike_location(raw: DataFrame) -> DataFrame:
    rows = filter_not_null(raw, "latitude", "longitude")
    return project_columns(rows, "station_id", "address1", "address2", "latitude", "longitude")


def src_bus_usage(raw: DataFrame) -> DataFrame:
    return project_columns(
        filter_not_null(raw, "usage_date"),
        "usage_date", "route_number", "route_name", "node_id", "ars_id", "station_name",
        "boarding_count", "getoff_count", "_loaded_at",
    )


def src_bus_stop_location(raw: DataFrame) -> DataFrame:
    rows = filter_not_null(raw, "latitude", "longitude")
    return project_columns(
        rows, "node_id", "ars_id", "stop_name_kr", "latitude", "longitude", "stop_type"
    )


def src_subway_usage(raw: DataFrame) -> DataFrame:
    """Dates in one text form, and the id that names a station on a line."""
    return project_columns(
        filter_not_null(raw, "use_ymd"),
        fx.normalize_compact_date(F.col("use_ymd")).alias("usage_date"),
        F.col("line").alias("line"),
        F.col("station").alias("station"),
        fx.composite_id(F.col("line"), F.col("station")).alias("source_station_id"),
        F.col("gt_on").alias("gt_on"),
        F.col("gt_off").alias("gt_off"),
        F.col("_loaded_at"),
    )


def src_subway_location(raw: DataFrame) -> DataFrame:
    rows = filter_not_null(raw, "latitude", "longitude")
    return project_columns(
        rows,
        "line_no", "external_station_code", "station_name", "latitude", "longitude",
        F.col("created_date").alias("_loaded_at"),
    )
