"""Explicit schemas: nothing in this package infers a schema from data."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    VariantType,
)


def text_fields(*names: str) -> StructType:
    """A struct whose fields are all nullable strings."""
    return StructType([StructField(name, StringType()) for name in names])


def envelope(service: str, row: StructType) -> StructType:
    """``{service: {list_total_count, row: [...]}}`` as answered by the usage and location APIs."""
    body = StructType(
        [StructField("list_total_count", IntegerType()), StructField("row", ArrayType(row))]
    )
    return StructType([StructField(service, body)])


# Field names of the landed files, in file order.
RAW_BIKE_USAGE = text_fields(
    "RENT_DT", "RENT_HR", "RENT_ID", "RENT_NM", "RENT_TYPE", "GENDER_CD",
    "AGE_TYPE", "USE_CNT", "EXER_AMT", "CARBON_AMT", "MOVE_METER", "MOVE_TIME",
    "START_INDEX", "END_INDEX", "RNUM",
)
RAW_BIKE_STATION = text_fields("RENT_NO", "STA_ADD1", "STA_ADD2", "STA_LAT", "STA_LONG")
RAW_BUS_STOP = text_fields("NODE_ID", "STOPS_NO", "STOPS_NM", "YCRD", "XCRD", "STOPS_TYPE")
RAW_BUS_USAGE = text_fields(
    "USE_YMD", "RTE_ID", "RTE_NO", "RTE_NM", "STOPS_ID", "STOPS_ARS_NO",
    "SBWY_STNS_NM", "GTON_TNOPE", "GTOFF_TNOPE", "REG_YMD",
)
# The station code keeps its JSON type (number or text), because 0 and "0" differ.
RAW_METRO_STATION = text_fields("역명", "위도", "경도", "호선").add("고유역번호(외부역코드)", VariantType())
# Landed as Parquet; earlier days have narrower counts, and some no registration date.
RAW_SUBWAY_USAGE = (
    text_fields("USE_YMD", "LINE", "STATION").add("GT_ON", LongType()).add("GT_OFF", LongType()).add("REG_DATE", StringType())
)
RAW_SUBWAY_OPTIONAL = ["REG_DATE"]
METRO_REQUIRED = ["역명", "위도", "경도", "호선"]
PAGING_COLUMNS = ["START_INDEX", "END_INDEX", "RNUM"]

# Raw name -> warehouse name.
BIKE_USAGE_NAMES = {
    "RENT_DT": "usage_date",
    "RENT_HR": "usage_time",
    "RENT_ID": "station_id",
    "RENT_NM": "station_name",
    "RENT_TYPE": "rental_type_code",
    "GENDER_CD": "gender",
    "AGE_TYPE": "age_group",
    "USE_CNT": "usage_count",
    "EXER_AMT": "calories",
    "CARBON_AMT": "carbon_emission",
    "MOVE_METER": "distance",
    "MOVE_TIME": "duration",
}
BIKE_STATION_NAMES = {
    "RENT_NO": "station_id",
    "STA_ADD1": "address1",
    "STA_ADD2": "address2",
    "STA_LAT": "latitude",
    "STA_LONG": "longitude",
}
BUS_STOP_NAMES = {
    "NODE_ID": "node_id",
    "STOPS_NO": "ars_id",
    "STOPS_NM": "stop_name_kr",
    "YCRD": "latitude",
    "XCRD": "longitude",
    "STOPS_TYPE": "stop_type",
}
BUS_USAGE_NAMES = {
    "USE_YMD": "usage_date",
    "RTE_NO": "route_number",
    "RTE_NM": "route_name",
    "STOPS_ID": "node_id",
    "STOPS_ARS_NO": "ars_id",
    "SBWY_STNS_NM": "station_name",
    "GTON_TNOPE": "boarding_count",
    "GTOFF_TNOPE": "getoff_count",
}
METRO_STATION_NAMES = {
    "역명": "station_name",
    "고유역번호(외부역코드)": "external_station_code",
    "위도": "latitude",
    "경도": "longitude",
    "호선": "line_no",
}

# Warehouse tables: name -> DDL.
TABLES = {
    "bike_usage": (
        "usage_time int, station_id string, station_name string, rental_type_code string, "
        "gender string, age_group string, usage_count int, calories double, "
        "carbon_emission double, distance double, duration int, "
        "_updated_at timestamp, _loaded_at timestamp, usage_date date"
    ),
    "bike_usage_by_hour": (
        "usage_time int, station_id string, station_name string, rental_type_code string, "
        "gender string, age_group string, usage_count int, calories int, "
        "carbon_emission double, distance double, duration int, usage_date date"
    ),
    "bike_location": (
        "station_id string, address1 string, address2 string, latitude double, longitude double"
    ),
    "bus_usage": (
        "route_number string, route_name string, node_id string, ars_id string, "
        "station_name string, boarding_count int, getoff_count int, "
        "_updated_at timestamp, _loaded_at timestamp, usage_date date"
    ),
    "bus_stop_location": (
        "node_id string, ars_id string, stop_name_kr string, latitude double, "
        "longitude double, stop_type string"
    ),
    "subway_usage": (
        "use_ymd string, line string, station string, gt_on int, gt_off int, "
        "_loaded_at timestamp, usage_date date"
    ),
    "subway_location": (
        "station_name string, external_station_code string, latitude double, longitude double, "
        "line_no string, seq_no int, created_date date"
    ),
    "dim_date": (
        "date_id date, year int, month int, day_of_month int, day_of_week_kr string, "
        "is_weekend boolean, quarter int, year_month string"
    ),
    "dim_user": "user_id string, gender string, age_group string",
    "dim_station": (
        "station_id string, source_station_id string, station_name string, station_type string, "
        "address string, city string, latitude double, longitude double"
    ),
    "fact_bike_usage": (
        "station_id string, user_id string, rental_type_code string, usage_time int, "
        "usage_count int, calories double, carbon_emission double, distance double, "
        "duration int, _loaded_at timestamp, date_id date"
    ),
    "fact_bus_usage": (
        "station_id string, route_number string, boarding_count int, getoff_count int, "
        "_loaded_at timestamp, date_id date"
    ),
    "fact_subway_usage": (
        "station_id string, line string, boarding_count int, getoff_count int, "
        "_loaded_at timestamp, date_id date"
    ),
}


def table_schema(name: str) -> StructType:
    return StructType.fromDDL(TABLES[name])
