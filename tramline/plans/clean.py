"""Landed text rows to typed rows. One projection each: no shuffle, no Python."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, functions as F

from tramline import functions as fx, schemas
from tramline.operators.columns import (
    audit_stamp,
    drop_if_exists,
    drop_strict,
    rename_map,
    rename_positional,
)
from tramline.operators.filters import require_fields


def _station_id(text: Column) -> Column:
    """A numeric id kept as trimmed text, so that a leading zero stays visible."""
    plain = text.try_cast("bigint").isNotNull()
    return F.when(plain, fx.strip_ws(text)).otherwise(fx.coerce_int(text).cast("string"))


def clean_bike_usage(raw: DataFrame, run: datetime) -> DataFrame:
    """The lenient variant: numbers that cannot be read become null."""
    named = rename_positional(
        drop_strict(raw, schemas.PAGING_COLUMNS), list(schemas.BIKE_USAGE_NAMES.values())
    )
    whole = {
        name: fx.coerce_int32(F.col(name))
        for name in ("usage_time", "usage_count", "duration")
    }
    real = {
        name: fx.coerce_double(F.col(name))
        for name in ("calories", "carbon_emission", "distance")
    }
    typed = named.withColumns(
        {
            "usage_date": fx.to_date_strict(F.col("usage_date")),
            "station_id": _station_id(F.col("station_id")),
            "station_name": fx.name_split_second(F.col("station_name")),
            **whole,
            **real,
        }
    )
    return audit_stamp(typed, run)


def _clean_bike_usage_strictly(raw: DataFrame) -> DataFrame:
    named = rename_map(raw, schemas.BIKE_USAGE_NAMES)
    whole = {
        name: fx.cast_int_strict(F.col(name))
        for name in ("usage_time", "usage_count", "duration")
    }
    real = {name: fx.cast_double_strict(F.col(name)) for name in ("carbon_emission", "distance")}
    return named.withColumns(
        {
            "usage_date": fx.to_date_strict(F.col("usage_date")),
            "calories": fx.coerce_int_or_zero(F.col("calories")),
            **whole,
            **real,
        }
    )


def bike_usage_faults(raw: DataFrame) -> Column:
    """The names of the columns whose values the strict variant would stop at."""
    back = {name: landed for landed, name in schemas.BIKE_USAGE_NAMES.items()}
    value = {name: F.col(f"`{back[name]}`") for name in back}
    whole = [(n, value[n].try_cast("int").isNull()) for n in ("usage_time", "usage_count", "duration")]
    real = [
        (n, value[n].isNotNull() & fx.coerce_double(value[n]).isNull())
        for n in ("carbon_emission", "distance")
    ]
    burnt = fx.coerce_double(value["calories"])
    others = [
        ("usage_date", value["usage_date"].isNotNull() & fx.to_date_or_null(value["usage_date"]).isNull()),
        ("calories", burnt.isNotNull() & burnt.try_cast("int").isNull()),
    ]
    return F.array_compact(F.array(*(F.when(bad, F.lit(n)) for n, bad in [*whole, *real, *others])))


def clean_bike_usage_strict(raw: DataFrame) -> DataFrame:
    """The strict variant: a bad number stops the job, except calories (0 when unreadable).

    Id and name stay as landed.
    """
    return _clean_bike_usage_strictly(raw)


def clean_bike_usage_bulk(raw: DataFrame) -> DataFrame:
    """The strict variant for history: whole-number ids, names without their number prefix."""
    return _clean_bike_usage_strictly(raw).withColumns(
        {
            "station_id": fx.cast_int_strict(F.col("station_id")),
            "station_name": fx.name_strip_prefix(F.col("station_name")),
        }
    )


def _coordinate(text: Column) -> Column:
    return fx.nan_to_null(fx.zero_to_null(fx.cast_double_strict(text)))


def clean_bike_station(raw: DataFrame) -> DataFrame:
    """Bike stations; a coordinate of zero is unknown, an id that is no number is an error."""
    named = rename_map(raw, schemas.BIKE_STATION_NAMES)
    checked_id = F.when(
        fx.cast_int_strict(F.col("station_id")).isNotNull(), fx.strip_ws(F.col("station_id"))
    )
    return named.withColumns(
        {
            "station_id": checked_id,
            "latitude": _coordinate(F.col("latitude")),
            "longitude": _coordinate(F.col("longitude")),
        }
    )


def clean_bus_stop(raw: DataFrame) -> DataFrame:
    """Bus stops; short stop numbers are filled to five digits."""
    return rename_map(raw, schemas.BUS_STOP_NAMES).withColumns(
        {
            "ars_id": fx.zfill(F.col("ars_id"), 5),
            "latitude": _coordinate(F.col("latitude")),
            "longitude": _coordinate(F.col("longitude")),
        }
    )


def clean_bus_usage(raw: DataFrame, run: datetime) -> DataFrame:
    """Bus boardings; counts that cannot be read become null."""
    typed = rename_map(raw, schemas.BUS_USAGE_NAMES).withColumns(
        {
            "usage_date": fx.to_date_strict(F.col("usage_date")),
            "boarding_count": fx.coerce_int32(F.col("boarding_count")),
            "getoff_count": fx.coerce_int32(F.col("getoff_count")),
        }
    )
    return audit_stamp(typed, run)


def clean_metro_station(raw: DataFrame, created: date) -> DataFrame:
    """Metro stations with their place in the landed array (``seq_no``).

    Records without name, line or coordinates are dropped after they were numbered.
    """
    whole = require_fields(raw, *schemas.METRO_REQUIRED)
    named = rename_map(whole, {**schemas.METRO_STATION_NAMES, "seq_no": "seq_no"})
    return named.withColumns(
        {
            "external_station_code": fx.falsy_variant(F.col("external_station_code")),
            "latitude": fx.cast_double_strict(F.col("latitude")),
            "longitude": fx.cast_double_strict(F.col("longitude")),
            "created_date": F.lit(created),
        }
    )


def clean_subway_usage(raw: DataFrame, run: datetime) -> DataFrame:
    """Subway boardings: the registration date goes, the load stamp comes."""
    return audit_stamp(drop_if_exists(raw, "REG_DATE"), run, "_loaded_at")
