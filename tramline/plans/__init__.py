"""The jobs a user calls."""

from tramline.plans.clean import (
    clean_bike_station,
    clean_bike_usage,
    clean_bike_usage_bulk,
    clean_bike_usage_strict,
    clean_bus_stop,
    clean_bus_usage,
    clean_metro_station,
    clean_subway_usage,
)
from tramline.plans.dims import USAGE_SETS, dim_date, dim_station, dim_user, dimensions, fan_out, usage_keys
from tramline.plans.facts import (
    fact_bike_usage,
    fact_bus_usage,
    fact_subway_usage,
    join_dim_date,
    join_dim_station,
    join_dim_user,
    star_join,
)
from tramline.plans.staging import (
    src_bike_location,
    src_bike_usage,
    src_bus_stop_location,
    src_bus_usage,
    src_subway_location,
    src_subway_usage,
)
from tramline.plans.warehouse import Warehouse

__all__ = [
    "USAGE_SETS", "dimensions", "usage_keys",
    "Warehouse", "clean_bike_station", "clean_bike_usage", "clean_bike_usage_bulk",
    "clean_bike_usage_strict", "clean_bus_stop", "clean_bus_usage", "clean_metro_station",
    "clean_subway_usage", "dim_date", "dim_station", "dim_user", "fact_bike_usage",
    "fact_bus_usage", "fact_subway_usage", "fan_out", "join_dim_date", "join_dim_station",
    "join_dim_user", "src_bike_location", "src_bike_usage",
    "src_bus_stop_location", "src_bus_usage", "src_subway_location", "src_subway_usage",
    "star_join",
]
