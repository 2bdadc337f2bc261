"""Column rules. Every function takes and returns ``Column`` and stays in the JVM."""

from tramline.functions.dates import (
    compact_date,
    compact_date_parts,
    date_parts,
    month_start,
    normalize_compact_date,
    run_date_minus_one,
    to_date_or_null,
    to_date_strict,
    weekday_name_kr,
    weekend_flag,
    year_month,
)
from tramline.functions.keys import composite_id, surrogate_key
from tramline.functions.numbers import (
    cast_double_strict,
    cast_int_strict,
    checked_int,
    coalesce_zero,
    coerce_double,
    coerce_int,
    coerce_int32,
    coerce_int_or_zero,
    falsy_number,
    falsy_text,
    falsy_variant,
    nan_to_null,
    zero_to_null,
)
from tramline.functions.payload import rows_to_json, xml_total_count
from tramline.functions.text import (
    name_split_second,
    name_strip_prefix,
    pad_number,
    strip_ws,
    zfill,
)

__all__ = [
    "cast_double_strict", "cast_int_strict", "checked_int", "coalesce_zero", "coerce_double", "coerce_int",
    "coerce_int_or_zero", "compact_date", "compact_date_parts", "composite_id", "date_parts",
    "falsy_number", "falsy_text", "falsy_variant", "month_start", "name_split_second",
    "name_strip_prefix", "nan_to_null", "normalize_compact_date", "pad_number", "rows_to_json",
    "run_date_minus_one", "strip_ws", "surrogate_key", "to_date_or_null", "to_date_strict", "weekday_name_kr",
    "weekend_flag", "xml_total_count", "year_month", "zero_to_null", "zfill",
]
