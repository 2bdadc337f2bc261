"""Number rules.

The strict casts raise and the coercing ones null, whatever ``spark.sql.ansi.enabled`` says.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Java also reads "3d", "0x1p3" and "NaN" as doubles; those are not numbers here.
_PLAIN = r"^\s*[+-]?(\d{1,300}(\.\d*)?|\.\d+)\s*$"
_SCIENTIFIC = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_INFINITE = r"^[+-]?[iI][nN][fF]([iI][nN][iI][tT][yY])?$"


def _stop(message: str, value: Column) -> Column:
    shown = F.coalesce(value.cast("string"), F.lit("null"))
    return F.raise_error(F.concat(F.lit(message + ": "), shown))


def cast_int_strict(value: Column) -> Column:
    """Whole number or an error; null is an error too, and so is a number with a fraction."""
    whole = value.try_cast("int")
    # Text with a fraction is no int to try_cast; a number is cut, and shows it when compared.
    same = F.when(F.typeof(value) == "string", whole.isNotNull()).otherwise(whole.cast("double") == value.try_cast("double"))
    return F.coalesce(F.when(same, whole), _stop("not an integer", value))


def cast_double_strict(value: Column) -> Column:
    """Number or an error; null stays null."""
    number = F.coalesce(coerce_double(value), _stop("not a number", value))
    return F.when(value.isNotNull(), number)


def coerce_double(value: Column) -> Column:
    """Number, or null when the text is not one or is too large for a double."""
    text, number = value.cast("string"), value.try_cast("double")
    in_range = text.rlike(_SCIENTIFIC) & (F.abs(number) < float("inf"))
    return F.when(text.rlike(_PLAIN) | in_range | text.rlike(_INFINITE), number)


def coerce_int(value: Column) -> Column:
    """Whole number, or null when the text is not a number.

    A number with a fraction is an error: it cannot be stored in a whole-number column
    without changing it.
    """
    text, number = value.cast("string"), value.try_cast("double")
    fraction = _stop("fraction in a whole-number column", value)
    whole = F.when(number % 1 != 0, fraction).otherwise(number.cast("bigint"))
    in_range = text.rlike(_SCIENTIFIC) & (F.abs(number) < float("inf"))
    return F.coalesce(value.try_cast("bigint"), F.when(in_range, whole))


def coerce_int32(value: Column) -> Column:
    """As :func:`coerce_int`, for an ``int`` column: a number out of its range stops the job.

    Plain whole text, the usual case, is read by one cast; the patterns are only asked about the
    rest.
    """
    text, number = value.cast("string"), value.try_cast("double")
    in_range = text.rlike(_SCIENTIFIC) & (F.abs(number) < float("inf"))
    whole = F.coalesce(number.try_cast("int"), _stop("out of range", value))
    slow = F.when(number % 1 != 0, _stop("fraction in a whole-number column", value)).otherwise(whole)
    quick = F.when(F.typeof(value) == "string", value.try_cast("int"))
    return F.coalesce(quick, F.when(in_range, slow))


def checked_int(value: Column) -> Column:
    """A number as ``int``; null stays null, one out of range stops the job."""
    return F.when(value.isNotNull(), F.coalesce(value.try_cast("int"), _stop("out of range", value)))


def coerce_int_or_zero(value: Column) -> Column:
    """Number truncated toward zero, out of range an error; 0 when missing or not a number."""
    return F.coalesce(checked_int(coerce_double(value)), F.lit(0))


def zero_to_null(value: Column) -> Column:
    """0.0 marks an unknown coordinate."""
    return F.nullif(value, F.lit(0.0))


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def coalesce_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def falsy_number(value: Column, default: int = -1) -> Column:
    """Null and 0 become ``default``."""
    return F.coalesce(F.nullif(value, F.lit(0)), F.lit(default))


def falsy_text(value: Column, default: str = "-1") -> Column:
    """Null and the empty text become ``default``; the text ``0`` is kept."""
    return F.coalesce(F.nullif(value, F.lit("")), F.lit(default))


def falsy_variant(value: Column, default: str = "-1") -> Column:
    """As :func:`falsy_number` or :func:`falsy_text`, by the JSON type of each value; gives text."""
    text = F.try_variant_get(value, "$", "string")
    is_text = F.schema_of_variant(value) == "STRING"
    is_zero = ~is_text & (text.try_cast("double") == 0)
    return F.when(is_zero, F.lit(default)).otherwise(falsy_text(text, default))
