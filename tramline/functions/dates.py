"""Date rules. All accept a date, a timestamp or, where said, text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tramline.constants import WEEKDAYS_KR


_DASHED = r"^\s*\d{4}-\d{1,2}-\d{1,2}([ T]\d{1,2}:\d{1,2}(:\d{1,2}(\.\d+)?)?\s*(Z|[+-]\d{1,2}(:?\d{2})?)?)?\s*$"
_COMPACT = r"^\s*\d{8}\s*$"


def to_date_or_null(text: Column) -> Column:
    """A whole ``yyyyMMdd`` or ``yyyy-M-d``, the latter with an optional time; all else is null."""
    shown = text.cast("string")
    compact = F.try_to_date(F.trim(shown), "yyyyMMdd")
    # Only text of eight letters can be compact, so most text meets one pattern.
    short = (F.length(F.trim(shown)) == 8) & shown.rlike(_COMPACT)
    return F.when(short, compact).when(shown.rlike(_DASHED), text.try_cast("date"))


def to_date_strict(text: Column) -> Column:
    """Text to date; null stays null, text that is not a whole date stops the job."""
    parsed = to_date_or_null(text)
    bad = F.raise_error(F.concat(F.lit("not a date: "), text.cast("string")))
    return F.when(text.isNotNull(), F.coalesce(parsed, bad))


def normalize_compact_date(text: Column) -> Column:
    """``20250131`` becomes ``2025-01-31``; anything that is not a valid compact date is kept."""
    dashed = F.date_format(F.try_to_date(text, "yyyyMMdd"), "yyyy-MM-dd")
    return F.coalesce(F.when(F.length(text) == 8, dashed), text)


def date_parts(day: Column) -> dict[str, Column]:
    """Calendar numbers of a day, by output name."""
    return {
        "year": F.year(day),
        "month": F.month(day),
        "day_of_month": F.dayofmonth(day),
        "quarter": F.quarter(day),
    }


def weekday_name_kr(day: Column) -> Column:
    names = F.array(*[F.lit(name) for name in WEEKDAYS_KR])
    return F.get(names, F.dayofweek(day) - 1)  # dayofweek counts from 1 = Sunday


def weekend_flag(day: Column) -> Column:
    return F.coalesce(F.dayofweek(day).isin(1, 7), F.lit(False))


def year_month(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def run_date_minus_one(run: Column) -> Column:
    """The day a run is responsible for: the one before it. Keeps the type of ``run``."""
    return run - F.expr("INTERVAL 1 DAY")


def compact_date(day: Column) -> Column:
    return F.date_format(day, "yyyyMMdd")


def compact_date_parts(text: Column) -> dict[str, Column]:
    """Year, month and day pieces of a ``YYYYMMDD`` text, still text."""
    return {
        "yyyy": F.substring(text, 1, 4),
        "mm": F.substring(text, 5, 2),
        "dd": F.substring(text, 7, 2),
    }


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")
