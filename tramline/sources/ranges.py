"""Date ranges as scan predicates, and the days they lack."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, functions as F

from tramline.constants import HOURS_PER_DAY


class MissingDays(Exception):
    """A strict range scan found days without rows."""


def date_hour_spine(
    bounds: DataFrame, start: str = "start", end: str = "end", hours: int | None = HOURS_PER_DAY
) -> DataFrame:
    """Every day of each inclusive range, times every hour (``hours=None``: days only)."""
    days = bounds.select(F.explode(F.sequence(start, end, F.expr("INTERVAL 1 DAY"))).alias("usage_date"))
    if hours is None:
        return days
    clock = F.array(*[F.lit(hour) for hour in range(hours)])
    return days.select("usage_date", F.explode(clock).alias("usage_time"))


def backfill_range(rows: DataFrame, column: str, start: date, end: date) -> DataFrame:
    """Rows of an inclusive date range in one scan; the predicate prunes partitions."""
    return rows.where(F.col(column).between(F.lit(start), F.lit(end)))


def absent_days(rows: DataFrame, column: str, start: date, end: date) -> DataFrame:
    """Days of the range without any row. Only distinct days are shuffled."""
    bounds = rows.sparkSession.range(1).select(F.lit(start).alias("start"), F.lit(end).alias("end"))
    spine = date_hour_spine(bounds, hours=None)
    seen = backfill_range(rows, column, start, end).select(
        F.col(column).cast("date").alias("usage_date")
    ).distinct()
    return spine.join(seen, "usage_date", "left_anti")


def previous_month_bounds(run: date) -> tuple[date, date]:
    """First and last day of the calendar month before ``run``."""
    last = run.replace(day=1) - timedelta(days=1)
    return last.replace(day=1), last


def previous_month(rows: DataFrame, column: str, run: date, strict: bool = False) -> DataFrame:
    """Rows of the month before ``run``; ``strict`` raises if one of its days has none."""
    start, end = previous_month_bounds(run)
    if strict:
        lacking = [row.usage_date for row in absent_days(rows, column, start, end).collect()]
        if lacking:
            raise MissingDays(f"no rows for {sorted(lacking)}")
    after = end + timedelta(days=1)
    return rows.where((F.col(column) >= F.lit(start)) & (F.col(column) < F.lit(after)))
