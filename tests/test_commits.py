"""Tables read through commit records: every step of a batch may break off."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from conftest import STOPPED, plan_of, values

from tramline import plans, sinks
from tramline.sinks.commits import CommittedTable

D1, D2, D3 = (dt.date(2025, 1, n) for n in (1, 2, 3))
DAYS = "v int, usage_date date"
STAMPED = "v int, _loaded_at timestamp, usage_date date"


def stamp(day: int, hour: int = 0) -> dt.datetime:
    return dt.datetime(2025, 1, day, hour)


@pytest.fixture
def days(spark, frame, tmp_path):
    """A table of three days, one batch."""
    table = CommittedTable(spark, str(tmp_path / "days"), StructType.fromDDL(DAYS), "usage_date")
    table.append(frame(DAYS, (1, D1), (2, D2), (3, D3)))
    return table


def test_days_change_together(frame, days):
    days.replace_days(frame(DAYS, (10, D1), (11, D1)), [D1, D2])
    assert values(days.read()) == [(10, D1), (11, D1), (3, D3)]
    days.replace_days(frame(DAYS, (10, D1), (11, D1)), [D1, D2])
    assert values(days.read()) == [(10, D1), (11, D1), (3, D3)]
    assert values(days.read(1)) == [(1, D1), (2, D2), (3, D3)]


@pytest.mark.parametrize("bad", [(7, dt.date(2025, 2, 1)), (7, None)])
def test_a_stray_row_changes_no_day(frame, days, bad):
    before = values(days.read())
    with pytest.raises(STOPPED):
        days.replace_days(frame(DAYS, (10, D1), (20, D2), bad), [D1, D2])
    assert values(days.read()) == before
    days.append(frame(DAYS, (9, D3)))
    assert values(days.read()) == [(1, D1), (2, D2), (3, D3), (9, D3)]


class Broken(Exception):
    pass


def breaking(monkeypatch, step):
    """From now on a batch breaks off right before ``step``."""

    def stop(*_args, **_kwargs):
        raise Broken

    monkeypatch.setattr(CommittedTable, step, stop)


@pytest.mark.parametrize("step", ["_publish", "_added"])
def test_an_increment_that_breaks_off_is_loaded_whole_by_the_next(spark, frame, tmp_path, monkeypatch, step):
    table = CommittedTable(spark, str(tmp_path / "t"), StructType.fromDDL(STAMPED), "usage_date")
    rows = [(1, stamp(1), D1), (2, stamp(2), D2), (3, None, D2), (4, stamp(3), D3), (5, stamp(3), D1)]
    assert table.append_above_mark(frame(STAMPED, *rows[:3])) is None
    with monkeypatch.context() as patch:
        breaking(patch, step)
        with pytest.raises(Broken):
            table.append_above_mark(frame(STAMPED, *rows))
    assert sorted(row.v for row in table.read().collect()) == [1, 2]
    assert table.append_above_mark(frame(STAMPED, *rows)) == "2025-01-02 00:00:00"
    assert sorted(row.v for row in table.read().collect()) == [1, 2, 4, 5]
    assert table.append_above_mark(frame(STAMPED, *rows)) == "2025-01-03 00:00:00"
    assert sorted(row.v for row in table.read().collect()) == [1, 2, 4, 5]
    gone = table.expire()
    assert len(gone) == 2 and sorted(row.v for row in table.read().collect()) == [1, 2, 4, 5]


def test_a_write_that_breaks_off_leaves_nothing_to_see(spark, frame, tmp_path):
    """Some files of the batch are there when a task fails."""
    table = CommittedTable(spark, str(tmp_path / "t"), StructType.fromDDL(STAMPED), "usage_date")
    rows = spark.range(0, 40, 1, 4).select(
        F.when(F.col("id") < 35, F.col("id").cast("int")).otherwise(F.raise_error(F.lit("bad row")).cast("int")).alias("v"),
        F.lit(stamp(1)).alias("_loaded_at"), F.lit(D1).alias("usage_date"),
    )
    with pytest.raises(STOPPED):
        table.append_above_mark(rows)
    assert not table.exists() and table.state() is None
    with pytest.raises(FileNotFoundError):
        table.read()
    assert table.append_above_mark(rows.where("id < 35")) is None and table.read().count() == 35


def test_the_mark_needs_no_read_of_the_table(spark, frame, tmp_path, monkeypatch):
    table = CommittedTable(spark, str(tmp_path / "t"), StructType.fromDDL(STAMPED), "usage_date")
    table.append_above_mark(frame(STAMPED, (1, stamp(2, 5), D1)))
    with monkeypatch.context() as patch:
        breaking(patch, "read")
        assert table.append_above_mark(frame(STAMPED, (2, stamp(2, 6), D1), (3, stamp(2, 5), D1))) == "2025-01-02 05:00:00"
    assert sorted(row.v for row in table.read().collect()) == [1, 2]
    # A table changed in another way is asked, nulls included, with the same outcome.
    table.append(frame(STAMPED, (7, stamp(9), D1), (8, None, D2)))
    assert table.state().marks == {}
    assert table.append_above_mark(frame(STAMPED, (9, stamp(9), D1), (10, stamp(10), D1))) == "2025-01-09 00:00:00"
    assert sorted(row.v for row in table.read().collect()) == [1, 2, 7, 8, 10]
    # An increment without rows keeps the mark.
    table.append_above_mark(frame(STAMPED))
    assert table.append_above_mark(frame(STAMPED, (11, stamp(10), D1))) == "2025-01-10 00:00:00"


def test_a_table_of_null_stamps(spark, frame, tmp_path):
    table = CommittedTable(spark, str(tmp_path / "t"), StructType.fromDDL(STAMPED), "usage_date")
    table.append(frame(STAMPED, (1, None, D1)))
    assert table.append_above_mark(frame(STAMPED, (2, stamp(1), D1), (3, None, D1))) is None
    assert sorted(row.v for row in table.read().collect()) == [1, 2]


def test_a_second_writer_fails_and_changes_nothing(frame, days):
    class Slow(CommittedTable):
        def _write(self, *args):
            done = super()._write(*args)
            days.append(frame(DAYS, (50, D1)))  # the other run is first
            return done

    slow = Slow(days.spark, days.path, days.schema, days.partition_by)
    with pytest.raises(sinks.Conflict):
        slow.append(frame(DAYS, (60, D1)))
    assert values(days.read()) == [(1, D1), (2, D2), (3, D3), (50, D1)]


def test_tables_without_folders_and_empty_ones(spark, frame, tmp_path):
    table = CommittedTable(spark, str(tmp_path / "plain"), StructType.fromDDL("a int, b string"))
    table.append(frame("a int, b string"))
    assert table.read().count() == 0 and table.read().columns == ["a", "b"]
    table.append(frame("b string, a int", ("x", 1)))
    assert values(table.read()) == [(1, "x")]
    with pytest.raises(sinks.SchemaDrift):
        table.append(frame("a string, b string", ("x", "y")))
    assert values(table.read()) == [(1, "x")]


def test_an_emptied_table(spark, frame, days):
    days.replace_days(frame(DAYS), [D1, D2, D3])
    assert days.read().count() == 0 and days.read().dtypes == [("v", "int"), ("usage_date", "date")]
    assert len(days.expire()) == 2 and os.listdir(days.path) == ["_commits"]
    days.replace_days(frame(DAYS, (1, D1)), [D1])
    assert values(days.read()) == [(1, D1)]


def test_a_day_is_read_from_its_folders_alone(days):
    plan = plan_of(days.read().where(F.col("usage_date") == F.lit(D2)))
    assert "PartitionFilters: [isnotnull(usage_date" in plan


def test_files_are_loaded_once(spark, frame, tmp_path, monkeypatch):
    landing = tmp_path / "landing"
    schema = "v int, usage_date date"
    table = CommittedTable(spark, str(tmp_path / "t"), StructType.fromDDL(schema), "usage_date")

    def land(name, *rows):
        frame(schema, *rows).coalesce(1).write.parquet(str(landing / name))

    def load():
        return len(table.load_files(str(landing), lambda files: spark.read.parquet(*files), "part-*.parquet"))

    land("a", (1, D1), (2, D2))
    land("b", (3, D1))
    with monkeypatch.context() as patch:  # breaks off after the rows and the list are written
        breaking(patch, "_publish")
        with pytest.raises(Broken):
            load()
    assert not table.exists()
    assert load() == 2 and values(table.read()) == [(1, D1), (2, D2), (3, D1)]
    assert load() == 0 and values(table.read()) == [(1, D1), (2, D2), (3, D1)]
    land("c", (4, D3))
    assert load() == 1 and values(table.read()) == [(1, D1), (2, D2), (3, D1), (4, D3)]
    assert load() == 0 and table.new_files(str(landing)).count() == 0
    # A file that was written anew is a new one.
    frame(schema, (5, D3), (6, D3)).coalesce(1).write.mode("overwrite").parquet(str(landing / "c"))
    assert load() == 1 and table.read().count() == 6


def test_history_is_loaded_once(spark, tmp_path):
    house = plans.Warehouse(spark, str(tmp_path / "house"))
    raw = spark.createDataFrame(
        [("2025-01-01", "1", "102", "102. A", "S", "M", "20", "1", "2", "0.1", "10", "5")],
        ", ".join(f"{name} string" for name in plans.warehouse.schemas.BIKE_USAGE_NAMES),
    )
    house.stage_bike_history(raw, str(tmp_path / "parts"), dt.datetime(2025, 2, 1))
    assert house.load_bike_history(str(tmp_path / "parts"))
    assert house.load_bike_history(str(tmp_path / "parts")) == []
    assert house.read("bike_usage").count() == 1
    house.stage_bike_history(raw.union(raw), str(tmp_path / "more"), dt.datetime(2025, 2, 1))
    house.load_bike_history(str(tmp_path / "more"))
    assert house.read("bike_usage").count() == 3
    assert set(house.register_sources("raw_")) == {"bike_rentals_by_hour"}
    assert spark.sql("SELECT sum(usage_count) AS n FROM raw_bike_rentals_by_hour").first().n == 3
