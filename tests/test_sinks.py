from __future__ import annotations

import datetime as dt

import pyarrow.parquet as pq
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from conftest import values
from tramline import sinks, sources

D1, D2, D3 = (dt.date(2025, 1, day) for day in (1, 2, 3))
DAYS = "v int, usage_date date"


@pytest.fixture
def table(frame, tmp_path):
    path = str(tmp_path / "table")
    rows = frame(DAYS, (1, D1), (2, D1), (3, D2), (4, D3))
    sinks.write_parquet(rows, path, ["usage_date"], gather=True)
    return path


def content(spark, path):
    return values(spark.read.parquet(path).select("v", "usage_date"))


def test_replacing_a_day_twice_is_replacing_it_once(spark, frame, table):
    batch = frame(DAYS, (8, D1), (9, D1))
    for _ in range(2):
        sinks.replace_by_date(batch, table, D1)
        assert content(spark, table) == [(3, D2), (4, D3), (8, D1), (9, D1)]


def test_an_empty_batch_empties_its_day(spark, frame, table):
    sinks.replace_by_date(frame(DAYS), table, D1)
    assert content(spark, table) == [(3, D2), (4, D3)]
    sinks.replace_by_date(frame(DAYS, (1, D1)), table, D1)
    assert content(spark, table) == [(1, D1), (3, D2), (4, D3)]


@pytest.mark.parametrize("stray", [D2, None])
def test_a_row_of_another_day_stops_the_load_and_changes_nothing(spark, frame, table, stray):
    before = content(spark, table)
    with pytest.raises(PySparkException, match="row of another day"):
        sinks.replace_by_date(frame(DAYS, (8, D1), (9, stray)), table, D1)
    assert content(spark, table) == before


def test_a_failing_batch_keeps_the_old_day(spark, frame, table):
    before = content(spark, table)
    bad = frame(DAYS, (8, D1)).withColumn("v", F.raise_error(F.lit("boom")).cast("int"))
    with pytest.raises(PySparkException, match="boom"):
        sinks.replace_by_date(bad, table, D1)
    assert content(spark, table) == before


def test_many_days_at_once_and_the_first_load(spark, frame, tmp_path):
    path = str(tmp_path / "new")
    sinks.replace_days(frame(DAYS, (1, D1), (3, D3)), path, [D1, D2, D3])
    assert content(spark, path) == [(1, D1), (3, D3)]
    sinks.replace_days(frame(DAYS, (5, D2)), path, [D2, D3])
    assert content(spark, path) == [(1, D1), (5, D2)]


def test_full_refresh(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    sinks.full_refresh(frame("v int", (1,)), path)
    sinks.full_refresh(frame("v int", (2,), (3,)), path)
    assert values(spark.read.parquet(path)) == [(2,), (3,)]
    sinks.full_refresh(spark.read.parquet(path).where("v = 2"), path)
    assert values(spark.read.parquet(path)) == [(2,)]
    bad = frame("v int", (9,)).select(F.raise_error(F.lit("boom")).cast("int").alias("v"))
    with pytest.raises(PySparkException, match="boom"):
        sinks.full_refresh(bad, path)
    assert values(spark.read.parquet(path)) == [(2,)]


def test_append_repeats_rows_and_refuses_drift(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(2):
        sinks.append_load(frame("v int, s string", (1, "x")), path)
    sinks.append_load(frame("s string, v int", ("y", 2)), path)
    assert values(spark.read.parquet(path)) == [(1, "x"), (1, "x"), (2, "y")]
    for drifted in ("v int", "v long, s string", "v int, s string, more int"):
        with pytest.raises(sinks.SchemaDrift):
            sinks.append_load(frame(drifted), path)


def stamped(frame, *pairs):
    rows = frame("v int, s string", *pairs)
    return rows.select("v", F.col("s").cast("timestamp").alias("_loaded_at"))


def test_increment_takes_only_newer_rows(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    first = stamped(frame, (1, "2025-01-01"), (2, "2025-01-02"), (3, None))
    assert sinks.incremental_append(first, path) is None
    second = stamped(frame, (4, "2025-01-01"), (5, "2025-01-02"), (6, "2025-01-02 00:00:00.000001"), (7, None))
    mark = sinks.incremental_append(second, path)
    assert mark == "2025-01-02 00:00:00"
    assert sorted(row.v for row in spark.read.parquet(path).collect()) == [1, 2, 6]
    assert sorted(row.v for row in sinks.late_rows(second, mark).collect()) == [4, 5]
    sinks.incremental_append(second, path)
    assert spark.read.parquet(path).count() == 3


def test_increment_into_an_empty_table_is_a_first_run(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    rows = stamped(frame, (1, "2025-01-01"))
    sinks.full_refresh(rows.limit(0), path)
    assert sinks.incremental_append(rows, path) is None
    assert spark.read.parquet(path).count() == 1
    bare = str(tmp_path / "bare")
    rows.limit(0).withColumn("p", F.lit(1)).write.partitionBy("p").parquet(bare)
    assert sinks.read_if_present(spark, bare) is None


def test_two_batches_equal_one_when_stamps_ascend(spark, frame, tmp_path):
    rows = stamped(frame, *[(n, f"2025-01-{n:02d}") for n in range(1, 11)])
    once, twice = str(tmp_path / "once"), str(tmp_path / "twice")
    sinks.incremental_append(rows, once)
    sinks.incremental_append(rows.where("v <= 6"), twice)
    sinks.incremental_append(rows, twice)
    assert values(spark.read.parquet(once)) == values(spark.read.parquet(twice))


def test_align_by_name(frame):
    target = StructType.fromDDL("id bigint, day date, missing string")
    got = sinks.align_by_name(frame("DAY string, extra int, Id string", ("2025-01-01", 1, "7")), target)
    assert got.dtypes == [("id", "bigint"), ("day", "date"), ("missing", "string")]
    assert values(got) == [(7, D1, None)]
    with pytest.raises(PySparkException, match="id: bad value x"):
        sinks.align_by_name(frame("id string", ("x",)), target).collect()
    with pytest.raises(sinks.SchemaDrift):
        sinks.align_by_name(frame("id int, x int", (1, 2)).toDF("id", "ID"), target)


def test_load_continue_splits_good_and_bad(frame):
    target = StructType.fromDDL("id int, price double")
    loaded = sinks.load_continue(frame("ID string, Price string", ("1", "2.5"), ("x", "y"), (None, None), ("3", "z")), target)
    assert values(sinks.accepted(loaded)) == [(1, 2.5), (None, None)]
    assert values(sinks.rejected(loaded)) == [
        ('{"ID":"3","Price":"z"}', ["price"]), ('{"ID":"x","Price":"y"}', ["id", "price"]),
    ]


def test_schema_guard(frame):
    target = StructType.fromDDL("a int, b string")
    assert sinks.schema_guard(frame("b string, a int"), target).columns == ["a", "b"]
    with pytest.raises(sinks.SchemaDrift, match="bigint"):
        sinks.schema_guard(frame("a long, b string"), target)


def test_chunks_have_a_row_cap(spark, tmp_path):
    path = tmp_path / "chunks"
    sinks.write_parquet_chunked(spark.range(0, 10, 1, 1).toDF("v"), str(path), max_rows=4)
    counts = [pq.ParquetFile(file).metadata.num_rows for file in path.glob("*.parquet")]
    assert sorted(counts) == [2, 4, 4]


def test_date_folders(spark, frame, tmp_path):
    path = tmp_path / "folders"
    sinks.write_date_folders(frame("v int, d date, h int", (1, D1, 5)), str(path), "d", "h")
    assert list(path.glob("yyyy=2025/mm=01/dd=01/hh=05/*.json"))


def test_gathered_folders_have_few_files(spark, tmp_path):
    rows = spark.range(0, 1000, 1, 8).select(F.col("id").alias("v"), (F.col("id") % 3).alias("k"))
    sinks.write_parquet(rows, str(tmp_path / "t"), ["k"], gather=True)
    for folder in (tmp_path / "t").glob("k=*"):
        assert len(list(folder.glob("*.parquet"))) == 1


def test_materialize_kinds(spark, frame, tmp_path):
    rows = stamped(frame, (1, "2025-01-01"))
    for kind in ("ephemeral", "view", "table", "incremental"):
        for _ in range(2):
            kept = sinks.materialize(rows, kind, f"m_{kind}", str(tmp_path / kind))
        assert kept.count() == 1
    assert spark.table("m_view").count() == 1
    with pytest.raises(ValueError):
        sinks.materialize(rows, "table", "m")
    with pytest.raises(ValueError):
        sinks.materialize(rows, "snapshot", "m", str(tmp_path / "s"))


def test_only_complete_days_are_ingested(spark, frame, table):
    batch = frame(DAYS, (10, D1), (30, D2), (40, D3))
    promised = frame("usage_date date, n int", (D1, 1), (D2, 2), (D3, 1))
    audit = sources.landing_audit(batch, promised, promised.select("usage_date"), ["usage_date"], "n")
    assert sinks.ingest_days_if_complete(batch, audit, table) == [D1, D3]
    assert content(spark, table) == [(10, D1), (3, D2), (40, D3)]
    assert sinks.ingest_days_if_complete(batch, audit.where("status = 'short'"), table) == []


def test_a_failed_swap_leaves_the_old_table(spark, frame, tmp_path, monkeypatch):
    from tramline.sinks import tables

    path = str(tmp_path / "swap")
    tables.full_refresh(frame("a int", (1,)), path)
    real = tables.place_of

    class Stubborn:
        def __init__(self, fs):
            self.fs, self.moves = fs, 0

        def __getattr__(self, name):
            return getattr(self.fs, name)

        def rename(self, source, target):
            self.moves += 1
            return False if self.moves == 2 else self.fs.rename(source, target)

    made = {}

    def place(session, where):
        spot, fs = real(session, where)
        return spot, made.setdefault("fs", Stubborn(fs))

    monkeypatch.setattr(tables, "place_of", place)
    with pytest.raises(OSError):
        tables.full_refresh(frame("a int", (2,)), path)
    monkeypatch.undo()
    assert values(spark.read.parquet(path)) == [(1,)]


def test_a_table_set_aside_comes_back(spark, frame, tmp_path):
    from tramline.sinks import tables

    path = tmp_path / "aside"
    tables.full_refresh(frame("a int", (1,)), str(path))
    path.rename(tmp_path / "_aside-0123-old")
    assert tables.restore(spark, str(path)) and values(spark.read.parquet(str(path))) == [(1,)]
    assert not tables.restore(spark, str(path))


def test_values_that_would_change_do_not_fit(spark, frame):
    from pyspark.sql.types import StructType

    from tramline.sinks import accepted, align_by_name, load_continue, rejected

    rows = frame("n double, d timestamp", (3.0, None), (3.7, None), (3e12, None))
    target = StructType.fromDDL("n int, d date")
    loaded = load_continue(rows, target)
    assert values(accepted(loaded)) == [(3, None)] and rejected(loaded).count() == 2
    with pytest.raises(Exception, match="bad value 3.7"):
        align_by_name(rows, target).collect()


def test_many_days_make_few_files(spark, tmp_path):
    from tramline.sinks import append_load

    rows = spark.range(0, 1200, 1, 40).selectExpr("id", "CAST(id % 30 AS INT) AS day")
    append_load(rows, str(tmp_path / "days"), ["day"], gather=True)
    assert len(list((tmp_path / "days").glob("day=*/*.parquet"))) == 30


def test_scratch_of_a_step_goes_with_it(spark):
    from tramline.session import place_of, scratch_path, scratch_scope

    kept = scratch_path(spark, "kept")
    with pytest.raises(ZeroDivisionError), scratch_scope(spark):
        inside = scratch_path(spark, "inside")
        spark.range(3).write.parquet(inside)
        spark.read.parquet(inside).write.parquet(kept)
        assert inside.rpartition("/")[0] != kept.rpartition("/")[0]
        raise ZeroDivisionError
    place, fs = place_of(spark, inside)
    assert not fs.exists(place) and not fs.exists(place.getParent()) and spark.read.parquet(kept).count() == 3
