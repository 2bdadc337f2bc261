from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import STOPPED, plan_of, values
from tramline import schemas, sources
from tramline.sources import paging

AB = schemas.text_fields("a", "b")


def test_json_arrays_as_files_and_as_lines(spark, tmp_path):
    (tmp_path / "file.json").write_text('[\n {"a": "1", "b": null},\n {"b": "y"}\n]')
    rows = sources.scan_json_rows(spark, str(tmp_path / "file.json"), AB, array_files=True)
    assert values(rows) == [("1", None), (None, "y")]
    (tmp_path / "lines.json").write_text('[{"a": "1"}, {"a": "2"}]\n[]\n{"a": "3"}\n')
    rows = sources.scan_json_rows(spark, str(tmp_path / "lines.json"), AB)
    assert values(rows) == [("1", None), ("2", None), ("3", None)]


def test_broken_json_stops_a_strict_scan(spark, tmp_path):
    (tmp_path / "bad.json").write_text('[{"a": "1"}, {"a"')
    with pytest.raises(STOPPED, match="bad.json"):
        sources.scan_json_rows(spark, str(tmp_path), AB, array_files=True).collect()


def test_hourly_files_missing_or_broken_are_skipped(spark, tmp_path):
    for hour in (4, 6, 7):
        folder = tmp_path / "usage_date=2025-01-31" / f"usage_time={hour}"
        folder.mkdir(parents=True)
        whole = f'[{{"a": "{hour}"}}, {{"a": "{hour}x"}}]'
        (folder / "data.json").write_text(whole[:-1] if hour == 6 else whole)
    rows = sources.scan_hourly_json(spark, str(tmp_path), AB)
    day = dt.date(2025, 1, 31)
    assert values(rows.select("usage_date", "usage_time", "a")) == [
        (day, 4, "4"), (day, 4, "4x"), (day, 7, "7"), (day, 7, "7x"),
    ]
    grid = sources.date_hour_spine(
        spark.createDataFrame([(day, day)], "start date, end date")
    ).where("usage_time BETWEEN 4 AND 7")
    promised = grid.withColumn("total", F.lit(2))
    audit = sources.landing_audit(rows, promised, grid, ["usage_date", "usage_time"], "total")
    assert values(audit.select("usage_time", "status")) == [
        (4, "complete"), (5, "short"), (6, "short"), (7, "complete"),
    ]


XML = "<r><list_total_count>{n}</list_total_count>{rows}</r>"


def test_xml_pages(spark, frame):
    two = "<row><a>1</a><b> x &lt; y </b></row><row><b></b></row>"
    pages = frame(
        "p string",
        (XML.format(n=2, rows=two),),
        (XML.format(n=1, rows="<row><a>9</a></row>"),),
        (XML.format(n=0, rows=""),),
        ("<r><RESULT><CODE>INFO-200</CODE></RESULT></r>",),
    )
    assert values(sources.unwrap_xml(pages, "p", AB)) == [("1", " x < y "), ("9", None), (None, None)]
    assert values(sources.xml_totals(pages, "p")) == [(0, False), (1, False), (2, False), (None, True)]


def test_xml_files(spark, tmp_path):
    rows = "<row><a>1</a><b> x </b></row><row><a>2</a><b/></row>"
    (tmp_path / "bus.xml").write_text(XML.format(n=2, rows=rows))
    assert values(sources.scan_xml_rows(spark, str(tmp_path), AB)) == [("1", " x "), ("2", None)]


def test_envelopes(frame):
    answers = frame(
        "id int, p string",
        (1, '{"svc": {"list_total_count": 2500, "row": [{"a": "1"}, {"a": "2", "b": "y"}]}}'),
        (2, '{"svc": {"list_total_count": 0, "row": []}}'),
        (3, '{"RESULT": {"CODE": "INFO-200"}}'),
        (4, '{"svc": {"list_total_count": 5}}'),
    )
    rows = sources.unwrap_json_envelope(answers, "p", "svc", AB, keep=["id"])
    assert values(rows) == [(1, "1", None), (1, "2", "y")]
    totals = sources.envelope_totals(answers, "p", "svc", keep=["id"])
    assert values(totals) == [(1, 2500, False), (2, 0, False), (3, None, True), (4, 5, False)]
    lists = frame("p string", ('{"data": [{"a": "1"}]}',), ("{}",))
    assert values(sources.unwrap_json_list(lists, "p", "data", AB)) == [("1", None)]


def test_unreadable_documents(frame):
    cut = frame("p string", ('{"svc": {"row": [{"a": "1"}',))
    assert sources.unwrap_json_envelope(cut, "p", "svc", AB).count() == 0
    assert values(sources.envelope_totals(cut, "p", "svc")) == [(None, True)]
    bad = frame("p string", ("<r><row><a>1</a>",))
    assert sources.unwrap_xml(bad, "p", AB).count() == 0
    for strict in (
        sources.unwrap_json_envelope(cut, "p", "svc", AB, strict=True),
        sources.unwrap_json_list(cut, "p", "svc", AB, strict=True),
        sources.array_position_seq(cut, "p", AB),
        sources.unwrap_xml(bad, "p", AB, strict=True),
    ):
        with pytest.raises(STOPPED):
            strict.collect()


def pages_by_hand(total: int, size: int) -> list[tuple]:
    return [(s, min(s + size - 1, total)) for s in range(1, total + 1, size)]


@pytest.mark.parametrize("block", [1, 2, 10_000])
def test_page_plan(frame, monkeypatch, block):
    monkeypatch.setattr(paging, "_BLOCK_PAGES", block)
    totals = frame("k string, total int", ("a", 2500), ("b", 0), ("c", 1000), ("d", 1001), ("e", None))
    plan = sources.page_plan(totals)
    for key, total in (("a", 2500), ("b", 0), ("c", 1000), ("d", 1001), ("e", 0)):
        got = plan.where(F.col("k") == key).select("start_index", "end_index")
        assert sorted(map(tuple, got.collect())) == pages_by_hand(total, 1000)


def test_audit_statuses(frame):
    landed = frame("h int", *[(h,) for h in (1, 1, 2, 3, 3, 4)])
    promised = frame("h int, list_total_count int", (1, 2), (2, 5), (3, 1), (4, None), (5, 0), (1, 2))
    grid = frame("h int", *[(h,) for h in range(1, 8)])
    audit = sources.landing_audit(landed, promised, grid, ["h"])
    assert values(audit.select("h", "status")) == [
        (1, "complete"), (2, "short"), (3, "excess"), (4, "unpromised"), (5, "empty"),
        (6, "missing"), (7, "missing"),
    ]
    assert audit.agg(F.sum("landed_rows")).first()[0] == landed.count()
    with pytest.raises(sources.IncompleteLanding):
        sources.require_complete(audit)
    sources.require_complete(audit.where("h IN (1, 5)"))
    with pytest.raises(sources.IncompleteLanding):
        sources.require_complete(audit.where("h IN (1, 5)"), allow_empty=False)


def test_month_bounds_wrap_the_year():
    run = dt.date(2026, 1, 10)
    assert sources.previous_month_bounds(run) == (dt.date(2025, 12, 1), dt.date(2025, 12, 31))
    assert sources.previous_month_bounds(dt.date(2024, 3, 31))[1] == dt.date(2024, 2, 29)


def test_previous_month_strict_needs_every_day(spark, frame):
    days = [(dt.date(2025, 2, day),) for day in range(1, 29)]
    month = frame("d date", *days, (dt.date(2025, 1, 31),), (dt.date(2025, 3, 1),))
    run = dt.date(2025, 3, 6)
    assert sources.previous_month(month, "d", run, strict=True).count() == 28
    lacking = month.where("d <> DATE '2025-02-10'")
    assert sources.previous_month(lacking, "d", run).count() == 27
    with pytest.raises(sources.MissingDays, match="2025, 2, 10"):
        sources.previous_month(lacking, "d", run, strict=True)
    absent = sources.absent_days(lacking, "d", dt.date(2025, 2, 9), dt.date(2025, 2, 11))
    assert values(absent) == [(dt.date(2025, 2, 10),)]


def test_day_scan_prunes_folders(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    rows = frame("d date, v int", *[(dt.date(2025, 1, day), day) for day in range(1, 6)])
    rows.write.partitionBy("d").parquet(path)
    day = sources.scan_parquet_day(spark, path, "d", dt.date(2025, 1, 3))
    assert values(day.select("v")) == [(3,)]
    assert "PartitionFilters: [isnotnull(d" in plan_of(day)
    span = sources.backfill_range(spark.read.parquet(path), "d", dt.date(2025, 1, 2), dt.date(2025, 1, 4))
    assert values(span.select("v")) == [(2,), (3,), (4,)]
    assert "PartitionFilters: [isnotnull(d" in plan_of(span)


def test_sources_by_path_and_by_name(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    frame("v int", (1,)).write.parquet(path)
    frame("v int", (2,)).createOrReplaceTempView("known")
    sources.register_sources(spark, {"one": path, "two": "known"}, prefix="src_")
    assert values(spark.sql("SELECT * FROM src_one UNION ALL SELECT * FROM src_two")) == [(1,), (2,)]
