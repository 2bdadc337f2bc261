"""Ranges told by footers, complete bus days, and the pages that never came."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql.types import StructType

from conftest import values

from tramline import plans, sources
from tramline.sources.census import landed_days, widens

D = [dt.date(2025, 1, n) for n in range(1, 11)]
WANTED = "line string, n bigint, note string"
RUN = dt.datetime(2025, 2, 1, 6)


@pytest.fixture
def landing(spark, tmp_path):
    """Each day of another kind; the last was not landed."""
    path = tmp_path / "landing"

    def land(day, schema, *rows):
        folder = path / f"usage_date={day.isoformat()}"
        spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(str(folder))
        return folder

    land(D[0], "line string, n int, note string", ("a", 1, "x"))
    land(D[1], "line string, n bigint, note string", ("b", 2**40, "x"))
    land(D[2], "line string, n string, note string", ("c", "3", "x"))
    folder = land(D[3], "line string, n int, note string", ("d", 4, "x"))
    whole = next(folder.glob("*.parquet"))
    (folder / "part-cut.parquet").write_bytes(whole.read_bytes()[:-9])
    land(D[4], "line string, n int, note string", ("e", 5, "x"))
    land(D[4], "line string, n bigint, note string, more double", ("e", 6, "x", 1.0))  # two schemas in one day
    land(D[5], "line string, n smallint", ("f", 6))  # no note
    land(D[6], "line string, note string", ("g", "x"))  # no n
    land(D[7], "NOTE string, N int, Line string", ("x", 8, "h"))  # other case and order
    land(D[8], "line string, n double, note string", ("i", 9.0, "x"))
    return str(path)


def test_a_range_of_many_kinds(spark, landing):
    wanted = StructType.fromDDL(WANTED)
    rows, left_out = sources.read_range(spark, landing, "usage_date", D[0], D[9], wanted, optional=["note"])
    assert rows.dtypes == [("line", "string"), ("n", "bigint"), ("note", "string"), ("usage_date", "date")]
    assert values(rows) == [
        ("a", 1, "x", D[0]), ("b", 2**40, "x", D[1]), ("e", 5, "x", D[4]), ("e", 6, "x", D[4]), ("f", 6, None, D[5]), ("h", 8, "x", D[7]),
    ]
    assert sorted(left_out) == [D[2], D[3], D[6], D[8], D[9]]
    assert left_out[D[2]] == "n: string is no bigint" and left_out[D[8]] == "n: double is no bigint"
    assert left_out[D[6]] == "n: no such column" and left_out[D[9]] == "not landed"
    assert "part-cut.parquet" in left_out[D[3]]
    strict = sources.read_range(spark, landing, "usage_date", D[0], D[9], wanted)[1]
    assert strict[D[5]] == "note: no such column"


def test_ranges_of_nothing(spark, landing):
    wanted = StructType.fromDDL(WANTED)
    late = [dt.date(2026, 1, 1), dt.date(2026, 1, 2)]
    rows, left_out = sources.read_range(spark, landing, "usage_date", *late, wanted)
    assert rows.count() == 0 and left_out == dict.fromkeys(late, "not landed")
    assert [found.day for found in landed_days(spark, landing, "usage_date", D[0], D[1])] == D[:2]
    assert landed_days(spark, landing + "-none", "usage_date", D[0], D[1]) == []


@pytest.mark.parametrize(
    "have,want,fits",
    [
        ("int", "bigint", True), ("bigint", "int", False), ("tinyint", "smallint", True), ("int", "double", True), ("bigint", "double", False),
        ("float", "double", True), ("double", "float", False), ("string", "int", False), ("int", "string", False), ("date", "timestamp_ntz", True),
        ("int", "decimal(10,0)", True), ("int", "decimal(10,1)", False), ("decimal(5,2)", "decimal(7,3)", True), ("decimal(5,2)", "decimal(5,3)", False),
        ("smallint", "float", True), ("int", "float", False), ("boolean", "int", False), ("string", "string", True),
    ],
)
def test_what_widens(have, want, fits):
    kinds = [StructType.fromDDL(f"x {kind}")[0].dataType for kind in (have, want)]
    assert widens(*kinds) == fits


def test_a_subway_range_leaves_bad_days_out(spark, tmp_path):
    house, landing = plans.Warehouse(spark, str(tmp_path / "house")), str(tmp_path / "subway")
    for at, kind in enumerate(["int", "bigint", "string", "int"]):
        folder = f"{landing}/usage_date={D[at].isoformat()}"
        spark.sql(f"SELECT '{D[at]:%Y%m%d}' USE_YMD, '1호선' LINE, 'S' STATION, CAST({at} AS {kind}) GT_ON, CAST(1 AS {kind}) GT_OFF").write.parquet(folder)
    (tmp_path / "subway" / f"usage_date={D[3].isoformat()}" / "part-x.parquet").write_bytes(b"PAR1 cut off")
    left_out = house.load_subway_range(landing, D[0], D[4], RUN)
    assert sorted(left_out) == D[2:5] and left_out[D[4]] == "not landed" and "GT_ON" in left_out[D[2]]
    assert values(house.read("subway_usage").select("usage_date", "gt_on")) == [(D[0], 0), (D[1], 1)]
    # A day that went bad keeps what it had.
    (tmp_path / "subway" / f"usage_date={D[0].isoformat()}" / "part-x.parquet").write_bytes(b"PAR1 cut off")
    assert D[0] in house.load_subway_range(landing, D[0], D[1], RUN)
    assert house.read("subway_usage").count() == 2


# --- bus days


def page(day, first, last, total, root="CardBus"):
    rows = "".join(
        f"<row><USE_YMD>{day:%Y%m%d}</USE_YMD><RTE_NO>{n}</RTE_NO><STOPS_ID>N</STOPS_ID><GTON_TNOPE>{n}</GTON_TNOPE></row>"
        for n in range(first, last + 1)
    )
    promise = "" if total is None else f"<list_total_count>{total}</list_total_count>"
    return f"<{root}>{promise}{rows}</{root}>"


def test_bus_days_are_loaded_if_complete(spark, tmp_path):
    house, land = plans.Warehouse(spark, str(tmp_path / "house")), tmp_path / "bus"
    land.mkdir()
    pages = {
        "a1": page(D[0], 1, 3, 5), "a2": page(D[0], 4, 5, 5),
        "b1": page(D[1], 1, 3, 7), "b3": page(D[1], 7, 7, 7),  # a page is missing
        "c1": page(D[2], 1, 3, 5), "c2": page(D[2], 4, 5, 5), "c3": page(D[2], 4, 5, 5),  # a page came twice
        "d1": page(D[3], 1, 3, 5), "d2": page(D[3], 4, 5, None),  # a page without its total
        "e1": page(D[4], 1, 3, 5), "e2": page(D[4], 4, 5, 6),  # totals differ
        "x": "<RESULT><CODE>ERROR-300</CODE></RESULT>", "y": "not xml <",
    }
    for name, text in pages.items():
        (land / f"{name}.xml").write_text(text)
    empty = land / f"usage_date={D[5].isoformat()}"
    empty.mkdir()
    (empty / "f.xml").write_text(page(D[5], 1, 0, 0))
    both = str(land) + "/{*.xml,*/*.xml}"
    assert house.load_bus_days_if_complete(both, RUN) == [D[0], D[5]]
    assert values(house.read("bus_usage").select("usage_date", "boarding_count")) == [(D[0], n) for n in range(1, 6)]
    (land / "b2.xml").write_text(page(D[1], 4, 6, 7))
    (land / "c3.xml").unlink()
    (land / "a2.xml").unlink()
    assert house.load_bus_days_if_complete(str(land / "*.xml"), RUN) == [D[1], D[2]]
    assert house.read("bus_usage").count() == 5 + 7 + 5
    assert house.load_bus_days_if_complete(str(land / "x.xml"), RUN) == []


# --- missing pages


def brute_missing(totals, landed):
    result = []
    for key, total in totals.items():
        came = {n for k, a, b in landed if k == key for n in range(max(a, 1), b + 1)}
        start = None
        for row in range(1, total + 2):
            gone = row <= total and row not in came
            if gone and start is None:
                start = row
            elif not gone and start is not None:
                result.append((key, start, row - 1))
                start = None
    return sorted(result, key=repr)


PAGES = st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(-2, 60), st.integers(-2, 70)), max_size=12)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(totals=st.dictionaries(st.sampled_from(["a", "b", "c", None]), st.integers(0, 60)), landed=PAGES)
def test_missing_pages_are_those_of_brute_force(spark, totals, landed):
    have = spark.createDataFrame([*totals.items()], "key string, total int")
    came = spark.createDataFrame(landed, "key string, start_index int, end_index bigint")
    assert values(sources.missing_pages(have, came, ["key"])) == brute_missing(totals, landed)


def test_a_huge_gap_is_one_row(spark, frame):
    have = frame("day string, hour int, total bigint", ("x", 1, 10**15), ("x", 2, 5))
    came = frame("day string, hour int, start_index bigint, end_index bigint", ("x", 1, 1001, 2000), ("x", 2, 1, 5))
    assert values(sources.missing_pages(have, came, ["day", "hour"])) == [("x", 1, 1, 1000), ("x", 1, 2001, 10**15)]


def test_plan_and_gaps_meet(spark, frame):
    """What is missing of a plan's pages is the pages that were left out."""
    have = frame("day string, total bigint", ("x", 25_500))
    plan = [tuple(row) for row in sources.page_plan(have).select("day", "start_index", "end_index").collect()]
    random.Random(1).shuffle(plan)
    came = spark.createDataFrame(plan[5:], "day string, start_index bigint, end_index bigint")
    gaps = values(sources.missing_pages(have, came, ["day"]))
    assert {n for _, a, b in gaps for n in range(a, b + 1)} == {n for _, a, b in plan[:5] for n in range(a, b + 1)}
