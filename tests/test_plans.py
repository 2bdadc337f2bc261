"""The jobs on small fixtures with hand-computed results."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import STOPPED, plan_of, values
from tramline import plans, schemas, sources
from tramline.operators import one_set
from tramline.functions import surrogate_key
from tramline.sources.audit import IncompleteLanding

RUN = dt.datetime(2025, 2, 1)
DAY = dt.date(2025, 1, 31)


def rental(**changes) -> dict:
    row = dict(
        RENT_DT="2025-01-31", RENT_HR="5", RENT_ID="102", RENT_NM="102. A.B", RENT_TYPE="DAY",
        GENDER_CD="M", AGE_TYPE="20s", USE_CNT="3", EXER_AMT="3.7", CARBON_AMT="0.5",
        MOVE_METER="10.5", MOVE_TIME="7", START_INDEX="1", END_INDEX="1000", RNUM="1",
    )
    return {**row, **changes}


def rentals(spark, *rows: dict):
    return spark.createDataFrame(
        [tuple(row[name] for name in schemas.RAW_BIKE_USAGE.names) for row in rows],
        schemas.RAW_BIKE_USAGE,
    )


def test_clean_bike_usage_is_lenient(spark):
    raw = rentals(
        spark,
        rental(),
        rental(RENT_DT="20250131", RENT_ID=" 0102 ", RENT_NM="nodot", USE_CNT="x", EXER_AMT="x", MOVE_TIME=None),
        rental(RENT_ID="ST-9", RENT_NM=None, RENT_HR="", CARBON_AMT=None, MOVE_METER="n/a"),
    )
    got = plans.clean_bike_usage(raw, RUN)
    picked = got.select(
        "usage_date", "usage_time", "station_id", "station_name", "usage_count", "calories",
        "carbon_emission", "distance", "duration", F.col("_loaded_at").cast("string"),
    )
    stamp = "2025-01-31 00:00:00"
    assert [tuple(row) for row in picked.collect()] == [
        (DAY, 5, "102", "A", 3, 3.7, 0.5, 10.5, 7, stamp),
        (DAY, 5, "0102", None, None, None, 0.5, 10.5, None, stamp),
        (DAY, None, None, None, 3, 3.7, None, None, 7, stamp),
    ]
    with pytest.raises(PySparkException, match="not a date"):
        plans.clean_bike_usage(rentals(spark, rental(RENT_DT="soon")), RUN).collect()


def test_clean_bike_usage_strict_and_bulk(spark):
    raw = rentals(spark, rental(EXER_AMT="-3.7"), rental(EXER_AMT=None, CARBON_AMT=None))
    columns = ["station_id", "station_name", "calories", "carbon_emission"]
    strict = plans.clean_bike_usage_strict(raw).select(*columns)
    assert [tuple(row) for row in strict.collect()] == [
        ("102", "102. A.B", -3, 0.5), ("102", "102. A.B", 0, None),
    ]
    bulk = plans.clean_bike_usage_bulk(raw).select(*columns)
    assert [tuple(row) for row in bulk.collect()] == [(102, "A.B", -3, 0.5), (102, "A.B", 0, None)]
    for change in ({"USE_CNT": "3.7"}, {"MOVE_TIME": None}, {"MOVE_METER": "x"}, {"RENT_HR": ""}):
        with pytest.raises(PySparkException):
            plans.clean_bike_usage_strict(rentals(spark, rental(**change))).collect()
    with pytest.raises(PySparkException):
        plans.clean_bike_usage_bulk(rentals(spark, rental(RENT_ID="ST-9"))).collect()


def test_clean_places(spark):
    bike = spark.createDataFrame(
        [(" 0102 ", "a", None, "37.5", "0.0"), ("7", None, "b", None, "127")], schemas.RAW_BIKE_STATION
    )
    assert values(plans.clean_bike_station(bike)) == [("0102", "a", None, 37.5, None), ("7", None, "b", None, 127.0)]
    with pytest.raises(PySparkException):
        row = [("x", "a", "b", "1", "2")]
        plans.clean_bike_station(spark.createDataFrame(row, schemas.RAW_BIKE_STATION)).collect()
    bus = spark.createDataFrame(
        [("N1", "123", "Stop", "37.5", "127.0", "T"), ("N2", None, "Stop", "0", "0.0", None)], schemas.RAW_BUS_STOP
    )
    assert values(plans.clean_bus_stop(bus)) == [
        ("N1", "00123", "Stop", 37.5, 127.0, "T"), ("N2", None, "Stop", None, None, None),
    ]


def metro(**changes) -> dict:
    return {"역명": "A", "위도": "37.5", "경도": 127.0, "호선": "1", "고유역번호(외부역코드)": 150, **changes}


def test_clean_metro_station_numbers_before_it_drops(frame):
    lacking = metro()
    del lacking["위도"]
    records = [metro(**{"고유역번호(외부역코드)": 0}), lacking, metro(**{"고유역번호(외부역코드)": "0"})]
    array = frame("value string", (json.dumps(records, ensure_ascii=False),))
    raw = sources.array_position_seq(array, "value", schemas.RAW_METRO_STATION)
    got = plans.clean_metro_station(raw, DAY).select("seq_no", "external_station_code", "latitude", "line_no")
    assert values(got) == [(1, "-1", 37.5, "1"), (3, "0", 37.5, "1")]


def test_clean_usage_of_bus_and_subway(spark, frame):
    bus = spark.createDataFrame(
        [("20250131", "R", "1", "Line 1", "N1", "123", "Stop", "12", "x", "20250203")], schemas.RAW_BUS_USAGE
    )
    got = plans.clean_bus_usage(bus, RUN).drop("_updated_at", "_loaded_at")
    assert values(got) == [(DAY, "1", "Line 1", "N1", "123", "Stop", 12, None)]
    subway = frame("USE_YMD string, REG_DATE string", ("20250131", "x"))
    for raw in (subway, subway.drop("REG_DATE")):
        assert plans.clean_subway_usage(raw, RUN).columns == ["USE_YMD", "_loaded_at"]


# --- models -----------------------------------------------------------------------------------


def usage(frame, *rows):
    """(day, station id, name, gender, age group, count, stamp) -> staged bike usage"""
    made = frame(
        "usage_date date, station_id string, station_name string, gender string, age_group string, "
        "usage_count int, s string",
        *rows,
    )
    other = {"usage_time": "int", "rental_type_code": "string", "calories": "double",
             "carbon_emission": "double", "distance": "double", "duration": "int"}
    filled = made.withColumns({name: F.lit(None).cast(kind) for name, kind in other.items()})
    return plans.src_bike_usage(filled.withColumn("_loaded_at", F.col("s").cast("timestamp")))


def test_staging_filters(frame):
    got = usage(frame, (DAY, "0123", "t", "M", "20", 1, None), (DAY, "101", "a", "M", "20", 1, None),
                (DAY, None, "n", "M", "20", 1, None), (None, "102", "b", "M", "20", 1, None))
    assert values(got.select("station_id")) == [("101",)]
    raw = frame(
        "use_ymd string, line string, station string, gt_on int, gt_off int, _loaded_at timestamp",
        ("20250131", "1호선", "S", 1, 2, None), ("2025-01-31", None, "S", 1, 2, None), (None, "1호선", "S", 1, 2, None),
    )
    assert values(plans.src_subway_usage(raw).select("usage_date", "source_station_id")) == [
        ("2025-01-31", "1호선 - S"), ("2025-01-31", None),
    ]


def test_dim_date_unites_dates_of_different_types(frame):
    dates, texts = frame("usage_date date", (DAY,), (DAY,)), frame("usage_date string", ("2025-01-31",), ("2025-02-01",))
    got = plans.dim_date(dates, dates, texts)
    assert values(got) == [
        (dt.date(2025, 1, 31), 2025, 1, 31, "금요일", False, 1, "2025-01"),
        (dt.date(2025, 2, 1), 2025, 2, 1, "토요일", True, 1, "2025-02"),
    ]
    with pytest.raises(PySparkException, match="not a date: 20251331"):
        plans.dim_date(dates, dates, frame("usage_date string", ("20251331",))).collect()


@pytest.fixture
def star(frame):
    """Station 102 is known under two names, station 9 has no location."""
    bike = usage(
        frame,
        (DAY, "102", "A", "M", "20", 1, "2025-01-31"),
        (DAY, "102", "B", None, "20", 2, "2025-01-31"),
        (DAY, "102", "A", "F", "30", 4, None),
        (DAY, "9", "C", "M", "20", 8, "2025-01-31"),
        (dt.date(2025, 2, 1), "102", "A", "M", "20", 16, "2025-02-01"),
    )
    bus = frame("usage_date date, node_id string, route_number string, boarding_count int, getoff_count int, "
                "_loaded_at timestamp", (DAY, "N1", "1", 5, None, RUN), (DAY, "N2", "1", 6, 7, RUN))  # fmt: skip
    subway = frame(
        "usage_date string, line string, station string, source_station_id string, gt_on int, gt_off int, "
        "_loaded_at timestamp",
        ("2025-01-31", "1호선", "S", "1호선 - S", None, 3, RUN),
        ("2025-01-31", "9호선", "S", "9호선 - S", 1, 1, RUN),
    )
    places = {
        "bike_locations": frame("station_id string, address1 string, latitude double, longitude double",
                                ("0102", "Main St", 1.0, 2.0), ("55", "Side St", 1.0, 2.0)),
        "bus_locations": frame("node_id string, stop_name_kr string, latitude double, longitude double",
                               ("N1", "Stop", 1.0, 2.0)),
        "subway_locations": frame("line_no string, station_name string, latitude double, longitude double",
                                  ("1", "S", 1.0, 2.0), ("9", "S", 1.0, 2.0)),
    }
    return {"bike": bike, "bus": bus, "subway": subway, **places}


@pytest.mark.parametrize("max_rows", [1000, 0])
def test_dim_station(star, max_rows):
    got = plans.dim_station(**star, max_rows=max_rows)
    assert values(got.select("source_station_id", "station_name", "station_type", "address", "city")) == [
        ("102", "A", "BIKE", "Main St", "서울"),
        ("102", "B", "BIKE", "Main St", "서울"),
        ("1호선 - S", "S", "SUBWAY", None, "서울"),
        ("N1", "Stop", "BUS", None, "서울"),
    ]
    key = surrogate_key(F.col("source_station_id"), F.col("station_name"))
    assert got.where(F.col("station_id") != key).count() == 0
    assert got.select("station_id").distinct().count() == 4
    assert values(plans.fan_out(got)) == [("BIKE", "102", 2)]
    single = plans.dim_station(**star, dedupe=True)
    assert single.count() == 3 and plans.fan_out(single).count() == 0


@pytest.mark.parametrize("max_rows", [1000, 0])
def test_facts(star, max_rows):
    dates = plans.dim_date(star["bike"], star["bus"], star["subway"])
    stations, users = plans.dim_station(**star), plans.dim_user(star["bike"])
    assert values(users.select("gender", "age_group")) == [("F", "30"), ("M", "20"), (None, "20")]
    bike = plans.fact_bike_usage(star["bike"], dates, stations, users, max_rows=max_rows)
    assert sorted(row.usage_count for row in bike.collect()) == [1, 1, 16, 16]
    newer = plans.fact_bike_usage(star["bike"], dates, stations, users, "2025-01-31 00:00:00", max_rows)
    assert sorted(row.usage_count for row in newer.collect()) == [16, 16]
    bus = plans.fact_bus_usage(star["bus"], dates, stations, max_rows=max_rows)
    assert values(bus.select("boarding_count", "getoff_count", "date_id")) == [(5, None, DAY)]
    subway = plans.fact_subway_usage(star["subway"], dates, stations, max_rows=max_rows)
    assert values(subway.select("line", "boarding_count", "getoff_count", "date_id")) == [("1호선", 0, 3, DAY)]


# --- the warehouse ------------------------------------------------------------------------------


def write_lines(folder, name, rows):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(row, ensure_ascii=False) for row in rows))
    return str(folder)


def bus_xml(*rows: dict) -> str:
    items = "".join("<row>" + "".join(f"<{k}>{v}</{k}>" for k, v in row.items()) + "</row>" for row in rows)
    return f"<CardBus><list_total_count>{len(rows)}</list_total_count>{items}</CardBus>"


@pytest.fixture
def loaded(spark, tmp_path):
    house = plans.Warehouse(spark, str(tmp_path / "house"))
    land = tmp_path / "landing"
    bike = write_lines(land / "bike", "a.json", [[rental(), rental(USE_CNT="9", GENDER_CD=None)], rental(RENT_ID="0102")])
    house.load_bike_day(bike, RUN)
    (land / "bus").mkdir()
    (land / "bus" / "bus.xml").write_text(
        bus_xml(dict(USE_YMD="20250131", RTE_NO="1", RTE_NM="L", STOPS_ID="N1", STOPS_ARS_NO="123",
                     SBWY_STNS_NM="Stop", GTON_TNOPE="5", GTOFF_TNOPE="6"))
    )
    house.load_bus_day(str(land / "bus"), RUN)
    subway = spark.createDataFrame(
        [("20250130", "1호선", "S", 1, 2, "x", dt.date(2025, 1, 30)), ("20250131", "1호선", "S", 3, None, "x", DAY)],
        "USE_YMD string, LINE string, STATION string, GT_ON int, GT_OFF int, REG_DATE string, usage_date date",
    )
    subway.write.partitionBy("usage_date").parquet(str(land / "subway"))
    house.load_subway_month(str(land / "subway"), RUN)
    house.refresh_bike_locations(
        write_lines(land / "bl", "a.json", [dict(RENT_NO="102", STA_ADD1="Main St", STA_LAT="1.5", STA_LONG="2")])
    )
    house.refresh_bus_stops(
        write_lines(land / "st", "a.json", [dict(NODE_ID="N1", STOPS_NO="123", STOPS_NM="Stop", YCRD="1", XCRD="2")])
    )
    (land / "metro").mkdir()
    (land / "metro" / "m.json").write_text(json.dumps([metro(역명="S")], ensure_ascii=False))
    house.refresh_metro_stations(str(land / "metro"), DAY)
    return house, land


def test_from_landing_to_facts(spark, loaded):
    house, land = loaded
    house.build_dimensions()
    house.append_facts()
    assert house.read("dim_date").count() == 2
    assert house.read("dim_station").count() == 3
    bike = house.read("fact_bike_usage")
    assert values(bike.select("usage_count", "date_id")) == [(3, DAY)]
    assert house.read("fact_bus_usage").count() == 1
    assert values(house.read("fact_subway_usage").select("boarding_count", "getoff_count")) == [(1, 2), (3, 0)]

    # Everything can run again: days are replaced, and facts take nothing they already have.
    house.load_bike_day(str(land / "bike"), RUN)
    house.load_subway_month(str(land / "subway"), RUN)
    house.build_dimensions()
    assert house.append_fact_bike_usage() == "2025-01-31 00:00:00"
    house.append_facts()
    assert house.read("bike_usage").count() == 3
    assert house.read("subway_usage").count() == 2
    assert house.read("fact_bike_usage").count() == 1
    assert house.read("fact_subway_usage").count() == 2

    # The next day is appended.
    next_day = [rental(RENT_DT="2025-02-01", USE_CNT="7")]
    house.load_bike_day(write_lines(land / "bike2", "a.json", next_day), dt.datetime(2025, 2, 2))
    house.build_dimensions()
    house.append_fact_bike_usage()
    assert values(house.read("fact_bike_usage").select("usage_count")) == [(3,), (7,)]


def test_subway_ranges(spark, loaded):
    house, land = loaded
    start, end = dt.date(2025, 1, 29), DAY
    landed = {row.usage_date for row in house.read("subway_usage").select("usage_date").distinct().collect()}
    absent = [day for day in (start, dt.date(2025, 1, 30), end) if day not in landed]
    assert absent and house.load_subway_range(str(land / "subway"), start, end, RUN) == dict.fromkeys(absent, "not landed")
    assert house.read("subway_usage").count() == 2
    house.load_subway_range(str(land / "subway"), start, end, RUN, append=True)
    assert house.read("subway_usage").count() == 4
    with pytest.raises(sources.MissingDays):
        house.load_subway_month(str(land / "subway"), RUN, strict=True)


def test_places_survive_a_bad_landing(spark, loaded):
    house, land = loaded
    empty = write_lines(land / "none", "a.json", [[]])
    with pytest.raises(sources.IncompleteLanding):
        house.refresh_bike_locations(empty)
    (land / "cut").mkdir()
    (land / "cut" / "m.json").write_text(json.dumps([metro()])[:-1])
    with pytest.raises(STOPPED):
        house.refresh_metro_stations(str(land / "cut"), DAY)
    assert house.read("bike_location").count() == house.read("subway_location").count() == 1


def test_incomplete_days_are_left_alone(spark, loaded):
    house, land = loaded
    days = [DAY, dt.date(2025, 2, 1)]
    landed = [rental(RENT_DT=day.isoformat(), RENT_HR=str(hour), USE_CNT="50") for day in days for hour in range(24)]
    landing = write_lines(land / "two_days", "a.json", landed[:-1])
    promised = sources.date_hour_spine(
        spark.createDataFrame([tuple(days)], "start date, end date")
    ).withColumn("list_total_count", F.lit(1))
    assert house.load_bike_days_if_complete(landing, promised, RUN) == [DAY]
    assert house.read("bike_usage").agg(F.sum("usage_count")).first()[0] == 24 * 50
    write_lines(land / "two_days", "b.json", landed[-1:])
    assert house.load_bike_days_if_complete(landing, promised, RUN) == days
    assert house.read("bike_usage").count() == 48


def test_hour_files(spark, tmp_path):
    house = plans.Warehouse(spark, str(tmp_path / "house"))

    def land(hour, rows, cut=None):
        folder = tmp_path / "land" / f"usage_time={hour:02d}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / "data.json").write_text(json.dumps(rows)[:cut])

    land(4, [rental(RENT_HR="4"), rental(RENT_HR="4", EXER_AMT=None), rental(RENT_HR="4", USE_CNT="many")])
    land(5, [rental(RENT_HR="5")])
    for _ in range(2):
        assert house.load_bike_day_by_hour(str(tmp_path / "land"), RUN) == []
    shown = ("usage_time", "station_name", "calories", "usage_date")
    whole = [(4, "102. A.B", 0, DAY), (4, "102. A.B", 3, DAY), (5, "102. A.B", 3, DAY)]
    assert values(house.read("bike_usage_by_hour").select(*shown)) == whole
    rejects = spark.read.parquet(house.path("bike_usage_by_hour_rejects")).collect()
    assert [r["_rejected_columns"] for r in rejects] == [["usage_count"]] and '"many"' in rejects[0]["_raw"]

    land(5, [rental(RENT_HR="5")], cut=-3)
    with pytest.raises(IncompleteLanding, match="usage_time=05"):
        house.load_bike_day_by_hour(str(tmp_path / "land"), RUN)
    assert values(house.read("bike_usage_by_hour").select(*shown)) == whole
    skipped = house.load_bike_day_by_hour(str(tmp_path / "land"), RUN, partial=True)
    assert len(skipped) == 1 and "usage_time=05" in skipped[0]
    assert house.read("bike_usage_by_hour").count() == 2


@pytest.mark.parametrize(
    "page",
    [
        "<RESULT><CODE>ERROR-300</CODE></RESULT>",
        "<r><list_total_count>5</list_total_count><row><USE_YMD>20250131</USE_YMD></row></r>",
    ],
)
def test_an_incomplete_bus_landing_leaves_the_day(spark, loaded, page):
    house, land = loaded
    before = values(house.read("bus_usage"))
    (land / "bus" / "bus.xml").write_text(page)
    with pytest.raises(IncompleteLanding):
        house.load_bus_day(str(land / "bus"), RUN)
    assert values(house.read("bus_usage")) == before


def test_bike_history(spark, loaded):
    house, land = loaded
    raw = rentals(spark, rental(RENT_DT="2025-01-01"), rental(RENT_DT="2025-01-02", EXER_AMT="x"))
    house.stage_bike_history(raw, str(land / "parts"), RUN)
    house.load_bike_history(str(land / "parts"))
    assert house.read("bike_usage").count() == 5
    old = house.read("bike_usage").where("usage_date < DATE '2025-01-10'")
    assert values(old.select("station_id", "station_name", "calories")) == [("102", "A.B", 0.0), ("102", "A.B", 3.0)]


def test_dimensions_read_each_usage_table_once(spark, star):
    """All keys come from one scan, and the dimensions are those of the usage rows."""
    for kind, sets in plans.USAGE_SETS.items():
        keys = plans.usage_keys(kind, star[kind])
        plan = plan_of(keys)
        physical = plan[plan.index("== Physical Plan ==") :]
        assert physical.count("Scan") == 1 and physical.count("Expand") == 1
        for place, columns in enumerate(sets):
            assert values(one_set(keys, place, *columns)) == values(star[kind].select(*columns).distinct())
    keys = {kind: plans.usage_keys(kind, star[kind]) for kind in plans.USAGE_SETS}
    made = plans.dimensions(keys, {name: rows for name, rows in star.items() if name.endswith("_locations")})
    assert values(made["dim_date"]) == values(plans.dim_date(star["bike"], star["bus"], star["subway"]))
    assert values(made["dim_user"]) == values(plans.dim_user(star["bike"]))
    assert values(made["dim_station"]) == values(plans.dim_station(**star))


def test_increment_filters_the_usage_scan(spark, loaded):
    """The stamp literal reaches the Parquet scan below the joins; usage rows are not shuffled."""
    house, _ = loaded
    house.build_dimensions()
    rows = plans.fact_bike_usage(
        house.staged()["bike"], house.read("dim_date"), house.read("dim_station"), house.read("dim_user")
    )
    plan = plan_of(rows.where(F.col("_loaded_at") > F.lit("2025-01-31 00:00:00").cast("timestamp")))
    assert "GreaterThan(_loaded_at," in plan
    physical = plan[plan.index("== Physical Plan ==") :]
    assert physical.count("BroadcastHashJoin") == 3 and "hashpartitioning" not in physical
