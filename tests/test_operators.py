from __future__ import annotations

import datetime as dt
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import plan_of, values
from tramline import operators as op


def brute_join(rows: list[tuple], dimension: list[tuple]) -> Counter:
    """Inner join on the first field; null keys match nothing."""
    return Counter(
        (*row, *entry[1:])
        for row in rows
        for entry in dimension
        if row[0] is not None and row[0] == entry[0]
    )


def skewed(seed: int) -> tuple[list[tuple], list[tuple]]:
    """One key and one group of identical rows hold a third of all rows each."""
    draw = random.Random(seed)
    rows = [(7, draw.random()) for _ in range(400)] + [(8, 0.5)] * 400
    rows += [(draw.choice([None, *range(40)]), draw.random()) for _ in range(400)]
    dimension = [(key, f"name {key}") for key in range(5, 45)]
    dimension += [(7, "second"), (7, "third"), (8, "second"), (None, "nobody")]
    return rows, dimension


@pytest.mark.parametrize("share", [0.001, 0.05, 0.4])
def test_skew_join_equals_brute_force(frame, share):
    rows, dimension = skewed(1)
    big = frame("k int, v double", *rows).repartition(6, "v")
    small = frame("k int, name string", *dimension)
    got = Counter(map(tuple, op.skew_join(big, small, ["k"], share).select("k", "v", "name").collect()))
    assert got == brute_join(rows, dimension)


def test_skew_join_on_two_keys(frame):
    big = frame("a string, b string, v int", *[("x", "y", n) for n in range(50)], ("x", None, 1), ("z", "y", 2))
    small = frame("a string, b string, w int", ("x", "y", 1), ("x", "y", 2), ("x", None, 3), ("z", "y", 4))
    got = op.skew_join(big, small, ["a", "b"], share=0.1)
    assert got.count() == 101 and got.where("a = 'z'").select("w").first()[0] == 4


def test_skew_join_spreads_a_hot_key(spark, frame):
    """No task gets more of the hot key than a few shares, copies of one row included."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = frame("k int, v int", *[(1, 0)] * 800, *[(key, key) for key in range(2, 402)])
        big = rows.repartition(16)
        small = frame("k int, w int", *[(key, key) for key in range(402)])
        joined = op.skew_join(big, small, ["k"], share=0.02)
        sizes = joined.where("k = 1").groupBy(F.spark_partition_id().alias("p")).count()
        counts = [row["count"] for row in sizes.collect()]
        assert sum(counts) == 800 and max(counts) <= 300 and len(counts) >= 5
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_slots_are_bounded_by_the_share():
    """However the rows are distributed, all slots together stay below 2 / share."""
    draw = random.Random(3)
    share = 0.01
    for _ in range(50):
        counts = [draw.choice([1, 10, 1000, 100_000]) for _ in range(300)]
        ceiling = sum(counts) * share
        hot = [math.ceil(n / ceiling) for n in counts if n > ceiling]
        assert len(hot) <= 1 / share and sum(hot) <= 2 / share


def test_skew_join_needs_keys_of_one_exact_type(frame):
    big = frame("k int, d double", (1, 1.0))
    with pytest.raises(TypeError):
        op.skew_join(big, frame("k bigint", (1,)), ["k"])
    with pytest.raises(TypeError):
        op.skew_join(big, frame("d double", (1.0,)), ["d"])


def test_attach_broadcasts_only_within_the_bound(frame):
    rows, dimension = skewed(2)
    big, small = frame("k int, v double", *rows), frame("k int, name string", *dimension)
    assert op.fits(small, 44) and not op.fits(small, 43)
    assert op.fits(small, max_bytes=4000) and not op.fits(small, max_bytes=1000)
    assert op.fits(small.limit(0), 0)
    near, far = op.attach(big, small, ["k"]), op.attach(big, small, ["k"], max_rows=10)
    assert "BroadcastHashJoin" in plan_of(near)
    assert "_slot" in plan_of(far)
    assert values(near) == values(far)
    assert Counter(map(tuple, near.select("k", "v", "name").collect())) == brute_join(rows, dimension)


@pytest.mark.parametrize("max_rows", [1000, 1])
def test_join_distinct(frame, max_rows):
    usage = frame("k int, name string", (1, "a"), (1, "a"), (1, "b"), (2, "c"), (3, "d"), (None, "e"))
    places = frame("k int, lat double", (1, 0.5), (1, 0.5), (1, 0.7), (2, None), (4, 1.0), (None, 2.0))
    got = op.join_distinct(usage, places, ["k"], max_rows)
    assert values(got) == values(usage.join(places, "k").distinct())


def test_columns(frame):
    rows = frame("A int, b string", (1, "x"))
    assert op.drop_strict(rows, ["b"]).columns == ["A"]
    with pytest.raises(KeyError):
        op.drop_strict(rows, ["c"])
    assert op.drop_if_exists(rows, "b", "REG_DATE").columns == ["A"]
    assert op.rename_positional(rows, ["x", "y"]).columns == ["x", "y"]
    with pytest.raises(ValueError):
        op.rename_positional(rows, ["x"])
    assert op.rename_map(rows, {"b": "y", "A": "x"}).columns == ["y", "x"]
    assert op.project_columns(rows, "b").columns == ["b"]
    constant = op.literal_columns(rows, {"kind": "BIKE", "address": None})
    assert constant.dtypes[-2:] == [("kind", "string"), ("address", "string")]


def test_stamp_is_the_day_before_in_utc(frame):
    rows = frame("a int", (1,))
    ahead = dt.timezone(dt.timedelta(hours=9))
    for run in (dt.datetime(2025, 3, 1), dt.datetime(2025, 3, 1, 9, tzinfo=ahead)):
        stamped = op.audit_stamp(rows, run)
        assert stamped.columns == ["a", "_updated_at", "_loaded_at"]
        assert stamped.select(F.col("_loaded_at").cast("string")).first()[0] == "2025-02-28 00:00:00"


def test_filters(frame):
    ids = frame("id string, lat double", ("0123", 1.0), ("101", None), (None, 2.0), ("9", 3.0))
    assert values(op.filter_not_like(ids, "id", "0%").select("id")) == [("101",), ("9",)]
    assert op.filter_not_null(ids, "id", "lat").count() == 2
    assert op.require_fields(ids, "id").count() == 3
    assert op.filter_in_list(ids, "id", ["9", "8"]).count() == 1


def test_high_water_mark(spark, frame, tmp_path):
    stamp = "timestamp'2025-01-0{} 00:00:00.123456'"
    rows = spark.sql(f"SELECT explode(array({', '.join(stamp.format(n) for n in (1, 2, 3))}, null)) AS s")
    mark = op.high_water_mark(rows.where(f"s <= {stamp.format(2)}"), "s")
    assert mark == "2025-01-02 00:00:00.123456"
    assert op.filter_hwm(rows, "s", mark).count() == 1
    assert op.filter_hwm(rows, "s", None).count() == 3
    assert op.high_water_mark(rows.limit(0), "s") is None
    path = str(tmp_path / "t")
    rows.write.parquet(path)
    assert "GreaterThan(s," in plan_of(op.filter_hwm(spark.read.parquet(path), "s", mark))


def test_sets(frame):
    one, two = frame("d date", (dt.date(2025, 1, 1),)), frame("d date", (dt.date(2025, 1, 1),), (None,))
    assert op.union_distinct(one, two).count() == 2
    with pytest.raises(TypeError):
        op.union_distinct(one, frame("d string", ("2025-01-01",)))
    pairs = frame("a int, b int", (1, 1), (1, 1), (1, 2), (None, 2), (None, 2))
    assert op.distinct_pairs(pairs, "a", "b").count() == op.group_ordinals(pairs, "a", "b").count() == 3
    ints, texts = frame("id int, n string", (1, "x")), frame("n string, id string", ("y", "A1"))
    both = op.union_all_conformed([ints, texts], {"id": "string", "n": "string"})
    assert values(both) == [("1", "x"), ("A1", "y")]
    assert values(op.sample_head(pairs, F.col("b").desc(), "a", n=1)) == [(None, 2)]


@pytest.mark.parametrize("max_rows", [500_000, 0])
@pytest.mark.parametrize("kinds", [("int", "bigint"), ("double", "double")])
def test_key_types_are_checked_at_any_size(frame, max_rows, kinds):
    from tramline.operators.joins import attach, join_distinct

    one = 1.0 if "double" in kinds else 1
    rows, dimension = frame(f"k {kinds[0]}", (one,)), frame(f"k {kinds[1]}, v int", (one, 2))
    for join in (attach, join_distinct):
        with pytest.raises(TypeError):
            join(rows, dimension, ["k"], max_rows)
