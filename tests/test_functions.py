"""Every edge row of the cleaning rules, with hand-computed results."""

from __future__ import annotations

import datetime as dt
import hashlib
from decimal import Decimal
from functools import partial

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tramline import functions as fx


def apply(frame, kind, rule, *inputs):
    rows = frame(f"n int, c {kind}", *enumerate(inputs))
    return [row.r for row in rows.select("n", rule(F.col("c")).alias("r")).orderBy("n").collect()]


def fails(frame, kind, rule, *inputs):
    with pytest.raises(PySparkException):
        apply(frame, kind, rule, *inputs)


TEXT_RULES = [
    (fx.name_split_second, ["102. A.B", "nodot", None, "7.", "1.　X \t.y"], ["A", None, None, "", "X"]),
    (fx.name_strip_prefix, ["102. A.B", "nodot", None, "1.2.C", "x1.A"], ["A.B", "nodot", None, "2.C", "x1.A"]),
    (fx.strip_ws, [" a b\t\r\n", "　 x ", "", None], ["a b", "x", "", None]),
    (fx.zfill, ["123", "1234567", None, "", "-12", "+1"], ["00123", "1234567", None, "00000", "-0012", "+0001"]),
    (fx.normalize_compact_date, ["20250131", "2025-01-31", "20251331", "2025013", None],
     ["2025-01-31", "2025-01-31", "20251331", "2025013", None]),
    (fx.coerce_int, ["3", "x", "", None, " 4 ", "5.0", "1e3", "3d", "nan", "9007199254740993"],
     [3, None, None, None, 4, 5, 1000, None, None, 9007199254740993]),
    (fx.coerce_double, ["3.5", "x", "", None, "-.5", "2.", "3f", "0x1p3", "NaN", "1E-2", "1e309", "9" * 309, "0" * 310 + "1", "-inf", " inf"],
     [3.5, None, None, None, -0.5, 2.0, None, None, None, 0.01, None, None, 1.0, float("-inf"), None]),
    (fx.coerce_int_or_zero, ["3.7", "-3.7", "x", None, ""], [3, -3, 0, 0, 0]),
    (fx.cast_int_strict, ["3", " -4 "], [3, -4]),
    (fx.cast_double_strict, ["3.5", None, "7"], [3.5, None, 7.0]),
    (fx.to_date_strict, ["20250131", "2025-01-31", "2025-01-31 05:00:00", None],
     [dt.date(2025, 1, 31)] * 3 + [None]),
    (fx.falsy_text, ["0", "", None, "150"], ["0", "-1", "-1", "150"]),
    (lambda c: fx.falsy_variant(F.parse_json(c)), ["0", '""', "null", None, "150", '"0"', "0.0"],
     ["-1", "-1", "-1", "-1", "150", "0", "-1"]),
    (fx.xml_total_count, ["<r><list_total_count>12</list_total_count></r>", "<r><a>1</a></r>", "no xml", None],
     [12, None, None, None]),
]


@pytest.mark.parametrize("rule,inputs,expected", TEXT_RULES, ids=range(len(TEXT_RULES)))
def test_text_rules(frame, rule, inputs, expected):
    assert apply(frame, "string", rule, *inputs) == expected


@pytest.mark.parametrize(
    "rule,text",
    [
        (fx.cast_int_strict, "3.7"),
        (fx.cast_int_strict, None),
        (fx.cast_int_strict, "x"),
        (fx.cast_double_strict, "x"),
        (fx.cast_double_strict, "3d"),
        (fx.coerce_int, "3.7"),
        (fx.to_date_strict, "20251331"),
        (fx.to_date_strict, "soon"),
        (fx.to_date_strict, "2025013"),
        (fx.to_date_strict, "202501"),
        (fx.to_date_strict, "2025-01-31 junk"),
        (fx.coerce_int_or_zero, "3000000000"),
        (partial(fx.xml_total_count, strict=True), "<r><a>1</a></r>"),
    ],
    ids=range(13),
)
def test_strict_rules_stop(frame, rule, text):
    fails(frame, "string", rule, text)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_strictness_does_not_depend_on_ansi_mode(spark, frame, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        fails(frame, "string", fx.cast_int_strict, "x")
        fails(frame, "string", fx.cast_double_strict, "x")
        fails(frame, "string", fx.to_date_strict, "x")
        assert apply(frame, "string", fx.coerce_int, "x", "1") == [None, 1]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_strict_whole_numbers_of_numbers(spark, frame, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        assert apply(frame, "double", fx.cast_int_strict, 3.0, -0.0, 2147483647.0) == [3, 0, 2147483647]
        assert apply(frame, "bigint", fx.cast_int_strict, 3, -7) == [3, -7]
        for bad in (3.7, float("nan"), float("inf"), 3e9, None):
            fails(frame, "double", fx.cast_int_strict, bad)
        fails(frame, "bigint", fx.cast_int_strict, 3_000_000_000)
        fails(frame, "decimal(4,1)", fx.cast_int_strict, Decimal("3.5"))
        assert apply(frame, "decimal(4,1)", fx.cast_int_strict, Decimal("3.0")) == [3]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_coordinates(frame):
    def rule(c):
        return fx.nan_to_null(fx.zero_to_null(fx.cast_double_strict(c)))

    assert apply(frame, "string", rule, "37.5", "0.0", "0", None) == [37.5, None, None, None]
    assert apply(frame, "double", fx.nan_to_null, float("nan"), 1.0, None) == [None, 1.0, None]


def test_number_defaults(frame):
    assert apply(frame, "int", fx.falsy_number, 0, None, 5) == [-1, -1, 5]
    assert apply(frame, "int", fx.coalesce_zero, None, 7) == [0, 7]
    assert apply(frame, "int", fx.pad_number, 5, 23) == ["05", "23"]


SUNDAY, MONDAY, SATURDAY = dt.date(2025, 6, 1), dt.date(2025, 6, 2), dt.date(2025, 6, 7)


def test_calendar(frame):
    days = (SUNDAY, MONDAY, SATURDAY, None)
    assert apply(frame, "date", fx.weekday_name_kr, *days) == ["일요일", "월요일", "토요일", None]
    assert apply(frame, "date", fx.weekend_flag, *days) == [True, False, True, False]
    assert apply(frame, "date", fx.year_month, SUNDAY) == ["2025-06"]
    assert apply(frame, "date", fx.compact_date, SUNDAY) == ["20250601"]
    assert apply(frame, "date", fx.month_start, SATURDAY) == [SUNDAY]
    assert apply(frame, "date", lambda c: fx.date_parts(c)["quarter"], SUNDAY) == [2]
    before = apply(frame, "date", lambda c: fx.run_date_minus_one(c).cast("date"), dt.date(2025, 3, 1))
    assert before == [dt.date(2025, 2, 28)]


def test_compact_date_parts(frame):
    rows = frame("c string", ("20250103",))
    assert tuple(rows.select(*fx.compact_date_parts(F.col("c")).values()).first()) == ("2025", "01", "03")


def test_keys(frame):
    rows = frame("a string, b string", ("x", "y"), ("x", None), (None, None))
    marker = "_dbt_utils_surrogate_key_null_"
    texts = ["x-y", f"x-{marker}", f"{marker}-{marker}"]
    got = [row.k for row in rows.select(fx.surrogate_key(F.col("a"), F.col("b")).alias("k")).collect()]
    assert got == [hashlib.md5(text.encode()).hexdigest() for text in texts]
    ids = [row.k for row in rows.select(fx.composite_id(F.col("a"), F.col("b")).alias("k")).collect()]
    assert ids == ["x - y", None, None]


def test_rows_to_json_writes_nulls(frame):
    rows = frame("a int, b string", (1, None))
    assert rows.select(fx.rows_to_json(F.col("a"), F.col("b"))).first()[0] == '{"a":1,"b":null}'
