"""Text rules against the Python and pandas behaviour they stand for, on random input."""

from __future__ import annotations

import math
import random
import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tramline import functions as fx
from tramline.constants import WHITESPACE

ALPHABETS = {
    "names": "0123.. aB역　\t\n\xa0.",
    "numbers": "0123456789..--+eE  ",
    "oddities": "12.dDfFxXnaiNINyt_ ",
}


def texts(alphabet: str, n: int = 3000) -> list[str]:
    draw = random.Random(alphabet)
    return ["".join(draw.choices(alphabet, k=draw.randint(0, 8))) for _ in range(n)]


def second(text: str) -> str | None:
    pieces = text.split(".")
    return pieces[1].strip() if len(pieces) > 1 else None


PYTHON = {
    fx.strip_ws: str.strip,
    fx.zfill: lambda text: text.zfill(5),
    fx.name_split_second: second,
    fx.name_strip_prefix: lambda text: re.sub(r"^\d+\.", "", text).strip(),
    fx.falsy_text: lambda text: text or "-1",
}


@pytest.mark.parametrize("alphabet", ALPHABETS)
@pytest.mark.parametrize("rule", PYTHON, ids=lambda rule: rule.__name__)
def test_rule_equals_python(frame, rule, alphabet):
    given = texts(ALPHABETS[alphabet])
    rows = frame("c string", *[(text,) for text in given]).select("c", rule(F.col("c")).alias("r"))
    wrong = [(row.c, row.r) for row in rows.collect() if row.r != PYTHON[rule](row.c)]
    assert wrong == []


def test_whitespace_is_what_python_strips():
    assert set(WHITESPACE) == {chr(n) for n in range(0x110000) if chr(n).isspace()}


@pytest.mark.parametrize("alphabet", ["numbers", "oddities"])
def test_coerce_double_equals_pandas(frame, alphabet):
    given = sorted(set(texts(ALPHABETS[alphabet])))
    want = pd.to_numeric(pd.Series(given, dtype=object), errors="coerce")
    rows = frame("n int, c string", *enumerate(given)).select("n", fx.coerce_double(F.col("c")).alias("r"))
    got = {row.n: row.r for row in rows.collect()}
    wrong = [
        (text, got[n], want[n])
        for n, text in enumerate(given)
        if (got[n] is None) != bool(pd.isna(want[n]))
        # pandas rounds large exponents less exactly
        or (got[n] is not None and not math.isclose(got[n], want[n], rel_tol=1e-12))
    ]
    assert wrong == []
