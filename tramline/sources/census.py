"""What the day folders of a Parquet range hold, told by the footers of their files.

Days of one schema are read together; each group is widened to a given schema. A day that was not
landed, cannot be read or cannot be widened does not stop the others: it is left out and returned.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date, timedelta
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import (
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StructField,
    StructType,
    TimestampNTZType,
)

from tramline.session import place_of

#: Footers of so many days are looked at at once; each is a job over the day's files.
_AT_ONCE = 8
_UNREADABLE = (PySparkException, Py4JJavaError)
_WHOLE = [ByteType(), ShortType(), IntegerType(), LongType()]
_DIGITS = {ByteType(): 3, ShortType(): 5, IntegerType(): 10, LongType(): 19}


@dataclass(frozen=True)
class LandedDay:
    """A landed day: files of one schema each, or why it cannot be read."""

    day: date
    files: tuple[tuple[str, str], ...] = ()  # (folder or file, its schema as JSON)
    fault: str | None = None


def widens(have: DataType, want: DataType) -> bool:
    """Whether every value of one type is the same value in the other."""
    if have == want:
        return True
    if have in _WHOLE and want in _WHOLE:
        return _WHOLE.index(have) < _WHOLE.index(want)
    if isinstance(want, DecimalType):
        if isinstance(have, DecimalType):
            return have.scale <= want.scale and have.precision - have.scale <= want.precision - want.scale
        return have in _DIGITS and _DIGITS[have] <= want.precision - want.scale
    if want == DoubleType():
        return have == FloatType() or have in _WHOLE[:3]
    return (want == FloatType() and have in _WHOLE[:2]) or (have == DateType() and want == TimestampNTZType())


def _misfit(have: StructType, want: StructType, optional: Sequence[str]) -> str | None:
    """Why rows of one schema cannot be widened to the other."""
    kinds: dict[str, list[DataType]] = {}
    for own in have:
        kinds.setdefault(own.name.lower(), []).append(own.dataType)
    for wanted in want:
        found = kinds.get(wanted.name.lower(), [])
        if len(found) > 1:
            return f"{wanted.name}: several columns"
        if not found and wanted.name not in optional:
            return f"{wanted.name}: no such column"
        if found and not widens(found[0], wanted.dataType):
            return f"{wanted.name}: {found[0].simpleString()} is no {wanted.dataType.simpleString()}"
    return None


def _reason(error: Exception) -> str:
    """What Spark says of the file, without its stack."""
    said = error.java_exception if isinstance(error, Py4JJavaError) else None
    while said is not None and said.getCause() is not None:
        said = said.getCause()
    return (str(error) if said is None else said.getMessage() or said.toString()).splitlines()[0][:300]


def _footers(spark: SparkSession, path: str) -> str:
    """The schema of all Parquet files below ``path``; fails if one cannot be read or they differ."""
    return spark.read.option("mergeSchema", True).parquet(path).schema.json()


def _files(spark: SparkSession, folder: str) -> list[str]:
    place, fs = place_of(spark, folder)
    found = [status.getPath() for status in fs.listStatus(place) if status.isFile()]
    return sorted(path.toString() for path in found if path.getName()[0] not in "._")


def _look(spark: SparkSession, day: date, folder: str) -> LandedDay:
    try:
        return LandedDay(day, ((folder, _footers(spark, folder)),))
    except _UNREADABLE:
        # Files that differ are told apart; a broken one is met again here.
        try:
            return LandedDay(day, tuple((path, _footers(spark, path)) for path in _files(spark, folder)))
        except _UNREADABLE as error:
            return LandedDay(day, fault=_reason(error))


def landed_days(spark: SparkSession, landing: str, column: str, start: date, end: date) -> list[LandedDay]:
    """The days of the range that have files, in folders ``column=yyyy-mm-dd``, with their schemas.

    The footer of every file is read, none of its rows. The driver holds one entry a day, or one
    a file where the files of a day differ.
    """
    days = [start + timedelta(days=n) for n in range((end - start).days + 1)]
    folders = [(day, f"{landing.rstrip('/')}/{column}={day.isoformat()}") for day in days]
    there = []
    for day, folder in folders:
        place, fs = place_of(spark, folder)
        if fs.exists(place) and _files(spark, folder):
            there.append((day, folder))
    with ThreadPoolExecutor(_AT_ONCE) as pool:
        return list(pool.map(lambda item: _look(spark, *item), there))


def read_range(
    spark: SparkSession,
    landing: str,
    column: str,
    start: date,
    end: date,
    schema: StructType,
    optional: Sequence[str] = (),
) -> tuple[DataFrame, dict[date, str]]:
    """(rows of the days that can be read, why each other day of the range was left out).

    ``schema`` has the wanted columns without ``column``, which comes from the folder names and is
    a date. A narrower number becomes the wanted type; columns are found by name in any case, an
    extra one is ignored, a missing one is null if it is ``optional``. A day whose values
    could change on the way (text, a wider number), that lacks a column, has no files or an
    unreadable one is left out whole.
    """
    left_out = {start + timedelta(days=n): "not landed" for n in range((end - start).days + 1)}
    groups: dict[str, list[str]] = {}
    for found in landed_days(spark, landing, column, start, end):
        faults = [_misfit(StructType.fromJson(json.loads(kind)), schema, optional) for _, kind in found.files]
        fault = found.fault or next((each for each in faults if each), None)
        if fault:
            left_out[found.day] = fault
            continue
        del left_out[found.day]
        for path, kind in found.files:
            groups.setdefault(kind, []).append(path)
    parts = [_widened(spark, landing, column, kind, paths, schema) for kind, paths in groups.items()]
    if not parts:
        parts = [spark.createDataFrame([], StructType([*schema.fields, StructField(column, DateType())]))]
    return reduce(DataFrame.unionByName, parts), left_out


def _widened(spark: SparkSession, landing: str, column: str, kind: str, paths: list[str], schema: StructType) -> DataFrame:
    """The files of one schema in one scan, in the wanted types."""
    held = StructType.fromJson(json.loads(kind))
    own = {name.lower(): name for name in held.names}
    scan = spark.read.schema(StructType([*held.fields, StructField(column, DateType())])).option("basePath", landing)
    columns = [
        F.col(f"`{own[wanted.name.lower()]}`").cast(wanted.dataType).alias(wanted.name)
        if wanted.name.lower() in own
        else F.lit(None).cast(wanted.dataType).alias(wanted.name)
        for wanted in schema
    ]
    return scan.parquet(*paths).select(*columns, column)
