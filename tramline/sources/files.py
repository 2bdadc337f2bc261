"""Scans of landed files. JSON and XML schemas are given, so no scan reads its data twice;
Parquet scans take the schema the files carry."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType


def scan_json_rows(
    spark: SparkSession, path: str, schema: StructType, array_files: bool = False
) -> DataFrame:
    """Rows of landed JSON.

    ``array_files=False`` reads one object, or one array of objects, per line; such files split
    across tasks. ``array_files=True`` reads files that are a single, possibly indented, array;
    one file is then one task's work, so land them in pieces.
    """
    return (
        spark.read.schema(schema)
        .option("multiLine", array_files)
        .option("mode", "FAILFAST")
        .json(path)
    )


def scan_hourly_json(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All readable hour files below ``path``; an absent or unreadable file gives no rows.

    Folder names such as ``usage_date=.../usage_time=...`` become columns. An array file is
    parsed as one record, so a broken one is dropped whole. ``schema`` should be all text: a
    value of another type would count as broken.
    """
    return (
        spark.read.schema(schema)
        .option("multiLine", True)
        .option("mode", "DROPMALFORMED")
        .option("ignoreMissingFiles", True)
        .json(path)
    )


def broken_files(spark: SparkSession, path: str, schema: StructType) -> list[str]:
    """The files :func:`scan_hourly_json` leaves out, by path; there are as many as hours at most."""
    marked = StructType([*schema.fields, StructField("_broken", StringType())])
    rows = (
        spark.read.schema(marked)
        .option("multiLine", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_broken")
        .option("ignoreMissingFiles", True)
        .json(path)
    )
    # Spark parses a file only if a column beside the broken text is asked for.
    found = rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.bool_or(F.col("_broken").isNotNull()).alias("broken"), F.count(f"`{schema.names[0]}`").alias("read")
    )
    return sorted(row["file"] for row in found.where("broken").collect())


def scan_xml_rows(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """One row per ``<row>`` element; an absent child is null."""
    return (
        spark.read.format("xml")
        .schema(schema)
        .option("rowTag", "row")
        .option("ignoreSurroundingSpaces", False)
        .option("nullValue", "")
        .option("mode", "FAILFAST")
        .load(path)
    )


def scan_parquet_day(spark: SparkSession, path: str, column: str, day: date) -> DataFrame:
    """One day of a date-partitioned dataset; the other folders are never listed as input."""
    return spark.read.parquet(path).where(F.col(column) == F.lit(day))


def scan_glob(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """Parquet files of one folder whose names match, e.g. ``bike_part*.parquet``."""
    return spark.read.option("pathGlobFilter", pattern).parquet(path)


def full_scan(spark: SparkSession, path: str) -> DataFrame:
    """A whole table. Input splits (``spark.sql.files.maxPartitionBytes``) are the chunks."""
    return spark.read.parquet(path)
