from __future__ import annotations

import os
import sys

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tramline.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.maxMetadataStringLength", "10000")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    session = builder.getOrCreate()
    if not session.conf.get("spark.checkpoint.dir", None):
        session.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    session.sparkContext.setLogLevel("ERROR")
    return configure(session)


@pytest.fixture
def frame(spark):
    """frame("a int, b string", (1, "x"), ...) -> DataFrame"""

    def make(schema: str, *rows: tuple):
        return spark.createDataFrame(list(rows), schema)

    return make


STOPPED = (PySparkException, Py4JJavaError)  # how a job that was stopped by its data ends


def values(rows) -> list[tuple]:
    return sorted((tuple(row) for row in rows.collect()), key=repr)


def plan_of(rows) -> str:
    return rows._jdf.queryExecution().toString()
