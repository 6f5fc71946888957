from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(params=[True, False], ids=["ansi", "lenient"])
def either_mode(spark, request):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", str(request.param).lower())
    yield spark
    spark.conf.set("spark.sql.ansi.enabled", before)


@pytest.fixture
def apply(either_mode):
    """Apply a column function to a list of texts, in both ANSI modes."""

    def run(function, values):
        rows = [(i, value) for i, value in enumerate(values)]
        df = either_mode.createDataFrame(rows, "i int, x string")
        return [row[1] for row in df.select("i", function("x")).orderBy("i").collect()]

    return run
