"""One local session for all tests, and small builders for fixtures."""

from __future__ import annotations

import sys
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("gaugeworks-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def catalogue(spark):
    from gaugeworks.catalogue import default_catalogue

    return default_catalogue(spark).persist()


START = datetime(2026, 1, 1)


@pytest.fixture(scope="session")
def hours(spark):
    """``hours({"code": [levels or None]})``: one reading per hour from 2026-01-01."""

    def build(series: dict[str, list]):
        rows = [
            (i, code, START + timedelta(hours=i), None if level is None else float(level))
            for code, levels in series.items()
            for i, level in enumerate(levels)
        ]
        return spark.createDataFrame(
            rows, "seq bigint, station_code string, timestamp timestamp, water_level double"
        )

    return build
