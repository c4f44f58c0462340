"""Merge, retention, anti-join, reports and exact quantiles."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeworks.operators import latest, merge, metadata, quality
from gaugeworks.operators.quantiles import exact_quantiles
from gaugeworks.catalogue import default_manifest
from gaugeworks.schema import READINGS

T0 = datetime(2026, 1, 1)
COLUMNS = "station_code string, timestamp timestamp, water_level double, flood_status string, dedup_key string"


def rows(spark, *items):
    return spark.createDataFrame(list(items), COLUMNS)


def reading(code, hour, level, status="NORMAL", key=""):
    return (code, T0 + timedelta(hours=hour), level, status, key if key is None else key or f"{code}_{hour}_{level}")


def test_merge_keeps_the_new_row_and_is_idempotent(spark):
    old = rows(spark, reading("A", 0, 1.0, "old"), reading("A", 1, 1.0))
    new = rows(spark, reading("A", 0, 1.0, "new"), reading("B", 2, 1.0))
    once = merge.merge_readings(old, new, 365)
    twice = merge.merge_readings(once, new, 365)
    state = lambda df: sorted(map(tuple, df.select("dedup_key", "flood_status").collect()))
    assert state(once) == [("A_0_1.0", "new"), ("A_1_1.0", "NORMAL"), ("B_2_1.0", "NORMAL")]
    assert state(twice) == state(once)


def test_missing_keys_count_as_one_key(spark):
    df = rows(spark, *[reading("A", i, float(i), key=None) for i in range(4)]).withColumn("seq", F.col("water_level"))
    merged = merge.dedup_readings(rows(spark).withColumn("seq", F.lit(0.0)), df, sequence="seq").collect()
    assert [r["water_level"] for r in merged] == [3.0]


def test_retention_bound_is_inclusive(spark):
    df = rows(spark, reading("A", 0, 1.0), reading("A", 1, 1.0), reading("A", 25, 1.0), ("A", None, 1.0, None, "x"))
    assert merge.retain_days(df, 1).count() == 2
    assert merge.retain_days(df, 0).count() == 4
    assert merge.retain_days(df.filter("timestamp IS NULL"), 1).count() == 1


def test_anti_join_keeps_copies_inside_new(spark):
    old = spark.createDataFrame([("k1",), (None,)], "k string")
    new = spark.createDataFrame([("k1",), ("k2",), ("k2",), (None,)], "k string")
    assert sorted((r[0] for r in merge.new_rows_only(old, new, "k").collect()), key=str) == [None, "k2", "k2"]
    assert merge.new_rows_only(old.limit(0), new, "k").count() == 4


def test_union_of_sources_fills_missing_columns(spark):
    a, b = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([("v",)], "y string")
    assert sorted(map(str, merge.union_tables([a, b]).collect())) == ["Row(x=1, y=None)", "Row(x=None, y='v')"]


def test_duplicate_reports(spark):
    df = rows(spark, reading("A", 0, 1.0), reading("A", 0, 2.0), reading("A", 0, 3.0), reading("B", 0, 1.0))
    found = {r[0]: r[1] for r in quality.duplicate_timestamps(df).collect()}
    assert found == {"A": 3, "B": 0}
    assert quality.excess_duplicates(df, ["station_code", "timestamp"]).first()[0] == 2
    assert quality.excess_duplicates(df.limit(0), ["dedup_key"]).first()[0] == 0


def test_null_percentages_of_an_empty_table(spark):
    assert {r[1] for r in quality.null_percentages(rows(spark)).collect()} == {100.0}


def test_summary_and_report(spark):
    df = rows(
        spark,
        reading("A", 0, 1.0, "WARNING"),
        reading("A", 1, 2.0, "NORMAL"),
        reading("A", 2, 4.0, "NORMAL"),
        reading("A", 3, None, None),
        ("B", None, None, None, "b"),
    )
    table = {r["station_code"]: r for r in quality.executive_summary(df).collect()}
    assert table["A"]["status_dist"] == "NORMAL:2, WARNING:1" and table["A"]["missing_gauge_pct"] == 25.0
    assert (table["A"]["start"], table["A"]["end"]) == ("2026-01-01 00:00", "2026-01-01 03:00")
    assert (table["B"]["start"], table["B"]["min_level_m"], table["B"]["status_dist"]) == ("n/a", None, "n/a")
    report = quality.validation_report(df).first()
    assert (report["total_records"], report["stations"], report["excess_duplicates"]) == (5, 2, 0)
    assert report["null_percentage"]["flood_status"] == 40.0 and len(report["summary"]) == 2
    empty = quality.validation_report(rows(spark)).first()
    assert (empty["total_records"], empty["stations"]) == (0, 0)


def test_exact_quantiles(spark):
    rng = random.Random(5)
    values = [round(rng.expovariate(0.01), 1) for _ in range(3000)] + [7.0] * 1500 + [1e9, -1e9]
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),), (float("inf"),)], "v double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 0.999, 1.0]
    assert exact_quantiles(df, "v", probs) == pytest.approx(list(np.quantile(values, probs)))
    assert exact_quantiles(df.filter("v IS NULL"), "v", [0.5]) == [None]


def test_latest_ignores_missing_times_and_breaks_ties(spark):
    df = rows(spark, reading("A", 1, 1.0), reading("A", 1, 2.0), ("A", None, 9.0, None, "x")).withColumn("seq", F.col("water_level"))
    assert latest.latest_reading(df, "seq").first()["water_level"] == 2.0


def test_last_n_of_one_hot_station(spark):
    df = spark.range(5000).select(
        F.concat(F.lit("A"), F.col("id") % 1).alias("station_code"), F.timestamp_seconds(F.col("id") * 600).alias("timestamp"), "id"
    )
    kept = latest.last_n(df, 1500)
    assert kept.count() == 1500 and kept.agg(F.min("id")).first()[0] == 3500
    hours = spark.range(5000).select(F.lit("A").alias("station_code"), F.col("id").alias("hour"))
    kept = latest.last_n(hours.union(hours.limit(0)).union(spark.sql("SELECT 'B', 7L")), 2048, time="hour")
    assert kept.filter("station_code = 'A'").agg(F.min("hour"), F.count("*")).first() == (5000 - 2048, 2048)
    assert kept.count() == 2049


def test_kpis_count_missing_status_as_not_normal(spark):
    df = rows(spark, reading("A", 0, 1.0), reading("B", 0, 1.0, None), reading("C", 0, 1.0, "DANGER"))
    k = latest.kpis(df).first()
    assert (k["stations"], k["records"], k["not_normal"]) == (3, 3, 2)


def test_status_histogram_and_centre(spark):
    df = spark.createDataFrame(
        [("CAVMSI", 10.95, 78.8, "WARNING"), ("YMNCKT", 25.2, 80.9, "WARNING"), ("X", None, None, None)],
        "station_code string, latitude double, longitude double, flood_status string",
    )
    assert [tuple(r) for r in latest.status_histogram(df).collect()] == [("WARNING", 2)]
    assert tuple(latest.map_centre(df).first()) == pytest.approx((18.075, 79.85))


def test_metadata_document(spark, catalogue):
    df = rows(spark, reading("CAVMSI", 0, 1.0), reading("CAVMSI", 5, 1.0, "DANGER"), reading("YMNCKT", 1, 1.0, None))
    document = metadata.dataset_metadata(
        df, catalogue, default_manifest(spark), 365, "2026-02-01T00:00:00Z", {"dataset": "d"}, "p"
    ).first()
    assert document["temporalCoverage"].asDict() == {"start_date": "2026-01-01T00:00:00Z", "end_date": "2026-01-01T05:00:00Z"}
    assert document["total_records"] == 3 == sum(s["records"] for s in document["monitored_stations"])
    assert document["alert_status_distribution"] == {"NORMAL": 1, "DANGER": 1}
    assert document["monitored_basins"] == ["Cauvery", "Godavari", "Krishna", "Narmada", "Yamuna Basin"]
    assert len(document["sources"]) == 10 and [s["station_code"] for s in document["monitored_stations"]][0] == "CAVMSI"
    empty = metadata.dataset_metadata(
        spark.createDataFrame([], READINGS), catalogue, default_manifest(spark), 365, "x", {"dataset": "d"}, "p"
    ).first()
    assert empty["temporalCoverage"]["start_date"] == "unknown" and empty["total_records"] == 0
