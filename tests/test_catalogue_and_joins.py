"""Catalogue rules, category codes and station joins."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from gaugeworks.catalogue import STATION_FIELDS, STATIONS, audit_catalogue, default_manifest, make_catalogue, require_valid
from gaugeworks.operators import enrich, features
from gaugeworks.plans.hourly import transform_readings
from gaugeworks.sources import resources


def station(**changes):
    return {**dict(zip(STATION_FIELDS, STATIONS[5])), **changes}


def test_default_catalogue_is_valid(catalogue):
    assert audit_catalogue(catalogue).filter("size(violations) > 0").isEmpty()
    assert require_valid(catalogue) is catalogue


@pytest.mark.parametrize(
    "changes, rule",
    [
        ({"station_code": " "}, "empty station_code"),
        ({"source_station_name": ""}, "empty source_station_name"),
        ({"kind": "radar"}, "unknown kind"),
        ({"latitude": 91.0}, "latitude out of range"),
        ({"longitude": -181.0}, "longitude out of range"),
        ({"danger_level": 90.0}, "thresholds not ascending"),
    ],
)
def test_broken_entries_are_named(spark, changes, rule):
    entry = make_catalogue(spark, [station(**changes)])
    assert audit_catalogue(entry).first()["violations"] == [rule]
    with pytest.raises(ValueError):
        require_valid(entry)


def test_empty_catalogue_is_an_error(spark):
    with pytest.raises(ValueError):
        require_valid(make_catalogue(spark, []))


def test_category_codes(spark, catalogue):
    codes = {r[0]: tuple(r)[1:] for r in features.category_codes(catalogue).collect()}
    assert codes == {
        "CAVMSI": (0, 0, 1),
        "GDBDCL": (1, 1, 1),
        "KRSNWDP": (2, 2, 1),
        "NRMMDL": (3, 3, 1),
        "PTHNGD": (4, 1, 1),
        "YMNCKT": (5, 4, 0),
        "YMNDLH": (6, 4, 0),
    }
    df = spark.createDataFrame([("CAVMSI",), ("NOPE",)], "station_code string")
    coded = {r["station_code"]: r["station_code_id"] for r in features.encode_stations(df, catalogue).collect()}
    assert coded == {"CAVMSI": 0, "NOPE": -1}


def test_codes_are_places_among_the_sorted(spark):
    values = spark.range(500).select(F.sha2(F.col("id").cast("string"), 256).alias("v"))
    codes = {r[0]: r[1] for r in features._codes(values, "v").collect()}
    assert codes == {v: i for i, v in enumerate(sorted(codes))} and len(codes) == 500


def test_first_catalogue_entry_wins_and_aliases_count(spark):
    cat = make_catalogue(
        spark,
        [
            station(station_code="A", source_station_name="Weir", match_aliases=["Old  Weir"]),
            station(station_code="B", source_station_name="weir ", station_name="B gauge"),
        ],
    )
    df = spark.createDataFrame([("WEIR",), ("old weir",), ("b GAUGE",), ("other",), (None,)], "station_name string")
    joined = [(r["station_code"], r["warning_level"]) for r in enrich.join_stations(df, cat).collect()]
    assert sorted(joined, key=str) == [("A", 82.115), ("A", 82.115), ("B", 82.115), ("UNKNOWN", None), ("other", None)]


def test_raw_record_becomes_a_reading(spark, catalogue):
    raw = spark.createDataFrame(
        [("MUSIRI", "13-01-2026 10:30", "82.5", None, 7), ("Nowhere", "bad", "1", None, 8), ("Nowhere", "13-01-2026 10:30", "x", 1.5, 9)],
        "Station string, `Data Acquisition Time` string, `River Water Level Telemetry Hourly (meter)` string, Latitude double, SlNo int",
    )
    rows = transform_readings(raw, catalogue, "Asia/Kolkata").orderBy("station_code").collect()
    assert len(rows) == 2
    assert rows[0]["dedup_key"] == "CAVMSI_2026-01-13T05:00:00+0000_82.5000"
    assert rows[0]["timestamp"] == datetime(2026, 1, 13, 5) and rows[0]["flood_status"] == "WARNING"
    assert rows[0]["latitude"] == pytest.approx(10.93805556)
    assert (rows[1]["station_code"], rows[1]["flood_status"], rows[1]["latitude"]) == ("Nowhere", None, 1.5)
    assert "SlNo" not in rows[0].asDict()


def test_empty_input_gives_an_empty_canonical_frame(spark, catalogue):
    raw = spark.createDataFrame([], "Station string, time string, level string")
    out = transform_readings(raw, catalogue)
    assert out.isEmpty() and out.columns[0] == "station_code" and out.columns[-1] == "dedup_key"


def test_name_reports(spark, catalogue):
    df = spark.createDataFrame([("MUSIRI",), ("zeta",), ("Alpha",), ("zeta",)], "station_name string")
    assert [r[0] for r in enrich.unresolved_names(df, catalogue).collect()] == ["Alpha", "zeta"]
    kept = enrich.monitored_only(df.union(spark.createDataFrame([(None,), ("",)], "station_name string")), catalogue)
    assert sorted((r[0] for r in kept.collect()), key=str) == ["", "MUSIRI", None]


def test_counts_cover_every_station(spark, catalogue):
    df = spark.createDataFrame([("CAVMSI",), ("CAVMSI",), ("OTHER",)], "station_code string")
    counts = {r["station_code"]: r["records"] for r in enrich.station_counts(df, catalogue).collect()}
    assert counts["CAVMSI"] == 2 and counts["YMNDLH"] == 0 and len(counts) == 7
    assert enrich.absent_stations(df, catalogue).count() == 6
    trained = spark.createDataFrame([("CAVMSI",)], "station_code string")
    assert [r[0] for r in enrich.without_model(df, trained).collect()] == ["OTHER"]


def test_resources(spark, catalogue):
    manifest = default_manifest(spark)
    chosen = resources.select_resources(manifest, resources.split_list(" godavari, KRISH,"), ["(2026 - 2030)"])
    assert sorted(r["basin"] for r in chosen.collect()) == ["Godavari", "Krishna"]
    assert resources.select_resources(manifest, resources.split_list("")).count() == 10
    with pytest.raises(ValueError):
        resources.require_resources(resources.select_resources(manifest, ["ganga"]))
    live = resources.resources_in_window(manifest, datetime(2025, 12, 31, 23, 59, 59), datetime(2026, 1, 1))
    assert live.count() == 10
    live = resources.resources_in_window(manifest, datetime(2026, 1, 1), datetime(2026, 2, 1))
    assert {r["start_year"] for r in live.collect()} == {2026}
    asked = resources.resource_stations(manifest.filter("start_year = 2026"), catalogue.filter("basin_name <> 'Krishna'"))
    names = sorted((r["source_station_name"] or "") for r in asked.collect() if r["basin"] in ("Godavari", "Krishna"))
    assert names == ["", "Bhadrachalam", "Jaikwadi Dam"]


def test_catalogue_join_is_broadcast_by_size_only(spark, catalogue):
    """No hint: over the threshold the same join shuffles."""
    df = spark.createDataFrame([("MUSIRI",)], "station_name string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        joined = enrich.join_stations(df, catalogue)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Broadcast" not in plan and joined.first()["station_code"] == "CAVMSI"
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
