"""Sources, sinks and the two whole jobs."""

from __future__ import annotations

import json
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from gaugeworks.catalogue import default_manifest
from gaugeworks.operators import columns as cols
from gaugeworks.plans import daily
from gaugeworks.plans.hourly import refresh_days, run_hourly
from gaugeworks.schema import HINDI_CATEGORIES, READINGS
from gaugeworks.sources import payload, publish, published, resources, snapshots

RAW = "Station string, `Data Acquisition Time` string, `River Water Level Telemetry Hourly (meter)` string, SlNo bigint"


def landed(spark, first, n, station="MUSIRI", base=82.0):
    rows = []
    for i in range(n):
        ist = first + timedelta(hours=i) + timedelta(hours=5, minutes=30)
        rows.append((station, ist.strftime("%d-%m-%Y %H:%M"), f"{base + 0.1 * (i % 20):.3f}", i))
    return spark.createDataFrame(rows, RAW)


def test_absent_table_is_empty_with_the_schema(spark, tmp_path):
    df = published.read_published(spark, str(tmp_path / "nothing"))
    assert df.isEmpty() and df.schema == READINGS
    mark = published.high_water_mark(df, datetime(2021, 1, 1)).first()["since"]
    assert mark == datetime(2021, 1, 1)


def test_slice_is_open_below_closed_above(spark):
    times = [None, datetime(2026, 1, 1), datetime(2026, 1, 2), datetime(2026, 1, 3)]
    df = spark.createDataFrame([(t,) for t in times], "timestamp timestamp")
    kept = published.incremental_slice(df, datetime(2026, 1, 1), datetime(2026, 1, 2))
    assert sorted((r[0] for r in kept.collect()), key=str) == [datetime(2026, 1, 2), None]


def test_slice_reaches_the_scan(spark, tmp_path):
    spark.range(10).select(F.timestamp_seconds("id").alias("timestamp")).write.parquet(str(tmp_path / "t"))
    df = published.incremental_slice(spark.read.parquet(str(tmp_path / "t")), datetime(1970, 1, 1), datetime(1971, 1, 1))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(IsNull(timestamp),And(GreaterThan(timestamp" in plan


@pytest.mark.parametrize(
    "days, due",
    [
        ([], (True, date(1900, 1, 1))),
        ([date(2026, 1, d) for d in range(10, 16)], (True, date(2026, 1, 16))),
        ([date(2026, 1, 19)], (False, None)),
        ([date(2026, 1, 18)], (True, date(2026, 1, 19))),
    ],
)
def test_update_decision(spark, days, due):
    df = spark.createDataFrame([(d.isoformat(),) for d in days], "date_obs_elab string")
    assert tuple(published.update_decision(df, date(2026, 1, 20)).first()) == due


def test_update_decision_needs_a_date_column(spark):
    with pytest.raises(KeyError):
        published.update_decision(spark.range(1), date(2026, 1, 1))


@pytest.mark.parametrize(
    "document",
    [
        {"result": {"total": 2, "records": [{"a": 1}, {"a": 2}]}},
        {"data": [{"a": 1}, {"a": 2}], "observations": [{"a": 9}]},
        {"results": [{"a": 1}, {"a": 2}]},
        {"observations": [{"a": 1}, {"a": 2}], "records": None},
        [{"a": 1}, {"a": 2}],
    ],
)
def test_payload_shapes(spark, tmp_path, document):
    (tmp_path / "page.json").write_text(json.dumps(document))
    records = payload.payload_records(payload.read_payloads(spark, str(tmp_path)))
    assert sorted(r["a"] for r in records.collect()) == [1, 2]


@pytest.mark.parametrize(
    "document", [{"result": {"total": 0}, "records": [{"a": 1}]}, {"result": {"records": []}, "data": [{"a": 1}]}]
)
def test_a_result_without_records_is_empty(spark, tmp_path, document):
    (tmp_path / "page.json").write_text(json.dumps(document))
    assert payload.payload_records(payload.read_payloads(spark, str(tmp_path))).count() == 0


def test_lists_of_different_records_are_merged(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"records": [{"a": 1, "b": "x"}]}))
    (tmp_path / "b.json").write_text(json.dumps({"data": [{"a": "two", "c": 2.5}]}))
    got = payload.payload_records(payload.read_payloads(spark, str(tmp_path))).collect()
    assert sorted((r["a"], r["b"], r["c"]) for r in got) == [("1", "x", None), ("two", None, 2.5)]


def test_flatten_keeps_extra_columns(spark):
    df = spark.sql("SELECT named_struct('name', 'MUSIRI', 'id', 7) AS station, 82.5 AS level, 'x' AS note")
    flat = payload.flatten_records(df)
    assert flat.columns == ["station.name", "station.id", "level", "note"]
    assert cols.normalize_columns(flat).columns == ["water_level", "station.name", "station.id", "note"]


def test_hourly_run_twice_is_the_same_dataset(spark, tmp_path, catalogue):
    root = str(tmp_path / "published")
    args = dict(
        catalogue=catalogue,
        manifest=default_manifest(spark),
        root=root,
        default_start=datetime(2025, 12, 1),
        descriptors={"dataset": "Gauge levels"},
        provider="p",
    )
    feed = landed(spark, datetime(2026, 1, 1), 30).union(landed(spark, datetime(2026, 1, 1), 5, "Elsewhere"))
    feed = feed.union(spark.createDataFrame([("MUSIRI", "soon", "82.1", 1)], RAW))
    first = run_hourly(spark, feed, end=datetime(2026, 1, 1, 20), **args)
    assert first.readings.count() == 21 and {r[0] for r in first.readings.select("station_code").collect()} == {"CAVMSI"}
    assert first.absent.count() == 6 and first.dropped_rows == 1
    again = run_hourly(spark, feed, end=datetime(2026, 1, 1, 20), **args)
    # nothing new: nothing is written
    assert again.readings.count() == 21 and again.version == first.version and again.days == []
    later = run_hourly(spark, feed, end=datetime(2026, 1, 2, 20), **args)
    assert later.readings.count() == 30
    report = later.report.totals.first()
    assert report["total_records"] == 30 and report["excess_duplicates"] == 0
    meta = json.loads(publish.document_text(spark, f"{later.version}/metadata"))
    assert meta["total_records"] == 30 and sum(s["records"] for s in meta["monitored_stations"]) == 30
    for name in ("csv", "stations"):
        held = snapshots.DaySnapshots(spark, root).read_text_format(name)
        assert sorted(map(str, held.collect())) == sorted(map(str, later.readings.collect()))
    backfill = run_hourly(spark, feed, end=datetime(2026, 1, 2, 20), backfill_from=datetime(2025, 12, 31), **args)
    assert backfill.readings.count() == 30


def test_day_table_run_equals_the_full_rewrite(spark, tmp_path, catalogue):
    feed = landed(spark, datetime(2026, 1, 1), 80)
    whole = dict(
        catalogue=catalogue, manifest=default_manifest(spark), root=str(tmp_path / "whole"), retention_days=2,
        default_start=datetime(2025, 12, 1), descriptors={}, provider="p",
    )
    for end in (datetime(2026, 1, 2), datetime(2026, 1, 2), datetime(2026, 1, 4)):
        full = run_hourly(spark, feed, end=end, **whole).readings
        days = refresh_days(
            spark, feed, catalogue, str(tmp_path / "days"), end, datetime(2025, 12, 1), retention_days=2
        )
        assert sorted(map(tuple, full.collect()), key=str) == sorted(map(tuple, days.collect()), key=str)
    assert days.count() == 49


def test_selected_resources_prune_partitions(spark, tmp_path):
    rows = [(b, r, i) for b in ("Godavari", "Krishna") for r in ("(2021 - 2025)", "(2026 - 2030)") for i in range(3)]
    path = str(tmp_path / "landing")
    spark.createDataFrame(rows, "basin string, time_range string, v int").write.partitionBy("basin", "time_range").parquet(path)
    chosen = resources.select_resources(default_manifest(spark), ["krishna"], ["(2026 - 2030)"])
    df = resources.read_selected(spark.read.parquet(path), chosen)
    assert df.count() == 3 and {r["basin"] for r in df.collect()} == {"Krishna"}
    scan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(basin" in scan


def test_station_partitions_keep_the_column(spark, tmp_path):
    df = spark.createDataFrame(
        [("A/1", datetime(2026, 1, 1, h), float(h)) for h in (3, 1, 2)] + [("B", datetime(2026, 1, 1), 9.0)],
        "station_code string, timestamp timestamp, water_level double",
    )
    publish.write_station_partitions(df, str(tmp_path / "s"))
    back = spark.read.option("header", True).csv(str(tmp_path / "s"))
    assert {r["station"] for r in back.collect()} == {"A/1", "B"} == {r["station_code"] for r in back.collect()}


def test_range_partitions_split_a_hot_station(spark):
    df = spark.range(20000).select(
        F.when(F.col("id") % 10 < 9, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("station_code"),
        F.timestamp_seconds("id").alias("timestamp"),
    )
    sizes = publish.by_station_and_time(df, 8).groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in sizes) < 20000 / 3


def test_readers_see_whole_versions(spark, tmp_path):
    data = publish.VersionedDataset(spark, str(tmp_path))
    assert data.current() is None and data.read().isEmpty()
    for n in (1, 2):
        version = data.stage()
        row = [("A", None, None, datetime(2026, 1, 1), float(n), None, None, None, None, None, None, "k")]
        publish.write_parquet(spark.createDataFrame(row, READINGS), f"{version}/parquet")
        if n == 2:
            assert data.read().first()["water_level"] == 1.0
        data.publish(version)
        assert data.read().first()["water_level"] == float(n)


def test_day_table_rewrites_touched_days_only(spark, tmp_path):
    root = str(tmp_path / "days")

    def batch(*items):
        rows = [("A", None, None, t, v, None, None, None, None, None, None, f"A_{t}") for t, v in items]
        return spark.createDataFrame(rows, READINGS)

    publish.upsert_days(spark, root, batch((datetime(2026, 1, 1, 5), 1.0), (datetime(2026, 1, 2, 5), 1.0)))
    kept = sorted(p.name for p in (tmp_path / "days" / "day=2026-01-01").iterdir())
    publish.upsert_days(spark, root, batch((datetime(2026, 1, 2, 5), 2.0), (datetime(2026, 1, 3, 5), 2.0)))
    assert sorted(p.name for p in (tmp_path / "days" / "day=2026-01-01").iterdir()) == kept
    state = {r["timestamp"].day: r["water_level"] for r in publish.read_days(spark, root).collect()}
    assert state == {1: 1.0, 2: 2.0, 3: 2.0}
    assert publish.read_days(spark, root, 1).count() == 2
    publish.upsert_days(spark, root, batch((datetime(2026, 1, 9), 3.0)), retention_days=6)
    assert publish.read_days(spark, root).count() == 2 and not (tmp_path / "days" / "day=2026-01-01").exists()


# --- daily family -----------------------------------------------------------
PROVIDER = "code_station string, date_obs_elab string, resultat_obs_elab string, libelle_statut string"


def test_rename_round_trip(spark):
    df = spark.createDataFrame([("F700000109", "2024-01-15", "5800.0", "Donnée validée")], PROVIDER)
    assert cols.to_provider(cols.to_english(df)).collect() == df.collect()
    both = spark.createDataFrame([("a", "b")], "code_station string, station_code string")
    assert cols.to_english(both).columns == ["code_station", "station_code"]


def test_two_of_three_rows_are_new(spark):
    schema = "code_station string, date_obs_elab string, resultat_obs_elab double"
    old = spark.createDataFrame([("109", "2026-01-15", 5800.0), ("109", "2026-01-16", 5850.0)], schema)
    new = spark.createDataFrame(
        [("109", "2026-01-15", 5800.0), ("109", "2026-01-17", 5900.0), ("110", "2026-01-17", 6100.0)], schema
    )
    assert daily.new_daily_rows(old, new).count() == 2


def test_postprocess(spark):
    df = spark.createDataFrame(
        [("B", "2026-01-16", "6100", "Donnée brute"), ("A", "2026-01-16", "N/A", "?"), ("A", "2026-01-15", "6000", None)],
        PROVIDER,
    )
    types = {"date_obs_elab": "date", "resultat_obs_elab": "double"}
    rows = daily.postprocess(df, types=types).collect()
    assert [(r["record_date"].day, r["station_code"]) for r in rows] == [(15, "A"), (16, "A"), (16, "B")]
    assert [r["flood_alert"] for r in rows] == [False, False, True]
    assert [r["validation_status"] for r in rows] == [None, "?", "raw"]
    assert rows[0].__fields__[:4] == ["station_code", "record_date", "water_level_mm", "flood_alert"]
    hindi = spark.createDataFrame([("मान्य",)], "validation_status string")
    assert cols.translate_categories(hindi, HINDI_CATEGORIES).first()[0] == "validated"


def test_daily_run_adds_new_days_once(spark, tmp_path):
    out = str(tmp_path / "daily")
    first = spark.createDataFrame([("109", "2026-01-15", "5800", "raw")], PROVIDER)
    page = spark.createDataFrame(
        [("109", "2026-01-15", "5800", "Donnée brute"), ("109", "2026-01-16", "6200", "Donnée brute"),
         ("109", "2026-01-17", "6300", "Donnée validée")],
        PROVIDER,
    )
    assert daily.run_daily(spark, [first], out, date(2026, 1, 16), {"title": "t"}).count() == 1
    done = daily.run_daily(spark, [page], out, date(2026, 1, 20), {"title": "t"})
    assert [(r["record_date"].day, r["validation_status"]) for r in done.orderBy("record_date").collect()] == [(15, "raw"), (16, "raw"), (17, "validated")]
    current = publish.VersionedDataset(spark, out).current()
    meta = json.loads(spark.read.text(f"{current}/metadata").first()[0])
    assert meta["temporalCoverage"] == {"startDate": "2026-01-15", "endDate": "2026-01-17"}
    same = daily.run_daily(spark, [page], out, date(2026, 1, 18), {"title": "t"})
    assert same.count() == 3 and publish.VersionedDataset(spark, out).current() == current


def test_old_versions_go(spark, tmp_path):
    out = str(tmp_path / "daily")
    for day in range(5, 10):
        page = spark.createDataFrame([("109", f"2026-01-0{day}", "5800", "raw")], PROVIDER)
        got = daily.run_daily(spark, [page], out, date(2026, 1, day + 1), {}, keep_versions=2)
    assert got.count() == 5 and len(list((tmp_path / "daily").glob("version-*"))) == 2


def test_day_table_leaves_untimed_rows_out(spark, tmp_path):
    schema = "station_code string, timestamp timestamp, water_level double, dedup_key string"
    batch = spark.createDataFrame([("A", datetime(2026, 1, 1), 1.0, "k1"), ("A", None, 2.0, "k2")], schema)
    root = str(tmp_path / "days")
    assert [publish.upsert_days(spark, root, batch, retention_days=5) for _ in range(2)] == [1, 1]
    assert publish.read_days(spark, root, 5).count() == 1 and publish.newest_day(spark, root).count() == 1


def test_hourly_run_extracts_from_a_landing_zone(spark, tmp_path, catalogue):
    zone = tmp_path / "zone"
    for basin, years, level in (("Cauvery", "(2026 - 2030)", "82.5"), ("Cauvery", "(2016 - 2020)", "9"), ("Yamuna", "(2026 - 2030)", "200")):
        folder = zone / f"basin={basin}" / f"time_range={years}"
        folder.mkdir(parents=True)
        rows = [{"Station": "MUSIRI", "Data Acquisition Time": f"0{d}-01-2026 05:30", "River Water Level Telemetry Hourly (meter)": level} for d in (1, 2)]
        (folder / "page.json").write_text(json.dumps({"result": {"records": rows}}))
    fields = "basin string, kind string, time_range string, resource_id string, start_year int, end_year int"
    manifest = spark.createDataFrame(
        [("Cauvery", "telemetry", "(2026 - 2030)", "r1", 2026, 2030), ("Cauvery", "telemetry", "(2016 - 2020)", "r2", 2016, 2020),
         ("Yamuna", "telemetry", "(2026 - 2030)", "r3", 2026, 2030)],
        fields,
    )
    args = dict(root=str(tmp_path / "out"), end=datetime(2026, 2, 1), default_start=datetime(2025, 12, 1), descriptors={}, provider="p")
    done = run_hourly(spark, str(zone), catalogue, manifest, basins=["cauvery"], **args)
    assert sorted(r["water_level"] for r in done.readings.collect()) == [82.5, 82.5]
    with pytest.raises(ValueError):
        run_hourly(spark, str(zone), catalogue, manifest, basins=["nowhere"], **args)
    with pytest.raises(ValueError):
        run_hourly(spark, str(zone), catalogue.withColumn("latitude", F.lit(100.0)), manifest, **args)


def test_cursor(spark):
    page = spark.createDataFrame([(date(2026, 1, 5),), (date(2026, 1, 7),)], "record_date date")
    assert published.next_cursor(page, date(2026, 1, 20)).first()[0] == date(2026, 1, 8)
    assert published.next_cursor(page, date(2026, 1, 8)).first()[0] is None
    assert published.next_cursor(page.limit(0), date(2026, 1, 8)).first()[0] is None


def test_payload_pages_are_written_by_many_tasks_and_read_with_their_schema(spark, tmp_path, monkeypatch):
    from gaugeworks.bindings import reports

    spark.range(60_000).selectExpr("id AS event_id", "'{\"k\": 1}' AS props").write.parquet(f"{tmp_path}/events.parquet")
    read, seen = payload.read_payloads, []

    def reading(spark, path, schema=None):
        seen.append((path, schema))
        return read(spark, path, schema)

    monkeypatch.setattr(payload, "read_payloads", reading)
    got = reports.payload_explode(spark, str(tmp_path))
    assert got.count() == sum((i // 200) % 7 < 4 for i in range(60_000))
    (path, schema), = seen
    files = [f.name for f in Path(path.removeprefix("file:")).glob("part-*")]
    assert schema is not None and len(files) >= 300
    assert len({name.split("-")[1] for name in files}) >= 4
