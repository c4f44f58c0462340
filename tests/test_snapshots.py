"""Versions that share days, kept summaries and documents written row by row."""

from __future__ import annotations

import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gaugeworks.operators import latest, metadata, quality
from gaugeworks.operators.merge import merge_readings
from gaugeworks.operators.summary import Summary
from gaugeworks.schema import READINGS
from gaugeworks.sources import publish
from gaugeworks.sources.snapshots import FORMATS, DaySnapshots

START = datetime(2026, 1, 1)
STATUS = ["NORMAL", "WARNING", "DANGER", None]


def batch(spark, first, hours, seed, stations=("A", "B/ö", None)):
    rng, rows = random.Random(seed), []
    for h in range(hours):
        for code in stations:
            for copy in range(rng.choice([0, 1, 1, 2])):
                level = rng.choice([None, rng.randint(0, 50) / 4])
                moment = START + timedelta(hours=first + h)
                rows.append((code, code, "b", moment, level, rng.choice(STATUS), 1.0, None, 3.0, 1.0, 2.0, f"{code}_{moment}_{level}"))
    return spark.createDataFrame(rows, READINGS)


def same(one, two):
    assert one.columns == two.columns
    return sorted(map(str, one.collect())) == sorted(map(str, two.collect()))


def folders(root):
    return {p.relative_to(root).as_posix() for p in root.glob("batch-*/parquet/day=*")}


def test_a_run_of_one_day_writes_one_day(spark, tmp_path):
    data, whole = DaySnapshots(spark, str(tmp_path)), spark.createDataFrame([], READINGS)
    runs = [batch(spark, 0, 72, 1), batch(spark, 48, 24, 2), batch(spark, 70, 26, 3), batch(spark, 96, 4, 4)]
    expected_days = [["2026-01-01", "2026-01-02", "2026-01-03"], ["2026-01-03"], ["2026-01-03", "2026-01-04"], ["2026-01-05"]]
    seen = set()
    for new, days in zip(runs, expected_days):
        done = data.commit(new, retention_days=2, formats=FORMATS)
        whole = merge_readings(whole, new, retention_days=2)
        assert done.days == days and done.untimed == 0
        fresh = folders(tmp_path) - seen
        assert sorted(f[-10:] for f in fresh) == days
        seen |= fresh
        keys = ["station_code", "timestamp", "water_level", "dedup_key"]
        assert same(data.read(2).select(*keys), whole.select(*keys))
        assert data.newest() == whole.agg(F.max("timestamp")).first()[0]
    assert data.commit(runs[-1].limit(0)).days == [] and folders(tmp_path) == seen
    untimed = runs[0].limit(3).withColumn("timestamp", F.lit(None).cast("timestamp"))
    current = data.current()
    assert data.commit(untimed).untimed == 3 and data.current() == current


def test_readers_see_whole_versions_between_any_two_steps(spark, tmp_path, monkeypatch):
    data = DaySnapshots(spark, str(tmp_path))
    data.commit(batch(spark, 0, 60, 1))
    before = sorted(map(str, data.read().collect()))

    class Crash(Exception):
        pass

    def crash(*args, **kwargs):
        raise Crash

    for step in ("_write_formats", "_write_text", "publish", "stage"):
        with monkeypatch.context() as patch:
            patch.setattr(data, step, crash)
            with pytest.raises(Crash):
                data.commit(batch(spark, 40, 40, 2))
        assert sorted(map(str, DaySnapshots(spark, str(tmp_path)).read().collect())) == before
    old = data.read()
    data.commit(batch(spark, 40, 40, 2))
    assert sorted(map(str, old.collect())) == before  # a reader keeps the version it began with
    assert sorted(map(str, data.read().collect())) != before
    held = sorted(map(str, data.read().collect()))
    data.prune(1)
    assert sorted(map(str, data.read().collect())) == held
    listed = {f"{e.batch}/parquet/day={e.day}" for e in data.entries().values()}
    assert folders(tmp_path) == listed and len(list(tmp_path.glob("version-*"))) == 1


def test_prune_keeps_what_older_versions_list(spark, tmp_path):
    data = DaySnapshots(spark, str(tmp_path))
    for k in range(4):
        data.commit(batch(spark, 24 * k, 24, k))
    versions = sorted(tmp_path.glob("version-*"), key=lambda p: p.stat().st_mtime)
    data.prune(2)
    assert sorted(p.name for p in tmp_path.glob("version-*")) == sorted(p.name for p in versions[-2:])
    older = data.entries(str(versions[-2]))
    assert sorted(older) == ["2026-01-01", "2026-01-02", "2026-01-03"] and len(data.entries()) == 4


def test_reports_of_kept_summaries_equal_recomputation(spark, tmp_path):
    data = DaySnapshots(spark, str(tmp_path))
    for k, (first, hours) in enumerate([(0, 100), (90, 30), (115, 10)]):
        done = data.commit(batch(spark, first, hours, k), retention_days=3)
    assert done.days == ["2026-01-05", "2026-01-06"]
    readings, kept = data.read(3), data.summary(3)
    assert same(kept.executive_summary(), quality.executive_summary(readings))
    assert same(kept.duplicate_timestamps(), quality.duplicate_timestamps(readings))
    counts = quality.null_counts(readings)
    assert same(kept.null_counts(), counts)
    assert same(kept.status_counts(), metadata.status_counts(readings))
    assert same(kept.station_table(), latest.station_table(readings))
    whole = quality.validation_report(readings).first()
    report = kept.report()
    assert report.totals.first().asDict() == {k: whole[k] for k in ("stations", "total_records", "excess_duplicates")}
    assert {r[0]: r[1] for r in report.null_percentage.collect()} == whole["null_percentage"]
    newest = latest.latest_reading(readings, "dedup_key")
    assert same(kept.latest(), newest.select(*READINGS.fieldNames()))
    assert same(kept.status_histogram(), latest.status_histogram(newest))
    assert same(kept.kpis(), latest.kpis(readings, "dedup_key"))


def test_summaries_of_nothing(spark, tmp_path):
    data = DaySnapshots(spark, str(tmp_path))
    kept = data.summary(3)
    assert data.read(3).isEmpty() and data.newest() is None and kept.executive_summary().isEmpty()
    assert kept.report().totals.first().asDict() == {"stations": 0, "total_records": 0, "excess_duplicates": 0}
    assert {r["null_pct"] for r in kept.report().null_percentage.collect()} == {100.0}
    assert kept.kpis().first()["stations"] == 0 and kept.latest().isEmpty()


def test_summary_reads_no_readings_but_the_cut_day(spark, tmp_path):
    data = DaySnapshots(spark, str(tmp_path))
    data.commit(batch(spark, 0, 100, 1))
    folders_read = {f.rsplit("/", 3)[-3] + "/" + f.rsplit("/", 2)[-2] for f in data.summary(2).statuses.inputFiles()}
    assert folders_read == {"statuses/day=2026-01-04", "statuses/day=2026-01-05", "parquet/day=2026-01-03"}
    assert all("/statuses/day=" in f for f in data.summary(0).statuses.inputFiles())


def test_documents_are_written_row_by_row(spark, tmp_path):
    rows = [(None, 1), ("a", 2), ('q"uote', 3), ("ü\n", 4)]
    table = spark.createDataFrame(rows, "station_code string, n int").repartition(3)
    head = spark.sql("SELECT 7 AS total, map('x', 1) AS mix")
    sections = {"stations": table, "none": table.limit(0), "last": spark.createDataFrame([(3, "c"), (1, "d")], "k int, v string")}
    publish.write_document(head, sections, str(tmp_path / "doc"))
    got = json.loads(publish.document_text(spark, str(tmp_path / "doc")))
    assert got == {
        "total": 7, "mix": {"x": 1}, "none": [], "last": [{"k": 1, "v": "d"}, {"k": 3, "v": "c"}],
        "stations": [{"n": 1}, {"station_code": "a", "n": 2}, {"station_code": 'q"uote', "n": 3}, {"station_code": "ü\n", "n": 4}],
    }


def test_a_document_of_many_stations_has_short_rows(spark, tmp_path):
    table = spark.range(200_000).select(F.format_string("s%07d", "id").alias("station_code"), F.col("id").alias("records"))
    lines = publish.document_lines(spark.sql("SELECT 1 AS total"), {"stations": table})
    longest, count = lines.agg(F.max(F.length("line")), F.count("*")).first()
    assert longest < 100 and count == 200_003
    publish.write_document(spark.sql("SELECT 1 AS total"), {"stations": table}, str(tmp_path / "doc"))
    assert len(json.loads(publish.document_text(spark, str(tmp_path / "doc")))["stations"]) == 200_000


def test_summary_of_readings_without_days_table(spark):
    readings = batch(spark, 0, 30, 9)
    assert same(Summary.of(readings).executive_summary(), quality.executive_summary(readings))


def test_scratch_tables_go_with_their_block(spark):
    from gaugeworks.session import scratch, written

    kept = written(spark.range(3).toDF("n"), "kept")
    with scratch(spark):
        inside = written(spark.range(5).toDF("n"), "inside")
        assert inside.count() == 5
        folder = inside.inputFiles()[0].rsplit("/", 1)[0]
    assert publish.path_exists(spark, kept.inputFiles()[0]) and not publish.path_exists(spark, folder)
    assert kept.count() == 3
