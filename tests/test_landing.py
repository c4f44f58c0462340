"""Landing zones: folders before files, variants, station names at the scan."""

from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import Observation, functions as F

from gaugeworks.plans.hourly import extract_landed
from gaugeworks.sources import landing, published

MANIFEST = "basin string, kind string, time_range string, resource_id string, start_year int, end_year int"
NOW = "(2026 - 2030)"


def manifest(spark, *basins):
    return spark.createDataFrame([(b, "telemetry", NOW, f"r-{b}", 2026, 2030) for b in basins], MANIFEST)


def put(zone, basin, years, **files):
    folder = zone / f"basin={basin}" / f"time_range={years}"
    folder.mkdir(parents=True, exist_ok=True)
    for name, content in files.items():
        (folder / f"{name}.json").write_text(content if isinstance(content, str) else json.dumps(content, indent=1))


def rows_of(df):
    return sorted((r["station_name"], r["water_level"]) for r in df.collect())


@pytest.mark.parametrize(
    "document, levels",
    [
        ({"result": {"total": 2, "records": [{"level": 1}, {"level": "2.5"}]}}, ["1", "2.5"]),
        ({"data": [{"level": 1}], "observations": [{"level": 9}]}, ["1"]),
        ({"results": [{"level": 1}, {"level": None}, 7, "x", [1]]}, ["1", None]),
        ({"observations": [{"level": 1}], "records": None}, ["1"]),
        ({"observations": [{"level": 1}], "records": {"level": 3}}, ["1"]),
        ([{"level": 1}, {"Water Level ": 2}], ["1", "2"]),
        ({"result": [{"level": 4}]}, ["4"]),
        ({"result": {"total": 0}, "records": [{"level": 1}]}, []),
        ({"result": None, "records": [{"level": 1}]}, []),
        ({"result": {"records": []}, "data": [{"level": 1}]}, []),
        ({"records": [{"level": {"deep": 1}, "WL": 3}]}, ["3"]),
        ("not json", []),
        (7, []),
    ],
)
def test_payload_shapes(spark, tmp_path, document, levels):
    put(tmp_path, "A", NOW, page=document)
    got = landing.landed_records(spark, str(tmp_path), manifest(spark, "A"))
    assert sorted((r["water_level"] for r in got.collect()), key=str) == sorted(levels, key=str)


def test_files_may_differ_in_every_type(spark, tmp_path):
    put(tmp_path, "A", NOW, a={"records": [{"Station": "x", "level": 1.5}]}, b={"data": [{"Station": "y", "level": "1,5", "n": {"k": 1}}]})
    put(tmp_path, "B", NOW, a=[{"Station": 3, "level": True}])
    got = landing.landed_records(spark, str(tmp_path), manifest(spark, "A", "B"))
    assert rows_of(got) == [("3", "true"), ("x", "1.5"), ("y", "1,5")]
    assert got.columns[:2] == ["basin", "time_range"] and set(got.dtypes[2:]) == {(c, "string") for c in got.columns[2:]}


def test_folders_not_chosen_are_not_opened(spark, tmp_path):
    good = {"records": [{"Station": "x", "level": 1.5, "Date": "01-01-2026 05:30"}]}
    put(tmp_path, "A", NOW, a=good)
    alone = landing.landed_records(spark, str(tmp_path), manifest(spark, "A"))
    before = (alone.schema, rows_of(alone))
    put(tmp_path, "A", "(2016 - 2020)", a='{"records": [{"level": {"only_here": 1}}]}')
    put(tmp_path, "C", NOW, a="{ broken", b='{"level": "text"}')
    (tmp_path / "basin=C" / f"time_range={NOW}" / "a.json").chmod(0)
    chosen = manifest(spark, "A").unionByName(
        spark.createDataFrame([("A", "telemetry", "(2016 - 2020)", "old", 2016, 2020), ("Z", "telemetry", NOW, "none", 2026, 2030)], MANIFEST)
    )
    got = extract_landed(spark, str(tmp_path), chosen, datetime(2026, 1, 1), datetime(2026, 2, 1))
    assert (got.count(), len(landing.resource_folders(spark, str(tmp_path), chosen))) == (1, 2)
    again = landing.landed_records(spark, str(tmp_path), manifest(spark, "A", "Z"))
    assert (again.schema, rows_of(again)) == before
    plan = again._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 1 and "basin=C" not in plan
    assert landing.landed_records(spark, str(tmp_path / "none"), manifest(spark, "A")).isEmpty()


def test_reading_starts_no_job_before_an_action(spark, tmp_path):
    put(tmp_path, "A", NOW, a={"records": [{"level": 1}]}, b="nothing")
    chosen = manifest(spark, "A")
    folders = landing.resource_folders(spark, str(tmp_path), chosen)
    spark.sparkContext.setJobGroup("landing", "reading")
    frame = landing.typed_records(landing.variant_records(landing.read_payload_variants(spark, str(tmp_path), folders)))
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("landing")
    assert frame.count() == 1
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_bad_files_are_counted_and_named(spark, tmp_path):
    put(tmp_path, "A", NOW, a={"records": [{"level": 1}]}, b="{", c=" ", d="")
    seen = Observation("payloads")
    assert landing.landed_records(spark, str(tmp_path), manifest(spark, "A"), seen).count() == 1
    assert seen.get["bad_payloads"] == 2
    names = [r["file"].rsplit("/", 1)[-1] for r in landing.bad_payloads(spark, str(tmp_path), manifest(spark, "A")).collect()]
    assert sorted(names) == ["b.json", "c.json"]


# station names at the scan


def zone_and_catalogue(spark, path, stations=400):
    rows = spark.range(stations * 20).select(
        F.when(F.col("id") % 2 == 0, "North").otherwise("south").alias("basin"),
        F.lit(NOW).alias("time_range"),
        F.format_string("S%05d", F.col("id") % stations).alias("Station"),
        F.col("id").alias("level"),
    )
    rows.repartitionByRange(8, "Station").write.partitionBy("basin", "time_range").option("parquet.block.size", 1024).parquet(path)
    return spark.read.parquet(path), rows


def scanned_rows(df):
    """Rows that left the scans, from the executed plan's metrics."""
    df.collect()
    plan, total, todo = df._jdf.queryExecution().executedPlan(), 0, []
    todo.append(plan)
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("Scan parquet"):
            total += node.metrics().get("numOutputRows").get().value()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        if "QueryStage" in node.getClass().getSimpleName():
            todo.append(node.plan())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return total


@pytest.mark.parametrize("few", [1000, 0])
def test_only_asked_stations_are_kept(spark, tmp_path, few):
    landed, rows = zone_and_catalogue(spark, str(tmp_path / "zone"))
    stations = spark.createDataFrame(
        [("NORTH", "S00002"), ("north", "S00004"), ("North", "S00003"), ("elsewhere", "S00006"), ("north", "")],
        "basin_name string, source_station_name string",
    )
    chosen = manifest(spark, "North")
    got = landing.stations_of_resources(landed, chosen, stations, few=few)
    assert {(r["basin"], r["Station"]) for r in got.collect()} == {("North", "S00002"), ("North", "S00004")} and got.count() == 40
    both = landing.stations_of_resources(landed, manifest(spark, "North", "south"), stations, few=few)
    assert both.count() == 40 + rows.filter("basin = 'south'").count()  # a basin without stations is read whole
    assert landing.stations_of_resources(landed, chosen.limit(0), stations, few=few).count() == 0


def test_few_names_reach_the_scan(spark, tmp_path):
    landed, _ = zone_and_catalogue(spark, str(tmp_path / "zone"))
    stations = spark.createDataFrame([("north", "S00002"), ("north", "S00004")], "basin_name string, source_station_name string")
    got = landing.stations_of_resources(landed, manifest(spark, "North"), stations)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "In(Station, [S00002,S00004])" in plan and "PartitionFilters" in plan
    assert scanned_rows(got) < landed.count() / 4


def test_many_names_become_a_bloom_filter(spark, tmp_path):
    landed, _ = zone_and_catalogue(spark, str(tmp_path / "zone"))
    stations = spark.range(150).select(F.lit("north").alias("basin_name"), F.format_string("S%05d", 2 * F.col("id")).alias("source_station_name"))
    stations.write.parquet(str(tmp_path / "stations"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        got = landing.stations_of_resources(landed, manifest(spark, "North"), spark.read.parquet(str(tmp_path / "stations")), few=10)
        assert got.count() == 150 * 20
        assert "might_contain" in got._jdf.queryExecution().optimizedPlan().toString()
    finally:
        for k in settings:
            spark.conf.unset(k)


# unreadable published tables


def test_unreadable_files_fail_or_are_left_out_and_named(spark, tmp_path):
    path = str(tmp_path / "table")
    spark.range(4).select(F.col("id").cast("string").alias("station_code")).repartition(2).write.parquet(path)
    (tmp_path / "table" / "part-bad.parquet").write_bytes(b"PAR1 cut off")
    (tmp_path / "table" / "part-empty.parquet").write_bytes(b"")
    with pytest.raises(Exception, match="part-"):
        published.read_published(spark, path).collect()
    kept, bad = published.read_readable(spark, path)
    assert sorted(r["station_code"] for r in kept.collect()) == ["0", "1", "2", "3"]
    assert sorted(b.rsplit("/", 1)[-1] for b in bad) == ["part-bad.parquet", "part-empty.parquet"]
    for file in (tmp_path / "table").glob("*.parquet"):
        file.write_bytes(b"")
    kept, bad = published.read_readable(spark, path)
    assert kept.isEmpty() and len(bad) == 4 and kept.columns == published.READINGS.fieldNames()
    assert published.read_readable(spark, str(tmp_path / "absent"))[1] == []


def test_lines_are_payloads_like_files(spark, tmp_path):
    documents = [{"result": {"records": [{"level": 1}]}}, [{"level": "2.5"}, 7], {"data": [{"level": {"deep": 1}, "WL": 3}]}, "not json"]
    put(tmp_path / "files", "A", NOW, **{f"p{i}": d for i, d in enumerate(documents)})
    lines = [d if isinstance(d, str) else json.dumps(d) for d in documents]
    put(tmp_path / "lines", "A", NOW, one="\n".join([*lines[:2], "", "  "]), two="\n".join([*lines[2:], lines[3], ""]))
    chosen, seen = manifest(spark, "A"), Observation("lines")
    whole = landing.landed_records(spark, str(tmp_path / "files"), chosen)
    got = landing.landed_records(spark, str(tmp_path / "lines"), chosen, seen, lines=True)
    assert rows_of(got) == rows_of(whole) and len(rows_of(got)) == 3
    assert seen.get["bad_payloads"] == 2
    assert [r["file"].rsplit("/", 1)[-1] for r in landing.bad_payloads(spark, str(tmp_path / "lines"), chosen, lines=True).collect()] == ["two.json"]


def test_the_zone_of_the_queries_has_few_files(spark, tmp_path):
    from pathlib import Path

    from gaugeworks.bindings import feeds

    kinds = "element_at(array('click', 'view', 'purchase'), cast(id % 3 + 1 AS int)) AS event_type"
    rows = spark.range(8_000).selectExpr("id AS event_id", "timestamp'2024-01-05' + make_dt_interval(0, 0, 0, id) AS ts", kinds, "id % 50 + 0.25D AS value", "'{}' AS props")
    rows.write.parquet(f"{tmp_path}/events.parquet")
    zone, _ = feeds._json_zone(spark, str(tmp_path))
    files = [f for f in Path(zone.removeprefix("file:")).rglob("part-*")]
    assert len(files) < 80  # 80 payloads to be read, 160 beside them
    got = feeds.payload_variants(spark, str(tmp_path))
    assert got.count() == 8_000 and got.filter("water_level IS NULL").count() == 160
