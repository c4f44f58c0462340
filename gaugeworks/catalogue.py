"""Station catalogue and source manifest as small DataFrames, and their audit."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# --- Fixed values: monitored stations --------------------------------------
STATION_FIELDS = [
    "station_code",
    "station_name",
    "source_station_name",
    "basin_name",
    "kind",
    "warning_level",
    "danger_level",
    "high_flood_level",
    "latitude",
    "longitude",
]
STATIONS = [
    ("YMNDLH", "Yamuna at Old Delhi Railway Bridge", "Old Delhi Railway Bridge", "Yamuna Basin", "manual", 204.50, 205.33, 207.49, 28.6585, 77.2347),
    ("YMNCKT", "Yamuna at Chitrakoot", "Chitrakoot", "Yamuna Basin", "manual", 137.00, 137.50, 138.50, 25.14222222, 80.85472222),
    ("PTHNGD", "Godavari at Paithan (Jaikwadi Dam)", "Jaikwadi Dam", "Godavari", "telemetry", 463.91, 465.50, 465.50, 19.4720, 75.3500),
    ("GDBDCL", "Godavari at Bhadrachalam", "Bhadrachalam", "Godavari", "telemetry", 45.72, 48.77, 55.66, 17.66944444, 80.87388889),
    ("KRSNWDP", "Krishna at Wadenepally", "Wadenepally", "Krishna", "telemetry", 23.00, 23.50, 24.00, 16.79416667, 80.07305556),
    ("CAVMSI", "Cauvery at Musiri", "MUSIRI", "Cauvery", "telemetry", 82.115, 83.115, 86.175, 10.93805556, 78.44027778),
    ("NRMMDL", "Narmada at Mandla", "Mandla", "Narmada", "telemetry", 437.2, 437.8, 439.405, 22.59833333, 80.36527778),
]

# --- Fixed values: source resources, one per basin, kind and year range ----
RESOURCE_FIELDS = ["basin", "kind", "time_range", "resource_id", "start_year", "end_year"]
RESOURCES = [
    ("Godavari", "telemetry", "(2021 - 2025)", "4d139325-8371-422f-acef-d34ccec4300e", 2021, 2025),
    ("Godavari", "telemetry", "(2026 - 2030)", "c6f31452-b416-4599-a6ae-07ad4217cdf4", 2026, 2030),
    ("Krishna", "telemetry", "(2021 - 2025)", "4ddede56-5e49-4956-bb6f-df3786bf601f", 2021, 2025),
    ("Krishna", "telemetry", "(2026 - 2030)", "d80798b9-4b11-4626-8b63-964202ba7216", 2026, 2030),
    ("Cauvery", "telemetry", "(2021 - 2025)", "b5776a31-0583-4c27-a2d9-ee81e3b3a03a", 2021, 2025),
    ("Cauvery", "telemetry", "(2026 - 2030)", "d027c5ac-379d-4ac2-8ced-97b02b6edbc0", 2026, 2030),
    ("Narmada", "telemetry", "(2021 - 2025)", "0b01ff69-83de-4274-8233-6e564a6eeb9a", 2021, 2025),
    ("Narmada", "telemetry", "(2026 - 2030)", "a2e056f6-ed8a-45bf-9142-01dc1904405a", 2026, 2030),
    ("Yamuna Basin", "manual", "(2021 - 2025)", "dd3b9bba-6ba2-4954-93cf-e3ee84b5d9af", 2021, 2025),
    ("Yamuna Basin", "manual", "(2026 - 2030)", "8663d648-5057-4eaf-86fc-72d5e755f053", 2026, 2030),
]
KINDS = ["telemetry", "manual"]
# ---------------------------------------------------------------------------


def _local(spark: SparkSession, rows: list[dict], fields: list[tuple[str, pa.DataType]]) -> DataFrame:
    # an Arrow table becomes a local relation whose size Catalyst knows, so it
    # decides on broadcasting by that size and no hint is needed
    return spark.createDataFrame(pa.Table.from_pylist(rows, schema=pa.schema(fields)))


def make_catalogue(spark: SparkSession, stations: list[dict]) -> DataFrame:
    """Catalogue rows in catalogue order; ``match_aliases`` defaults to empty."""
    text, number = pa.string(), pa.float64()
    types = [text] * 5 + [number] * 5
    fields = [("position", pa.int64()), *zip(STATION_FIELDS, types), ("match_aliases", pa.list_(text))]
    rows = [{"match_aliases": [], **station, "position": i} for i, station in enumerate(stations)]
    return _local(spark, rows, fields)


def default_catalogue(spark: SparkSession) -> DataFrame:
    return make_catalogue(spark, [dict(zip(STATION_FIELDS, row)) for row in STATIONS])


def default_manifest(spark: SparkSession) -> DataFrame:
    types = [pa.string()] * 4 + [pa.int32()] * 2
    rows = [dict(zip(RESOURCE_FIELDS, row)) for row in RESOURCES]
    return _local(spark, rows, list(zip(RESOURCE_FIELDS, types)))


def _blank(c: Column) -> Column:
    return F.coalesce(F.trim(c), F.lit("")) == ""


def audit_catalogue(catalogue: DataFrame, key: str = "station_code") -> DataFrame:
    """One row per catalogue entry with the list of violated rules.

    ``key`` names the column the catalogue is looked up by; it has to equal the
    entry's own code.
    """
    rules = {
        "empty station_code": _blank(F.col("station_code")),
        "empty source_station_name": _blank(F.col("source_station_name")),
        "unknown kind": ~F.coalesce(F.col("kind").isin(KINDS), F.lit(False)),
        "latitude out of range": ~F.coalesce(F.col("latitude").between(-90, 90), F.lit(False)),
        "longitude out of range": ~F.coalesce(F.col("longitude").between(-180, 180), F.lit(False)),
        "thresholds not ascending": ~F.coalesce(
            (F.col("warning_level") <= F.col("danger_level"))
            & (F.col("danger_level") <= F.col("high_flood_level")),
            F.lit(False),
        ),
        "key differs from station_code": ~F.col(key).eqNullSafe(F.col("station_code")),
    }
    found = F.array(*[F.when(broken, F.lit(text)) for text, broken in rules.items()])
    return catalogue.withColumn("violations", F.array_compact(found))


def require_valid(catalogue: DataFrame, key: str = "station_code") -> DataFrame:
    """The catalogue itself, or an error naming the first broken entries."""
    if catalogue.isEmpty():
        raise ValueError("station catalogue must not be empty")
    broken = audit_catalogue(catalogue, key).filter(F.size("violations") > 0)
    examples = broken.select(key, "violations").take(5)
    if examples:
        raise ValueError(f"invalid station catalogue: {[tuple(r) for r in examples]}")
    return catalogue
