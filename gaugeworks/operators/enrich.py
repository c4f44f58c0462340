"""Joins of readings with the station catalogue.

The catalogue side carries no broadcast hint: Catalyst broadcasts it while its
known size is under the session threshold and shuffles beyond that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gaugeworks.functions.text import clean_name

PROFILE = [
    "station_code",
    "station_name",
    "basin_name",
    "warning_level",
    "danger_level",
    "high_flood_level",
    "latitude",
    "longitude",
]


def spellings(catalogue: DataFrame) -> DataFrame:
    """One row per accepted cleaned spelling; the first catalogue entry wins."""
    names = F.concat(
        F.array("source_station_name", "station_name"),
        F.coalesce("match_aliases", F.array().cast("array<string>")),
    )
    return (
        catalogue.select("position", F.struct(*PROFILE).alias("profile"), F.explode(names).alias("spelling"))
        .select("position", "profile", clean_name(F.col("spelling")).alias("clean_name"))
        .filter(F.col("clean_name").isNotNull())
        .groupBy("clean_name")
        .agg(F.min_by("profile", "position").alias("profile"))
    )


def join_stations(df: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Station code, name, basin, thresholds and coordinates by name.

    Unresolved names become the code, a missing name ``UNKNOWN``; coordinates of
    the reading come before those of the catalogue.
    """
    if "station_name" not in df.columns:
        return df
    own = [c for c in df.columns if c not in PROFILE]
    held = set(df.columns)
    raw = {c: F.col(c) if c in held else F.lit(None).cast("double") for c in ("latitude", "longitude")}
    p = "profile."
    return (
        df.withColumn("clean_name", clean_name(F.col("station_name")))
        .join(spellings(catalogue), "clean_name", "left")
        .select(
            *own,
            F.coalesce(F.col(p + "station_code"), F.col("station_name"), F.lit("UNKNOWN")).alias("station_code"),
            F.coalesce(F.col(p + "station_name"), F.col("station_name")).alias("station_name"),
            F.col(p + "basin_name").alias("basin_name"),
            *[F.col(p + c).alias(c) for c in ("warning_level", "danger_level", "high_flood_level")],
            *[F.coalesce(raw[c], F.col(p + c)).alias(c) for c in ("latitude", "longitude")],
        )
    )


def unresolved_names(df: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Distinct names that match no catalogue entry, sorted."""
    return (
        df.select(F.coalesce("station_name", F.lit("UNKNOWN")).alias("station_name"))
        .distinct()
        .withColumn("clean_name", clean_name(F.col("station_name")))
        .join(spellings(catalogue).select("clean_name"), "clean_name", "left_anti")
        .select("station_name")
        .orderBy("station_name")
    )


def monitored_only(df: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Rows of catalogue stations, and rows that name no station."""
    known = spellings(catalogue).select("clean_name", F.lit(True).alias("monitored"))
    name = clean_name(F.col("station_name"))
    return (
        df.withColumn("clean_name", name)
        .join(known, "clean_name", "left")
        .filter(F.col("monitored") | (F.coalesce("clean_name", F.lit("")) == ""))
        .drop("clean_name", "monitored")
    )


def absent_stations(readings: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Configured stations without a single row."""
    seen = readings.select("station_code").distinct()
    return catalogue.join(seen, "station_code", "left_anti").select("station_code", "station_name", "basin_name")


def without_model(readings: DataFrame, trained: DataFrame) -> DataFrame:
    """Station codes with data but no trained model."""
    seen = readings.filter(F.col("station_code").isNotNull()).select("station_code").distinct()
    return seen.join(trained.select("station_code"), "station_code", "left_anti").orderBy("station_code")


def station_counts(readings: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Record count for every catalogue station, 0 when absent."""
    return counts_for_catalogue(readings.groupBy("station_code").agg(F.count("*").alias("records")), catalogue)


def counts_for_catalogue(counts: DataFrame, catalogue: DataFrame) -> DataFrame:
    """The same from (station_code, records) counted elsewhere."""
    return catalogue.join(counts, "station_code", "left").select(
        "station_code",
        "station_name",
        "basin_name",
        "latitude",
        "longitude",
        F.col("warning_level").alias("warning_level_m"),
        F.col("danger_level").alias("danger_level_m"),
        F.col("high_flood_level").alias("high_flood_level_m"),
        F.coalesce("records", F.lit(0)).cast("bigint").alias("records"),
    )
