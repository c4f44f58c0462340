"""Choosing source resources: by name, by year range, by station."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F


def split_list(text: str | None) -> list[str] | None:
    """Comma list of a job argument; empty means no filter."""
    parts = [p.strip() for p in (text or "").split(",")]
    return [p for p in parts if p] or None


def select_resources(
    manifest: DataFrame, basins: list[str] | None = None, time_ranges: list[str] | None = None
) -> DataFrame:
    """Any-of substring match on basin, exact match on range, both case-blind."""
    chosen = manifest
    if basins:
        wanted = F.array(*[F.lit(b.strip().lower()) for b in basins])
        chosen = chosen.filter(F.exists(wanted, lambda b: F.contains(F.lower("basin"), b)))
    if time_ranges:
        chosen = chosen.filter(F.lower("time_range").isin([r.strip().lower() for r in time_ranges]))
    return chosen


def require_resources(manifest: DataFrame) -> DataFrame:
    if manifest.isEmpty():
        raise ValueError("no source resource matches the filters")
    return manifest


def resources_in_window(manifest: DataFrame, since: datetime, end: datetime) -> DataFrame:
    """Resources whose years can hold rows of (since, end]."""
    first = F.make_timestamp(F.col("start_year"), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    last = F.make_timestamp(F.col("end_year"), F.lit(12), F.lit(31), F.lit(23), F.lit(59), F.lit(59))
    return manifest.filter(
        (F.lit(since).cast("timestamp") <= last) & (F.lit(end).cast("timestamp") >= first)
    )


def resource_stations(manifest: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Station names to ask each resource for, one row each.

    A resource of a basin without stations keeps one row with a NULL name: it is
    read unfiltered. Rows, not lists, so that a basin may hold any number.
    """
    names = catalogue.select(F.lower("basin_name").alias("basin_key"), "source_station_name").distinct()
    return manifest.withColumn("basin_key", F.lower("basin")).join(names, "basin_key", "left").drop("basin_key")


def read_selected(landed: DataFrame, selected: DataFrame) -> DataFrame:
    """Rows of the selected resources only.

    On a landing zone of ``basin=.../time_range=...`` directories the join keys are
    partition columns, so Spark prunes directories by the selection at run time.
    """
    keys = ["basin", "time_range"]
    return landed.join(selected.select(*keys).distinct(), keys, "left_semi")
