"""Metadata documents of the published datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gaugeworks.operators.enrich import counts_for_catalogue
from gaugeworks.schema import READING_COLUMNS
from gaugeworks.session import cut_lineage

ISO = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def temporal_bounds(df: DataFrame, column: str = "timestamp", pattern: str = ISO) -> DataFrame:
    """First and last time as text, or ``unknown``."""
    return df.agg(
        F.coalesce(F.date_format(F.min(column), pattern), F.lit("unknown")).alias("start_date"),
        F.coalesce(F.date_format(F.max(column), pattern), F.lit("unknown")).alias("end_date"),
    )


def status_counts(df: DataFrame) -> DataFrame:
    """Rows per status, missing excluded."""
    return df.filter(F.col("flood_status").isNotNull()).groupBy("flood_status").agg(F.count("*").alias("records"))


def reading_fold(readings: DataFrame) -> DataFrame:
    """Records and bounds per (station, status)."""
    return readings.groupBy("station_code", "flood_status").agg(
        F.count("*").alias("records"), F.min("timestamp").alias("low"), F.max("timestamp").alias("high")
    )


def metadata_parts(
    fold: DataFrame,
    columns: list[str],
    catalogue: DataFrame,
    manifest: DataFrame,
    retention_days: int,
    generated_at: str,
    descriptors: dict[str, str],
    provider: str,
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """The metadata document (A8) as one row of totals and its lists as tables.

    Texts and the clock are parameters; all counts come from the fold.
    """
    mix = fold.filter(F.col("flood_status").isNotNull()).groupBy("flood_status").agg(F.sum("records").alias("records"))
    entries = F.array_sort(F.collect_list(F.struct("flood_status", "records")))
    counts = fold.groupBy("station_code").agg(F.sum("records").alias("records"))
    sources = manifest.select(F.lit(provider).alias("provider"), "basin", "kind", "time_range", "resource_id")
    total = fold.agg(
        F.coalesce(F.sum("records"), F.lit(0)).alias("total_records"), F.min("low").alias("low"), F.max("high").alias("high")
    )
    unknown = F.lit("unknown")
    head = total.select(
        *[F.lit(text).alias(name) for name, text in descriptors.items()],
        F.struct(
            F.coalesce(F.date_format("low", ISO), unknown).alias("start_date"),
            F.coalesce(F.date_format("high", ISO), unknown).alias("end_date"),
        ).alias("temporalCoverage"),
        catalogue.agg(F.array_sort(F.collect_set("basin_name"))).scalar().alias("monitored_basins"),
        "total_records",
        mix.agg(F.map_from_entries(entries)).scalar().alias("alert_status_distribution"),
        F.struct(F.array(*[F.lit(c) for c in READING_COLUMNS if c in columns]).alias("columns")).alias("schema"),
        F.lit(retention_days).alias("retention_days"),
        F.lit(generated_at).alias("generated_at"),
    )
    return head, {"monitored_stations": counts_for_catalogue(counts, catalogue), "sources": sources}


def dataset_metadata(
    readings: DataFrame,
    catalogue: DataFrame,
    manifest: DataFrame,
    retention_days: int,
    generated_at: str,
    descriptors: dict[str, str],
    provider: str,
) -> DataFrame:
    """The metadata document in one row, for catalogues whose stations fit a row.

    One pass folds the readings to a row per (station, status), which is written
    down; everything else works on that fold, the catalogue or the manifest.
    """
    fold = cut_lineage(reading_fold(readings))
    head, lists = metadata_parts(
        fold, readings.columns, catalogue, manifest, retention_days, generated_at, descriptors, provider
    )
    gathered = {name: table.agg(F.array_sort(F.collect_list(F.struct("*")))).scalar() for name, table in lists.items()}
    before = head.columns.index("total_records")
    return head.select(
        *head.columns[:before],
        gathered["monitored_stations"].alias("monitored_stations"),
        "total_records",
        "alert_status_distribution",
        "schema",
        gathered["sources"].alias("sources"),
        "retention_days",
        "generated_at",
    )


def daily_metadata(df: DataFrame, descriptors: dict[str, str]) -> DataFrame:
    """First and last record date plus given descriptors."""
    bounds = temporal_bounds(df, "record_date", "yyyy-MM-dd")
    return bounds.select(
        *[F.lit(text).alias(name) for name, text in descriptors.items()],
        F.struct(F.col("start_date").alias("startDate"), F.col("end_date").alias("endDate")).alias("temporalCoverage"),
    )


def as_json(document: DataFrame) -> DataFrame:
    """A one-row document as one JSON text."""
    return document.select(F.to_json(F.struct("*")).alias("value"))
