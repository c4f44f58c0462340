"""The hourly job: landed records to a published, validated dataset."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from gaugeworks.functions.levels import flood_status
from gaugeworks.functions.text import reading_key
from gaugeworks.operators import columns as cols
from gaugeworks.operators.enrich import absent_stations, join_stations, monitored_only
from gaugeworks.operators.metadata import metadata_parts
from gaugeworks.operators.summary import Report, Summary
from gaugeworks.catalogue import require_valid
from gaugeworks.schema import READING_COLUMNS
from gaugeworks.session import cut_lineage
from gaugeworks.sources.landing import landed_records
from gaugeworks.sources.publish import newest_day, read_days, upsert_days, write_document
from gaugeworks.sources.published import high_water_mark, incremental_slice
from gaugeworks.sources.resources import require_resources, resources_in_window, select_resources
from gaugeworks.sources.snapshots import FORMATS, DaySnapshots


def transform_readings(raw: DataFrame, catalogue: DataFrame | None = None, source_zone: str = "UTC") -> DataFrame:
    """Raw provider rows to canonical readings (C1); it does not deduplicate."""
    df = cols.normalize_columns(raw)
    df = cols.drop_untimed(cols.with_utc_timestamp(df, source_zone))
    return enrich_readings(df, catalogue)


def enrich_readings(df: DataFrame, catalogue: DataFrame | None = None, sequence: str | None = None) -> DataFrame:
    """The part of C1 after the timestamps are parsed and checked; ``sequence`` is kept for a merge."""
    df = cols.coerce_doubles(df, ["water_level", "latitude", "longitude"])
    if catalogue is not None:
        df = join_stations(df, catalogue)
    held = set(df.columns)
    missing = [c for c in ("station_code", "warning_level", "danger_level", "high_flood_level") if c not in held]
    df = df.withColumns(
        {c: F.lit(None).cast("string" if c == "station_code" else "double") for c in missing}
    ) if missing else df
    status = flood_status(
        F.col("water_level"), F.col("warning_level"), F.col("danger_level"), F.col("high_flood_level")
    )
    key = reading_key(F.col("station_code"), F.col("timestamp"), F.col("water_level"))
    df = df.withColumn("flood_status", status).withColumn("dedup_key", key)
    return df.select(*[c for c in READING_COLUMNS if c in df.columns], sequence) if sequence else cols.canonical(df)


@dataclass
class HourlyRun:
    """What one run produced: the current version, what was written, and the reports."""

    version: str | None
    days: list[str]
    dropped_rows: int
    readings: DataFrame
    absent: DataFrame
    report: Report


def fetch_new(
    landed: DataFrame, catalogue: DataFrame, since: datetime, end: datetime, source_zone: str
) -> DataFrame:
    """Landed rows of monitored stations inside the run's window, timestamps parsed."""
    df = cols.with_utc_timestamp(cols.normalize_columns(landed), source_zone)
    return incremental_slice(monitored_only(df, catalogue), since, end)


def extract_landed(
    spark: SparkSession,
    landing: str,
    manifest: DataFrame,
    since: datetime,
    end: datetime,
    report: Observation | None = None,
    lines: bool = False,
) -> DataFrame:
    """Records of a landing zone of JSON payloads that can matter to (since, end].

    ``landing`` has ``basin=.../time_range=...`` folders; those of other resources, or of
    years outside the window, are not opened. With ``lines`` every line of a file is a payload.
    """
    chosen = resources_in_window(manifest, since, end)
    return landed_records(spark, landing, chosen, report, lines).drop("basin", "time_range")


def run_hourly(
    spark: SparkSession,
    landed: DataFrame | str,
    catalogue: DataFrame,
    manifest: DataFrame,
    root: str,
    end: datetime,
    default_start: datetime,
    descriptors: dict[str, str],
    provider: str,
    retention_days: int = 365,
    source_zone: str = "Asia/Kolkata",
    backfill_from: datetime | None = None,
    basins: list[str] | None = None,
    time_ranges: list[str] | None = None,
    sequence: str | None = None,
    keep_versions: int = 24,
    formats: Sequence[str] = FORMATS,
    lines: bool = False,
) -> HourlyRun:
    """Water mark, extract, slice, transform, merge, publish and validate.

    ``landed`` is a landing zone (with ``lines``, of files that hold a payload a line) or a
    table of its records; ``sequence`` names the column that tells the later of two equal keys. Only days that receive rows are read, merged and
    written, in every format; the reports follow from the days' kept summaries. A run
    without new rows writes nothing.
    """
    require_valid(catalogue)
    chosen = require_resources(select_resources(manifest, basins, time_ranges))
    dataset = DaySnapshots(spark, root)
    since = backfill_from or dataset.newest() or default_start
    records = extract_landed(spark, landed, chosen, since, end, lines=lines) if isinstance(landed, str) else landed
    untimed = Observation("untimed rows")
    fetched = fetch_new(records, catalogue, since, end, source_zone)
    fresh = enrich_readings(cols.drop_untimed(fetched, report=untimed), catalogue, sequence)

    def describe(summary: Summary, folder: str) -> None:
        fold = cut_lineage(summary.status_fold().selectExpr("station_code", "flood_status", "n AS records", "start AS low", "end AS high"))
        moment = end.strftime("%Y-%m-%dT%H:%M:%SZ")
        head, lists = metadata_parts(fold, READING_COLUMNS, catalogue, manifest, retention_days, moment, descriptors, provider)
        write_document(head, lists, f"{folder}/metadata")

    done = dataset.commit(fresh, sequence, retention_days, formats, describe)
    if done.days:
        dataset.prune(keep_versions)
    summary = dataset.summary(retention_days)
    return HourlyRun(
        done.version,
        done.days,
        untimed.get["dropped_rows"],
        dataset.read(retention_days),
        absent_stations(summary.stations, catalogue),
        summary.report(),
    )


def refresh_days(
    spark: SparkSession,
    landed: DataFrame,
    catalogue: DataFrame,
    root: str,
    end: datetime,
    default_start: datetime,
    retention_days: int = 365,
    source_zone: str = "Asia/Kolkata",
) -> DataFrame:
    """The same run into a table of days: reads the last day, rewrites touched days.

    The rows equal those of :func:`run_hourly`; the cost follows the new rows
    instead of the whole published history.
    """
    since = high_water_mark(newest_day(spark, root), default_start).first()["since"]
    fetched = cols.drop_untimed(fetch_new(landed, catalogue, since, end, source_zone))
    upsert_days(spark, root, enrich_readings(fetched, catalogue), retention_days=retention_days)
    return read_days(spark, root, retention_days)
