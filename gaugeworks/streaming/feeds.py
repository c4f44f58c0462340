"""The hourly feed as a stream: ingest, dedup, upsert, hourly means, latest status."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from gaugeworks.sources.snapshots import DaySnapshots


def landed_stream(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", files_per_trigger: int | None = None
) -> DataFrame:
    """Files of a landing folder, each read once."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def dedup_stream(readings: DataFrame, lateness: str, key: str = "dedup_key", ts: str = "timestamp") -> DataFrame:
    """First row per key within the lateness bound."""
    return readings.withWatermark(ts, lateness).dropDuplicatesWithinWatermark([key])


def hourly_stream(readings: DataFrame, lateness: str, ts: str = "timestamp", level: str = "water_level") -> DataFrame:
    """Hourly mean per station, emitted once an hour is past the watermark (T4)."""
    return (
        readings.withWatermark(ts, lateness)
        .groupBy("station_code", F.window(ts, "1 hour"))
        .agg(F.avg(level).alias("level"), F.count(level).alias("readings"))
        .select("station_code", F.col("window.start").alias("hour_start"), "level", "readings")
    )


def latest_stream(readings: DataFrame, columns: list[str], order: list[str]) -> DataFrame:
    """Newest row per station, kept as state (T5); use update or complete mode."""
    row = F.max_by(F.struct(*columns), F.struct(*order)).alias("row")
    return readings.groupBy("station_code").agg(row).select("station_code", "row.*")


def upsert_batches(
    spark: SparkSession, root: str, sequence: str | None = None, retention_days: int = 0, keep_versions: int = 24
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body: last-wins merge of each batch as a new version of the days.

    Readers see whole batches only. Merging the same batch again gives the same rows, so a
    batch repeated after a failure does no harm.
    """
    days = DaySnapshots(spark, root)

    def merge(batch: DataFrame, _: int) -> None:
        if days.commit(batch, sequence, retention_days).days:
            days.prune(keep_versions)

    return merge


def run_available(
    stream: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None] | str, mode: str = "append"
) -> StreamingQuery:
    """Process what has landed, then stop; ``sink`` is a path or a batch function."""
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if callable(sink):
        query = writer.foreachBatch(sink).start()
    else:
        query = writer.format("parquet").option("path", sink).start()
    query.awaitTermination()
    return query
