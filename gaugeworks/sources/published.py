"""Reading published tables, and where an incremental run starts."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from gaugeworks.functions.parsing import to_day
from gaugeworks.schema import EARLIEST_DATE, READINGS


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path (or a glob's match) exists on its Hadoop file system."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(jvm_path)
    return found is not None and len(found) > 0


def read_published(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType = READINGS
) -> DataFrame:
    """A published table, or an empty one of the same schema when it is absent."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True).option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]XXX")
    return reader.format(fmt).load(path)


def read_readable(
    spark: SparkSession, path: str, schema: T.StructType = READINGS
) -> tuple[DataFrame, list[str]]:
    """The Parquet files of a published table that can be read, and the names of those that cannot.

    This is the caller's choice to go on without damaged files; with none left the table is
    empty. A file counts as damaged if it does not end as a Parquet file does, which is
    looked up per file without reading its rows.
    """
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema), []
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    found, good, bad = system.listFiles(folder, True), [], []
    while found.hasNext():
        status = found.next()
        name = status.getPath().getName()
        if name.startswith(("_", ".")):
            continue
        (good if _ends_as_parquet(system, status) else bad).append(status.getPath().toString())
    rows = spark.read.schema(schema).option("basePath", path).parquet(*good) if good else spark.createDataFrame([], schema)
    return rows, sorted(bad)


def _ends_as_parquet(system, status) -> bool:
    """Head and tail hold the format's mark, and the footer's length fits the file."""
    size = status.getLen()
    if size < 12:
        return False
    stream = system.open(status.getPath())
    try:
        stream.seek(size - 8)
        tail = [stream.read() for _ in range(8)]
    finally:
        stream.close()
    footer = int.from_bytes(bytes(tail[:4]), "little")
    return bytes(tail[4:]) == b"PAR1" and footer + 12 <= size


def high_water_mark(readings: DataFrame, default: datetime, per_station: bool = False) -> DataFrame:
    """Newest timestamp, else the default start (S4); optionally one per station."""
    start = F.lit(default).cast("timestamp")
    grouped = readings.groupBy("station_code") if per_station else readings.groupBy()
    return grouped.agg(F.coalesce(F.max("timestamp"), start).alias("since"))


def incremental_slice(raw: DataFrame, since: datetime | Column, end: datetime | Column) -> DataFrame:
    """Rows with ``since < timestamp <= end``; unparsed timestamps are kept.

    Plain values become literals, which Parquet row groups are skipped by.
    """
    low = since if isinstance(since, Column) else F.lit(since).cast("timestamp")
    high = end if isinstance(end, Column) else F.lit(end).cast("timestamp")
    ts = F.col("timestamp")
    return raw.filter(ts.isNull() | ((ts > low) & (ts <= high)))


def update_decision(existing: DataFrame, as_of: date, region: str = "france") -> DataFrame:
    """One row: whether a daily update is due and from which day."""
    column = next((c for c in ("date_obs_elab", "record_date") if c in existing.columns), None)
    if column is None:
        raise KeyError("expected a date_obs_elab or record_date column")
    yesterday = F.lit(as_of - timedelta(days=1))
    last = existing.agg(F.max(to_day(F.col(column), dict(existing.dtypes)[column])).alias("last_day"))
    due = F.col("last_day").isNull() | (F.col("last_day") < yesterday)
    return last.select(
        due.alias("should_update"),
        F.when(F.col("last_day").isNull(), F.lit(date.fromisoformat(EARLIEST_DATE[region])))
        .when(due, F.date_add("last_day", 1))
        .alias("start_date"),
    )


def daily_since(landed: DataFrame, start: date | Column, column: str = "record_date") -> DataFrame:
    """Landed daily rows from the cursor day on, days midnight-normalised."""
    day = to_day(F.col(column), dict(landed.dtypes)[column])
    return landed.withColumn(column, day).filter(F.col(column) >= start)


def next_cursor(page: DataFrame, as_of: date, column: str = "record_date") -> DataFrame:
    """Day after the last one of a page; NULL when the feed is up to date."""
    last = page.agg(F.max(column).alias("last_day"))
    caught_up = F.col("last_day") >= F.lit(as_of - timedelta(days=1))
    return last.select(F.when(~caught_up, F.date_add("last_day", 1)).alias("cursor"))
