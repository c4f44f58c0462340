"""Publishing: CSV, Parquet, per-station partitions, metadata, whole-version swap."""

from __future__ import annotations

import json
import uuid
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from gaugeworks.operators.merge import dedup_readings, retain_days
from gaugeworks.operators.metadata import as_json
from gaugeworks.schema import READINGS
from gaugeworks.session import cut_lineage
from gaugeworks.sources.published import path_exists, read_published

POINTER = "CURRENT"
ISO_OUT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]XXX"
DAY_SCHEMA = T.StructType([*READINGS.fields, T.StructField("day", T.DateType())])


def by_station_and_time(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Range partitions over (station, time), sorted inside (O1).

    Range bounds are sampled, so a station with most of the rows spreads over
    many partitions and a small one shares a partition with its neighbours.
    """
    keys = ["station_code", "timestamp"]
    ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(*keys)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header."""
    df.write.mode("overwrite").option("header", True).option("timestampFormat", ISO_OUT).csv(path)


def write_parquet(df: DataFrame, path: str) -> None:
    """Parquet copy."""
    df.write.mode("overwrite").parquet(path)


def write_station_partitions(ordered: DataFrame, path: str, fmt: str = "csv") -> None:
    """One directory per station; the station column stays in the files.

    Takes rows that are range-partitioned by station and time, so each task
    meets few stations and needs only a local sort.
    """
    copied = ordered.withColumn("station", F.col("station_code")).sortWithinPartitions("station", "timestamp")
    writer = copied.write.mode("overwrite").option("header", True).option("timestampFormat", ISO_OUT)
    writer.partitionBy("station").format(fmt).save(path)


def write_json(document: DataFrame, path: str) -> None:
    """A one-row document as JSON text, UTF-8."""
    as_json(document).coalesce(1).write.mode("overwrite").text(path)


def document_lines(head: DataFrame, sections: dict[str, DataFrame]) -> DataFrame:
    """``(section, place, key, line)``: a JSON object, a line per row of its lists.

    ``head`` is one row of scalar fields. Each section becomes a list of its rows, which must
    differ, in order of its first column. No row holds more than one element.
    """
    text = F.to_json(F.struct("*"))
    opening = F.concat(F.substring(text, 1, F.length(text) - 1), F.when(F.length(text) > 2, ",").otherwise(""))
    none = F.lit(None).cast("string")
    parts = [head.select(F.lit(-1).alias("section"), F.lit(0).alias("place"), none.alias("key"), opening.alias("line"))]
    for number, (name, rows) in enumerate(sections.items()):
        key = F.col(rows.columns[0])
        place = F.struct(key.isNotNull().alias("held"), key.alias("key"), text.alias("text"))
        comma = F.when(place == rows.agg(F.min(place)).scalar(), "").otherwise(",")
        line = F.concat(comma, text)
        parts.append(rows.select(F.lit(number), F.lit(1), key.cast("string"), line))
        closing = "]}" if number == len(sections) - 1 else "],"
        ends = [(number, 0, None, json.dumps(name) + ":["), (number, 2, None, closing)]
        parts.append(head.sparkSession.createDataFrame(ends, "section int, place int, key string, line string"))
    return reduce(DataFrame.union, parts)


def write_document(head: DataFrame, sections: dict[str, DataFrame], path: str) -> None:
    """A document as text files that, one after another in order of name, are one JSON object."""
    order = ["section", "place", "key", F.ltrim("line", F.lit(","))]
    lines = document_lines(head, sections).repartitionByRange(*order).sortWithinPartitions(*order)
    lines.select("line").write.mode("overwrite").text(path)


def document_text(spark: SparkSession, path: str) -> str:
    """A small document as one string."""
    files = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), "value")
    return "".join(r["value"] for r in sorted(files.collect()))


class VersionedDataset:
    """Full versions side by side; readers follow a pointer that is renamed into place."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _fs(self, path: str):
        jvm_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return jvm_path.getFileSystem(self.spark._jsc.hadoopConfiguration()), jvm_path

    def current(self) -> str | None:
        pointer = f"{self.root}/{POINTER}"
        if not path_exists(self.spark, pointer):
            return None
        return f"{self.root}/{self.spark.read.text(pointer).first()[0]}"

    def stage(self) -> str:
        return f"{self.root}/version-{uuid.uuid4().hex}"

    def publish(self, version: str) -> None:
        """Make a completely written version the current one."""
        staged = f"{self.root}/.{POINTER}-{uuid.uuid4().hex}"
        fs, source = self._fs(staged)
        name = version.rsplit("/", 1)[-1]
        stream = fs.create(source)
        stream.write(bytearray(name.encode()))
        stream.close()
        options = self.spark._jvm.org.apache.hadoop.fs.Options
        context = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self.spark._jsc.hadoopConfiguration()
        )
        _, target = self._fs(f"{self.root}/{POINTER}")
        rename = self.spark.sparkContext._gateway.new_array(options.Rename, 1)
        rename[0] = options.Rename.OVERWRITE
        context.rename(context.makeQualified(source), context.makeQualified(target), rename)

    def read(self, table: str = "parquet") -> DataFrame:
        current = self.current()
        return read_published(self.spark, f"{current}/{table}" if current else f"{self.root}/none")

    def prune(self, keep: int) -> list[str]:
        """Delete all but the newest ``keep`` versions and the current one; the names that went."""
        fs, root = self._fs(self.root)
        held = sorted(
            (s for s in fs.listStatus(root) if s.getPath().getName().startswith("version-")),
            key=lambda s: s.getModificationTime(),
        )
        current = (self.current() or "").rsplit("/", 1)[-1]
        gone = [s.getPath() for s in held[: max(0, len(held) - keep)] if s.getPath().getName() != current]
        for path in gone:
            fs.delete(path, True)
        return [path.getName() for path in gone]


def publish_readings(df: DataFrame, metadata: DataFrame, root: str, parquet: bool = True, partition: bool = True) -> str:
    """Write one whole version (CSV, Parquet, stations, metadata) and switch to it.

    The rows are shuffled into order once; the other formats read that result.
    """
    dataset = VersionedDataset(df.sparkSession, root)
    version = dataset.stage()
    if parquet:
        write_parquet(by_station_and_time(df), f"{version}/parquet")
        ordered = df.sparkSession.read.schema(df.schema).parquet(f"{version}/parquet")
    else:
        ordered = cut_lineage(by_station_and_time(df))
    write_csv(ordered, f"{version}/csv")
    if partition:
        write_station_partitions(ordered, f"{version}/stations")
    write_json(metadata, f"{version}/metadata")
    dataset.publish(version)
    return version


def upsert_days(
    spark: SparkSession, root: str, new: DataFrame, sequence: str | None = None, retention_days: int = 0
) -> int:
    """Idempotent merge into a table partitioned by day, rewriting touched days only.

    Keys contain the reading's time, so equal keys share a day: days without new
    rows cannot change and are neither read nor written. Rows without a time have
    no day and are left out; their number is returned. Days wholly outside the
    retention are removed; :func:`read_days` cuts the boundary day exactly.
    """
    new = cut_lineage(new)  # read for its days, its untimed rows and the merge
    timed = new.filter(F.col("timestamp").isNotNull())
    days = timed.select(F.to_date("timestamp").alias("day")).distinct()
    untimed = new.filter(F.col("timestamp").isNull()).count()
    if timed.isEmpty():
        return untimed
    if path_exists(spark, root):
        touched = spark.read.schema(DAY_SCHEMA).parquet(root).join(days, "day", "left_semi").drop("day")
    else:
        touched = spark.createDataFrame([], READINGS)
    # the touched days are input and output: the merged rows are written aside first
    merged = cut_lineage(dedup_readings(touched, timed, sequence=sequence))
    (
        merged.withColumn("day", F.to_date("timestamp"))
        .repartitionByRange("day", "station_code", "timestamp")
        .sortWithinPartitions("day", "station_code", "timestamp")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("day")
        .parquet(root)
    )
    if retention_days > 0:
        _drop_days_before(spark, root, retention_days)
    return untimed


def _held_days(spark: SparkSession, root: str) -> list[date]:
    """Days of the table, from the names of its directories; no file is opened."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(root)
    names = [s.getPath().getName() for s in folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)]
    return sorted(date.fromisoformat(n[4:]) for n in names if n.startswith("day=") and n[4:5].isdigit())


def _drop_days_before(spark: SparkSession, root: str, retention_days: int) -> None:
    held = _held_days(spark, root)
    for day in held:
        if (held[-1] - day).days > retention_days:
            folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/day={day.isoformat()}")
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def read_days(spark: SparkSession, root: str, retention_days: int = 0) -> DataFrame:
    """The day table as readings, cut to the retention window."""
    if not path_exists(spark, root):
        return spark.createDataFrame([], READINGS)
    return retain_days(spark.read.schema(DAY_SCHEMA).parquet(root).drop("day"), retention_days)


def newest_day(spark: SparkSession, root: str) -> DataFrame:
    """Readings of the day table's last day, which hold its high-water mark."""
    if not path_exists(spark, root):
        return spark.createDataFrame([], READINGS)
    held = _held_days(spark, root)
    if not held:
        return spark.createDataFrame([], READINGS)
    return spark.read.schema(DAY_SCHEMA).parquet(root).filter(F.col("day") == F.lit(held[-1])).drop("day")
