"""Versions of a table of days that share the days they have in common.

A version is a manifest: a small file that lists, for every day, the folder that holds it,
its row count and its newest timestamp. A run writes the days that received rows to a new
batch folder, then a new manifest, then moves the pointer; no file is ever written twice.
So a run of one new day writes one day, a reader sees one whole version between any two
steps, and a run that stops half-way leaves a folder that nothing refers to.

Batch folders hold one ``day=...`` folder per touched day and format, and the summary of
that day. One writer at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from gaugeworks.operators.merge import dedup_readings
from gaugeworks.operators.summary import DAY, STATIONS, STATUSES, Summary, station_parts, status_parts
from gaugeworks.schema import READINGS
from gaugeworks.session import cut_lineage
from gaugeworks.sources.publish import ISO_OUT, VersionedDataset

ROWS = "parquet"
FORMATS = ("parquet", "csv", "stations")


@dataclass(frozen=True)
class DayEntry:
    """Where a version keeps a day, and what the day holds."""

    day: str
    batch: str
    rows: int
    newest: str


@dataclass(frozen=True)
class Commit:
    """What a run changed: the version it left current, the days written and rows without a time."""

    version: str | None
    days: list[str]
    untimed: int


class DaySnapshots(VersionedDataset):
    """The current version of a table of days, and runs that replace it."""

    def entries(self, version: str | None = None) -> dict[str, DayEntry]:
        """Manifest of a version (default: the current one) by day."""
        version = version or self.current()
        if version is None:
            return {}
        lines = self.spark.read.schema("value string").text(f"{version}/manifest.json").collect()
        return {e.day: e for e in (DayEntry(**json.loads(line["value"])) for line in lines)}

    def _paths(self, entries: Sequence[DayEntry], part: str) -> list[str]:
        return [f"{self.root}/{e.batch}/{part}/day={e.day}" for e in entries]

    def _frame(self, entries: Sequence[DayEntry], part: str, schema: T.StructType) -> DataFrame:
        """Rows of some days; the day folders are listed, no other file is looked at."""
        if not entries:
            return self.spark.createDataFrame([], schema)
        plain = T.StructType([f for f in schema if f.name != "day"])
        rows = self.spark.read.schema(plain).parquet(*self._paths(entries, part))
        if len(plain) == len(schema):
            return rows
        day = F.to_date(F.regexp_extract(F.input_file_name(), r"/day=([0-9-]+)/[^/]*$", 1))
        return rows.withColumn("day", day)

    def newest(self) -> datetime | None:
        """The newest timestamp, from the manifest alone."""
        held = self.entries().values()
        return max((datetime.fromisoformat(e.newest) for e in held), default=None)

    def read(self, retention_days: int = 0) -> DataFrame:
        """The readings of the current version, cut to the retention (U4)."""
        entries = self.entries()
        rows = self._frame(list(entries.values()), ROWS, READINGS)
        cutoff = self.cutoff(entries, retention_days)
        return rows.filter(F.col("timestamp") >= F.lit(cutoff).cast("timestamp")) if cutoff else rows

    @staticmethod
    def cutoff(entries: dict[str, DayEntry], retention_days: int) -> datetime | None:
        if retention_days <= 0 or not entries:
            return None
        return max(datetime.fromisoformat(e.newest) for e in entries.values()) - timedelta(days=retention_days)

    def summary(self, retention_days: int = 0, entries: dict[str, DayEntry] | None = None) -> Summary:
        """Summaries of a version's days; the day that the retention cuts is summarised from its rows."""
        entries = self.entries() if entries is None else entries
        cutoff = self.cutoff(entries, retention_days)
        edge = cutoff.date().isoformat() if cutoff else ""
        whole = [e for e in entries.values() if e.day > edge]
        kept = Summary(self._frame(whole, "statuses", STATUSES), self._frame(whole, "summary", STATIONS))
        if edge not in entries:
            return kept
        rows = self._frame([entries[edge]], ROWS, READINGS).filter(F.col("timestamp") >= F.lit(cutoff).cast("timestamp"))
        return kept.merged(Summary.of(rows))

    def commit(
        self,
        new: DataFrame,
        sequence: str | None = None,
        retention_days: int = 0,
        formats: Sequence[str] = (ROWS,),
        describe: Callable[[Summary, str], None] | None = None,
    ) -> Commit:
        """Idempotent merge of new rows as a new version.

        Keys contain the reading's time, so equal keys share a day, and days without new rows
        keep their folders. Days wholly outside the retention leave the manifest. Rows without
        a time have no day; they are left out and counted. Without new days nothing is written.
        ``describe`` gets the new version's summary and folder before readers can see it.
        """
        new = cut_lineage(new.withColumn("day", F.to_date("timestamp")))
        counted = {r["day"]: r["count"] for r in new.groupBy("day").count().collect()}
        untimed = counted.pop(None, 0)
        held = self.entries()
        if not counted:
            return Commit(self.current(), [], untimed)
        touched = [held[d.isoformat()] for d in counted if d.isoformat() in held]
        merged = dedup_readings(self._frame(touched, ROWS, READINGS), new.filter("day is not null").drop("day"), sequence=sequence)
        batch = f"batch-{uuid.uuid4().hex}"
        keys = ["day", "station_code", "timestamp"]
        ordered = merged.withColumn("day", F.to_date("timestamp")).repartitionByRange(*keys).sortWithinPartitions(*keys)
        ordered.write.partitionBy("day").parquet(f"{self.root}/{batch}/{ROWS}")
        days = [DayEntry(d.isoformat(), batch, 0, "") for d in counted]
        written = self._frame(days, ROWS, T.StructType([*READINGS, DAY]))
        self._write_formats(written, f"{self.root}/{batch}", formats)
        readings = written.drop("day")
        status_parts(readings).repartitionByRange("day").write.partitionBy("day").parquet(f"{self.root}/{batch}/statuses")
        station_parts(readings).repartitionByRange("day").write.partitionBy("day").parquet(f"{self.root}/{batch}/summary")
        found = self._frame(days, "statuses", STATUSES).groupBy("day").agg(F.sum("n").alias("n"), F.max("end").alias("end"))
        for row in found.collect():
            day = row["day"].isoformat()
            held[day] = DayEntry(day, batch, row["n"], row["end"].isoformat())
        cutoff = self.cutoff(held, retention_days)
        kept = [e for _, e in sorted(held.items()) if not cutoff or date.fromisoformat(e.day) >= cutoff.date()]
        version = self.stage()
        self._write_text(f"{version}/manifest.json", "\n".join(json.dumps(asdict(e)) for e in kept))
        if describe:
            describe(self.summary(retention_days, {e.day: e for e in kept}), version)
        self.publish(version)
        return Commit(version, sorted(d.isoformat() for d in counted), untimed)

    def _write_formats(self, written: DataFrame, folder: str, formats: Sequence[str]) -> None:
        for name in formats:
            if name == "csv":
                writer, by = written, ["day"]
            elif name == "stations":
                writer, by = written.withColumn("station", F.col("station_code")), ["day", "station"]
            else:
                continue
            sorted_rows = writer.sortWithinPartitions(*by, "timestamp")
            sorted_rows.write.partitionBy(*by).option("header", True).option("timestampFormat", ISO_OUT).csv(f"{folder}/{name}")

    def _write_text(self, path: str, text: str) -> None:
        fs, target = self._fs(path)
        stream = fs.create(target)
        stream.write(bytearray(text.encode()))
        stream.close()

    def files(self, name: str) -> list[str]:
        """Day folders of the current version in one of its formats."""
        return self._paths(list(self.entries().values()), name)

    def read_text_format(self, name: str) -> DataFrame:
        """The current version from its CSV files, whole or by station; both hold all columns."""
        folders = self.files(name)
        if not folders:
            return self.spark.createDataFrame([], READINGS)
        reader = self.spark.read.schema(READINGS).option("header", True).option("timestampFormat", ISO_OUT)
        return reader.option("recursiveFileLookup", True).csv(folders)

    def prune(self, keep: int) -> list[str]:
        """Delete manifests beyond the newest ``keep``, and day folders that no manifest lists."""
        gone = super().prune(keep)
        fs, root = self._fs(self.root)
        listed = [s.getPath().getName() for s in fs.listStatus(root)]
        kept = {(e.batch, e.day) for v in listed if v.startswith("version-") for e in self.entries(f"{self.root}/{v}").values()}
        for batch in (n for n in listed if n.startswith("batch-")):
            if not any(b == batch for b, _ in kept):
                fs.delete(self._fs(f"{self.root}/{batch}")[1], True)
                continue
            for part in fs.listStatus(self._fs(f"{self.root}/{batch}")[1]):
                for folder in fs.listStatus(part.getPath()) if part.isDirectory() else ():
                    day = folder.getPath().getName().removeprefix("day=")
                    if folder.isDirectory() and (batch, day) not in kept:
                        fs.delete(folder.getPath(), True)
        return gone
