"""Kept day summaries: partial aggregates of readings that merge into the reports.

A day's summary is two small tables. *Statuses* has a row per (day, station, status) with
counts, bounds and extremes; *stations* a row per (day, station) with repeated timestamps,
missing values by column and the newest reading. Equal timestamps share a day, so repeats
add up over days; everything else is a sum, minimum or maximum. The reports of a dataset
follow from the summaries of its days, and only days that received rows are summarised anew.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from gaugeworks.operators.latest import status_histogram
from gaugeworks.operators.quality import by_status, summary_of_statuses
from gaugeworks.schema import NORMAL, READINGS

DAY = T.StructField("day", T.DateType())
STATUSES = T.StructType(
    [
        T.StructField("station_code", T.StringType()),
        T.StructField("flood_status", T.StringType()),
        T.StructField("n", T.LongType()),
        T.StructField("start", T.TimestampType()),
        T.StructField("end", T.TimestampType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("missing", T.LongType()),
        DAY,
    ]
)
STATIONS = T.StructType(
    [
        T.StructField("station_code", T.StringType()),
        T.StructField("n", T.LongType()),
        T.StructField("duplicate_rows", T.LongType()),
        T.StructField("excess_rows", T.LongType()),
        T.StructField("nulls", T.ArrayType(T.LongType())),
        T.StructField("newest", READINGS),
        DAY,
    ]
)
COLUMNS = READINGS.fieldNames()


def _day() -> Column:
    return F.to_date("timestamp").alias("day")


def status_parts(readings: DataFrame) -> DataFrame:
    """One row per (day, station, status)."""
    return by_status(readings.withColumn("day", _day()), "day").select(*STATUSES.fieldNames())


def station_parts(readings: DataFrame) -> DataFrame:
    """One row per (day, station); of equal timestamps the reading with the greatest key is the newest."""
    moments = readings.groupBy("station_code", "timestamp").agg(
        F.count("*").alias("n"),
        F.array(*[F.count_if(F.col(c).isNull()) for c in COLUMNS]).alias("nulls"),
        F.max_by(F.struct(*COLUMNS), F.coalesce("dedup_key", F.lit(""))).alias("newest"),
    )
    sums = [F.sum(F.get("nulls", F.lit(i))) for i in range(len(COLUMNS))]
    return (
        moments.groupBy("station_code", _day())
        .agg(
            F.sum("n").alias("n"),
            F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).alias("duplicate_rows"),
            F.sum(F.col("n") - 1).alias("excess_rows"),
            F.array(*sums).alias("nulls"),
            F.max_by("newest", "timestamp").alias("newest"),
        )
        .select(*STATIONS.fieldNames())
    )


@dataclass(frozen=True)
class Summary:
    """The summaries of all days of a dataset."""

    statuses: DataFrame
    stations: DataFrame

    @staticmethod
    def of(readings: DataFrame) -> Summary:
        return Summary(status_parts(readings), station_parts(readings))

    def merged(self, other: Summary) -> Summary:
        """Both summaries; their days must differ."""
        return Summary(self.statuses.unionByName(other.statuses), self.stations.unionByName(other.stations))

    def executive_summary(self) -> DataFrame:
        """A4 from the parts."""
        return summary_of_statuses(self.status_fold())

    def status_fold(self) -> DataFrame:
        """One row per (station, status) over all days."""
        return self.statuses.groupBy("station_code", "flood_status").agg(
            F.sum("n").alias("n"),
            F.min("start").alias("start"),
            F.max("end").alias("end"),
            F.min("low").alias("low"),
            F.max("high").alias("high"),
            F.sum("missing").alias("missing"),
        )

    def totals(self) -> DataFrame:
        """Records, stations, copies and bounds, one row."""
        stations = self.stations.groupBy("station_code").agg(
            F.sum("n").alias("n"),
            F.sum("excess_rows").alias("excess_rows"),
            F.max("newest.timestamp").alias("end"),
        )
        first = self.statuses.agg(F.min("start")).scalar()
        return stations.agg(
            F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("records"),
            F.count("station_code").alias("stations"),
            F.coalesce(F.sum("excess_rows"), F.lit(0)).cast("bigint").alias("excess_rows"),
            F.max("end").alias("last_update"),
        ).withColumn("first_update", first)

    def duplicate_timestamps(self) -> DataFrame:
        """A1 from the parts."""
        return self.stations.groupBy("station_code").agg(F.sum("duplicate_rows").cast("bigint").alias("duplicate_rows"))

    def null_counts(self) -> DataFrame:
        """A3 and A15 from the parts; one row per published column."""
        counted = self.stations.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
            *[F.sum(F.get("nulls", F.lit(i))).alias(f"c{i}") for i in range(len(COLUMNS))],
        )
        pairs = [F.struct(F.lit(c).alias("column_name"), F.coalesce(f"c{i}", F.lit(0)).alias("nulls")) for i, c in enumerate(COLUMNS)]
        rows = counted.select("total", F.inline(F.array(*pairs)))
        share = F.when(F.col("total") > 0, F.round(100.0 * F.col("nulls") / F.col("total"), 2))
        return rows.select("column_name", F.col("nulls").cast("bigint").alias("nulls"), share.alias("null_pct"))

    def status_counts(self) -> DataFrame:
        """A7 from the parts."""
        held = self.statuses.filter(F.col("flood_status").isNotNull())
        return held.groupBy("flood_status").agg(F.sum("n").cast("bigint").alias("records"))

    def station_table(self) -> DataFrame:
        """A10 from the parts."""
        return self.status_fold().groupBy("station_code").agg(
            F.sum("n").cast("bigint").alias("records"),
            F.min("start").alias("first"),
            F.max("end").alias("last"),
            F.round(F.min("low"), 2).alias("min_level"),
            F.round(F.max("high"), 2).alias("max_level"),
        )

    def latest(self) -> DataFrame:
        """W1 from the parts: the newest reading of every station."""
        newest = W.partitionBy("station_code").orderBy(F.desc("day"))
        days = self.stations.filter(F.col("station_code").isNotNull()).withColumn("_rank", F.row_number().over(newest))
        return days.filter("_rank = 1").select("newest.*")

    def kpis(self) -> DataFrame:
        """A11 from the parts."""
        now = self.latest().agg(
            F.struct(
                F.count("*").alias("stations"), F.count_if(~F.col("flood_status").eqNullSafe(NORMAL)).alias("not_normal")
            )
        ).scalar()
        return self.totals().select(
            "records", "last_update", now["stations"].alias("stations"), now["not_normal"].alias("not_normal")
        )

    def status_histogram(self) -> DataFrame:
        """A12 from the parts."""
        return status_histogram(self.latest())

    def report(self) -> Report:
        """A5 from the parts."""
        nulls = self.null_counts().select("column_name", F.coalesce("null_pct", F.lit(100.0)).alias("null_pct"))
        totals = self.totals().select("stations", F.col("records").alias("total_records"), F.col("excess_rows").alias("excess_duplicates"))
        return Report(totals, self.duplicate_timestamps(), nulls, self.executive_summary())


@dataclass(frozen=True)
class Report:
    """The validation report (A5) as tables: one row of totals, a row per station or column."""

    totals: DataFrame
    duplicate_timestamps: DataFrame
    null_percentage: DataFrame
    summary: DataFrame

    def sections(self) -> dict[str, DataFrame]:
        """What a document lists, each by its first column."""
        return {
            "duplicate_timestamps": self.duplicate_timestamps.filter(F.col("station_code").isNotNull()),
            "null_percentage": self.null_percentage,
            "summary": self.summary,
        }
