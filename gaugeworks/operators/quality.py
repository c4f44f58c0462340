"""Quality reports over readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gaugeworks.operators.columns import named
from gaugeworks.operators.quantiles import exact_quantiles


def unpivot(row: DataFrame, names: list[str], key: str, value: str) -> DataFrame:
    """A one-row table with one column per name, turned on its side."""
    pairs = F.array(*[F.struct(F.lit(n).alias(key), F.col(f"c{i}").alias(value)) for i, n in enumerate(names)])
    return row.select(F.inline(pairs))


def duplicate_timestamps(df: DataFrame, station: str = "station_code", ts: str = "timestamp") -> DataFrame:
    """Rows in repeated (station, timestamp) groups, all copies counted (A1)."""
    return _copies(df, station, ts).select(station, "duplicate_rows")


def _copies(df: DataFrame, station: str, ts: str) -> DataFrame:
    groups = df.groupBy(station, ts).agg(F.count("*").alias("n"))
    return groups.groupBy(station).agg(
        F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).cast("bigint").alias("duplicate_rows"),
        F.sum(F.col("n") - 1).cast("bigint").alias("excess_rows"),
    )


def excess_duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Copies beyond the first (A2); missing parts compare equal."""
    groups = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("excess_rows"))


def null_percentages(df: DataFrame) -> DataFrame:
    """Missing share of every column, 100 on an empty table (A3)."""
    names = df.columns
    shares = [
        F.coalesce(F.round(100.0 * F.avg(named(n).isNull().cast("double")), 2), F.lit(100.0)).alias(f"c{i}")
        for i, n in enumerate(names)
    ]
    return unpivot(df.agg(*shares), names, "column_name", "null_pct")


def null_counts(df: DataFrame) -> DataFrame:
    """Missing values of every column with their share."""
    names = df.columns
    counts = [F.count_if(named(n).isNull()).alias(f"c{i}") for i, n in enumerate(names)]
    row = df.agg(F.count("*").alias("total"), *counts)
    pairs = F.array(
        *[F.struct(F.lit(n).alias("column_name"), F.col(f"c{i}").alias("nulls")) for i, n in enumerate(names)]
    )
    return row.select("total", F.inline(pairs)).select(
        "column_name",
        F.col("nulls").cast("bigint").alias("nulls"),
        F.when(F.col("total") > 0, F.round(100.0 * F.col("nulls") / F.col("total"), 2)).alias("null_pct"),
    )


def _moment(c: Column) -> Column:
    return F.coalesce(F.date_format(c, "yyyy-MM-dd HH:mm"), F.lit("n/a"))


def by_status(df: DataFrame, *more: str) -> DataFrame:
    """One row per (station, status): count, bounds, extremes and missing levels."""
    return df.groupBy(*more, "station_code", "flood_status").agg(
        F.count("*").alias("n"),
        F.min("timestamp").alias("start"),
        F.max("timestamp").alias("end"),
        F.min("water_level").alias("low"),
        F.max("water_level").alias("high"),
        F.count_if(F.col("water_level").isNull()).alias("missing"),
    )


def executive_summary(df: DataFrame) -> DataFrame:
    """Per station: count, bounds, extremes, missing share and status mix (A4)."""
    # two levels: the mix is collected from one row per (station, status)
    return summary_of_statuses(by_status(df))


def summary_of_statuses(statuses: DataFrame) -> DataFrame:
    """A4 from one row per (station, status)."""
    entry = F.when(
        F.col("flood_status").isNotNull(), F.struct((-F.col("n")).alias("rank"), F.col("flood_status").alias("status"))
    )
    mix = F.array_join(
        F.transform(
            F.array_sort(F.collect_list(entry)),
            lambda e: F.concat(e["status"], F.lit(":"), (-e["rank"]).cast("string")),
        ),
        ", ",
    )
    return statuses.groupBy("station_code").agg(
        F.sum("n").alias("records"),
        _moment(F.min("start")).alias("start"),
        _moment(F.max("end")).alias("end"),
        F.round(F.min("low"), 3).alias("min_level_m"),
        F.round(F.max("high"), 3).alias("max_level_m"),
        F.round(100.0 * F.sum("missing") / F.sum("n"), 2).alias("missing_gauge_pct"),
        F.coalesce(F.nullif(mix, F.lit("")), F.lit("n/a")).alias("status_dist"),
    )


def validation_report(df: DataFrame) -> DataFrame:
    """One-row report document (A5) made of A1 to A4.

    Three passes over the readings: copies, missing values, station summary.
    """
    copies = _copies(df, "station_code", "timestamp").agg(
        F.struct(
            F.coalesce(F.sum("excess_rows"), F.lit(0)).cast("bigint").alias("excess"),
            F.map_from_entries(
                F.filter(
                    F.array_sort(F.collect_list(F.struct("station_code", "duplicate_rows"))),
                    lambda e: e["station_code"].isNotNull(),
                )
            ).alias("per_station"),
        )
    ).scalar()
    nulls = null_percentages(df).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("column_name", "null_pct"))))
    ).scalar()
    summary = executive_summary(df).agg(
        F.array_sort(F.collect_list(F.struct("*"))).alias("summary"),
        F.coalesce(F.sum("records"), F.lit(0)).cast("bigint").alias("total_records"),
        F.count("station_code").alias("stations"),
    )
    return summary.select(
        "total_records",
        "stations",
        copies["excess"].alias("excess_duplicates"),
        copies["per_station"].alias("duplicate_timestamps"),
        nulls.alias("null_percentage"),
        "summary",
    )


def describe_levels(df: DataFrame, column: str = "water_level") -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles of a level."""
    quartiles = exact_quantiles(df, column, [0.25, 0.5, 0.75])
    return df.agg(
        F.count(column).alias("count"),
        F.avg(column).alias("mean"),
        F.stddev_samp(column).alias("std"),
        F.min(column).alias("min"),
        F.lit(quartiles[0]).alias("q25"),
        F.lit(quartiles[1]).alias("q50"),
        F.lit(quartiles[2]).alias("q75"),
        F.max(column).alias("max"),
    )


def alert_share(df: DataFrame) -> DataFrame:
    """Flood-alert count and share, day span, station count."""
    return df.agg(
        F.count("*").alias("records"),
        F.count_if("flood_alert").alias("alerts"),
        F.round(100.0 * F.count_if("flood_alert") / F.count("*"), 2).alias("alert_pct"),
        F.min("record_date").alias("first_day"),
        F.max("record_date").alias("last_day"),
        F.date_diff(F.max("record_date"), F.min("record_date")).cast("bigint").alias("day_span"),
        F.count_distinct("station_code").alias("stations"),
    )


def category_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct values of each category column."""
    counted = df.agg(*[F.count_distinct(c).alias(f"c{i}") for i, c in enumerate(columns)])
    return unpivot(counted, columns, "column_name", "distinct_values")


def daily_station_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("station_code").agg(F.count("*").alias("records"))
