"""Current state per station and the tables of the dashboard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from gaugeworks.functions import levels, text
from gaugeworks.operators.merge import keep_last
from gaugeworks.schema import NORMAL
from gaugeworks.session import cut_lineage


def latest_reading(df: DataFrame, sequence: str | None = None) -> DataFrame:
    """Newest row per station (W1); a missing timestamp never wins, ties go to the later row."""
    order = [F.desc_nulls_last("timestamp")] + ([F.desc(sequence)] if sequence else [])
    return keep_last(df.filter(F.col("station_code").isNotNull()), ["station_code"], order)


def last_n(
    df: DataFrame,
    n: int,
    key: str = "station_code",
    time: str = "timestamp",
    ties: list[Column] | None = None,
    cut: bool = True,
) -> DataFrame:
    """Last ``n`` rows per station (W13, O4); later ``ties`` first on equal times, no time last.

    Rows are counted per station and day (of a timestamp, or of an hour number);
    summed from the newest day on, the counts say which days can hold the last
    ``n`` rows. Only their rows are ranked, so no task sees more of a station
    than ``n`` rows and a day. Count and ranking both read the rows, which are written once
    for that unless ``cut`` says that they are a plain scan.
    """
    stamp = dict(df.dtypes)[time].startswith(("timestamp", "date"))
    day = F.to_date(time) if stamp else F.floor(F.col(time) / 24)
    df = cut_lineage(df.withColumn("_day", day)) if cut else df.withColumn("_day", day)
    newer = W.partitionBy(key).orderBy(F.desc_nulls_last("_day")).rowsBetween(W.unboundedPreceding, -1)
    days = (
        df.groupBy(key, "_day")
        .agg(F.count("*").alias("_rows"))
        .withColumn("_newer", F.coalesce(F.sum("_rows").over(newer), F.lit(0)))
        .filter(F.col("_newer") < n)
        .select(F.col(key).alias("_key"), F.col("_day").alias("_kept"))
    )
    near = df.join(days, F.col(key).eqNullSafe(F.col("_key")) & F.col("_day").eqNullSafe(F.col("_kept")))
    rank = F.row_number().over(W.partitionBy(key).orderBy(F.desc_nulls_last(time), *(ties or [])))
    return near.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank", "_day", "_key", "_kept")


def look_back(df: DataFrame, days: int) -> DataFrame:
    """Rows within ``days`` of the station's newest one, 0 keeps all.

    The earliest cutoff of all stations filters the scan before the join, so
    only rows near the end of the table are joined at all.
    """
    if not days:
        return df
    cutoffs = df.groupBy("station_code").agg(
        (F.max("timestamp") - F.make_dt_interval(F.lit(days))).alias("cutoff")
    )
    earliest = cutoffs.agg(F.min("cutoff")).scalar()
    return (
        df.filter(F.col("timestamp") >= earliest)
        .join(cutoffs, "station_code", "left")
        .filter(F.col("timestamp") >= F.col("cutoff"))
        .drop("cutoff")
    )


def kpis(df: DataFrame, sequence: str | None = None) -> DataFrame:
    """Station count, record count, last update, stations not NORMAL."""
    current = latest_reading(df, sequence).agg(
        F.struct(
            F.count("*").alias("stations"),
            F.count_if(~F.col("flood_status").eqNullSafe(NORMAL)).alias("not_normal"),
        )
    ).scalar()
    totals = df.agg(F.count("*").alias("records"), F.max("timestamp").alias("last_update"))
    return totals.select(
        "records",
        "last_update",
        current["stations"].alias("stations"),
        current["not_normal"].alias("not_normal"),
    )


def status_histogram(latest: DataFrame) -> DataFrame:
    """Stations per current status, label-sorted, missing excluded."""
    return (
        latest.filter(F.col("flood_status").isNotNull())
        .groupBy("flood_status")
        .agg(F.count("*").alias("stations"))
        .orderBy("flood_status")
    )


def map_centre(latest: DataFrame) -> DataFrame:
    """Mean coordinates of the current rows."""
    return latest.agg(F.avg("latitude").alias("latitude"), F.avg("longitude").alias("longitude"))


def station_table(df: DataFrame) -> DataFrame:
    """Records, first, last and level extremes per station (A10)."""
    return df.groupBy("station_code").agg(
        F.count("timestamp").alias("records"),
        F.min("timestamp").alias("first"),
        F.max("timestamp").alias("last"),
        F.round(F.min("water_level"), 2).alias("min_level"),
        F.round(F.max("water_level"), 2).alias("max_level"),
    )


def with_risk(latest: DataFrame, risks: DataFrame) -> DataFrame:
    """Current rows with their risk score, left."""
    return latest.join(risks.select("station_code", "risk_score"), "station_code", "left")


def map_layer(latest: DataFrame, risks: DataFrame) -> DataFrame:
    """Marker and buffer attributes per station."""
    risk = F.col("risk_score")
    status = F.coalesce("flood_status", F.lit(NORMAL))
    return with_risk(latest, risks).select(
        "station_code",
        "latitude",
        "longitude",
        status.alias("status"),
        levels.status_colour(status).alias("colour"),
        risk,
        levels.buffer_radius(risk).alias("radius"),
        levels.buffer_opacity(risk).alias("opacity"),
    )


def station_cards(latest: DataFrame, risks: DataFrame) -> DataFrame:
    """Label and plain-text card per station."""
    return with_risk(latest, risks).select(
        "station_code",
        text.station_label(F.col("station_name"), F.col("station_code")).alias("label"),
        text.station_popup(
            F.col("station_code"),
            F.col("station_name"),
            F.col("basin_name"),
            F.col("water_level"),
            F.col("flood_status"),
            F.col("risk_score"),
            F.col("timestamp"),
        ).alias("card"),
    )
