"""Forecast post-processing: time axis, fan, thresholds and flood risk.

A forecast is a long table (station_code, step, mean, ...) with steps 1..horizon;
one station's steps are as many as the horizon the caller asks for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from gaugeworks.functions.text import station_label
from gaugeworks.operators.latest import last_n, look_back

# --- Fixed values: horizon bound and score weights -------------------------
MAX_HORIZON = 256
SURGE_STEPS = 24
URGENCY_HOURS = 336.0
FAN_HISTORY_HOURS = 336
PROXIMITY_POINTS = 70.0
CROSSING_POINTS = 30.0
SURGE_POINTS = 15.0
SHORT_SURGE_FACTOR = 12
# ---------------------------------------------------------------------------


def bounded_horizon(hours: int, max_horizon: int) -> int:
    """Steps to forecast: at least one, at most ``max_horizon``."""
    return max(1, min(int(hours), max_horizon))


def forecast_axis(last: DataFrame, horizon: int, ts: str = "timestamp", max_horizon: int = MAX_HORIZON) -> DataFrame:
    """Steps 1..horizon, at most ``max_horizon``, one hour apart from the last reading."""
    steps = F.sequence(F.lit(1), F.lit(bounded_horizon(horizon, max_horizon)))
    return last.withColumn("step", F.explode(steps)).withColumn(
        "forecast_ts", F.col(ts) + F.make_dt_interval(hours=F.col("step"))
    )


def hours_to_threshold(forecast: DataFrame, threshold: str) -> DataFrame:
    """First step at or above the threshold per station, NULL if none."""
    return forecast.groupBy("station_code").agg(
        F.min(F.when(F.col("mean") >= F.col(threshold), F.col("step"))).cast("bigint").alias("hours_to_threshold")
    )


def repair_fan(forecast: DataFrame) -> DataFrame:
    """Order low, median and high and move the fan to the last level."""
    first = W.partitionBy("station_code").orderBy("step")
    offset = F.coalesce(F.col("last_level") - F.first("median").over(first), F.lit(0.0))
    return forecast.withColumn("offset", offset).select(
        "station_code",
        "step",
        (F.col("mean") + F.col("offset")).alias("mean"),
        (F.least("low", "median") + F.col("offset")).alias("low"),
        (F.greatest("high", "median") + F.col("offset")).alias("high"),
        "last_level",
    )


def residual_fan(mean: Column, low_offset: Column, high_offset: Column) -> tuple[Column, Column]:
    """Band from residual offsets that never crosses the mean."""
    return F.least(mean + low_offset, mean), F.greatest(mean + high_offset, mean)


def _clip(c: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), c))


def risk_scores(forecast: DataFrame, hours_between: int = 1) -> DataFrame:
    """Risk per station from (step, mean), last_level and danger_level."""
    ordered = F.transform(
        F.array_sort(F.collect_list(F.struct("step", "mean"))), lambda e: e["mean"]
    )
    folded = forecast.groupBy("station_code").agg(
        F.first("last_level").alias("last_level"),
        F.first("danger_level").alias("danger_level"),
        F.max("mean").alias("peak"),
        F.min(F.when(F.col("mean") >= F.col("danger_level"), F.col("step"))).alias("first_step"),
        ordered.alias("path"),
    )
    last, danger, path = F.col("last_level"), F.col("danger_level"), F.col("path")
    steps = F.size(path)
    inner = F.greatest(steps - 1, F.lit(0))
    rises = F.zip_with(F.slice(path, F.lit(2), inner), F.slice(path, F.lit(1), inner), lambda b, a: b - a)
    scored = folded.withColumns(
        {
            "warning_range": F.greatest(F.lit(0.5), 0.4 * F.abs(danger - last)),
            "distance": danger - F.greatest(last, F.coalesce("peak", last)),
            "late_rise": F.when(
                steps > SURGE_STEPS, F.element_at(path, -1) - F.get(path, steps - 1 - SURGE_STEPS)
            ),
            "steepest": F.greatest(F.lit(0.0), F.array_max(rises)),
        }
    )
    known = last.isNotNull() & danger.isNotNull()
    urgency = F.coalesce(_clip(1.0 - F.col("first_step") * hours_between / URGENCY_HOURS, 0.0, 1.0), F.lit(1.0))
    surge = _clip(
        F.coalesce("late_rise", F.col("steepest") * SHORT_SURGE_FACTOR) / F.col("warning_range"), 0.0, 1.0
    )
    parts = scored.withColumns(
        {
            "proximity": F.when(
                known,
                _clip(PROXIMITY_POINTS * (1.0 - F.col("distance") / F.col("warning_range")), 0.0, PROXIMITY_POINTS),
            ),
            "crossing": F.when(
                known & (F.col("distance") <= 0), CROSSING_POINTS * (0.5 + 0.5 * urgency)
            ).otherwise(0.0),
            "surge": F.when(known, SURGE_POINTS * surge).otherwise(0.0),
        }
    )
    total = F.col("proximity") + F.col("crossing") + F.col("surge")
    return parts.select(
        "station_code",
        "last_level",
        "peak",
        F.when(known, _clip(total, 0.0, 100.0)).alias("risk_score"),
        "proximity",
        "crossing",
        "surge",
        F.col("first_step").cast("bigint").alias("hours_to_danger"),
    )


def risk_ranking(risks: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Stations by falling risk, score cut to an integer (O3)."""
    names = catalogue.select("station_code", "station_name")
    return (
        risks.join(names, "station_code", "left")
        .orderBy(F.desc("risk_score"), "station_code")
        .select(
            station_label(F.col("station_name"), F.col("station_code")).alias("station"),
            F.col("risk_score").cast("int").alias("risk"),
            F.coalesce(F.col("hours_to_danger").cast("string"), F.lit("∞")).alias("hours_to_danger"),
        )
    )


def highest_risk(risks: DataFrame) -> DataFrame:
    """Largest score over all stations, at most 100."""
    return risks.agg(F.least(F.max("risk_score"), F.lit(100.0)).cast("int").alias("max_risk"))


def forecast_card(risks: DataFrame) -> DataFrame:
    """Figures of the forecast card per station (C11)."""
    return risks.select(
        "station_code",
        F.round("last_level", 2).alias("last_observed"),
        F.round("peak", 2).alias("forecast_peak"),
        F.round("risk_score", 0).alias("risk_score"),
        F.round("proximity", 0).alias("proximity"),
        F.round("crossing", 0).alias("crossing"),
        F.round("surge", 0).alias("surge"),
        F.coalesce(F.col("hours_to_danger").cast("string"), F.lit("∞")).alias("hours_to_danger"),
    )


THRESHOLDS = ["warning_level", "danger_level", "high_flood_level"]


def fan_table(
    history: DataFrame, forecast: DataFrame, catalogue: DataFrame, tail_hours: int = FAN_HISTORY_HOURS
) -> DataFrame:
    """Observed tail and forecast with band and thresholds in one table."""
    tail = last_n(history, tail_hours).select("station_code", "timestamp", F.col("level").alias("observed"))
    ahead = forecast.select("station_code", F.col("forecast_ts").alias("timestamp"), "mean", "low", "high")
    lines = catalogue.select("station_code", *THRESHOLDS)
    return tail.unionByName(ahead, allowMissingColumns=True).join(lines, "station_code", "left")


def history_table(readings: DataFrame, catalogue: DataFrame, days: int = 60) -> DataFrame:
    """Look-back history with threshold columns."""
    own = look_back(readings.select("station_code", "timestamp", "water_level"), days)
    return own.join(catalogue.select("station_code", *THRESHOLDS), "station_code", "left")
