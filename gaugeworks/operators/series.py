"""Cleaning of hourly level series, all stations in one plan.

Hours are epoch hours (bigint ``hour``); ``level`` is never NaN. The rolling
fence needs no materialised grid: on a strict hourly grid the trailing 48 rows
are the trailing 48 hours, so frames range over the hours that have a value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gaugeworks.functions.levels import clip_to_band, level_band
from gaugeworks.operators.blocks import (
    BLOCK,
    KEY,
    block_window,
    epoch_hour,
    hour_timestamp,
    own_rows,
    with_halo,
    with_positions,
)

# --- Fixed values: cleaning parameters -------------------------------------
FENCE_WIDTH = 8.0
FENCE_HOURS = 48
MAD_SCALE = 1.4826
MAD_FLOOR = 1e-9
SMOOTH_HOURS = 24
SMOOTH_MIN = 12
JUNK_RUN_HOURS = 48
JUNK_BUFFER_HOURS = 36
JUNK_MIN_SERIES = 100
PIN_TOLERANCE = 1e-6
# ---------------------------------------------------------------------------
GAP_PIECE = 4096


def dedup_timestamps(
    readings: DataFrame, sequence: str, ts: str = "timestamp", level: str = "water_level"
) -> DataFrame:
    """Last reading per (station, timestamp) in ingest order, missing ones dropped."""
    return (
        readings.filter(F.col(ts).isNotNull() & F.col(level).isNotNull())
        .groupBy(KEY, ts)
        .agg(F.max_by(level, sequence).alias(level))
    )


def hourly_mean(readings: DataFrame, ts: str = "timestamp", level: str = "water_level") -> DataFrame:
    """Mean level per station and hour (A17); hours without a reading have no row."""
    return (
        readings.filter(F.col(level).isNotNull())
        .groupBy(KEY, epoch_hour(F.col(ts)).alias("hour"))
        .agg(F.avg(level).alias("level"))
    )


def station_bands(catalogue: DataFrame) -> DataFrame:
    """Plausible band per station (P19), NULL without a usable threshold."""
    low, high = level_band(F.col("warning_level"), F.col("danger_level"), F.col("high_flood_level"))
    return catalogue.select(KEY, low.alias("band_low"), high.alias("band_high"))


def _fenced(w, k: float, hours: int) -> list[tuple[str, Column]]:
    trailing = w.rangeBetween(-(hours - 1), 0)
    spread = k * (MAD_SCALE * F.col("deviation") + MAD_FLOOR)
    return [
        ("median", F.percentile("level", F.lit(0.5)).over(trailing)),
        ("distance", F.abs(F.col("level") - F.col("median"))),
        ("deviation", F.percentile("distance", F.lit(0.5)).over(trailing)),
        ("level", F.least(F.greatest(F.col("level"), F.col("median") - spread), F.col("median") + spread)),
    ]


def mad_fence(
    hourly: DataFrame, k: float = FENCE_WIDTH, hours: int = FENCE_HOURS, size: int = BLOCK
) -> DataFrame:
    """Clip each hour to its trailing median plus or minus k scaled MADs."""
    df = with_halo(hourly, "hour", back=2 * (hours - 1), ahead=0, size=size)
    for name, value in _fenced(block_window("hour"), k, hours):
        df = df.withColumn(name, value)
    return own_rows(df).drop("median", "distance", "deviation")


def with_grid_hours(df: DataFrame, piece: int = GAP_PIECE) -> DataFrame:
    """A row per ``grid_hour`` from ``hour`` up to the next known one.

    A gap is cut into pieces first, so no row ever holds an array longer than a piece;
    the hours leave the task as rows, and what follows deals them out by block.
    """
    last = F.coalesce(F.col("next_hour") - 1, F.col("hour"))
    pieces = df.withColumn("_last", last).withColumn(
        "_from", F.explode(F.sequence(F.col("hour"), F.col("_last"), F.lit(piece).cast("bigint")))
    )
    hours = F.sequence(F.col("_from"), F.least(F.col("_last"), F.col("_from") + piece - 1))
    return pieces.withColumn("grid_hour", F.explode(hours)).drop("_last", "_from")


def hourly_grid(hourly: DataFrame, size: int = BLOCK) -> DataFrame:
    """Every hour from a station's first to its last; gaps have a NULL level."""
    w = block_window("position")
    df = with_halo(with_positions(hourly, "hour", "level", size=size), "position", back=0, ahead=1, size=size)
    df = own_rows(df.withColumn("next_hour", F.lead("hour").over(w)))
    return with_grid_hours(df).select(
        KEY,
        F.col("grid_hour").alias("hour"),
        F.when(F.col("grid_hour") == F.col("hour"), F.col("level")).alias("level"),
        "first_hour",
        "last_hour",
    )


def _linear(next_hour: Column, next_level: Column) -> Column:
    slope = (next_level - F.col("level")) / (next_hour - F.col("hour"))
    return F.when(F.col("grid_hour") == F.col("hour"), F.col("level")).otherwise(
        F.col("level") + slope * (F.col("grid_hour") - F.col("hour"))
    )


def interpolate(hourly: DataFrame, size: int = BLOCK) -> DataFrame:
    """Gaps of any length filled on the line between their neighbours."""
    w = block_window("position")
    df = with_halo(with_positions(hourly, "hour", "level", size=size), "position", back=0, ahead=1, size=size)
    df = own_rows(
        df.withColumn("next_hour", F.lead("hour").over(w)).withColumn("next_level", F.lead("level").over(w))
    )
    return with_grid_hours(df).select(
        KEY,
        F.col("grid_hour").alias("hour"),
        _linear(F.col("next_hour"), F.col("next_level")).alias("level"),
        (F.col("grid_hour") != F.col("hour")).alias("filled"),
    )


def junk_mask(
    grid: DataFrame,
    level: str = "level",
    smooth_hours: int = SMOOTH_HOURS,
    smooth_min: int = SMOOTH_MIN,
    run_hours: int = JUNK_RUN_HOURS,
    buffer_hours: int = JUNK_BUFFER_HOURS,
    min_series: int = JUNK_MIN_SERIES,
    size: int = BLOCK,
) -> DataFrame:
    """Adds ``junk`` to a strict hourly grid with bands and hour bounds.

    A candidate hour lies in a run of at least ``run_hours`` exactly if one of
    the next ``run_hours`` hours ends a full frame of candidates around it, so
    runs are found with two bounded frames and never followed to their ends.
    """
    back = (smooth_hours - 1) + (run_hours - 1)
    ahead = buffer_hours + run_hours - 1
    w = block_window("hour")
    smoothing = w.rowsBetween(-(smooth_hours - 1), 0)
    middle = F.col("band_low") + 0.5 * (F.col("band_high") - F.col("band_low"))
    smooth = F.when(F.count(level).over(smoothing) >= smooth_min, F.avg(level).over(smoothing))
    full = F.sum("candidate").over(w.rowsBetween(-(run_hours - 1), 0)) == run_hours
    followed = F.col("hour") + buffer_hours <= F.col("last_hour")
    series_rows = F.col("last_hour") - F.col("first_hour") + 1
    junk = (
        F.col("in_run")
        | (followed & F.coalesce(F.max("in_run").over(w.rowsBetween(1, buffer_hours)), F.lit(False)))
        | F.coalesce(F.col(level) >= F.col("band_high") - PIN_TOLERANCE, F.lit(False))
    )
    df = with_halo(grid, "hour", back, ahead, size)
    df = df.withColumn("candidate", F.coalesce(smooth > middle, F.lit(False)).cast("int"))
    df = df.withColumn("full_run", full)
    df = df.withColumn("in_run", F.max("full_run").over(w.rowsBetween(0, run_hours - 1)))
    df = df.withColumn("junk", F.col("band_low").isNotNull() & (series_rows >= min_series) & junk)
    return own_rows(df).drop("candidate", "full_run", "in_run")


def prepare_series(
    readings: DataFrame,
    sequence: str,
    bands: DataFrame | None = None,
    ts: str = "timestamp",
    level: str = "water_level",
    size: int = BLOCK,
) -> DataFrame:
    """Clean hourly series of every station (W7): (station, hour, level[, band]).

    Last reading per timestamp, hourly mean, fence, band, junk mask on the
    values before filling, filling, junk out. Without ``bands`` nothing is
    clipped to a band or masked.
    """
    return clean_hourly(hourly_mean(dedup_timestamps(readings, sequence, ts, level), ts, level), bands, size)


def clean_hourly(hourly: DataFrame, bands: DataFrame | None = None, size: int = BLOCK) -> DataFrame:
    """The cleaning of :func:`prepare_series` from hourly means on."""
    placed = with_positions(hourly, "hour", "level", bands, size=size)
    # one pass: fence and band for the row, hour and level of the next known row
    df = with_halo(placed, "position", back=2 * (FENCE_HOURS - 1), ahead=1, size=size)
    by_hour = block_window("hour")
    for name, value in _fenced(by_hour, FENCE_WIDTH, FENCE_HOURS):
        df = df.withColumn(name, value)
    if bands is not None:
        df = df.withColumn("level", clip_to_band(F.col("level"), F.col("band_low"), F.col("band_high")))
    df = df.withColumn("next_hour", F.lead("hour").over(by_hour))
    df = df.withColumn("next_level", F.lead("level").over(by_hour))
    df = with_grid_hours(own_rows(df))
    grid = df.select(
        KEY,
        F.col("grid_hour").alias("hour"),
        _linear(F.col("next_hour"), F.col("next_level")).alias("level"),
        F.when(F.col("grid_hour") == F.col("hour"), F.col("level")).alias("measured"),
        "first_hour",
        "last_hour",
        *([] if bands is None else ["band_low", "band_high"]),
    )
    if bands is None:
        return grid.select(KEY, "hour", "level")
    masked = junk_mask(grid, "measured", size=size).filter(~F.col("junk"))
    return masked.select(KEY, "hour", "level", "band_low", "band_high")


def as_readings(series: DataFrame) -> DataFrame:
    """Epoch hours back to timestamps."""
    return series.withColumn("timestamp", hour_timestamp(F.col("hour")))
