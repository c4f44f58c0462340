"""Supervised feature frame over clean hourly series.

Lags and rolling statistics count surviving rows, not hours: after junk removal
a series may have holes. Rows are therefore numbered first and the frames run in
blocks of row numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from gaugeworks.catalogue import KINDS
from gaugeworks.functions.seasonal import seasonal_encodings
from gaugeworks.operators.blocks import BLOCK, KEY, block_window, hour_timestamp, own_rows, with_halo, with_positions
from gaugeworks.session import cut_lineage

# --- Fixed values: feature definitions -------------------------------------
LAGS = [1, 2, 3, 6, 12, 24, 48, 168]
ROLLS = [(24, "mean"), (24, "std"), (72, "mean"), (168, "mean")]
DIFFS = [1, 24]
MIN_SERIES_HOURS = 216
MAX_JUNK_SHARE = 0.05
HOLDOUT_SHARE = 0.1
CATEGORIES = ["station_code", "basin_name", "kind"]
SEASONAL = ["sin_hour", "cos_hour", "sin_doy", "cos_doy"]
# ---------------------------------------------------------------------------
SLIDING_ROWS = 24


def feature_columns() -> list[str]:
    """The 21 model inputs in model order."""
    return [
        *CATEGORIES,
        *SEASONAL,
        *[f"lag_{k}" for k in LAGS],
        *[f"roll{w}_{stat}" for w, stat in ROLLS],
        *[f"diff_{k}" for k in DIFFS],
    ]


def numbered(series: DataFrame, attributes: DataFrame | None = None, size: int = BLOCK) -> DataFrame:
    """``position`` and ``series_rows`` per station over the surviving rows."""
    return with_positions(series.select(KEY, "hour", "level"), "hour", "level", attributes, size=size)


def add_lags(df: DataFrame, w, lags: list[int] = LAGS) -> DataFrame:
    """Level k rows earlier."""
    return df.withColumns({f"lag_{k}": F.lag("level", k).over(w) for k in lags})


def add_rolls(df: DataFrame, w, rolls: list[tuple[int, str]] = ROLLS) -> DataFrame:
    """Trailing mean and deviation, NULL until the window is full.

    A sliding frame adds up its rows again for every row, so long means are
    differences of one running sum over the block instead.
    """
    function = {"mean": F.avg, "std": F.stddev_samp}
    df = df.withColumn("running", F.sum("level").over(w.rowsBetween(W.unboundedPreceding, 0)))

    def roll(n: int, stat: str) -> Column:
        if stat == "mean" and n > SLIDING_ROWS:
            before = F.coalesce(F.lag("running", n).over(w), F.lit(0.0))
            return (F.col("running") - before) / n
        return function[stat]("level").over(w.rowsBetween(-(n - 1), 0))

    return df.withColumns(
        {f"roll{n}_{stat}": F.when(F.col("position") >= n - 1, roll(n, stat)) for n, stat in rolls}
    ).drop("running")


def add_diffs(df: DataFrame, w, diffs: list[int] = DIFFS) -> DataFrame:
    """Change against k rows earlier (W10), from the lag column where there is one."""
    earlier = {k: F.col(f"lag_{k}") if f"lag_{k}" in df.columns else F.lag("level", k).over(w) for k in diffs}
    return df.withColumns({f"diff_{k}": F.col("level") - level for k, level in earlier.items()})


def add_target(df: DataFrame, w) -> DataFrame:
    """Level of the next row."""
    return df.withColumn("target", F.lead("level").over(w))


def series_features(placed: DataFrame, size: int = BLOCK) -> DataFrame:
    """Lags, rolls, differences, target and seasonal columns of numbered rows."""
    w = block_window("position")
    back = max(*LAGS, *DIFFS, *[n for n, _ in ROLLS])
    df = with_halo(placed, "position", back, ahead=1, size=size)
    for add in (add_lags, add_rolls, add_diffs, add_target):
        df = add(df, w)
    df = own_rows(df).withColumn("timestamp", hour_timestamp(F.col("hour")))
    return df.withColumns(seasonal_encodings(F.col("timestamp")))


def _codes(values: DataFrame, column: str) -> DataFrame:
    """Position of each distinct value among the sorted ones, from 0.

    Range partitions in order, each row numbered in its own; written down so
    that both readers see one split. Only partitions are put in order by one task.
    """
    distinct, code = values.select(column).distinct(), f"{column}_id"
    ranged = cut_lineage(distinct.orderBy(column).withColumn("mark", F.monotonically_increasing_id()))
    ranged = ranged.withColumns({"part": F.shiftright("mark", 33), "row": F.col("mark").bitwiseAND((1 << 33) - 1)})
    parts = ranged.groupBy("part").agg(F.count("*").alias("rows"))
    earlier = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = parts.select("part", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("rows_before"))
    return ranged.join(offsets, "part").select(column, (F.col("rows_before") + F.col("row")).cast("int").alias(code))


def category_codes(catalogue: DataFrame) -> DataFrame:
    """Stable integer codes per catalogue station (P17): positions among sorted values."""
    kinds = sorted(KINDS)
    kind = F.coalesce(
        *[F.when(F.col("kind") == k, F.lit(i)) for i, k in enumerate(kinds)], F.lit(-1)
    ).cast("int")
    return (
        catalogue.select(KEY, "basin_name", kind.alias("kind_id"))
        .join(_codes(catalogue, KEY), KEY)
        .join(_codes(catalogue, "basin_name"), "basin_name")
        .select(KEY, "station_code_id", "basin_name_id", "kind_id")
    )


def encode_stations(df: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Adds the three category codes, -1 for stations not in the catalogue."""
    joined = df.join(category_codes(catalogue), KEY, "left")
    return joined.withColumns({f"{c}_id": F.coalesce(f"{c}_id", F.lit(-1)) for c in CATEGORIES})


def above_middle() -> Column:
    return F.col("level") > F.col("band_low") + 0.5 * (F.col("band_high") - F.col("band_low"))


def junk_share(series: DataFrame) -> DataFrame:
    """Clean hours per station and their share above the band midpoint."""
    return series.groupBy(KEY).agg(
        F.count("*").alias("series_rows"),
        (F.count_if(above_middle()) / F.count("*")).alias("junk_share"),
    )


def training_frame(
    series: DataFrame,
    catalogue: DataFrame,
    min_hours: int = MIN_SERIES_HOURS,
    max_junk_share: float = MAX_JUNK_SHARE,
    size: int = BLOCK,
) -> DataFrame:
    """Feature rows of all trainable stations, nothing missing.

    ``series`` carries its band columns. History length and junk share come with
    the row numbering, so stations are chosen without a second pass.
    ``is_holdout`` marks the last tenth of each station.
    """
    codes = category_codes(catalogue).withColumn("known", F.lit(True))
    narrow = series.select(KEY, "hour", "level", "band_low", "band_high")
    placed = with_positions(narrow, "hour", "level", codes, {"hours_above": above_middle()}, size)
    enough = (F.col("series_rows") >= min_hours) & (F.col("hours_above") <= max_junk_share * F.col("series_rows"))
    chosen = placed.filter(F.col("known") & enough).drop("known", "hours_above", "band_low", "band_high")
    rows = series_features(chosen, size).dropna(subset=["target", *model_inputs()])
    held_out = F.col("position") >= F.floor((1 - HOLDOUT_SHARE) * F.col("series_rows"))
    return rows.withColumn("is_holdout", held_out)


def model_inputs() -> list[str]:
    """Feature columns as they are named in the training frame."""
    return [f"{c}_id" if c in CATEGORIES else c for c in feature_columns()]
