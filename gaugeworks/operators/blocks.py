"""Splitting long series into bounded blocks.

A window partitioned by station alone would put a whole series, however long,
into one task. Here every station is cut into blocks of consecutive positions;
each row is also sent to the neighbouring blocks that need it as context (its
halo), windows run per (station, block), and only a block's own rows are kept.
For frames no wider than the halo the result is the one of the uncut series.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

# with a halo of a few hundred rows still below the 4096 rows that Spark's window
# operator buffers in memory by default
BLOCK = 2048
KEY = "station_code"
HOUR_SECONDS = 3600


def epoch_hour(ts: Column) -> Column:
    return F.floor(F.unix_timestamp(ts.cast("timestamp")) / HOUR_SECONDS).cast("bigint")


def hour_timestamp(hour: Column) -> Column:
    return F.timestamp_seconds(hour * HOUR_SECONDS)


def block_of(position: Column, size: int = BLOCK) -> Column:
    # never NULL, so that no join adds a filter to one of two equal subplans
    return F.coalesce(F.floor(position / F.lit(size)).cast("bigint"), F.lit(0).cast("bigint"))


def with_halo(df: DataFrame, position: str, back: int, ahead: int, size: int = BLOCK) -> DataFrame:
    """Each row once per block that sees it; ``is_own`` marks the block's own rows."""
    p = F.col(position)
    blocks = F.sequence(block_of(p - ahead, size), block_of(p + back, size))
    return df.withColumn("block", F.explode(blocks)).withColumn(
        "is_own", F.col("block") == block_of(F.col(position), size)
    )


def own_rows(df: DataFrame) -> DataFrame:
    return df.filter("is_own").drop("is_own", "block")


def block_window(position: str) -> W:
    return W.partitionBy(KEY, "block").orderBy(position)


def with_positions(
    df: DataFrame,
    hour: str,
    measured: str,
    attributes: DataFrame | None = None,
    tallies: dict[str, Column] | None = None,
    size: int = BLOCK,
) -> DataFrame:
    """Exact row position per station, with the station's row count and hour bounds.

    Rows are numbered inside (station, block of hours); the numbers of rows in
    earlier blocks come from a summary with one row per (station, block). Both
    read the same shuffle as long as ``df`` holds no column the summary leaves
    out, so keep it narrow. ``attributes`` (one row per station) is joined to
    the summary and never meets the rows on the station key alone; ``tallies``
    are conditions counted over the whole series.
    """
    tallies = tallies or {}
    placed = df.filter(F.col(KEY).isNotNull() & F.col(hour).isNotNull())
    blocked = placed.withColumn("block", block_of(F.col(hour), size)).repartition(KEY, "block")
    summary = blocked.groupBy(KEY, "block").agg(
        F.count(measured).alias("rows_in_block"),
        F.min(hour).alias("low"),
        F.max(hour).alias("high"),
        *[F.count_if(condition).alias(name) for name, condition in tallies.items()],
    )
    station = W.partitionBy(KEY)
    earlier = station.orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    summary = summary.select(
        KEY,
        "block",
        F.coalesce(F.sum("rows_in_block").over(earlier), F.lit(0)).alias("rows_before"),
        F.sum("rows_in_block").over(station).alias("series_rows"),
        F.min("low").over(station).alias("first_hour"),
        F.max("high").over(station).alias("last_hour"),
        *[F.sum(name).over(station).alias(name) for name in tallies],
    )
    if attributes is not None:
        summary = summary.join(attributes, KEY, "left")
    # every row has its summary; as a left join it can never broadcast the rows,
    # whose size Catalyst underestimates after an explode
    number = F.row_number().over(W.partitionBy(KEY, "block").orderBy(hour))
    return (
        blocked.withColumn("number", number)
        .join(summary, [KEY, "block"], "left")
        .withColumn("position", F.col("rows_before") + F.col("number") - 1)
        .drop("rows_before", "number", "block")
    )
