"""Row numbers and prefix sums over a global order, without one task for all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.session import cut_lineage

RANKS_PER_BLOCK = 1 << 16


def ranked(frame: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """``frame`` with its rows numbered from 0 in the given order, without one task for all.

    Rows are range-sorted, counted by partition, and each partition counts on from the sum
    of those before it; only one number per partition goes to the driver.
    """
    part, inside = "_partition", "_inside"
    spread = cut_lineage(
        frame.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn(inside, F.monotonically_increasing_id())
        .withColumn(part, F.spark_partition_id())
        .withColumn(inside, F.col(inside).bitwiseAND(F.lit((1 << 33) - 1)))
    )
    counts = sorted((r[0], r[1]) for r in spread.groupBy(part).count().collect())
    starts, total = [], 0
    for number, count in counts:
        starts.append((number, total))
        total += count
    offsets = frame.sparkSession.createDataFrame(starts or [(0, 0)], f"{part} int, _before bigint")
    return spread.join(offsets, part).withColumn(name, F.col("_before") + F.col(inside)).drop(part, inside, "_before")


def running_sums(rows: DataFrame, rank: str, value: str, before: str) -> DataFrame:
    """Adds the sum of ``value`` over all smaller ranks to ``(rank, value)`` rows.

    Blocks of consecutive ranks are summed first; only one row per block is put in order.
    """
    block = rows.withColumn("_block", F.shiftright(F.col(rank), 16))
    ordered = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        block.groupBy("_block")
        .agg(F.sum(value).alias("_sum"))
        .select("_block", F.coalesce(F.sum("_sum").over(ordered), F.lit(0)).alias("_start"))
    )
    inside = Window.partitionBy("_block").orderBy(rank).rowsBetween(Window.unboundedPreceding, -1)
    return (
        block.withColumn(before, F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .join(starts, "_block")
        .withColumn(before, F.col(before) + F.col("_start"))
        .drop("_block", "_start")
    )
