"""Exact linear quantiles of a column, of all rows or by group, without gathering any column or group."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window as W, functions as F

from gaugeworks.functions.parsing import finite
from gaugeworks.session import cut_lineage


def exact_quantiles(df: DataFrame, column: str, probs: list[float]) -> list:
    """Linear-interpolated quantiles, as many as ``probs``; NULL, NaN and infinities do not count.

    Values are counted once (map-side combined) and range-sorted. The counts of
    the partitions, one number each, tell which partition holds a wanted rank;
    only those partitions are summed up, and only the wanted values leave Spark.
    """
    ordered = cut_lineage(
        df.select(finite(F.col(column).cast("double")).alias("v"))
        .filter("v IS NOT NULL")
        .groupBy("v")
        .agg(F.count("*").alias("n"))
        .repartitionByRange("v")
        .withColumn("part", F.spark_partition_id())
    )
    starts, total = {}, 0
    for part, rows in sorted(map(tuple, ordered.groupBy("part").agg(F.sum("n")).collect())):
        starts[part] = total
        total += rows
    if not total:
        return [None] * len(probs)
    spots = [p * (total - 1) for p in probs]
    ranks = sorted({r for s in spots for r in (math.floor(s), math.ceil(s))})
    held = {max((p for p in starts if starts[p] <= r), key=starts.get) for r in ranks}
    upto = F.sum("n").over(W.partitionBy("part").orderBy("v"))
    begin = F.element_at(F.create_map(*[F.lit(x) for p in held for x in (p, starts[p])]), F.col("part"))
    placed = ordered.filter(F.col("part").isin(*held)).withColumn("end", begin + upto)
    wanted = F.exists(F.array(*[F.lit(r) for r in ranks]), lambda r: (r < F.col("end")) & (r >= F.col("end") - F.col("n")))
    rows = placed.filter(wanted).select("v", F.col("end") - F.col("n"), "end").collect()
    value = {r: v for r in ranks for v, first, end in rows if first <= r < end}
    low = [value[math.floor(s)] for s in spots]
    return [a + (value[math.ceil(s)] - a) * (s - math.floor(s)) for a, s in zip(low, spots)]


def exact_quantiles_by(df: DataFrame, key: str, column: str, probs: list[float]) -> DataFrame:
    """``(key, rows, quantiles)``: the same for every group at once, one row per group with values.

    Counted values are range-sorted by (group, value), so a group with most of the rows
    spreads over many partitions. Each piece of a group inside a partition is summed, and a
    running sum over a group's pieces (at most one a partition) says which piece holds a
    wanted rank. Only those pieces are summed up inside, a task seeing one partition's rows.
    """
    ordered = cut_lineage(
        df.select(F.col(key).alias("g"), finite(F.col(column).cast("double")).alias("v"))
        .filter("v IS NOT NULL")
        .groupBy("g", "v")
        .agg(F.count("*").alias("n"))
        .repartitionByRange("g", "v")
        .withColumn("part", F.spark_partition_id())
    )
    pieces = ordered.groupBy("g", "part").agg(F.sum("n").alias("held"))
    earlier = W.partitionBy("g").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    pieces = cut_lineage(
        pieces.withColumns(
            {"first": F.coalesce(F.sum("held").over(earlier), F.lit(0)), "rows": F.sum("held").over(W.partitionBy("g"))}
        )
    )
    spots = F.transform(F.array(*[F.lit(float(p)) for p in probs]), lambda p: p * (F.col("rows") - 1))
    wanted = pieces.select(
        F.col("g").alias("wg"), F.col("part").alias("wpart"), "first", "held", "rows", F.posexplode(spots).alias("prob", "spot")
    ).select(
        "*", F.explode(F.array(F.struct(F.floor("spot").alias("rank"), F.lit(False).alias("high")), F.struct(F.ceil("spot").alias("rank"), F.lit(True).alias("high")))).alias("at")
    )
    wanted = wanted.filter((F.col("at.rank") >= F.col("first")) & (F.col("at.rank") < F.col("first") + F.col("held")))
    upto = F.sum("n").over(W.partitionBy("g", "part").orderBy("v"))
    some = wanted.select("wg", "wpart").distinct()
    near = ordered.join(some, F.col("g").eqNullSafe(F.col("wg")) & (F.col("part") == F.col("wpart")), "left_semi")
    placed = near.withColumn("upto", upto)
    same = F.col("g").eqNullSafe(F.col("wg")) & (F.col("part") == F.col("wpart"))
    inside = F.col("at.rank") - F.col("first")
    found = placed.join(wanted, same & (inside < F.col("upto")) & (inside >= F.col("upto") - F.col("n")))
    ends = found.groupBy("g", "rows", "prob", "spot").agg(
        F.max(F.when(~F.col("at.high"), F.col("v"))).alias("low"), F.max(F.when(F.col("at.high"), F.col("v"))).alias("high")
    )
    value = F.col("low") + (F.col("high") - F.col("low")) * (F.col("spot") - F.floor("spot"))
    listed = ends.groupBy("g", "rows").agg(F.array_sort(F.collect_list(F.struct("prob", value.alias("value")))).alias("all"))
    return listed.select(F.col("g").alias(key), "rows", F.transform("all", lambda e: e["value"]).alias("quantiles"))
