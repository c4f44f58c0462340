"""Idempotent merge, rolling retention and the daily anti-join."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from gaugeworks.operators.columns import canonical, coerce_doubles, with_utc_timestamp
from gaugeworks.session import cut_lineage


def union_tables(tables: list[DataFrame]) -> DataFrame:
    """All rows of all tables, missing columns NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def keep_last(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the last in ``order``.

    ``row_number() = 1`` lets Spark drop losers before the shuffle, so a key
    that holds most rows still sends one row per input task.
    """
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def retain_days(df: DataFrame, days: int, column: str = "timestamp") -> DataFrame:
    """Rows no older than ``days`` before the newest one, bound included (U4)."""
    if days <= 0:
        return df
    newest = df.agg(F.max(column).alias("newest")).scalar()
    cutoff = newest - F.make_dt_interval(F.lit(days))
    return df.filter((F.col(column) >= cutoff) | newest.isNull())


def dedup_readings(
    existing: DataFrame, new: DataFrame, dedup_key: str = "dedup_key", sequence: str | None = None
) -> DataFrame:
    """Union with one row per key, new over old, later over earlier."""
    both = existing.withColumn("_batch", F.lit(0)).unionByName(
        new.withColumn("_batch", F.lit(1)), allowMissingColumns=True
    )
    order = [F.desc("_batch")] + ([F.desc(sequence)] if sequence else [])
    kept = keep_last(both, [dedup_key], order)
    kept = with_utc_timestamp(kept) if "timestamp" in kept.columns else kept
    return canonical(coerce_doubles(kept, [c for c in ("water_level", "latitude", "longitude") if c in kept.columns]))


def merge_readings(
    existing: DataFrame,
    new: DataFrame,
    retention_days: int = 365,
    dedup_key: str = "dedup_key",
    sequence: str | None = None,
) -> DataFrame:
    """Idempotent merge with retention (U1); order the result when it is written."""
    merged = dedup_readings(existing, new, dedup_key, sequence)
    # the newest time and the rows both need the merge: it is written once
    return retain_days(cut_lineage(merged), retention_days) if retention_days > 0 else merged


def new_rows_only(existing: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of ``new`` whose key is not in ``existing`` (J4); copies inside ``new`` stay."""
    seen = existing.select(key).filter(F.col(key).isNotNull()).distinct()
    return new.join(seen, key, "left_anti")
