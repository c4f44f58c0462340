"""Mixing sources to target weights.

Every document gets a hash-random key. Within its source the documents are sorted by
that key in ranges of the key space, prefix sums of their sizes run over the ranges,
and the source's budget cuts the sorted run at the exact word; a budget above the
source's own size repeats it in whole epochs first.

The ranges are equal parts of the space of a 64-bit hash, so a source that holds most
rows spreads over as many ranges as its rows ask for, and no sampling decides the
bounds: reruns agree.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.llm.ranks import ranked
from gaugeworks.llm.text import word_count
from gaugeworks.session import cut_lineage

LEAST_PER_RANGE = 1_000
WEIGHTS = (3.0, 1.0, 2.0)


def source_targets(
    sizes: DataFrame, share: float = 1.5, most: float = 2.0, weights: Sequence[float] = WEIGHTS
) -> DataFrame:
    """Target words per source from ``(source, source_size)``.

    Sources in code-point order, null last, take the weights in turn and share ``share``
    times the total. A target stops at ``most`` times its source; what lies above is shared
    again by weight among the others, until none is above. Returns
    ``source, source_size, source_no, target``.
    """
    order = [F.col("source").isNull(), F.col("source")]
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    table = cut_lineage(
        ranked(sizes.select("source", "source_size"), order, "source_no").withColumn(
            "weight", F.get(cycle, (F.col("source_no") % len(weights)).cast("int"))
        )
    )
    cap = F.col("source_size") * F.lit(float(most))
    total = (table.agg(F.sum("source_size")).first()[0] or 0) * share
    level, capped = 0.0, -1
    while True:
        full = cap <= F.col("weight") * F.lit(level)
        held, rest, now = table.agg(
            F.sum(F.when(full, cap).otherwise(0.0)),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight"))),
            F.count_if(full),
        ).first()
        if now == capped or not rest:
            break
        level, capped = (total - held) / rest, now
    return table.withColumn("target", F.least(cap, F.col("weight") * F.lit(level)) if rest else cap).drop("weight")


def mix(
    docs: DataFrame,
    share: float = 1.5,
    most: float = 2.0,
    weights: Sequence[float] = WEIGHTS,
    seed: int = 7,
    least_per_range: int = LEAST_PER_RANGE,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Words taken from every document so that each source meets its target.

    Returns one row per document: ``doc_id, source, size, source_size, target, taken`` and
    the columns named in ``carry``. ``taken`` is the number of words the mix takes, repeats
    counted: whole epochs of the document plus the part before its source's cut.

    Null or empty text: size 0, nothing taken. Null source: a source of its own, last.
    Null or repeated doc_id: rows of equal key and size are interchangeable, each is one
    row. Empty table: no rows. Further columns of any name are ignored.
    """
    rows = cut_lineage(
        docs.select(
            "doc_id",
            "source",
            word_count(F.col("text")).alias("size"),
            F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("source")).alias("_key"),
            F.struct(*carry).alias("_carry") if carry else F.lit(None).cast("int").alias("_carry"),
        )
    )
    per_source = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("_n"))
    count = per_source.agg(F.sum("_n")).first()[0] or 0
    # as many rows to a range as there are ranges: neither side of the prefix sums grows faster
    per_range = max(least_per_range, math.isqrt(count))
    bits = max(0, (max(1, -(-count // per_range)) - 1).bit_length())
    place = F.shiftrightunsigned("_key", 64 - bits) if bits else F.lit(0).cast("long")
    targets = source_targets(per_source, share, most, weights)
    known = rows.withColumn("_range", place).join(
        targets.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")), "left"
    )
    sums = known.groupBy("source_no", "_range").agg(F.sum("size").alias("_sum"))
    before = Window.partitionBy("source_no").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("source_no", "_range", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    inside = (
        Window.partitionBy("source_no", "_range")
        .orderBy("_key", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = (
        known.withColumn("_prefix", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(starts, ["source_no", "_range"])
        .withColumn("_prefix", F.col("_prefix") + F.col("_start"))
    )
    budget = F.floor("target")
    whole = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    # floor of a quotient of longs is taken in doubles; sizes stay far below 2^53
    rest = budget - whole * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("_prefix")))
    return placed.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        (whole * F.col("size") + part).cast("long").alias("taken"),
        *([F.col(f"_carry.{c}").alias(c) for c in carry if c not in ("doc_id", "source")]),
    )
