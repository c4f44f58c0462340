"""Exact dedup by distributed MSD radix partitioning.

Documents are split by their leading bytes, then every group that still has two or more
members by its next bytes, until a group is a singleton or its texts have ended. A digit
is a run of bytes whose width grows from round to round, so the number of rounds follows
the logarithm of the longest text. Groups are compared by the bytes themselves; no digest
stands for a text.

Each round counts (group, digit) with map-side aggregation, so a group of a third of all
rows sends one row per task, and joins the counts back, where adaptive execution splits
the large side. After the first round only members of groups carry their text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.text import filled, folded
from gaugeworks.llm.skew import dealt_anew
from gaugeworks.session import cut_lineage

HEAD_BYTES = 64
GROWTH = 16


def exact_groups(
    docs: DataFrame, carry: Sequence[str] = (), head: int = HEAD_BYTES, growth: int = GROWTH
) -> DataFrame:
    """Groups of equal texts; texts are equal when identical after lower-casing A-Z only.

    Returns one row per document: ``doc_id, keep_id, group_size, kept, text_sha256`` and the
    columns named in ``carry``. ``keep_id`` is the largest doc_id of the group, whose row is
    the one with ``kept``.

    Null text counts as empty. Null doc_id is smaller than any other. Rows that repeat a
    doc_id and a text are copies of each other: one of them is kept. Empty table: no rows.
    Further columns of any name are ignored unless carried.
    """
    text = filled(F.col("text"))
    length = F.octet_length(text)
    first = F.substring(folded(F.substring(text, 1, head)).cast("binary"), 1, head)
    heads = (
        docs.select(length.alias("_n"), first.alias("_head"))
        .groupBy("_n", "_head")
        .count()
        .filter("count > 1")
        .select(dealt_anew("_n"), "_head", F.lit(True).alias("_grouped"))
    )
    rows = docs.select(
        F.struct("doc_id", *[c for c in carry if c not in ("doc_id", "text")]).alias("_row"),
        F.col("text").alias("_text"),
        length.alias("_n"),
        first.alias("_head"),
    )
    whole = folded(filled(F.col("_text")))
    everything = cut_lineage(
        rows.join(heads, ["_n", "_head"], "left").select(
            F.monotonically_increasing_id().alias("_uid"),
            "_row",
            F.col("_text") if "text" in carry else F.lit(None).cast("string").alias("_text"),
            F.sha2(whole, 256).alias("text_sha256"),
            "_n",
            F.when(F.col("_grouped"), F.col("_head")).alias("_head"),
            F.when(F.col("_grouped"), F.substring(whole.cast("binary"), head + 1, 2**31 - 1)).alias("_rest"),
        )
    )
    active = everything.filter("_rest is not null").select("_uid", "_row.doc_id", "_n", "_head", "_rest")
    keys, at, width, ended = ["_n", "_head"], head, head * growth, []
    while True:
        digit = active.withColumn("_digit", F.substring("_rest", 1, width))
        groups = (
            digit.groupBy(*keys, "_digit")
            .agg(F.count("*").alias("_size"), F.min("_uid").alias("_next"), F.max(F.struct("doc_id", "_uid")).alias("_last"))
            .filter("_size > 1")
        )
        at += width
        split = cut_lineage(
            digit.join(groups.withColumn(keys[0], dealt_anew(keys[0])), [*keys, "_digit"]).select(
                "_uid",
                "doc_id",
                "_n",
                F.col("_next").alias("_group"),
                F.when(F.col("_n") > at, F.substring("_rest", width + 1, 2**31 - 1)).alias("_rest"),
                "_size",
                "_last",
            )
        )
        ended.append(split.filter("_rest is null").select("_uid", "_size", "_last"))
        active = split.filter("_rest is not null").select("_uid", "doc_id", "_n", "_group", "_rest")
        if active.isEmpty():
            break
        keys, width = ["_group"], width * growth
    found = ended[0]
    for more in ended[1:]:
        found = found.unionByName(more)
    kept = F.coalesce(F.col("_last._uid") == F.col("_uid"), F.lit(True))
    return everything.join(found, "_uid", "left").select(
        F.col("_row.doc_id").alias("doc_id"),
        F.when(F.col("_size").isNull(), F.col("_row.doc_id")).otherwise(F.col("_last.doc_id")).alias("keep_id"),
        F.coalesce("_size", F.lit(1)).cast("long").alias("group_size"),
        kept.alias("kept"),
        "text_sha256",
        *[F.col("_text").alias("text") if c == "text" else F.col(f"_row.{c}").alias(c) for c in carry if c != "doc_id"],
    )
