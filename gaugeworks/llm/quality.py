"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document; the ledger stores the measurements and one
bit per failed rule. A policy is a named, versioned set of rules, so it is a mask, and
applying one is a bitwise AND over the ledger: texts are not read again. Ablations count,
per rule, what a policy would keep without it, in one bitwise aggregation.

Everything is built-in column functions; a document's windows are compared inside its own
row by sorting hashes of its 3-word windows, so no row leaves its task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.text import filled, words

SYMBOLS = r"[#*$%&|<>]"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """A bit of the ledger and the SQL condition over the measurements that sets it."""

    name: str
    failed: str


@dataclass(frozen=True)
class Policy:
    """A version and the rules it rejects by."""

    name: str
    version: int
    rules: tuple[str, ...]


#: Bit i of a ledger is rule i; append only, so that stored ledgers stay readable.
RULES = (
    Rule("too_few_words", "n_words < 50"),
    Rule("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 20 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("duplicate_lines", "n_dup_lines > 3 and 30 * n_dup_lines > n_words"),
)
BASE = Policy("base", 1, ("too_few_words", "repeated_windows"))
STRICT = Policy("strict", 1, tuple(r.name for r in RULES))


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row, also inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeated_words(found: Column, span: int = 3) -> Column:
    """Words covered by windows of ``span`` words that the array holds twice or more.

    Windows are compared by the 64-bit hash of their words' hashes: within one document of
    n words a false match has probability n^2 / 2^65.
    """

    def covered(places: Column) -> Column:
        # sorted starts: each covers span words, less where the next start is nearer
        gaps = F.transform(
            places,
            lambda p, i: F.least(F.lit(span), F.coalesce(F.get(places, i + 1) - p, F.lit(span))),
        )
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda total, gap: total + gap)

    def repeats(ordered: Column) -> Column:
        same = F.filter(
            ordered,
            lambda w, i: (w["h"] == F.get(ordered, i + 1)["h"]) | (w["h"] == F.get(ordered, i - 1)["h"]),
        )
        return let(F.array_sort(F.transform(same, lambda w: w["at"])), covered)

    def windows(hashes: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(hashes) - span)
        return F.transform(
            starts,
            lambda i: F.struct(
                F.xxhash64(*[F.get(hashes, i + k) for k in range(span)]).alias("h"), i.alias("at")
            ),
        )

    hashes = F.transform(found, lambda w: F.xxhash64(w))
    counted = let(hashes, lambda h: let(F.array_sort(windows(h)), repeats))
    return F.when(F.size(found) >= span, counted).otherwise(F.lit(0).cast("long"))


def repeated_lines(text: Column) -> Column:
    """Lines holding a word that equal an earlier line."""
    lines = F.filter(F.split(filled(text), "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda held: (F.size(held) - F.size(F.array_distinct(held))).cast("long"))


def measurements(text: Column) -> Column:
    """Struct of MEASURES for one text."""
    whole = filled(text)

    def of(found: Column) -> Column:
        return F.struct(
            F.size(found).cast("long").alias("n_words"),
            F.length(F.array_join(found, "")).cast("long").alias("word_chars"),
            F.coalesce(F.regexp_count(whole, F.lit(SYMBOLS)), F.lit(0)).cast("long").alias("n_symbols"),
            repeated_lines(text).alias("n_dup_lines"),
            repeated_words(found).alias("n_repeat_words"),
        )

    return let(words(text), of)


def ledger(docs: DataFrame, rules: Sequence[Rule] = RULES, carry: Sequence[str] = ()) -> DataFrame:
    """``doc_id``, the measurements, ``failed`` (bit i set: rule i failed) and carried columns.

    Null or empty text has no words and all measurements 0. Null and repeated doc_ids are
    rows like any other. Empty table: no rows. Further columns of any name are ignored
    unless carried.
    """
    carried = [c for c in carry if c != "doc_id"]
    rows = docs.select(
        "doc_id", measurements(F.col("text")).alias("_m"), F.struct(*carried).alias("_row") if carried else F.lit(0).alias("_row")
    ).select("doc_id", "_row", *[F.col(f"_m.{m}").alias(m) for m in MEASURES])
    bits = [
        F.when(F.expr(rule.failed), F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, rule in enumerate(rules)
    ]
    mask = bits[0]
    for bit in bits[1:]:
        mask = mask.bitwiseOR(bit)
    return rows.select("doc_id", *MEASURES, mask.alias("failed"), *[F.col(f"_row.{c}").alias(c) for c in carried])


def mask_of(policy: Policy, rules: Sequence[Rule] = RULES) -> int:
    places = {rule.name: i for i, rule in enumerate(rules)}
    return sum(1 << places[name] for name in policy.rules)


def passes(policy: Policy, failed: Column | None = None, rules: Sequence[Rule] = RULES) -> Column:
    """True where a ledger's row fails no rule of the policy."""
    return (F.col("failed") if failed is None else failed).bitwiseAND(F.lit(mask_of(policy, rules))) == 0


def ablations(book: DataFrame, policy: Policy, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Per rule of the policy: documents it fails, and those that it alone rejects."""
    places = {rule.name: i for i, rule in enumerate(rules)}
    rejected = F.col("failed").bitwiseAND(F.lit(mask_of(policy, rules)))
    counts = [F.count("*").alias("n_documents"), F.count_if(rejected == 0).alias("n_kept")]
    for name in policy.rules:
        bit = 1 << places[name]
        counts.append(F.count_if(F.col("failed").bitwiseAND(F.lit(bit)) != 0).alias(f"f_{name}"))
        counts.append(F.count_if(rejected == bit).alias(f"o_{name}"))
    rows = [
        F.struct(
            F.lit(policy.name).alias("policy"),
            F.lit(policy.version).alias("version"),
            F.lit(name).alias("rule"),
            F.col(f"f_{name}").alias("n_failed"),
            F.col(f"o_{name}").alias("n_only"),
            (F.col("n_kept") + F.col(f"o_{name}")).alias("n_kept_without"),
        )
        for name in policy.rules
    ]
    return book.agg(*counts).select(F.inline(F.array(*rows)))
