"""Queries over documents: mixing, exact dedup, quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from gaugeworks.llm import exact, hmm, mixing, packing, quality, simhash, spans
from gaugeworks.llm.registry import query, table


@query("op4_mix_sources")
def op4(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


#: A-Z only; lower() would fold other letters too.
FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(
    "op5_exact_dedup",
    f"""
    with folded as (select doc_id, {FOLDED} as t from documents)
    select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
           doc_id = max(doc_id) over same as kept, sha256(t) as text_sha256
    from folded window same as (partition by t)
    """,
)
def op5(spark, sf_dir):
    return exact.exact_groups(table(spark, sf_dir, "documents"))


@query(
    "op7_quality_rules",
    r"""
    with split as (
        select doc_id, coalesce(text, '') as t,
               list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') as w
        from documents),
    windows as (
        select doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as g
        from split, unnest(range(1, len(w) - 1)) as r(i) where len(w) >= 3),
    twice as (select doc_id, i from windows qualify count(*) over (partition by doc_id, g) > 1),
    covered as (
        select doc_id, count(distinct i + k) as n from twice, unnest([0, 1, 2]) as r(k) group by doc_id),
    lines as (
        select doc_id, l from split, unnest(string_split(t, chr(10))) as r(l)
        where regexp_matches(l, '[^\x20\x09-\x0D]')),
    dups as (select doc_id, count(*) - count(distinct l) as n from lines group by doc_id),
    measured as (
        select doc_id, len(w) as n_words, length(array_to_string(w, '')) as word_chars,
               length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as n_symbols,
               coalesce(dups.n, 0) as n_dup_lines, coalesce(covered.n, 0) as n_repeat_words
        from split left join dups using (doc_id) left join covered using (doc_id)),
    judged as (
        select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
               word_chars < 2 * n_words or word_chars > 20 * n_words or 10 * n_symbols > n_words
               or (n_dup_lines > 3 and 30 * n_dup_lines > n_words) as other_failed
        from measured)
    select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           not (base_failed or other_failed) as kept
    from judged
    """,
)
def op7(spark, sf_dir):
    book = quality.ledger(table(spark, sf_dir, "documents"))
    return book.select(
        "doc_id",
        *quality.MEASURES,
        (~quality.passes(quality.BASE)).alias("base_failed"),
        quality.passes(quality.STRICT).alias("kept"),
    )


@query("op1_pack")
def op1(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


@query("op10_simhash_golay")
def op10(spark, sf_dir):
    return simhash.near_groups(table(spark, sf_dir, "documents"))


@query("op3_substring_dedup")
def op3(spark, sf_dir):
    return spans.remove_repeats(table(spark, sf_dir, "documents"))


@query("op9_hmm_scores")
def op9(spark, sf_dir):
    return hmm.score(table(spark, sf_dir, "documents"))
