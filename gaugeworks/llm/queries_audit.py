"""Queries over documents: Merkle manifest, token counts, periodic runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from gaugeworks.llm import counts, manifest, runs
from gaugeworks.llm.queries_documents import FOLDED
from gaugeworks.llm.registry import query, table
from gaugeworks.llm.text import folded

#: CRC-32 of a short ASCII text in ``d``, bit by bit: 3988292384 is the reflected polynomial.
CRC32 = """
    xor(4294967295, list_reduce(
        list_prepend(4294967295::bigint, list_transform(string_split(d, ''), lambda c: ascii(c)::bigint)),
        lambda a, x: list_reduce(
            list_prepend(xor(a, x), range(0, 8)),
            lambda b, i: xor(b >> 1, 3988292384 * (b & 1)))))
"""
LEAF = "sha256({} || {})".format(
    " || ".join(f"coalesce(strlen({c}::varchar) || ':' || {c}::varchar, '-')" for c in ("doc_id", "source", "lang", "n_chars")),
    "coalesce(strlen({t}) || ':' || {t}, '-')",
)


@query(
    "op11_merkle_manifest",
    f"""
    with recursive checked as (
        select *, {CRC32} % 3 = 0 as tampered from (select *, doc_id::varchar as d from documents)),
    leaves as (
        select doc_id, dense_rank() over (order by lang nulls first) - 1 as g, lang,
               {LEAF.format(t="text")} as leaf,
               case when tampered then {LEAF.format(t=FOLDED.replace("coalesce(text, '')", "text"))}
                    else {LEAF.format(t="text")} end as found
        from checked),
    placed as (select *, row_number() over (partition by g order by doc_id nulls first, leaf) - 1 as k from leaves),
    nodes as (
        select g, 0 as l, k as i, leaf as h from placed
        union all
        select g, l + 1, i // 8, sha256(string_agg(h, '' order by i))
        from (select *, count(*) over (partition by g) as n from nodes) where n > 1 group by g, l, i // 8),
    subroots as (select g, l as top, h from nodes qualify l = max(l) over (partition by g)),
    crown as (
        select 0 as l, g as i, h from subroots
        union all
        select l + 1, i // 8, sha256(string_agg(h, '' order by i))
        from (select *, count(*) over () as n from crown) where n > 1 group by l, i // 8),
    root as (select h, l as top from crown qualify l = max(l) over ()),
    path as (
        select g, k, 0 as l, k as i, found as h from placed
        union all
        select g, k, l + 1, i // 8, sha256(string_agg(case when j = i then h else other end, '' order by j))
        from (select f.*, n.i as j, n.h as other
              from path f join subroots s on s.g = f.g and f.l < s.top
                   join nodes n on n.g = f.g and n.l = f.l and n.i // 8 = f.i // 8)
        group by g, k, l, i),
    crown_path as (
        select f.g, f.k, 0 as l, f.g as i, f.h from path f join subroots s on s.g = f.g and f.l = s.top
        union all
        select g, k, l + 1, i // 8, sha256(string_agg(case when j = i then h else other end, '' order by j))
        from (select f.*, n.i as j, n.h as other
              from crown_path f join root r on f.l < r.top join crown n on n.l = f.l and n.i // 8 = f.i // 8)
        group by g, k, l, i),
    siblings as (
        select f.g, f.k, 0 as part, f.l, n.i, n.h
        from path f join nodes n on n.g = f.g and n.l = f.l and n.i // 8 = f.i // 8 and n.i <> f.i
        union all
        select f.g, f.k, 1, f.l, n.i, n.h
        from crown_path f join crown n on n.l = f.l and n.i // 8 = f.i // 8 and n.i <> f.i),
    proofs as (select g, k, string_agg(h, '' order by part, l, i) as s from siblings group by g, k)
    select p.doc_id, p.leaf, s.h as subroot, r.h as root, sha256(coalesce(proofs.s, '')) as proof_sha256,
           f.h as folded_root, f.h = r.h as verified
    from placed p join subroots s using (g) cross join root r
         join crown_path f on f.g = p.g and f.k = p.k and f.l = r.top
         left join proofs on proofs.g = p.g and proofs.k = p.k
    """,
)
def op11(spark, sf_dir):
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    text = F.col("text")
    return manifest.manifest(table(spark, sf_dir, "documents"), F.when(tampered, folded(text)).otherwise(text))


@query("op12_token_counts")
def op12(spark, sf_dir):
    return counts.token_counts(table(spark, sf_dir, "documents"))


@query("op13_periodic_runs")
def op13(spark, sf_dir):
    return runs.periodic_runs(table(spark, sf_dir, "documents"), runs.planted_tails)
