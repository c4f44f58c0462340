"""Queries over pages and licences."""

from __future__ import annotations

from gaugeworks.llm import licences, urls
from gaugeworks.llm.registry import query, table


def url_sql(rules=urls.RULES, tree=urls.TreeRules()) -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    fits = "\n".join(
        f"when (host = '{r.host}' or host like '%.{r.host}') and starts_with(path, '{r.path}') then '{r.text}'"
        for r in sorted(rules, key=lambda r: -len(r.text))
    )
    verdict = "\n".join(f"when rule = '{r.text}' then '{r.verdict}'" for r in rules)
    steps = []
    for level in range(tree.depth):
        steps.append(
            f"""
    parent{level} as (select host, template, sum(n)::double as pn, sum(blocked)::double as pb from shape{level} group by all),
    kept{level} as (
        select host, template, part
        from (select host, template, parts[{level + 1}] as part, sum(n)::double as n, sum(blocked)::double as b
              from shape{level} where len(parts) > {level} group by all)
        join parent{level} using (host, template)
        where n >= {tree.support}
          and (b * pn - n * pb) * (b * pn - n * pb) > {tree.z * tree.z} * n * pb * (pn - pb)),
    shape{level + 1} as (
        select s.host, s.path, s.parts, s.n, s.blocked, s.allowed,
               case when len(s.parts) > {level} then s.template || '/' || coalesce(k.part, '*') else s.template end as template
        from shape{level} s left join kept{level} k
          on s.host = k.host and s.template = k.template and s.parts[{level + 1}] = k.part)"""
        )
    return rf"""
    with split as (
        select page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{upper}', '{lower}') as host,
               regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) as path
        from pages),
    ruled as (select *, case {fits} end as rule from split),
    labelled as (select *, case {verdict} end as label from ruled),
    shape0 as (
        select host, path, string_split(path, '/')[2:] as parts, count(*) as n,
               count(*) filter (label = 'block') as blocked, count(*) filter (label = 'allow') as allowed, '' as template
        from labelled group by host, path),
    {",".join(steps)},
    done as (
        select host, path, n, blocked, allowed,
               case when len(parts) > {tree.depth} then template || '/**' else template end as template
        from shape{tree.depth}),
    prior as (select (sum(blocked)::double + 1) / (sum(blocked)::double + sum(allowed)::double + 2) as p from done),
    judged as (
        select host, template,
               (sum(blocked)::double + {tree.weight}::double * any_value(p)) / (sum(blocked)::double + sum(allowed)::double + {tree.weight}::double) as purity
        from done, prior group by host, template)
    select l.page_id, l.host, l.path, l.rule,
           coalesce(l.label, case when j.purity >= {tree.reject} then 'block' else 'allow' end) as verdict, d.template
    from labelled l join done d on l.host = d.host and l.path = d.path
    join judged j on d.host = j.host and d.template = j.template
    """


@query("op6_url_templates", url_sql())
def op6(spark, sf_dir):
    return urls.judge_urls(table(spark, sf_dir, "pages")).drop("purity")


def licence_sql(templates=licences.TEMPLATES, least=licences.LEAST) -> str:
    rows = ", ".join("('{}', '{}')".format(n, t.replace("'", "''")) for n, t in sorted(templates.items()))
    plain = "regexp_replace(translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9\\n]+', ' ', 'g')"
    words = "list_filter(string_split_regex({}, '[ \\n]+'), lambda w: w <> '')"
    return f"""
    with template as (select * from (values {rows}) as t(name, body)),
    template_words as (select name, {words.format(plain.format('body'))} as w from template),
    template_pairs as (select distinct name, w[i] || ' ' || w[i + 1] as pair from template_words, unnest(range(1, len(w))) as r(i)),
    plain as (select doc_id, {plain.format('text')} as t from documents),
    line as (
        select doc_id, l.n as line, {words.format('l.body')} as w
        from (select doc_id, unnest(list_transform(string_split(t, chr(10)), lambda x, i: {{'n': i, 'body': x}})) as l from plain)),
    opened as (
        select *, sum((len(w) > 0 and coalesce(lag_len, 0) = 0)::int) over (partition by doc_id order by line) as block
        from (select *, lag(len(w)) over (partition by doc_id order by line) as lag_len from line)),
    unit as (
        select doc_id, 'l' || line as unit, w from line where len(w) > 1
        union all
        select doc_id, 'b' || block, flatten(list(w order by line)) from opened where block > 0 and len(w) > 0 group by doc_id, block
        union all
        select doc_id, 'd', flatten(list(w order by line)) from line group by doc_id),
    pairs as (select distinct doc_id, unit, w[i] || ' ' || w[i + 1] as pair from unit, unnest(range(1, len(w))) as r(i)),
    sizes as (select doc_id, unit, count(*) as a from pairs group by all),
    template_sizes as (select name, count(*) as b from template_pairs group by all),
    common as (select doc_id, unit, name, count(*) as i from pairs join template_pairs using (pair) group by all),
    template_lists as (
        select name, any_value(len(w)) as m, list(distinct pair) as held from template_words join template_pairs using (name) group by name),
    starts as (
        select doc_id, w, i from unit, unnest(range(1, len(w))) as r(i) where unit = 'd'),
    stretches as (
        select doc_id, name, held,
               list_distinct(list_transform(range(i, least(i + m - 1, len(w))), lambda j: w[j] || ' ' || w[j + 1])) as own
        from starts join template_pairs on pair = w[i] || ' ' || w[i + 1] join template_lists using (name)),
    stretch_dice as (
        select doc_id, name, 2.0 * len(list_intersect(own, held))::double / (len(own) + len(held))::double as dice from stretches),
    matches as (
        select doc_id, name, 2.0 * i::double / (a + b)::double as dice
        from common join sizes using (doc_id, unit) join template_sizes using (name)
        where 2.0 * i::double / (a + b)::double >= {least}
        union all
        select doc_id, name, dice from stretch_dice where dice >= {least}),
    best as (
        select doc_id, first(name order by dice desc, name) as licence, max(dice) as dice, count(*) as n_matches
        from matches group by doc_id)
    select doc_id, licence, dice, coalesce(n_matches, 0) as n_matches from documents left join best using (doc_id)
    """


@query("op8_licence_scan", licence_sql())
def op8(spark, sf_dir):
    return licences.licence_scan(table(spark, sf_dir, "documents"))
