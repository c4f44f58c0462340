"""Query over conversations."""

from __future__ import annotations

from gaugeworks.llm import chat
from gaugeworks.llm.registry import query, table

HARD = r"\### Assistant: </turn> ok"

# what a reversible format must give back: the input's own turns
SQL = r"""
    with turns as (
        select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
        union all values (-7::bigint, 0::bigint, 'user', '\### Assistant: </turn> ok'),
                         (-7::bigint, 1::bigint, 'assistant', '\### Assistant: </turn> ok')),
    sized as (
        select *, length('<turn >' || chr(10) || chr(10) || '</turn>' || chr(10))
                  + length(regexp_replace(role, '([\\<>#])', 'xx', 'g')) + length(regexp_replace(text, '([\\<>#])', 'xx', 'g')) as chars
        from turns),
    joined as (
        select conv_id, count(*) as n_turns,
               string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text) as body,
               coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '') as learned,
               sum(chars)::bigint as formatted_chars
        from sized group by conv_id)
    select conv_id, n_turns, sha256(body) as turns_sha256, length(learned) as loss_chars,
           sha256(learned) as loss_sha256, formatted_chars
    from joined
"""


@query("op2_chat_prefix_tree", SQL)
def op2(spark, sf_dir):
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame([(-7, 0, "user", HARD), (-7, 1, "assistant", HARD)], "conv_id bigint, turn bigint, role string, text string")
    return chat.read_back(chat.format_conversations(given.unionByName(added)))
