"""Conversations read as tool calls and results, and the SQL of the linked messages.

The table holds prose, so calls are derived from it: every assistant turn calls
one of three tools with its text as a query, some with broken or ill-typed
arguments, some after the call two turns before or after it; the turn that
follows answers it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMAS = {
    "search": {"query": ("string", True), "limit": ("integer", False), "deep": ("object", False)},
    "count": {"query": ("string", True), "limit": ("number", True), "deep": ("object", True)},
    "note": {"query": ("string", True), "limit": ("integer", False)},
}

NAME = "case n % 3 when 0 then 'search' when 1 then 'count' else 'note' end"
ARGUMENTS = """
  case n % 5
    when 0 then concat('{"query": ', words)
    when 1 then concat('{"query": "', words, '", "limit": "', n, '"}')
    when 2 then concat('{ "limit": ', n, ' }')
    else concat('{ "query" : "', words, '", "limit":', n, ', "deep": {"b": [1, true, null], "a": "', n, '"} }')
  end"""


def calls(conversations: DataFrame) -> DataFrame:
    words = F.regexp_replace("text", "[^A-Za-z]+", " ")
    rows = conversations.where("role = 'assistant'").withColumns({"n": F.char_length("text"), "words": words})
    after = F.array_compact(
        F.array(
            F.when((F.col("n") % 11 < 4) & (F.col("turn") >= 2), F.concat(F.lit("c"), F.col("turn") - 2)),
            F.when(F.col("n") % 13 == 0, F.concat(F.lit("c"), F.col("turn") + 2)),
        )
    )
    return rows.select(
        "conv_id", "turn", F.concat(F.lit("c"), F.col("turn")).alias("call_id"), F.expr(NAME).alias("name"),
        F.expr(ARGUMENTS).alias("arguments"), after.alias("after"),
    )


def results(conversations: DataFrame) -> DataFrame:
    rows = conversations.where("role = 'user' and turn > 0")
    return rows.select("conv_id", "turn", F.concat(F.lit("c"), F.col("turn") - 1).alias("call_id"), F.col("text").alias("content"))


#: Edges join calls two turns apart, so every cycle has two calls that name each other.
LINKED_SQL = """
with recursive said as (
  select conv_id, turn, text, length(text) as n, regexp_replace(text, '[^A-Za-z]+', ' ', 'g') as words
  from conversations where role = 'assistant'),
nodes as (
  select conv_id, turn, n, words, count(*) over (partition by conv_id, turn) as n_calls
  from said qualify row_number() over (partition by conv_id, turn order by text) = 1),
answers as (
  select conv_id, turn - 1 as turn, min(text) as content, count(*) as n_results
  from conversations where role = 'user' and turn > 0 group by 1, 2),
named as (
  select conv_id, turn, turn - 2 as parent from nodes where n % 11 < 4 and turn >= 2
  union all select conv_id, turn, turn + 2 from nodes where n % 13 = 0),
edges as (select e.* from named e semi join nodes p on e.conv_id = p.conv_id and e.parent = p.turn),
unknown as (
  select distinct conv_id, turn from named e anti join nodes p on e.conv_id = p.conv_id and e.parent = p.turn),
stuck as (
  select a.conv_id, a.turn from edges a join edges b on a.conv_id = b.conv_id and a.turn = b.parent and a.parent = b.turn
  union select e.conv_id, e.turn from edges e join stuck s on e.conv_id = s.conv_id and e.parent = s.turn),
open_nodes as (select conv_id, turn from nodes anti join stuck using (conv_id, turn)),
reached as (
  select conv_id, turn, 0 as level from open_nodes anti join edges using (conv_id, turn)
  union select e.conv_id, e.turn, r.level + 1 from reached r join edges e on e.conv_id = r.conv_id and e.parent = r.turn
        semi join open_nodes o on e.conv_id = o.conv_id and e.turn = o.turn),
leveled as (select conv_id, turn, max(level) as level from reached group by 1, 2),
tools as (
  select nodes.*, case n % 3 when 0 then 'search' when 1 then 'count' else 'note' end as name from nodes),
checked as (
  select *,
    case n % 5
      when 0 then null
      when 1 then '{"limit":"' || n || '","query":"' || words || '"}'
      when 2 then '{"limit":' || n || '}'
      else '{"deep":{"a":"' || n || '","b":[1,true,null]},"limit":' || n || ',"query":"' || words || '"}'
    end as canonical,
    case when n % 5 = 0 then ['no_object']
         when n % 5 = 1 then case when name = 'count' then ['missing:deep', 'type:limit'] else ['type:limit'] end
         when n % 5 = 2 then case when name = 'count' then ['missing:deep', 'missing:query'] else ['missing:query'] end
         when name = 'note' then ['unknown:deep'] else [] end as faults
  from tools)
select c.conv_id, 'c' || c.turn as call_id, c.turn, c.name, l.level,
       case when a.n_results is not null then c.turn + 1 end as result_turn, coalesce(a.n_results, 0) as n_results,
       array_to_string(c.faults || list_filter([
         case when c.n_calls > 1 then 'repeated_id' end, case when u.turn is not null then 'unknown_after' end,
         case when l.level is null then 'cycle' end], lambda f: f is not null), ',') as faults,
       '{"arguments":' || coalesce(canonical, 'null') || ',"call_id":"c' || c.turn || '","name":"' || c.name || '","result":'
         || coalesce(cast(to_json(a.content) as varchar), 'null') || '}' as message
from checked c
left join answers a on a.conv_id = c.conv_id and a.turn = c.turn
left join leveled l on l.conv_id = c.conv_id and l.turn = c.turn
left join unknown u on u.conv_id = c.conv_id and u.turn = c.turn
"""
