"""The operators applied to their whole tables, and their SQL where SQL can say it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanshift.llm import (
    bilinear,
    chat_queries,
    class_cuts,
    covering,
    decision_list,
    doubling,
    grouping,
    importance,
    mixing,
    shortest_first,
    splitters,
    syncmers,
    tool_calls,
    wavelet,
)
from loanshift.session import shared_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(
    """
    with cut as (
      select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') as words
      from documents),
    windows as (
      select doc_id, pos, md5(array_to_string(words[pos:pos + 12], ' ')) as w
      from (select doc_id, words, unnest(range(1, len(words) - 11)) as pos from cut)),
    firsts as (select w, min(doc_id) as first from windows group by w),
    gone as (
      select distinct doc_id, pos + unnest(range(0, 13)) as pos
      from windows join firsts using (w) where doc_id > first),
    lost as (select doc_id, list(pos) as ats from gone group by doc_id)
    select c.doc_id, cast(len(words) as bigint) as n_words, cast(coalesce(len(ats), 0) as bigint) as n_removed,
           sha256(coalesce(array_to_string(list_filter(words, lambda w, i: not list_contains(coalesce(ats, []), i)), ' '), ''))
             as kept_sha256
    from cut c left join lost l on c.doc_id = l.doc_id
    """
)
def op4_level_doubling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doubling.digests(table(spark, sf_dir, "documents"), window=13)


@query(chat_queries.LINKED_SQL)
def op1_tool_call_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    found = tool_calls.linked(chat_queries.calls(conversations), chat_queries.results(conversations), chat_queries.SCHEMAS)
    return found.withColumn("faults", F.array_join("faults", ","))


def tokenizer() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


@query()
def op5_wavelet_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/shards-{uuid.uuid4().hex}"
    wavelet.write_shards(table(spark, sf_dir, "documents"), path, tokenizer(), end_id=1)
    return wavelet.read_documents(spark, path)


@query()
def op7_linear_grouping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouping.pack_documents(table(spark, sf_dir, "documents"), tokenizer(), end_id=1, capacity=4096)


@query()
def op8_covering_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = covering.near_groups(table(spark, sf_dir, "documents"), shingle=3, radius=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query()
def op9_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decision_list.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op10_hypergeometric_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.decisions(table(spark, sf_dir, "documents"))


@query()
def op6_log_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bilinear.score(table(spark, sf_dir, "documents"))


@query()
def op2_closed_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.edited(table(spark, sf_dir, "documents"))


@query()
def op3_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = splitters.shard_documents(table(spark, sf_dir, "documents"), shards=8)
    none = F.lit(None).cast("int").alias("grown_shard")
    return found.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", none)


@query(
    """
    with crc_table as (
      select list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)
                  order by i) as t
      from (select unnest(range(0, 256)) as i)),
    sets as (
      select 'd' as side, doc_id, coalesce(text, '') as text from documents
      union all select 'b', null, coalesce(text, '') from benchmark),
    cut as (
      select side, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
      from sets),
    found as (select side, doc_id, unnest(words) as w from cut),
    coded as (
      select w, xor(list_reduce(
               list_prepend(4294967295, [('0x' || substr(hex(w), 2 * i + 1, 2))::bigint for i in range(0, strlen(w))]),
               lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 10000 as bucket
      from (select distinct w from found) cross join crc_table),
    counts as (
      select bucket, count(*) filter (side = 'd') as s, count(*) filter (side = 'b') as t from found join coded using (w) group by 1),
    sums as (select cast(sum(s) as double) as all_s, cast(sum(t) as double) as all_t from counts),
    gains as (
      select bucket, cast(floor(1000e0 * ln((t + 1e0) * (all_s + 1e4) / ((s + 1e0) * (all_t + 1e4)))) as bigint) as gain
      from counts cross join sums),
    weights as (
      select doc_id, cast(sum(gain) as bigint) as weight from found join coded using (w) join gains using (bucket)
      where side = 'd' group by 1),
    scored as (
      select c.doc_id, len(words) as n_features, coalesce(weight, 0) as weight,
             coalesce(weight, 0) + cast(floor(-1000e0 * ln(-ln((h + 0.5e0) / 4294967296e0))) as bigint) as score
      from (select *, ('0x' || substr(sha256('2024:' || doc_id), 1, 8))::bigint as h from cut where side = 'd') c
      left join weights w on c.doc_id = w.doc_id),
    drawn as (
      select doc_id, row_number() over (order by score desc, doc_id) as rank from scored where n_features >= 20)
    select s.doc_id, n_features, weight, score,
           case when rank <= (10 * (select count(*) from drawn)) // 100 then rank end as rank
    from scored s left join drawn d on s.doc_id = d.doc_id
    """
)
def op11_tokenizers_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def byte_tokenizer() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


@query()
def op12_shortest_pack_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shortest_first.pack_documents(table(spark, sf_dir, "documents"), byte_tokenizer(), end_id=1, capacity=2048).drop("ids")


@query(
    """
    with hashed as (select doc_id, coalesce(text, '') as t, length(coalesce(text, '')) as n, sha256('1:' || doc_id) as x from documents),
    drawn as (
      select *, ('0x' || substr(x, 1, 8))::bigint % (n + 1) as a, ('0x' || substr(x, 9, 8))::bigint % (n + 1) as b,
             ('0x' || substr(x, 17, 8))::bigint as h3, ('0x' || substr(x, 25, 8))::bigint as h4 from hashed),
    formed as (
      select *, least(a, b) as p, greatest(a, b) - least(a, b) as m,
             case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 90 then 'plain'
                  when h4 % 100 < 20 then 'spm' else 'psm' end as form from drawn)
    select doc_id, n, form, case when form <> 'plain' then p end as prefix_chars, case when form <> 'plain' then m end as middle_chars,
           sha256(case form when 'plain' then t
                  when 'psm' then '<P>' || substr(t, 1, p) || '<S>' || substr(t, p + m + 1) || '<M>' || substr(t, p + 1, m)
                  else '<S>' || substr(t, p + m + 1) || '<P>' || substr(t, 1, p) || '<M>' || substr(t, p + 1, m) end) as output_sha256,
           sha256(t) as restored_sha256
    from formed
    """
)
def op13_wavelet_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = class_cuts.transform(table(spark, sf_dir, "documents"), unit="chars")
    return found.select(
        "doc_id", "n", "form", F.col("prefix_units").alias("prefix_chars"), F.col("middle_units").alias("middle_chars"),
        F.sha2("output", 256).alias("output_sha256"), F.sha2(class_cuts.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )
