"""Registered queries of the operators, each over its whole table, with SQL where it can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medialoom.llm import (
    alignment,
    byte_bpe,
    language,
    lines,
    mixing,
    periods,
    quality,
    sharding,
    simhash,
    suffixes,
    token_counts,
    urls,
    vectors,
)
from medialoom.llm.common import read, replace_columns

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


@query("op1_quality_rules")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality.judge(
        read(spark, folder, "documents").select("doc_id", "text"), read(spark, folder, "labels")
    )
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


@query("op2_token_counts")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    counted = token_counts.count_tokens(docs, public_tokenizers.path("word_bpe_49k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


@query("op3_language_id")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = language.held_out_fold()
    net = language.learn(language.learning_rows(docs, held_out))
    named = language.identify(docs.select("doc_id", "text"), net)
    return replace_columns(named, {"held_out": held_out}).select(
        "doc_id", "held_out", "lang_pred", "score"
    )


OP4_SQL = """
with recursive shards as (
  select i, 'shard-' || lpad(cast(i as varchar), 2, '0') as shard from range(16) r(i)),
prefs as (
  select list(o order by i) as o, list(s order by i) as s from (
    select i, cast('0x' || substr(md5(shard || '/offset'), 1, 8) as bigint) % 2053 as o,
           cast('0x' || substr(md5(shard || '/stride'), 1, 8) as bigint) % 2052 + 1 as s from shards)),
filled(turn, holder) as (
  select 0, list_transform(range(2053), lambda x: -1)
  union all
  select turn + 1, holder[1:slot] || [turn % 16] || holder[slot + 2:]
  from (select turn, holder,
          list_filter(list_transform(range(2053), lambda k: (o[turn % 16 + 1] + k * s[turn % 16 + 1]) % 2053),
                      lambda p: holder[p + 1] = -1)[1] as slot
        from filled, prefs where turn < 2053)),
final as (select holder from filled where turn = 2053)
select doc_id, cast(slot as integer) as slot, shard from (
  select doc_id, cast('0x' || substr(md5(coalesce(cast(doc_id as varchar), 'null')), 1, 8) as bigint) % 2053 as slot
  from documents) d, final, shards where shards.i = holder[slot + 1]
"""


@query("op4_sharding", OP4_SQL)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.place(read(spark, folder, "documents").select("doc_id"))
    return placed.select("doc_id", "slot", "shard")


@query("op5_mixing")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.taken_words(read(spark, folder, "documents").select("doc_id", "text", "source"))


OP6_SQL = """
with recursive usable as (
  select vec_id, cast(embedding as double[]) as e from embeddings
  where embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as (
  select a.vec_id as a, b.vec_id as b from usable a join usable b
  on a.vec_id <> b.vec_id and len(a.e) = len(b.e) and list_cosine_similarity(a.e, b.e) >= 0.9),
reach(a, b) as (select vec_id, vec_id from embeddings
  union select reach.a, links.b from reach join links on reach.b = links.a),
named as (select a as vec_id, min(b) as component_id from reach group by a),
numbers as (select a, count(*) as n from links group by a)
select vec_id, coalesce(n, 0) as n_links, component_id, vec_id = component_id as kept
from named left join numbers on numbers.a = vec_id
"""


@query("op6_embedding_near_dedup", OP6_SQL)
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.near_duplicates(read(spark, folder, "embeddings").select("vec_id", "embedding"))


OP7_SQL = r"""
with split as (
  select page_id,
    translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') as path
  from pages),
ruled as (
  select *, case
    when (host = 'example.com' or suffix(host, '.example.com')) and prefix(path, '/de/') then 'example.com/de/'
    when (host = 'example.net' or suffix(host, '.example.net')) and prefix(path, '/en/') then 'example.net/en/'
    when (host = 'org' or suffix(host, '.org')) and prefix(path, '/fr/') then 'org/fr/'
    when (host = 'net' or suffix(host, '.net')) and prefix(path, '/') then 'net/' end as rule
  from split)
select page_id, host, path, rule, case
  when rule in ('example.com/de/', 'net/') then 'block'
  when rule is not null then 'allow'
  when regexp_full_match(host || path, 'ads\.[^/]*/.*|[^/]*\.ads\.[^/]*/.*|[^/]*doubleclick\.[^/]*/.*|.*/wp-admin/.*|.*/wp-login\.php|.*/login|.*/signin/.*|.*/cart/.*|.*/checkout/.*|.*\.exe|.*\.zip|.*\.mp[^/]', 's')
    then 'block' else 'allow' end as verdict
from ruled
"""


@query("op7_url_filters", OP7_SQL)
def op7(spark: SparkSession, folder: str) -> DataFrame:
    judged = urls.judge(read(spark, folder, "pages").select("page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


OP8_SQL = r"""
with texts as (select distinct doc_id, text from documents where text is not null),
lines as (
  select doc_id, text, unnest(string_split(text, chr(10))) as l,
         generate_subscripts(string_split(text, chr(10)), 1) as i from texts),
spoken as (
  select *, row_number() over (partition by doc_id, text order by i) as k
  from lines where regexp_matches(l, '[^\x20\x09-\x0D]')),
wins as (
  select doc_id, text, k, [l, lead(l, 1) over p, lead(l, 2) over p] as win,
         lead(l, 2) over p as third
  from spoken window p as (partition by doc_id, text order by k)),
ranked as (
  select *, row_number() over (partition by win order by doc_id nulls last, text, k) as occurrence
  from wins where third is not null),
covered as (
  select distinct doc_id, text, k + d as k from ranked, range(3) r(d) where occurrence > 1),
gone as (
  select spoken.doc_id, spoken.text, i from spoken join covered
  on spoken.doc_id is not distinct from covered.doc_id and spoken.text = covered.text and spoken.k = covered.k),
cleaned as (
  select lines.doc_id, lines.text, count(*) as n_lines, count(gone.i) as n_removed,
         coalesce(string_agg(l, chr(10) order by lines.i) filter (where gone.i is null), '') as rest
  from lines left join gone
  on lines.doc_id is not distinct from gone.doc_id and lines.text = gone.text and lines.i = gone.i
  group by lines.doc_id, lines.text)
select d.doc_id, coalesce(n_lines, 0) as n_lines, coalesce(n_removed, 0) as n_removed, c.rest as text
from documents d left join cleaned c on d.doc_id is not distinct from c.doc_id and d.text = c.text
"""


@query("op8_line_dedup", OP8_SQL)
def op8(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = lines.without_repeats(read(spark, folder, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", "n_lines", "n_removed", "text")


@query("op9_byte_bpe")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    found = byte_bpe.digests(docs, ranks, public_tokenizers.PATTERN)
    return found.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query("op10_simhash_near_dedup")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.component_ids(read(spark, folder, "documents").select("doc_id", "text"))


@query("op11_alignment")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    return alignment.align(docs, *paths).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest.alias("groups_sha256")
    )


@query("op12_periodic_runs")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    docs = periods.with_planted_runs(read(spark, folder, "documents").select("doc_id", "text"))
    found = periods.periodic_runs(docs).withColumn("best", periods.longest(F.col("runs")))
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.array_join(F.transform(line, lambda x: F.concat(x, F.lit("\n"))), "")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query("op13_suffix_dedup")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    found = suffixes.repeats(read(spark, folder, "documents").select("doc_id", "text"), digest=True)
    digest = F.coalesce("kept", F.lower(F.hex("sha")))
    return found.select(
        "doc_id", "n_bytes", suffixes.removed_bytes(F.col("spans")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), digest.alias("kept_sha256"),
    )
