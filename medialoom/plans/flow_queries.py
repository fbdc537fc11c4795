"""Registered queries: whole rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medialoom.plans import flows
from medialoom.plans.bindings import Tables
from medialoom.plans.catalogue_queries import BAD, FINAL, cat_sql, catalogue
from medialoom.plans.packaging_queries import scores
from medialoom.plans.registered import query
from medialoom.plans.sampling_queries import MODELS, NUMBERED, SAMPLE, VIEWS, permutation

DATE = "2026-04-08"
SHORT_VIEWS = VIEWS.replace("segmentations", "part_rows")

GENERATE = (
    cat_sql().rstrip()
    + f""",
top as (select * from quotas order by downloads desc, id limit 1000),
models as (
  select id, type, target, coalesce(strftime(created_at, '%Y-%m-%d'), 'unknown') as release_date,
    case when target >= 10000 then 10 when target >= 5000 then 5 else 2 end as tasks
  from top where downloads >= 30000 and weights and not {BAD['generate']} and id not in ({FINAL})
    and (type <> 'LoRA' or base <> 'None')),
slots as (
  select id as prompt_id, row_number() over (order by md5('42|' || id), id) - 1 as slot, count(*) over () as n
  from prompt_pool),
ranks as (
  select *, rank // n as round, id || '|' || (rank // n) as key, rank % n as place
  from (select id, type, release_date, target, tasks, unnest(range(target)) as rank from models),
       (select max(n) as n from slots)),
{permutation("select key, place, n from ranks")},
work as (
  select r.*, s.prompt_id, least(rank // (target // tasks), tasks - 1) as task,
    'hf_' || replace(r.id, '/', '_') || '_{DATE}_' || rank || '.png' as filename
  from ranks r join landed l using (key, place) join slots s on s.slot = l.slot)"""
)


@query(
    "generate_round",
    "catalogue_rows registry prompt_pool",
    GENERATE
    + """
select id, type, release_date, task, round, count(*) as rows, count(distinct prompt_id) as prompts,
  sum(('0x' || substr(md5(filename || '|' || prompt_id), 1, 8))::bigint)::bigint as digest
from work group by all""",
)
def _(t):
    pool = t.view("prompt_pool").withColumnRenamed("id", "prompt_id")
    work = flows.generate_round(catalogue(t), t.view("registry"), pool, ["prompt_id"], DATE)
    text = F.concat_ws("|", "filename", "prompt_id")
    digest = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return work.manifest.groupBy("id", "type", "release_date", "task", "round").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("prompt_id").alias("prompts"),
        F.sum(digest).alias("digest"),
    )


def round_sql(rows: str) -> str:
    """Terms of a repainting round over the prompts of a view: ``ready`` models and how many rows each
    has at most; quotas that these rows can't fill take no part and are reported."""
    terms = ",\n".join([MODELS, NUMBERED.replace("from segmentations s", f"from {rows} s")])
    return (
        cat_sql(1).rstrip()
        + f""",
{terms},
ready as (
  select m.id, m.type, m.target, n as valid,
    case when m.target >= 10000 then 10 when m.target >= 5000 then 5 else 3 end as tasks
  from models m join quotas q using (id), (select count(*) as n from valid_rows)
  where q.type <> 'LoRA' or q.base <> 'None')"""
    )


def manifest_sql(rows: str) -> str:
    return (
        round_sql(rows)
        + f""",
{SAMPLE}
select s.id, r.type, least(s.rank // (r.target // r.tasks), r.tasks - 1) as task, count(*) as rows,
  min(MaskPath) as first_mask
from sample s join ready r on s.id = r.id where r.target <= r.valid group by all"""
    )


def changes_sql(rows: str) -> str:
    return (
        round_sql(rows)
        + f""",
looked_at as (select * from top where downloads >= 30000 and id not in ({FINAL}))
select id as model_id, 'MODEL_FAULT' as status,
  case when {BAD['inpaint']} then 'Incompatible task: ' || pipeline_tag
    when not weights then 'No safetensors found' else 'Missing base model dependency' end as reason,
  '{DATE}' as date
from looked_at where {BAD['inpaint']} or not weights or (type = 'LoRA' and base = 'None')
union all
select id, 'INFRASTRUCTURE_FAULT', 'Only ' || valid || ' masks available, need ' || target, '{DATE}'
from ready where valid < target"""
    )


def repainting(t: Tables, rows: str) -> flows.Round:
    return flows.inpaint_round(
        catalogue(t), t.view("registry"), t.view(rows), t.view("mask_files"), ["ord"], DATE
    )


def manifest_summary(work: flows.Round) -> DataFrame:
    return work.manifest.groupBy("id", "type", "task").agg(
        F.count(F.lit(1)).alias("rows"), F.min("MaskPath").alias("first_mask")
    )


@query("inpaint_round", VIEWS, manifest_sql("segmentations"))
def _(t):
    return manifest_summary(repainting(t, "segmentations"))


@query("inpaint_round_short", SHORT_VIEWS, manifest_sql("part_rows"))
def _(t):
    # at sf0.01 the largest quotas run short, the others are filled
    return manifest_summary(repainting(t, "part_rows"))


@query("round_registry_changes", VIEWS, changes_sql("segmentations"))
def _(t):
    return repainting(t, "segmentations").registry_changes


@query("round_registry_changes_short", SHORT_VIEWS, changes_sql("part_rows"))
def _(t):
    return repainting(t, "part_rows").registry_changes


@query(
    "posts_to_package",
    "image_rows scores files",
    """select filename, label, (row_number() over (order by md5('42|' || filename), filename) - 1) // 500 as shard
from (select filename, coalesce(label, '') as label from image_rows
      where filename not in (select filename from scores where nsfw >= cast(0.7 as double))
        and filename in (select path from files))""",
)
def _(t):
    planned = flows.posts_to_package(t.view("image_rows"), scores(t), t.view("files"))
    return planned.select("filename", "label", "shard")
