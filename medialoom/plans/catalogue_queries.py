"""Registered queries: catalogue and registry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medialoom.operators import catalogue as cat
from medialoom.operators import registry as reg
from medialoom.plans.bindings import Tables
from medialoom.plans.registered import query

DATE = "2026-04-08"


def catalogue(t: Tables) -> DataFrame:
    """The catalogue with arrays and the variant column that the card is read into."""
    return t.view("catalogue_rows").select(
        "id",
        F.split("tags", ",").alias("tags"),
        F.parse_json("base_model").alias("base_model"),
        "pipeline_tag",
        "downloads",
        "created_at",
        F.split("files", ",").alias("files"),
    )


# DuckDB twin of the same reading, with one column per check
CAT = """cat as (
  select id, downloads, pipeline_tag, created_at,
         string_split(tags, ',') as tags, list_transform(string_split(tags, ','), lambda x: lower(x)) as low,
         base_model, lower(coalesce(pipeline_tag, '')) as task,
         len(list_filter(string_split(files, ','), lambda x: ends_with(x, '.safetensors'))) > 0 as weights
  from catalogue_rows)"""
BASED = """based as (
  select *, coalesce(
      nullif(case when base_model like '[%' then json_extract_string(base_model, '$[{0}]')
                  else json_extract_string(base_model, '$') end, ''),
      nullif(substr(list_filter(low, lambda x: starts_with(x, 'base_model:'))[1], 12), ''),
      'None') as base
  from cat)"""
KINDS = """kinds as (
  select *, case when len(list_filter(low, lambda x: x in ('lora', 'peft', 'adapter'))) > 0 then 'LoRA'
                 when base <> 'None' then 'Fine-tune' else 'Base' end as type
  from based),
quotas as (
  select *, case type when 'Base' then 10000 when 'Fine-tune' then 5000 else 2000 end as target
  from kinds)"""


def cat_sql(position: int = 0) -> str:
    return "with " + ",\n".join([CAT, BASED.format(position), KINDS]) + "\n"


BAD = {
    "generate": "(task like '%audio%' or task like '%3d%')",
    "inpaint": "(task like '%audio%' or task like '%3d%' or task like '%video%')",
}
BAD["count"] = BAD["inpaint"]
FINAL = "select model_id from registry where status in ('COMPLETED', 'MODEL_FAULT')"

for mode in ("generate", "inpaint"):

    @query(
        f"eligible_models_{mode}",
        "catalogue_rows registry",
        cat_sql()
        + f"""select id, downloads from cat where downloads >= 30000 and weights
and not {BAD[mode]} and id not in ({FINAL})""",
    )
    def _(t, mode=mode):
        return cat.eligible_models(catalogue(t), t.view("registry"), mode).select("id", "downloads")

    @query(
        f"eligibility_faults_{mode}",
        "catalogue_rows registry",
        cat_sql()
        + f"""select id as model_id, 'MODEL_FAULT' as status, reason, '{DATE}' as date
from (select *, case {{}} end as reason from cat
      where downloads >= 30000 and id not in ({FINAL})) where reason is not null""".format(
            " ".join(
                [
                    "when not weights then 'No safetensors found'",
                    f"when {BAD[mode]} then 'Incompatible task: ' || pipeline_tag",
                ][:: -1 if mode == "inpaint" else 1]
            )
        ),
    )
    def _(t, mode=mode):
        return cat.eligibility_faults(catalogue(t), t.view("registry"), mode, DATE)

    @query(
        f"classify_models_{mode}",
        "catalogue_rows",
        cat_sql(1 if mode == "inpaint" else 0) + "select id, type, target, base from quotas",
    )
    def _(t, mode=mode):
        return cat.classify_models(catalogue(t), mode).select("id", "type", "target", "base")

    @query(
        f"task_fanout_{mode}",
        "catalogue_rows",
        cat_sql(1 if mode == "inpaint" else 0)
        + f"""select id, case when target >= 10000 then 10 when target >= 5000 then 5
else {3 if mode == 'inpaint' else 2} end as tasks from quotas""",
    )
    def _(t, mode=mode):
        models = cat.classify_models(catalogue(t), mode)
        return models.select("id", cat.task_fanout(F.col("target"), mode).alias("tasks"))


@query(
    "resolve_base_model",
    "catalogue_rows",
    cat_sql() + "select id, base from based",
)
def _(t):
    return catalogue(t).select("id", cat.resolve_base_model().alias("base"))


@query(
    "lora_without_base",
    "catalogue_rows",
    cat_sql()
    + f"""select id as model_id, 'MODEL_FAULT' as status, 'Missing base model dependency' as reason,
'{DATE}' as date from quotas where type = 'LoRA' and base = 'None'""",
)
def _(t):
    return cat.lora_without_base(cat.classify_models(catalogue(t)), DATE)


@query(
    "required_repos",
    "catalogue_rows registry",
    cat_sql()
    + f"""select distinct repo from (
  select unnest([id, case when type = 'LoRA' and base <> 'None' then base end]) as repo
  from quotas where id not in ({FINAL})) where repo is not null""",
)
def _(t):
    pending = cat.pending_models(catalogue(t), t.view("registry"))
    return cat.required_repos(cat.classify_models(pending))


@query(
    "pending_models",
    "catalogue_rows registry",
    f"select id from catalogue_rows where id not in ({FINAL})",
)
def _(t):
    return cat.pending_models(catalogue(t), t.view("registry")).select("id")


@query(
    "top_models",
    "catalogue_rows",
    cat_sql()
    + """select id, downloads from cat where list_contains(tags, 'diffusers')
order by downloads desc, id limit 1000""",
)
def _(t):
    return cat.top_models(catalogue(t)).select("id", "downloads")


@query(
    "eligible_model_count",
    "catalogue_rows",
    cat_sql()
    + f"select count(*) as models from cat where downloads >= 30000 and weights and not {BAD['count']}",
)
def _(t):
    return cat.eligible_model_count(catalogue(t))


@query(
    "models_above_floor",
    "catalogue_rows",
    "select id, downloads from catalogue_rows where downloads >= 30000",
)
def _(t):
    return cat.models_above_floor(catalogue(t))


@query(
    "release_date",
    "catalogue_rows",
    "select id, coalesce(strftime(created_at, '%Y-%m-%d'), 'unknown') as release_date from catalogue_rows",
)
def _(t):
    return catalogue(t).select("id", cat.release_date(F.col("created_at")).alias("release_date"))


@query(
    "resource_tier",
    "catalogue_rows registry",
    """select c.id, case when r.status = 'INFRASTRUCTURE_FAULT' and contains(r.reason, 'Memory')
then 'large' else 'default' end as tier
from catalogue_rows c left join registry r on c.id = r.model_id""",
)
def _(t):
    return reg.resource_tier(catalogue(t), t.view("registry")).select("id", "tier")


JUDGED = """judged as (
  select *, case exit_code when 0 then 'COMPLETED' when 14 then 'HALT' when 11 then 'MODEL_FAULT'
              else 'INFRASTRUCTURE_FAULT' end as status,
         case when exit_code = 0 then null else
           case when exit_code = 14 then 'Critical Code Bug'
                when exit_code = 11 then 'Incompatible Architecture'
                when exit_code in (12, 137, 9) then 'Node/GPU Out of Memory'
                when exit_code = 10 then 'Data/Path Typo'
                else 'Generic Slurm/Job Failure' end || ' (Exit ' || exit_code || ')' end as reason
  from attempts)"""
BEFORE = """kept as (
  select * from (select *, coalesce(bool_or(exit_code = 14) over (
      partition by run order by ts, seq rows between unbounded preceding and current row), false) as halted
    from judged) where not halted)"""
CHANGES = """changes as (
  select model_id, status, reason, strftime(ts, '%Y-%m-%d') as date, seq as ord from kept)"""


@query(
    "exit_to_status",
    "attempts",
    f"with {JUDGED} select seq, model_id, status, reason from judged",
)
def _(t):
    return reg.exit_to_status(t.view("attempts")).select("seq", "model_id", "status", "reason")


for variant, extra in (("image", ""), ("video", " or m like '%black image%'")):

    @query(
        f"triage_errors_{variant}",
        "attempts",
        f"""select seq, case when m like '%cuda out of memory%' then 12
  when error_class in ('FileNotFoundError', 'OSError') or m like '%no such file or directory%' then
    case when regexp_matches(m, 'model_index\\.json|config\\.json|scheduler|huggingface|safetensors')
         then 11 else 10 end
  when regexp_matches(m, 'weight|pipeline|expected str|time embedding|incorrect config|dimension')
    {extra} then 11
  else 14 end as triaged_exit
from (select *, lower(message) as m from attempts)""",
    )
    def _(t, variant=variant):
        return reg.triage_errors(t.view("attempts"), variant).select("seq", "triaged_exit")


@query(
    "before_halt",
    "attempts",
    f"with {JUDGED}, {BEFORE} select run, seq, model_id, exit_code from kept",
)
def _(t):
    return reg.before_halt(t.view("attempts")).select("run", "seq", "model_id", "exit_code")


UPSERTED = """upserted as (
  select model_id, status, reason, date from (
    select *, row_number() over (partition by model_id order by date desc, rank desc, ord desc) as rn
    from (select model_id, status, reason, date, ord, 0 as rank from registry
          union all select model_id, status, reason, date, ord, 1 from changes))
  where rn = 1)"""


def current_registry(t: Tables) -> DataFrame:
    return reg.upsert_registry(t.view("registry"), reg.registry_changes(t.view("attempts")))


@query(
    "upsert_registry",
    "registry attempts",
    f"with {JUDGED}, {BEFORE}, {CHANGES}, {UPSERTED} select * from upserted",
)
def _(t):
    return current_registry(t).drop("ord")


@query(
    "evictable_models",
    "registry attempts",
    f"""with {JUDGED}, {BEFORE}, {CHANGES}, {UPSERTED}
select model_id, 'models--' || replace(model_id, '/', '--') as cache_folder
from upserted where status <> 'INFRASTRUCTURE_FAULT'""",
)
def _(t):
    return reg.evictable_models(current_registry(t))


@query(
    "completed_models",
    "registry attempts",
    f"""with {JUDGED}, {BEFORE}, {CHANGES}, {UPSERTED}
select model_id from upserted where status = 'COMPLETED'""",
)
def _(t):
    return reg.completed_models(current_registry(t))
