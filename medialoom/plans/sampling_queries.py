"""Registered queries: samples, numbering, shards of work."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medialoom.functions import fixed_values as fv
from medialoom.operators import catalogue as cat
from medialoom.operators import context as ctx
from medialoom.operators import naming
from medialoom.operators import numbering as num
from medialoom.operators import sampling as smp
from medialoom.plans.bindings import LINE_KEY, Tables
from medialoom.plans.catalogue_queries import BAD, FINAL, cat_sql, catalogue
from medialoom.plans.context_queries import LOOKUP
from medialoom.plans.registered import query

DATE = "2026-04-08"

NUMBERED = """flagged as (
  select s.*, f.path is not null as valid
  from segmentations s left join (select distinct path from mask_files) f on s.MaskPath = f.path),
numbered as (
  select *, row_number() over (order by md5('42|' || ord), ord) - 1 as pos from flagged),
valid_rows as (
  select *, row_number() over (order by pos) - 1 as slot, count(*) over () as n from numbered where valid),
slots as (
  select *, (pos - slot) - coalesce(lag(pos - slot) over (order by slot), 0) as missing_before
  from valid_rows)"""
MODELS = f"""top as (
  select * from quotas order by downloads desc, id limit 1000),
models as (
  select id, type, target, created_at
  from top where downloads >= 30000 and weights and not {BAD['inpaint']} and id not in ({FINAL}))"""


def permutation(draws: str) -> str:
    """The term ``walk`` (key, place, slot): each place of ``draws`` (key, place, n) is moved over a
    grid by hashes of its row and column until it falls on a number below n."""
    state = "select * exclude (slot), slot // b as r, slot % b as c from walk where step = 0 or slot >= n"
    for turn in range(smp.ROUNDS):
        by, to, size = ("c", "r", "a") if turn % 2 == 0 else ("r", "c", "b")
        seed = f"(({by} + k[{2 * turn + 1}]) % {smp.PRIME})"
        number = f"({seed} * {seed} % {smp.PRIME} * (k[{2 * turn + 2}] + 1) % {smp.PRIME})"
        state = f"select * replace (({to} + {number}) % {size} as {to}) from ({state})"
    return f"""draws as ({draws}),
grid as (
  select *, (n + a - 1) // a as b,
    list_transform(range({2 * smp.ROUNDS}), lambda i: ('0x' || substr(md5(key || '|' || i), 1, 7))::bigint) as k
  from (select *, ceil(sqrt(n::double))::bigint as a from draws)),
walk(key, place, n, a, b, k, slot, step) as (
  select key, place, n, a, b, k, place, 0 from grid
  union all select key, place, n, a, b, k, r * b + c, step + 1 from ({state})),
landed as (select key, place, slot from walk where step > 0 and slot < n)"""


DRAWS = """select id as key, unnest(range(least(target, n))) as place, n
  from models, (select max(n) as n from slots)"""
SAMPLE = f"""{permutation(DRAWS)},
sample as (
  select w.key as id, w.place as rank, s.* from landed w join slots s on s.slot = w.slot)"""
SAMPLED = cat_sql(1).rstrip() + ",\n" + ",\n".join([MODELS, NUMBERED, SAMPLE]) + "\n"
VIEWS = "catalogue_rows registry segmentations mask_files"


def models(t: Tables) -> DataFrame:
    top = cat.top_models(catalogue(t))
    kept = cat.eligible_models(top, t.view("registry"), "inpaint")
    return cat.classify_models(kept, "inpaint")


def sample(t: Tables, with_missing: bool = False) -> DataFrame:
    return smp.sample_per_model(
        models(t), t.view("segmentations"), t.view("mask_files"), ["ord"], with_missing=with_missing
    )


@query(
    "top_k_per_model",
    VIEWS,
    SAMPLED
    + """select id, count(*) as rows, count(distinct ord) as distinct_rows,
  sum(('0x' || substr(md5(id || '|' || rank || '|' || ord), 1, 8))::bigint)::bigint as digest
from sample group by id""",
)
def _(t):
    # the sampled rows of each model as counts and a digest over model, place and row
    text = F.concat_ws("|", "id", "rank", "ord")
    digest = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return sample(t).groupBy("id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("ord").alias("distinct_rows"),
        F.sum(digest).alias("digest"),
    )


@query(
    "model_prompt_matrix",
    VIEWS,
    SAMPLED
    + """select id, least(rank // (target // tasks), tasks - 1) as task, count(*) as rows,
  min(MaskPath) as first_mask, max(MaskPath) as last_mask
from (select s.*, m.target, case when m.target >= 10000 then 10 when m.target >= 5000 then 5 else 3 end as tasks
      from sample s join models m on s.id = m.id) group by 1, 2""",
)
def _(t):
    from medialoom.functions.columns import slice_task

    chosen = models(t).withColumn("tasks", cat.task_fanout(F.col("target"), "inpaint"))
    taken = sample(t).join(chosen.select("id", "target", "tasks"), "id")
    task = slice_task(F.col("rank"), F.col("target"), F.col("tasks"))
    return taken.groupBy("id", task.alias("task")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("MaskPath").alias("first_mask"),
        F.max("MaskPath").alias("last_mask"),
    )


MISSING_TOTAL = "(select count(*) from flagged where not valid)"


@query(
    "sampling_report",
    VIEWS,
    SAMPLED
    + f"""select m.id, m.target, coalesce(found, 0) as found,
  case when coalesce(found, 0) < m.target then {MISSING_TOTAL} else met end as missing_met
from models m left join (select id, count(*) as found, sum(missing_before)::bigint as met
                         from sample group by id) s on m.id = s.id""",
)
def _(t):
    missing = smp.missing_total(t.view("segmentations"), t.view("mask_files"), ["ord"])
    return smp.sampling_report(sample(t, True), models(t), missing)


@query(
    "quota_shortfall",
    VIEWS.replace("segmentations", "short_rows"),
    SAMPLED.replace("from segmentations s", "from short_rows s")
    + f"""select m.id as model_id, 'INFRASTRUCTURE_FAULT' as status,
  'Only ' || coalesce(found, 0) || ' masks available, need ' || m.target as reason, '{DATE}' as date
from models m left join (select id, count(*) as found from sample group by id) s on m.id = s.id
where coalesce(found, 0) < m.target""",
)
def _(t):
    # suppliers are few, so that quotas run short
    return smp.quota_shortfall(models(t), t.view("short_rows"), t.view("mask_files"), DATE)


@query(
    "inpaint_metadata_rows",
    VIEWS + " classes",
    SAMPLED.rstrip()
    + f""",
{LOOKUP},
rows_out as (
  select 'inpaint_' || replace(s.id, '/', '_') || '_{DATE}_' || s.rank || '.png' as filename,
    m.type, coalesce(strftime(m.created_at, '%Y-%m-%d'), 'unknown') as release_date,
    '{fv.SOURCE_IMAGE_BASE}/' || s.ImageID || '.jpg' as source_image_url,
    '{fv.MASK_BASE}' || lower(substr(s.MaskPath, 1, 1)) || '/' || s.MaskPath as mask_url,
    l.ClassName as class_name, s.id as model
  from sample s join models m on s.id = m.id left join lookup l on s.LabelName = l.LabelName)
select model, type, release_date, count(*) as rows, count(class_name) as named,
  sum(('0x' || substr(md5(filename || source_image_url || mask_url || coalesce(class_name, '')), 1, 8))::bigint)::bigint
    as digest
from rows_out group by model, type, release_date""",
)
def _(t):
    described = models(t).select("id", "type", cat.release_date(F.col("created_at")).alias("release_date"))
    named = ctx.with_class_names(
        sample(t).join(described, "id"), ctx.class_lookup(t.view("classes"))
    ).withColumn("generated_prompt", F.lit(None).cast("string"))
    rows = naming.inpaint_metadata_rows(named, DATE)
    text = F.concat("filename", "source_image_url", "mask_url", F.coalesce("class_name", F.lit("")))
    digest = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return rows.groupBy("model", "type", "release_date").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("class_name").alias("named"),
        F.sum(digest).alias("digest"),
    )


@query(
    "valid_masks",
    "segmentations mask_files",
    """select ImageID, MaskPath from segmentations where MaskPath in (select path from mask_files)""",
)
def _(t):
    return smp.valid_masks(t.view("segmentations"), t.view("mask_files")).select("ImageID", "MaskPath")


@query(
    "missing_masks",
    "segmentations mask_files",
    """select ImageID, MaskPath from segmentations where MaskPath not in (select path from mask_files)""",
)
def _(t):
    return smp.missing_masks(t.view("segmentations"), t.view("mask_files")).select("ImageID", "MaskPath")


@query(
    "uncached_images",
    "segmentations",
    """select distinct ImageID from segmentations
where ImageID not in (select cast(o_custkey * 2 as string) from orders)""",
)
def _(t):
    cached = t.sql("select cast(o_custkey * 2 as string) as image from {orders}")
    return smp.uncached_images(t.view("segmentations"), cached)


@query(
    "cache_counts",
    "segmentations",
    """select count(*) filter (c is null) as to_fetch, count(c) as cached
from (select distinct ImageID from segmentations)
left join (select distinct cast(o_custkey * 2 as string) as c from orders) on ImageID = c""",
)
def _(t):
    cached = t.sql("select cast(o_custkey * 2 as string) as image from {orders}")
    return smp.cache_counts(t.view("segmentations"), cached)


@query("needed_masks", "segmentations", "select distinct MaskPath from segmentations")
def _(t):
    return smp.needed_masks(t.view("segmentations"))


@query(
    "masks_by_archive",
    "segmentations",
    """select substr(MaskPath, 1, 1) as archive, count(distinct MaskPath) as masks
from segmentations group by 1""",
)
def _(t):
    return smp.masks_by_archive(smp.needed_masks(t.view("segmentations")))


LAYOUT_FILES = f"""
  select case substr({LINE_KEY}, 32, 1)
           when '0' then '' when '1' then substr({LINE_KEY}, 1, 1) || '/'
           when '2' then 'train-masks-' || substr({LINE_KEY}, 1, 1) || '/'
           else 'elsewhere/' end || substr({LINE_KEY}, 1, 12) || '.png' as path
  from {{lineitem}}
  union all
  select case substr({LINE_KEY}, 31, 1)
           when '0' then substr({LINE_KEY}, 1, 1) || '/'
           when '1' then 'train-masks-' || substr({LINE_KEY}, 1, 1) || '/'
           else 'elsewhere/' end || substr({LINE_KEY}, 1, 12) || '.png' as path
  from {{lineitem}}"""


@query(
    "resolve_mask_path",
    "segmentations",
    f"""with layout_files as ({LAYOUT_FILES.format(lineitem='lineitem')}),
needed as (select distinct MaskPath, substr(MaskPath, 1, 1) as k from segmentations),
places as (
  select MaskPath, 0 as place, MaskPath as path from needed
  union all select MaskPath, 1, k || '/' || MaskPath from needed
  union all select MaskPath, 2, 'train-masks-' || k || '/' || MaskPath from needed)
select n.MaskPath, b.path from needed n left join (
  select p.MaskPath, min_by(p.path, p.place) as path
  from places p where p.path in (select path from layout_files) group by p.MaskPath) b
on n.MaskPath = b.MaskPath""",
)
def _(t):
    return smp.resolve_mask_path(smp.needed_masks(t.view("segmentations")), t.sql(LAYOUT_FILES))


@query(
    "global_index",
    "segmentations",
    "select MaskPath, row_number() over (order by ord) - 1 as idx from segmentations",
)
def _(t):
    rows = t.view("segmentations").select("MaskPath", "ord")  # what is numbered is written: no more columns
    return num.ordered_index(rows, ["ord"]).select("MaskPath", "idx")


@query(
    "hash_index",
    "",
    """select event_id, row_number() over (order by md5('42|' || event_id), event_id) - 1 as idx
from events""",
)
def _(t):
    return num.hash_index(t.table("events").select("event_id"), ["event_id"])


@query(
    "hash_shuffle",
    "",
    """select event_id, event_type from events order by md5('42|' || event_id), event_id""",
)
def _(t):
    return smp.hash_shuffle(t.table("events").select("event_id", "event_type"), ["event_id"])


@query(
    "model_shuffle",
    "",
    """select event_id, row_number() over (order by md5('org1/m1|' || event_id), event_id) - 1 as idx
from events""",
)
def _(t):
    return smp.model_shuffle(t.table("events").select("event_id"), ["event_id"], "org1/m1")


@query(
    "cyclic_prompts",
    "prompt_pool",
    """with size as (select count(*) as size from prompt_pool),
wanted as (select count(*) as n from orders),
rounds as (select unnest(range((n - 1) // size + 1)) as round from wanted, size)
select position, round, id, chars from (
  select round * size + row_number() over (
      partition by round order by md5('42|' || round || '|' || id), id) - 1 as position,
    round, id, length(prompt) as chars
  from prompt_pool, rounds, size), wanted where position < n""",
)
def _(t):
    pool = t.view("prompt_pool").select("id", F.length("prompt").cast("bigint").alias("chars"))
    wanted = num.row_total(t.table("orders"))
    return smp.cyclic_prompts(pool, ["id"], wanted).select("position", "round", "id", "chars")


@query(
    "read_prompt_pool",
    "prompt_pool",
    "select prompt from prompt_pool where prompt is not null",
)
def _(t):
    return t.view("prompt_pool").select("prompt").na.drop()


@query(
    "sample_label",
    "image_rows",
    """select filename, label from image_rows where label = 'real'
order by md5('42|' || filename), filename limit 100""",
)
def _(t):
    return smp.sample_label(t.view("image_rows"), "real", 100, ["filename"]).select("filename", "label")


@query(
    "pick_rows",
    "segmentations",
    """with picks as (
  select pick, ('0x' || substr(md5('42|' || pick), 1, 15))::bigint % n as idx
  from (select unnest(range(1, 8)) as pick), (select count(*) as n from segmentations))
select pick::int as pick, MaskPath from picks join (
  select MaskPath, row_number() over (order by ord) - 1 as idx from segmentations) using (idx)""",
)
def _(t):
    return smp.pick_rows(t.view("segmentations"), ["ord"], 7).select("pick", "MaskPath")


@query(
    "pick_row_at",
    "segmentations",
    """select pick, MaskPath from (select unnest([1, 2]) as pick), (
  select MaskPath, row_number() over (order by ord) - 1 as idx from segmentations) where idx = 17""",
)
def _(t):
    return smp.pick_rows(t.view("segmentations"), ["ord"], 2, index=17).select("pick", "MaskPath")


@query(
    "skip_first",
    "files",
    "select path from files order by path offset 100",
)
def _(t):
    return smp.skip_first(t.view("files").select("path"), 100, ["path"])


@query(
    "cap_needed",
    "segmentations",
    """select MaskPath from (select distinct MaskPath from segmentations)
order by md5('42|' || MaskPath), MaskPath limit 500""",
)
def _(t):
    return smp.cap_needed(smp.needed_masks(t.view("segmentations")), 500, ["MaskPath"])


@query(
    "random_masks",
    "mask_files",
    "select path from mask_files order by md5('7|' || path), path limit 20",
)
def _(t):
    return smp.hash_sample(t.view("mask_files").select("path"), ["path"], 20, seed=7)


@query(
    "preview",
    "image_rows",
    "select filename, label, subreddit from image_rows order by doc_id limit 5",
)
def _(t):
    return smp.preview(t.view("image_rows"), ["doc_id"]).select("filename", "label", "subreddit")


@query(
    "generated_filenames",
    "attempts",
    """select seq, 'hf_' || safe || '_2026-04-08_' || seq || '.png' as image,
  'inpaint_' || safe || '_2026-04-08_' || seq || '.png' as inpaint,
  'hf_vid_' || safe || '_2026-04-08_' || seq || '_frame3.png' as frame
from (select seq, replace(model_id, '/', '_') as safe from attempts)""",
)
def _(t):
    model, date, index = F.col("model_id"), F.lit(DATE), F.col("seq")
    return t.view("attempts").select(
        "seq",
        naming.generated_filename(model, date, index).alias("image"),
        naming.inpaint_filename(model, date, index).alias("inpaint"),
        naming.video_frame_filename(model, date, index, F.lit(3)).alias("frame"),
    )


@query(
    "legacy_description",
    "",
    """select cast(p_partkey as string) as image_id, p_name as mask_label,
  'An image containing a ' || p_name as original_description,
  p_partkey || '_' || replace(p_name, ' ', '_') || '.png' as mask_file from part""",
)
def _(t):
    rows = t.sql("select cast(p_partkey as string) as image_id, p_name as mask_label from {part}")
    return naming.legacy_description(rows)
