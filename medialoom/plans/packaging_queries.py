"""Registered queries: safety, packaging, upload plans, backfill."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medialoom.functions import columns as col
from medialoom.operators import backfill as back
from medialoom.operators import numbering as num
from medialoom.operators import packaging as pack
from medialoom.operators import scoring
from medialoom.plans.bindings import Tables
from medialoom.plans.catalogue_queries import catalogue
from medialoom.plans.registered import query
from medialoom.session import scratch_folder

# --- classifier scores ------------------------------------------------------


def scores(t: Tables) -> DataFrame:
    def pair(label: str, value: str):
        return F.struct(F.lit(label).alias("label"), F.col(value).alias("score"))

    return t.view("scores").select(
        "filename", F.array(pair("nsfw", "nsfw"), pair("normal", "normal")).alias("result")
    )


@query(
    "unsafe_predicate",
    "scores",
    "select filename, nsfw >= cast(0.7 as double) as unsafe from scores",
)
def _(t):
    return scores(t).select("filename", col.unsafe_predicate(F.col("result")).alias("unsafe"))


@query(
    "drop_unsafe",
    "scores image_rows",
    """select filename, subreddit from image_rows
where filename not in (select filename from scores where nsfw >= cast(0.7 as double))""",
)
def _(t):
    return scoring.drop_unsafe(t.view("image_rows"), scores(t)).select("filename", "subreddit")


def length_scorer():
    """Stand-in for a classifier: the score follows the length of the text."""

    def score(batch: pd.DataFrame) -> list:
        unsafe = (batch["prompt"].str.len() % 100) / 100.0
        return [[{"label": "nsfw", "score": s}, {"label": "normal", "score": 1 - s}] for s in unsafe]

    return score


@query(
    "score_files",
    "prompt_pool",
    """select id, (length(prompt) % 100) / cast(100 as double) as score,
  (length(prompt) % 100) / cast(100 as double) >= cast(0.7 as double) as unsafe from prompt_pool""",
)
def _(t):
    scored = scoring.score_files(t.view("prompt_pool"), length_scorer)
    return scored.select(
        "id",
        F.col("result")[0]["score"].alias("score"),
        col.unsafe_predicate(F.col("result")).alias("unsafe"),
    )


def upper_case_writer():
    """Stand-in for a text model: answers in JSON with every word of the message."""

    def answer(batch: pd.DataFrame) -> list:
        words = batch["message"].str.replace(r"[^A-Za-z]+", " ", regex=True).str.strip().str.upper()
        return [f'Here: {{"prompt": "a {w}"}}' for w in words]

    return answer


@query(
    "generate_text",
    "prompt_pool",
    """select id, trim('a ' || upper(trim(regexp_replace(prompt, '[^A-Za-z]+', ' ', 'g')))) as generated_prompt
from prompt_pool""",
)
def _(t):
    rows = t.view("prompt_pool").select("id", F.col("prompt").alias("message"))
    return scoring.generate_text(rows, upper_case_writer).select("id", "generated_prompt")


def narrow_model():
    """Stand-in for an image model that runs out of memory above three rows."""

    def run(batch: pd.DataFrame) -> list:
        if len(batch) > 3:
            raise RuntimeError("CUDA out of memory")
        return [f"done {i}" for i in batch["id"]]

    return run


@query(
    "adaptive_batches",
    "prompt_pool",
    "select id, 'done ' || id as output, 0 as exit_code from prompt_pool",
)
def _(t):
    done = scoring.adaptive_batches(t.view("prompt_pool").select("id"), narrow_model, 12)
    return done.select("id", "output", "exit_code")


def batch_number():
    state = {"n": -1}

    def count(batch: pd.DataFrame) -> list:
        state["n"] += 1
        return [state["n"]] * len(batch)

    return count


@query(
    "micro_batches",
    "prompt_pool",
    "select count(*) as rows, 0 as early_short, false as any_larger from prompt_pool",
)
def _(t):
    """Batches of 32: all rows are in one, and only the last of a task has fewer."""
    from pyspark.sql import Window
    from pyspark.sql import types as T

    rows = t.view("prompt_pool").select("id", F.spark_partition_id().alias("task"))
    batched = scoring.call_in_batches(rows, batch_number, "batch", T.LongType(), 32)
    sizes = batched.groupBy("task", "batch").agg(F.count(F.lit(1)).alias("rows"))
    last = F.max("batch").over(Window.partitionBy("task"))
    return sizes.withColumn("last", last).agg(
        F.sum("rows").alias("rows"),
        F.count_if((F.col("rows") < 32) & (F.col("batch") < F.col("last"))).alias("early_short"),
        F.bool_or(F.col("rows") > 32).alias("any_larger"),
    )


# --- packaging --------------------------------------------------------------


@query(
    "fill_optional",
    "image_rows",
    """select filename, coalesce(label, '') as label, coalesce(post_date, '') as post_date, '' as prompt
from image_rows""",
)
def _(t):
    filled = pack.fill_optional(t.view("image_rows"), ["label", "post_date", "prompt"])
    return filled.select("filename", "label", "post_date", "prompt")


@query(
    "publish_projection_posts",
    "image_rows",
    """select filename as image, coalesce(label, '') as label, coalesce(subreddit, '') as subreddit,
  coalesce(post_date, '') as post_date, reddit_id from image_rows""",
)
def _(t):
    return pack.publish_projection(t.view("image_rows"), "posts")


@query(
    "publish_projection_generated",
    "image_rows",
    """select filename as image, '' as prompt, coalesce(label, '') as label, model, '' as type,
  '' as release_date from image_rows""",
)
def _(t):
    return pack.publish_projection(t.view("image_rows"), "generated")


@query(
    "present_files",
    "image_rows files",
    "select filename from image_rows where filename in (select path from files)",
)
def _(t):
    return pack.present_files(t.view("image_rows"), t.view("files")).select("filename")


@query(
    "mark_packaged",
    "image_rows files",
    "select filename, filename in (select path from files) as packaged from image_rows",
)
def _(t):
    rows = t.view("image_rows").withColumn("packaged", F.lit(False))
    shipped = t.view("files").select(F.col("path").alias("filename"))
    return pack.mark_packaged(rows, shipped).select("filename", "packaged")


@query("mark_all_packaged", "image_rows", "select filename, true as packaged from image_rows")
def _(t):
    rows = t.view("image_rows").withColumn("packaged", F.lit(False))
    return pack.mark_packaged(rows).select("filename", "packaged")


@query(
    "dataset_summary",
    "image_rows",
    """select 'label' as "column", label as value, count(*) as rows from image_rows group by label
union all select 'model', model, count(*) from image_rows group by model
union all select 'distinct subreddit', null, count(distinct subreddit) from image_rows""",
)
def _(t):
    return pack.dataset_summary(t.view("image_rows"), "subreddit", ["label", "model"])


SHARDS = """shards as (
  select filename, (row_number() over (order by md5('42|' || filename), filename) - 1) // {0} as shard
  from image_rows)"""


@query(
    "fixed_shards",
    "image_rows",
    f"""with {SHARDS.format(500)}, total as (select (count(*) + 499) // 500 as n from image_rows)
select filename, shard,
  'train-' || lpad(shard::varchar, 5, '0') || '-of-' || lpad(n::varchar, 5, '0') || '.parquet' as shard_name
from shards, total""",
)
def _(t):
    return pack.shard_plan(t.view("image_rows")).select("filename", "shard", "shard_name")


@query(
    "shard_sizes",
    "image_rows files",
    f"""with {SHARDS.format(100)}
select shard, count(length) as rows, coalesce(sum(length), 0)::bigint as bytes,
  coalesce(sum(length), 0) / cast(1048576 as double) as megabytes, count(*) filter (length is null) as missing
from shards left join files on filename = path group by shard""",
)
def _(t):
    return pack.shard_sizes(pack.shard_plan(t.view("image_rows"), 100), t.view("files"))


@query(
    "total_gigabytes",
    "files",
    "select sum(length) / cast(1073741824 as double) as gigabytes from files",
)
def _(t):
    return pack.total_gigabytes(t.view("files"))


# each shard is filled until a file does not fit: the next begins with the first row whose running
# bytes pass the cap, counted from where this one begins
NEXT_FIT = """with recursive ordered as (
  select *, row_number() over (order by md5('42|' || path), path) - 1 as idx,
    sum({size}) over (order by md5('42|' || path), path rows between unbounded preceding and current row)::bigint as bytes_to_here
  from files),
shards(shard, first) as (
  select 0::bigint, 0::bigint where exists (from ordered)
  union all
  select shard + 1, (select min(idx) from ordered o where o.idx > s.first and o.bytes_to_here > s.byte + {cap}) as next
  from (select shard, first, bytes_to_here - {size} as byte from shards join ordered on idx = first) s
  where exists (from ordered o where o.idx > s.first and o.bytes_to_here > s.byte + {cap}))
select path, bytes_to_here, max(shard) as shard from ordered join shards on first <= idx group by all"""


def next_fit(t, cap):
    planned = num.size_bounded_shards(t.view("files"), ["path"], "length", cap)
    return planned.select("path", "bytes_to_here", "shard")


@query(
    "size_bounded_shards",
    "files",
    f"select path, bytes_to_here, shard from ({NEXT_FIT.format(size='length', cap=100_000)})",
)
def _(t):
    return next_fit(t, 100_000)


@query(
    "size_bounded_shards_tight",
    "files",
    f"select path, bytes_to_here, shard from ({NEXT_FIT.format(size='length', cap=4_000)})",
)
def _(t):
    """A cap that many files reach and some pass."""
    return next_fit(t, 4_000)


# names already uploaded: the files of the labelled documents
UPLOADED = "select 'f' || cast(doc_id as string) || '.png' as name from {labels}"


@query(
    "remaining_uploads",
    "files",
    f"""select path from files
where string_split(path, '/')[-1] not in ({UPLOADED.format(labels='labels')})""",
)
def _(t):
    return pack.remaining_uploads(t.view("files"), t.sql(UPLOADED)).select("path")


@query(
    "upload_batches",
    "files",
    f"""with remaining as (
  select path, string_split(path, '/')[-1] as name, length,
    row_number() over (order by path) - 1 as idx
  from files where string_split(path, '/')[-1] not in ({UPLOADED.format(labels='labels')}))
select idx // 10 + 1 as batch, count(*) as files, sum(length) / cast(1048576 as double) as megabytes,
  string_agg('reddit/train/' || name, ' ' order by idx) as paths,
  'Add reddit shards: ' || min_by(name, idx) || ' to ' || max_by(name, idx) as message
from remaining group by 1""",
)
def _(t):
    planned = pack.upload_batches(t.view("files"), t.sql(UPLOADED), "reddit")
    return planned.withColumn("paths", F.array_join("paths", " "))


@query(
    "read_upload_tracker",
    "",
    UPLOADED.format(labels="labels"),
)
def _(t):
    from medialoom.sources.readers import names_in_array

    # JSON arrays as in tracker files, a hundred names in each
    names = t.sql(
        "select doc_id div 100 as part, 'f' || cast(doc_id as string) || '.png' as name from {labels}"
    )
    arrays = names.groupBy("part").agg(F.to_json(F.collect_list("name")).alias("value"))
    return names_in_array(arrays)


@query(
    "read_registry",
    "registry",
    "select model_id, status, reason, date from registry",
)
def _(t):
    from medialoom.sources.readers import registry_rows

    # JSON objects as in registry files, a hundred models in each
    member = F.concat(
        F.lit('"'), "model_id", F.lit('": '), F.to_json(F.struct("status", "reason", "date"))
    )
    objects = (
        t.view("registry")
        .groupBy(col.int_div(F.col("ord"), 100).alias("part"))
        .agg(F.concat(F.lit("{"), F.array_join(F.collect_list(member), ", "), F.lit("}")).alias("value"))
    )
    return registry_rows(objects).drop("ord")


@query(
    "publish_union",
    "image_rows generated_files",
    """select filename, label, null as prompt, 'reddit' as config from image_rows
union all select filename, 'fake', '', 'opensource' from generated_files
union all select 'inpaint_' || filename, 'fake', 'p', 'inpainting' from generated_files""",
)
def _(t):
    made = t.view("generated_files")
    fake = F.lit("fake").alias("label")
    return pack.publish_union(
        {
            "reddit": t.view("image_rows").select("filename", "label"),
            "opensource": made.select("filename", fake, F.lit("").alias("prompt")),
            "inpainting": made.select(
                F.concat(F.lit("inpaint_"), "filename").alias("filename"), fake, F.lit("p").alias("prompt")
            ),
        }
    )


# --- backfill ---------------------------------------------------------------

NAMES = """names as (
  select replace(model_id, '/', '_') as stem, max_by(model_id, ord) as model from registry group by 1)"""
# the longest name that starts the stem and leaves a valid tail, found by trying every name
MATCHED = """stems as (
  select filename, case when starts_with(filename, 'hf_') and ends_with(filename, '.png')
    then substr(filename, 4, length(filename) - 7) end as stem from {0}),
tries as (
  select s.filename, n.model, length(n.stem) as size, substr(s.stem, length(n.stem) + 1) as tail
  from stems s join names n on starts_with(s.stem, n.stem)),
hits as (
  select *, row_number() over (partition by filename order by size desc) as rn from tries
  where regexp_matches(tail, '^(_\\d{{4}}-\\d{{2}}-\\d{{2}})?_\\d+$')),
matched as (
  select s.filename, h.model,
    nullif(regexp_extract(h.tail, '^_(\\d{{4}}-\\d{{2}}-\\d{{2}})_\\d+$', 1), '') as date
  from stems s left join (select * from hits where rn = 1) h on s.filename = h.filename)"""
@query(
    "merged_summary",
    "image_rows",
    """select 'label' as "column", label as value, count(*) as rows, true as near from image_rows group by label
union all select 'model', model, count(*), true from image_rows group by model
union all select 'distinct filename', null, count(distinct filename), true from image_rows""",
)
def _(t):
    """Eight runs, one of them repeated; the estimate is held to 2 % of the exact number."""
    rows, folder = t.view("image_rows"), scratch_folder(t.spark, "summaries")
    for run in (*range(8), 3):
        part = rows.filter(F.pmod("doc_id", F.lit(8)) == run)
        pack.write_summary(pack.summary_increment(part, "filename", ["label", "model"]), folder, f"run{run}")
    merged = pack.merged_summary(pack.read_summaries(t.spark, folder))
    exact = rows.agg(F.count_distinct("filename").alias("exact")).withColumn("column", F.lit("distinct filename"))
    sketched = F.col("column") == "distinct filename"
    near = F.abs(F.col("rows") - F.col("exact")) <= F.col("exact") * 0.02
    return merged.join(exact, "column", "left").select(
        "column", "value",
        F.when(sketched, F.col("exact")).otherwise(F.col("rows")).alias("rows"),
        F.when(sketched, near).otherwise(True).alias("near"),
    )


UNTRACKED = """untracked as (
  select filename from generated_files
  where filename like '%.png' and filename not in (select filename from tracked_files))"""


@query(
    "match_files_to_models",
    "generated_files registry",
    f"with {NAMES}, {MATCHED.format('generated_files')} select * from matched",
)
def _(t):
    matched = back.match_files_to_models(t.view("generated_files"), t.view("registry"))
    return matched.select("filename", "model", "date")


@query(
    "parse_generated_filename",
    "generated_files",
    """select filename, nullif(regexp_extract(stem, '^(.*)_\\d+$', 1), '') as plain_stem,
  nullif(regexp_extract(stem, '^(.*?)_(\\d{4}-\\d{2}-\\d{2})_\\d+$', 1), '') as dated_stem,
  nullif(regexp_extract(stem, '_(\\d{4}-\\d{2}-\\d{2})_\\d+$', 1), '') as file_date
from (select filename, case when starts_with(filename, 'hf_') and ends_with(filename, '.png')
  then substr(filename, 4, length(filename) - 7) end as stem from generated_files)""",
)
def _(t):
    parsed = back.parse_generated_filename(t.view("generated_files"))
    return parsed.select("filename", "plain_stem", "dated_stem", "file_date")


@query(
    "untracked_files",
    "generated_files tracked_files",
    f"with {UNTRACKED} select filename from untracked",
)
def _(t):
    return back.untracked_files(t.view("generated_files"), t.view("tracked_files")).select("filename")


@query(
    "images_per_model",
    "generated_files registry",
    f"""with {NAMES}, {MATCHED.format('generated_files')}
select model, count(*) as images from matched where model is not null group by model""",
)
def _(t):
    return back.images_per_model(
        back.match_files_to_models(t.view("generated_files"), t.view("registry"))
    )


@query(
    "infer_type_by_count",
    "",
    """select c_custkey, case when n >= 8000 then 'Base' when n >= 4000 then 'Fine-tune' else 'LoRA' end as type
from (select c_custkey, cast(floor(c_acctbal) as bigint) as n from customer)""",
)
def _(t):
    rows = t.sql("select c_custkey, cast(floor(c_acctbal) as bigint) as n from {customer}")
    return rows.select("c_custkey", back.infer_type_by_count(F.col("n")).alias("type"))


@query(
    "with_release_dates",
    "attempts catalogue_rows",
    """select a.seq, coalesce(strftime(c.created_at, '%Y-%m-%d'), 'unknown') as release_date
from attempts a left join catalogue_rows c on a.model_id = c.id""",
)
def _(t):
    rows = t.view("attempts").withColumnRenamed("model_id", "model")
    return back.with_release_dates(rows, catalogue(t)).select("seq", "release_date")


@query(
    "backfill_rows",
    "generated_files tracked_files registry catalogue_rows",
    f"""with {NAMES}, {UNTRACKED}, {MATCHED.format('untracked')}
select m.filename, '' as prompt, 'fake' as label, m.model,
  case when n >= 8000 then 'Base' when n >= 4000 then 'Fine-tune' else 'LoRA' end as type,
  coalesce(strftime(c.created_at, '%Y-%m-%d'), 'unknown') as release_date, false as packaged
from matched m join (select model, count(*) as n from matched group by model) k on m.model = k.model
left join catalogue_rows c on c.id = m.model""",
)
def _(t):
    return back.backfill_rows(
        t.view("generated_files"), t.view("tracked_files"), t.view("registry"), catalogue(t)
    )


@query(
    "name_collisions",
    "",
    """select stem, count(*) as models from (
  select distinct p_name, replace(p_name, ' ', '_') as stem from part
  union all select distinct p_name || '/', replace(p_name, ' ', '_') from part)
group by stem having count(*) > 1""",
)
def _(t):
    # part names with a slash and with an underscore for their blank
    ids = t.sql(
        "select distinct replace(p_name, ' ', '/') as model_id, 1 as ord from {part} "
        "union all select distinct replace(p_name, ' ', '_'), 2 from {part}"
    )
    return back.name_collisions(ids)
