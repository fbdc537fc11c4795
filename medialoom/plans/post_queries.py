"""Registered queries: posts and streams."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medialoom.functions import columns as col
from medialoom.operators import posts as ops
from medialoom.plans.bindings import BINDINGS, Tables
from medialoom.plans.registered import query
from medialoom.session import scratch_folder
from medialoom.sources.readers import read_table, read_version
from medialoom.sources.writers import append_table
from medialoom.streaming import posts as streams
from medialoom.streaming import registry as registry_stream
from medialoom import schemas

NOW = dt.datetime(2026, 4, 8)


def as_posts(rows: DataFrame) -> DataFrame:
    """The view's flat columns in the nested shape of stored posts."""
    stream = F.struct(F.col("fallback_url").alias("fallback_url"))
    media = F.when(
        F.col("fallback_url").isNotNull(), F.struct(stream.alias("reddit_video"))
    )
    return rows.select(
        "id", "source", F.col("created_utc").cast("timestamp").alias("created_utc"), "url", "is_video", media.alias("media")
    )


def posts(t: Tables) -> DataFrame:
    return as_posts(t.view("posts"))


def sources(t: Tables) -> DataFrame:
    """Every spelling that occurs; the source error holds real images, view is not listed."""
    spelled = t.view("posts").groupBy("source").agg(F.min("id").alias("ord"))
    key = F.lower("source")
    real = spelled.filter(key == "error")
    ai = spelled.filter((key != "error") & (key != "signup"))
    return ops.labelled_sources(ai, real)


def cutoffs(t: Tables) -> DataFrame:
    return ops.source_cutoffs(sources(t), ops.last_seen(t.view("known_posts")), NOW)


SOURCES = """spelled as (select source, min(id) as ord, lower(source) as key from posts group by source),
sources as (
  select key, min_by(source, ord) as source, case when key = 'error' then 'real' else 'fake' end as label
  from spelled where key <> 'signup' group by key)"""
LAST = """last_days as (
  select lower(subreddit) as key, max(try_strptime(nullif(post_date, ''), '%Y-%m-%d'))::date as last_day
  from known_posts group by 1 having last_day is not null)"""
CUTOFFS = """cutoffs as (
  select s.key, s.source, s.label, l.last_day is not null as resumed,
         coalesce(cast(last_day as timestamp), timestamp '2026-04-08' - interval 1000 day) as cutoff
  from sources s left join last_days l on s.key = l.key)"""
KEPT = """kept as (
  select p.*, c.key, c.label, c.cutoff,
         case when regexp_matches(lower(p.url), '\\.(jpg|jpeg|png)$') then 'image'
              when p.is_video and p.fallback_url is not null then 'video' end as route
  from posts p join cutoffs c on lower(p.source) = c.key where p.created_utc >= c.cutoff),
named as (
  select *, 'reddit_' || key || '_' || strftime(created_utc, '%Y-%m-%d') || '_' || id as base_name
  from kept where route is not null),
found as (
  select *, case when route = 'image' then base_name || regexp_extract(url, '(\\.[^./]*)$', 1)
            else base_name || '_frame_0.jpg' end as filename from named)"""
NEW = """fresh as (select * from found where filename not in (select filename from known_posts))"""
ALL = "with " + ",\n".join([SOURCES, LAST, CUTOFFS, KEPT, NEW]) + "\n"
VIEWS = "posts known_posts"
ROWS = """select case when route = 'image' then filename else base_name || '_frame_' || i || '.jpg' end as filename,
  label, key as subreddit, strftime(created_utc, '%Y-%m-%d') as post_date, id as reddit_id, false as packaged
from (select *, unnest(case when route = 'image' then [0] else range(15) end) as i from fresh)"""


@query("labelled_sources", VIEWS, ALL + "select key, source, label from sources")
def _(t):
    return sources(t)


@query("last_seen", VIEWS, ALL + "select key, strftime(last_day, '%Y-%m-%d') as last_day from last_days")
def _(t):
    last = ops.last_seen(t.view("known_posts"))
    return last.select("key", col.day_text(F.col("last_day")).alias("last_day"))


@query("source_cutoffs", VIEWS, ALL + "select key, resumed, strftime(cutoff, '%Y-%m-%d') as cutoff from cutoffs")
def _(t):
    return cutoffs(t).select("key", "resumed", col.day_text(F.col("cutoff")).alias("cutoff"))


@query(
    "source_cutoffs_fixed",
    VIEWS,
    ALL + "select key, false as resumed, '2026-03-09' as cutoff from sources",
)
def _(t):
    fixed = ops.source_cutoffs(sources(t), ops.last_seen(t.view("known_posts")), NOW, days_ago=30)
    return fixed.select("key", "resumed", col.day_text(F.col("cutoff")).alias("cutoff"))


@query("after_cutoff", VIEWS, ALL + "select id, key, label from kept")
def _(t):
    return ops.after_cutoff(posts(t), cutoffs(t)).select("id", "key", "label")


@query(
    "route_media",
    "posts",
    """select id, route from (
  select id, case when regexp_matches(lower(url), '\\.(jpg|jpeg|png)$') then 'image'
    when is_video and fallback_url is not null then 'video' end as route from posts)
where route is not null""",
)
def _(t):
    return ops.route_media(posts(t)).select("id", "route")


@query("post_filenames", VIEWS, ALL + "select id, base_name, filename from found")
def _(t):
    named = ops.post_filenames(ops.route_media(ops.after_cutoff(posts(t), cutoffs(t))))
    return named.select("id", "base_name", "filename")


@query("new_posts", VIEWS, ALL + "select filename, id, route, label from fresh")
def _(t):
    fresh = ops.new_posts(ops.candidates(posts(t), cutoffs(t)), t.view("known_posts"))
    return fresh.select("filename", "id", "route", "label")


@query("post_metadata_rows", VIEWS, ALL + ROWS)
def _(t):
    return ops.ingest(posts(t), t.view("known_posts"), sources(t), NOW)


@query(
    "ingest_report",
    VIEWS,
    ALL
    + """, flagged as (
  select key, route, filename in (select filename from known_posts) as known from found)
select c.key, c.label, c.resumed,
  coalesce(sum(case when known then 0 when route = 'image' then 1 when route = 'video' then 15 end), 0)::bigint as new,
  count(*) filter (known) as skipped,
  case when c.key = 'click' then 'timeout' end as error
from cutoffs c left join flagged f on c.key = f.key group by all""",
)
def _(t):
    failed = sources(t).filter(F.col("key") == "click").select(
        "key", F.lit("timeout").alias("error")
    )
    return ops.ingest_report(
        ops.candidates(posts(t), cutoffs(t)), t.view("known_posts"), cutoffs(t), failed
    )


@query(
    "start_counts",
    VIEWS,
    ALL + "select count(*) filter (resumed) as resumed, count(*) filter (not resumed) as fresh from cutoffs",
)
def _(t):
    return ops.start_counts(cutoffs(t))


@query(
    "late_policy",
    VIEWS,
    ALL
    + """select c.key, count(*) filter (created_utc < cutoff) as late,
  count(*) filter (created_utc >= cutoff and created_utc::date = cutoff::date) as read_again,
  count(*) filter (created_utc >= cutoff and created_utc::date <> cutoff::date) as later
from posts p join cutoffs c on lower(p.source) = c.key group by c.key""",
)
def _(t):
    return ops.late_policy(posts(t), cutoffs(t))


@query(
    "frame_plan",
    "videos",
    """select id, i::int as frame, least(i * greatest(1, total_frames // 15), total_frames - 1)::int as position
from videos, (select unnest(range(15)) as i) where total_frames > 0""",
)
def _(t):
    return t.view("videos").select(
        "id", F.posexplode(col.frame_plan(F.col("total_frames"))).alias("frame", "position")
    )


@query(
    "frame_plan_even",
    "videos",
    """select id, position from (
  select id, total_frames, floor(i * greatest(1.0, total_frames / 10.0))::int as position
  from videos, (select unnest(range(10)) as i)) where position < total_frames""",
)
def _(t):
    return t.view("videos").select(
        "id", F.explode(col.frame_plan_even(F.col("total_frames"))).alias("position")
    )


# --- streams ----------------------------------------------------------------


def post_stream(t: Tables) -> DataFrame:
    schema = t.table("events").schema
    events = streams.file_stream(t.spark, t.folder, schema, "events.parquet")
    return as_posts(t.spark.sql(BINDINGS["posts"], events=events))


def collect_stream(stream: DataFrame, t: Tables, purpose: str) -> DataFrame:
    """Run a stream over what is there and read what it wrote."""
    out = scratch_folder(t.spark, purpose)
    running = (
        stream.writeStream.format("parquet")
        .option("path", out + "/rows")
        .option("checkpointLocation", out + "/state")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    running.awaitTermination()
    return t.spark.read.schema(stream.schema).parquet(out + "/rows")


@query("stream_new_posts", VIEWS, ALL + f"select * from known_posts union all select * from ({ROWS})")
def _(t):
    folder = scratch_folder(t.spark, "ingest")
    append_table(t.view("known_posts"), folder + "/metadata")
    running = streams.stream_new_posts(
        post_stream(t), sources(t), folder + "/metadata", folder + "/state", NOW
    )
    running.awaitTermination()
    return read_table(t.spark, folder + "/metadata", schemas.POST_METADATA)


@query("stream_new_posts_restarted", VIEWS, ALL + f"select * from known_posts union all select * from ({ROWS})")
def _(t):
    """The newest events first, one file a batch; half way the run goes on under another clock."""
    folder, events = scratch_folder(t.spark, "ingest"), t.table("events")
    append_table(t.view("known_posts"), folder + "/metadata")
    second = F.unix_timestamp("ts")
    cuts = events.select(second.alias("s")).approxQuantile("s", [0.25, 0.5, 0.75], 0.01)
    part = sum((F.when(second >= c, 1).otherwise(0) for c in cuts), F.lit(0))
    for now, parts in ((NOW, (3, 2)), (NOW + dt.timedelta(days=500), (1, 0))):
        for k in parts:
            append_table(events.filter(part == k).coalesce(1), folder + "/events")
        stream = streams.file_stream(t.spark, folder + "/events", events.schema, per_batch=1)
        arriving = as_posts(t.spark.sql(BINDINGS["posts"], events=stream))
        running = streams.stream_new_posts(arriving, sources(t), folder + "/metadata", folder + "/state", now)
        running.awaitTermination()
    return read_table(t.spark, folder + "/metadata", schemas.POST_METADATA)


@query("dedup_stream", "posts", "select distinct id from posts")
def _(t):
    return collect_stream(streams.dedup_stream(post_stream(t)).select("id"), t, "dedup")


@query(
    "daily_source_counts",
    "posts",
    # days that the watermark (newest post less two days) has closed
    """select strftime(created_utc, '%Y-%m-%d') as day, lower(source) as key, count(*) as posts
from posts group by 1, 2
having day::timestamp + interval 1 day <= (select max(created_utc) - interval 2 day from posts)""",
)
def _(t):
    counts = collect_stream(streams.daily_source_counts(post_stream(t)), t, "daily")
    return counts.withColumn("day", col.day_text(F.col("day")))


@query(
    "stream_registry",
    "registry attempts",
    """select model_id, status, reason, date from (
  select *, row_number() over (partition by model_id order by date desc, rank desc, ord desc) as rn
  from (select model_id, status, reason, date, ord, 0 as rank from registry union all
        select model_id,
          case exit_code when 0 then 'COMPLETED' when 11 then 'MODEL_FAULT' else 'INFRASTRUCTURE_FAULT' end,
          case when exit_code = 0 then null else case when exit_code = 11 then 'Incompatible Architecture'
            when exit_code in (12, 137, 9) then 'Node/GPU Out of Memory' when exit_code = 10 then 'Data/Path Typo'
            else 'Generic Slurm/Job Failure' end || ' (Exit ' || exit_code || ')' end,
          strftime(ts, '%Y-%m-%d'), seq, 1 from attempts where exit_code <> 14))
where rn = 1""",
)
def _(t):
    folder = scratch_folder(t.spark, "registry")
    t.view("registry").select("model_id", "status", "reason", "date", "ord").write.parquet(
        folder + "/table/version=-1"
    )
    schema = t.table("orders").schema
    orders = streams.file_stream(t.spark, t.folder, schema, "orders.parquet")
    attempts = t.spark.sql(BINDINGS["attempts"], orders=orders)
    running = registry_stream.stream_registry(attempts, folder + "/table", folder + "/state")
    running.awaitTermination()
    return read_version(t.spark, folder + "/table", schemas.REGISTRY).drop("ord")
