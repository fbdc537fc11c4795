"""Registered queries: video feed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medialoom.functions import columns as col
from medialoom.operators import feed
from medialoom.plans.bindings import Tables
from medialoom.plans.registered import query

PAGE = 50  # posts on a stored page

VIDEO_COLUMNS = "id title created_at model prompt creator quality video_url width height duration".split()

# what each shape must read as
VIDEOS = """shaped as (
  select event_id, event_id % 6 as s, event_id::varchar as n, user_id as u, event_type, ts from events),
videos as (
  select event_id, 'e' || n as id,
    case s when 0 then 't: ' || event_type when 1 then 'text ' || n when 4 then ' in/ner? ' else '' end as title,
    case s when 0 then strftime(ts, '%Y-%m-%d') else '' end as created_at,
    case s when 0 then 'm1' else '' end as model,
    case s when 0 then event_type || ' | x' when 1 then 'text ' || n when 2 then 'p ' || event_type else '' end as prompt,
    case s when 0 then 'u' || u when 3 then 'a' || u else 'unknown' end as creator,
    case s when 0 then 'source' when 1 then 'md' else 'unknown' end as quality,
    case s when 0 then 'https://videos.openai.com/' || n || '/source.mp4'
      when 1 then 'https://cdn.example.com/' || n || '.webm' when 2 then 'https://cdn.example.com/' || n || '.mp4'
      when 3 then 'https://cdn.example.com/' || n || '.webp'
      when 4 then 'https://videos.openai.com/v' || n end as video_url,
    case s when 0 then u when 1 then 7 when 3 then u else 0 end::double as width,
    case s when 0 then 5 when 1 then 3 else 0 end::double as height,
    case s when 0 then 2.5 when 3 then 4 else 0 end::double as duration
  from shaped where s <> 5)"""
NAMES = """cleaned as (
  select *, trim(regexp_replace(coalesce(nullif(title, ''), id), '[<>:"/\\\\|?*\\x00-\\x1f]', '_', 'g'), '. ') as clean
  from videos)"""


def posts(t: Tables) -> DataFrame:
    return t.view("feed_rows").select("event_id", F.parse_json("body").alias("post"))


def videos(t: Tables) -> DataFrame:
    return feed.normalize_feed_posts(posts(t))


def pages(t: Tables) -> DataFrame:
    """Stored pages of fifty posts; the odd ones name their cursor in a nested object."""
    number = col.int_div(F.col("event_id"), PAGE)
    last = t.table("events").agg(F.max(number).alias("n")).scalar()
    grouped = t.view("feed_rows").groupBy(number.alias("page_id")).agg(
        F.array_sort(F.collect_list(F.struct("event_id", "body"))).alias("rows")
    )
    listed = F.array_join(F.transform("rows", lambda r: r["body"]), ", ")
    following = F.concat(F.lit('"c'), (F.col("page_id") + 1).cast("string"), F.lit('"'))
    cursor = (
        F.when(F.col("page_id") == last, ', "has_more": false')
        .when(
            F.col("page_id") % 2 == 1,
            F.concat(F.lit(', "pagination": {"next": '), following, F.lit("}")),
        )
        .otherwise(F.concat(F.lit(', "next_cursor": '), following))
    )
    key = F.when(F.col("page_id") % 3 == 0, "posts").otherwise("items")
    body = F.concat(F.lit('{"'), key, F.lit('": ['), listed, F.lit("]"), cursor, F.lit("}"))
    request = F.when(F.col("page_id") > 0, F.concat(F.lit("c"), F.col("page_id").cast("string")))
    return feed.extract_feed_pages(
        grouped.select(request.alias("request_cursor"), F.parse_json(body).alias("page"))
    )


@query(
    "normalize_feed_post",
    "",
    f"with {VIDEOS} select event_id, {', '.join(VIDEO_COLUMNS)} from videos",
)
def _(t):
    return videos(t).select("event_id", *VIDEO_COLUMNS)


@query(
    "normalize_feed_post_deep",
    "",
    """select event_id, case when event_id % 17 <> 0 then 'e' || event_id end as id,
  case when event_id % 17 <> 0 then 'https://cdn.example.com/' || event_id || '.mp4' end as video_url,
  event_id % 17 <> 0 as found from events""",
)
def _(t):
    deep = t.view("deep_feed_rows").select("event_id", F.parse_json("body").alias("post"))
    rows = feed.normalize_feed_posts(deep, keep_without_url=True)
    there = F.col("found")
    return rows.select("event_id", F.when(there, F.col("id")).alias("id"), "video_url", "found")


@query(
    "extract_feed_page",
    "",
    f"""select coalesce(case when p > 0 then 'c' || p end, 'first') as request_cursor, posts,
  case when p < max(p) over () then 'c' || (p + 1) end as next_cursor
from (select event_id // {PAGE} as p, count(*) as posts from events group by 1)""",
)
def _(t):
    return pages(t).select(
        F.coalesce("request_cursor", F.lit("first")).alias("request_cursor"),
        F.size("posts").cast("bigint").alias("posts"),
        "next_cursor",
    )


@query(
    "feed_cursor_chain",
    "",
    f"""select distinct case when event_id < {PAGE} then '' else 'c' || (event_id // {PAGE}) end as cursor,
  event_id // {PAGE} as number from events""",
)
def _(t):
    return feed.feed_cursor_chain(pages(t))


@query(
    "cap_feed",
    "",
    f"""with {VIDEOS} select event_id // {PAGE} as page_number, (event_id % {PAGE})::int as pos, id, video_url
from videos order by event_id limit 50""",
)
def _(t):
    ordered = feed.normalize_feed_posts(feed.in_feed_order(pages(t)))
    return feed.cap_feed(ordered).select("page_number", "pos", "id", "video_url")


@query(
    "feed_in_order",
    "",
    f"""with {VIDEOS} select event_id // {PAGE} as page_number, (event_id % {PAGE})::int as pos, id, title, video_url
from videos""",
)
def _(t):
    ordered = feed.normalize_feed_posts(feed.in_feed_order(pages(t)))
    return feed.cap_feed(ordered, 0).select("page_number", "pos", "id", "title", "video_url")


@query(
    "with_detail_fallback",
    "",
    f"""with {VIDEOS} select event_id, id, title, model, video_url from videos
union all select event_id, 'e' || event_id, 'from detail', case when event_id % 4 = 1 then '' else 'm2' end,
  'https://videos.openai.com/d' || event_id
from events where event_id % 6 = 5 and event_id % 2 = 1""",
)
def _(t):
    details = t.view("feed_details").withColumnRenamed("body", "detail")
    rows = feed.with_detail_fallback(posts(t), details)
    return rows.select("event_id", "id", "title", "model", "video_url")


@query(
    "media_filename",
    "",
    f"""with {VIDEOS}, {NAMES} select event_id,
  clean || '_' || id || case when contains(video_url, '.webm') then '.webm'
    when contains(video_url, '.webp') then '.webp' else '.mp4' end as media_file,
  clean || '_' || id || '.json' as sidecar_file from cleaned""",
)
def _(t):
    return feed.media_filename(videos(t)).select("event_id", "media_file", "sidecar_file")


@query(
    "feed_sidecars",
    "",
    f"""with {VIDEOS}, {NAMES} select clean || '_' || id || '.json' as sidecar_file,
  to_json(struct_pack({', '.join(f'{c} := {c}' for c in VIDEO_COLUMNS)}))::varchar as value from cleaned""",
)
def _(t):
    return feed.feed_sidecars(videos(t).select(*VIDEO_COLUMNS, "raw_post"))


@query(
    "sanitize_filename",
    "",
    """select doc_id, coalesce(nullif(case when length(clean) > 80
    then rtrim(substr(clean, 1, 80), '. ') else clean end, ''), 'untitled') as name
from (select doc_id, trim(regexp_replace(text, '[<>:"/\\\\|?*\\x00-\\x1f]', '_', 'g'), '. ') as clean from documents)""",
)
def _(t):
    return t.table("documents").select("doc_id", col.sanitize_filename(F.col("text")).alias("name"))


@query(
    "url_names",
    "",
    """select page_id, string_split(url, '/')[-1] as name,
  regexp_extract(string_split(url, '/')[-1], '^\\.*[^.].*?(\\.[^.]*)$', 1) as extension from pages""",
)
def _(t):
    return t.table("pages").select(
        "page_id",
        col.base_name(F.col("url")).alias("name"),
        col.extension(F.col("url")).alias("extension"),
    )
