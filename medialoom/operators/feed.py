"""Video feed: pages to posts, posts of open shape to rows, the chain of pages.

Posts are variants; every rule is a path with a fallback, so no schema is needed.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medialoom.functions import fixed_values as fv
from medialoom.functions.columns import sanitize_filename, truthy
from medialoom.session import cut_lineage

ZEROS = ["0", "0.0", "false"]


def _variant(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "variant")


def _text(v: Column, path: str) -> Column:
    """Value at the path as text, null where it is missing, null, empty, zero or false."""
    text = F.try_variant_get(v, path, "string")
    kind = F.schema_of_variant(_variant(v, path))
    nothing = (kind != "STRING") & text.isin(ZEROS)
    return F.when(~F.coalesce(nothing, F.lit(False)), truthy(text))


def _first_text(v: Column, *paths: str) -> Column:
    return F.coalesce(*[_text(v, p) for p in paths])


def _filled(v: Column) -> Column:
    """The variant if it is an object with members, else null."""
    members = F.try_variant_get(v, "$", "map<string,variant>")
    return F.when(F.cardinality(members) > 0, v)


# What is read from a post, in one pass over the variant; whatever has another type
# than expected reads as null.
ENCODING = "struct<path:string,url:string,width:double,height:double,duration_secs:double>"
MEDIA = (
    "struct<url:string,path:string,source:string,type:string,width:double,height:double,"
    "duration:double,duration_secs:double>"
)
FIELDS = (
    "struct<id:variant,generation_id:string,gen_id:string,post_id:string,title:string,"
    "text:string,created_at:string,createdAt:string,model:string,prompt:string,"
    "actions:map<string,string>,user:variant,author:variant,width:double,height:double,"
    "url:string,video_url:string,videoUrl:string,media:variant,video:variant,"
    "generation:variant,generations:array<variant>,encodings:struct<{}>>"
)
# what tells whether a post has a url
URL_ENCODING = "struct<path:string,url:string>"
URL_FIELDS = (
    "struct<url:string,video_url:string,videoUrl:string,media:variant,video:variant,"
    "generation:variant,generations:array<variant>,encodings:struct<{}>>"
)
ROW = [
    "id", "title", "created_at", "model", "prompt", "creator", "quality", "video_url",
    "width", "height", "duration", "raw_post",
]


def _stage(df: DataFrame, **values: Column) -> DataFrame:
    """Further columns, each computed once.

    They pass through inline, so that neither a later column nor a later filter
    repeats the expressions.
    """
    row = F.struct(*[c.alias(name) for name, c in values.items()])
    return df.select("*", F.inline(F.array(row)))


def _order(quality: str) -> list[str]:
    return list(dict.fromkeys([quality, *fv.FEED_QUALITIES]))


def _fields(v: Column, quality: str, url_only: bool = False) -> Column:
    fields, encoding = (URL_FIELDS, URL_ENCODING) if url_only else (FIELDS, ENCODING)
    encodings = ",".join(f"{q}:{encoding}" for q in _order(quality))
    return F.try_variant_get(v, "$", fields.format(encodings))


def _any(*texts: Column) -> Column:
    return F.coalesce(*[truthy(t) for t in texts])


def _filled_any(v: Column) -> Column:
    text = F.to_json(v)
    return F.when(~text.isin("{}", "[]", "null", '""', "0", "false"), v)


def _media_item(media: Column) -> Column:
    """First video of a media list."""
    listed = F.try_variant_get(media, "$", f"array<{MEDIA}>")
    videos = F.filter(
        listed, lambda m: m.isNotNull() & (F.coalesce(m["type"], F.lit("video")) == "video")
    )
    return F.get(videos, 0)


def _nested(f: Column) -> Column:
    return F.coalesce(_filled(f["generation"]), F.get(f["generations"], 0))


def _level(df: DataFrame, kept: list[str], quality: str, host: str, url_only: bool) -> DataFrame:
    """Read the post in ``_v``; keep it in ``_hit`` if it has a url, else go one level down."""
    f = F.col("_f")
    encoded = [
        _any(f["encodings"][q]["path"], f["encodings"][q]["url"]) for q in _order(quality)
    ]
    df = df.withColumn("_f", _fields(F.col("_v"), quality, url_only)).withColumns(
        {
            "_encoded": F.coalesce(*encoded),
            "_candidate": _any(f["url"], f["video_url"], f["videoUrl"]),
        }
    )
    candidate = F.col("_candidate")
    usable = F.contains(candidate, F.lit(host)) | F.endswith(candidate, F.lit(".mp4"))
    df = df.withColumn("_direct", F.when(F.col("_encoded").isNull() & usable, candidate))
    no_url = F.col("_encoded").isNull() & F.col("_direct").isNull()
    df = df.withColumn(
        "_media", F.when(no_url, F.coalesce(_filled_any(f["media"]), _filled_any(f["video"])))
    )
    media, obj, item = F.col("_media"), F.col("_object"), F.col("_item")
    df = df.withColumns(
        {"_object": F.try_variant_get(media, "$", MEDIA), "_item": _media_item(media)}
    ).withColumn(
        "_url",
        F.coalesce(
            "_encoded",
            "_direct",
            _any(obj["url"], obj["path"], obj["source"]),
            _any(item["url"], item["path"]),
        ),
    )
    hit = F.struct(
        F.col("_url").alias("url"),
        F.col("_v").alias("v"),
        f.alias("f"),
        F.col("_encoded").isNotNull().alias("by_encoding"),
        F.col("_direct").isNotNull().alias("by_url"),
        media.isNull().alias("no_media"),
        obj.alias("object"),
        item.alias("item"),
    )
    here = F.when(F.col("_url").isNotNull(), hit)
    if "_hit" in df.columns:
        here = F.coalesce(F.col("_hit"), here)
    below = F.when(F.col("_url").isNull(), _nested(f))
    return df.select(
        *kept, F.inline(F.array(F.struct(here.alias("_hit"), below.alias("_v"))))
    )


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, inside a lambda too."""
    return F.get(F.transform(F.array(value), body), 0)


def _has_url(f: Column, quality: str, host: str) -> Column:
    """Whether ``_level`` would find a url in these fields."""
    encoded = [_any(f["encodings"][q]["path"], f["encodings"][q]["url"]) for q in _order(quality)]
    candidate = _any(f["url"], f["video_url"], f["videoUrl"])
    usable = F.contains(candidate, F.lit(host)) | F.endswith(candidate, F.lit(".mp4"))

    def of_media(media: Column) -> Column:
        obj, item = F.try_variant_get(media, "$", MEDIA), _media_item(media)
        return F.coalesce(
            _any(obj["url"], obj["path"], obj["source"]), _any(item["url"], item["path"])
        )

    media = F.coalesce(_filled_any(f["media"]), _filled_any(f["video"]))
    return F.coalesce(*encoded, F.when(usable, candidate), _let(media, of_media)).isNotNull()


def _descended(v: Column, quality: str, host: str) -> Column:
    """First of a post and the generations nested in it that has a url, null if none has.

    A post can't be deeper than the keys of its own text that open a level; the walk does
    nothing more once it has ended, so a long list of siblings costs no reading.
    """
    most = F.regexp_count(F.to_json(v), F.lit('"generations?"'))

    def onward(state: Column, _: Column) -> Column:
        def read(f: Column) -> Column:
            def go(url: Column) -> Column:
                below = F.when(url, state["v"]).otherwise(_nested(f))
                return _let(
                    below, lambda v: F.struct(v.alias("v"), (url | v.isNull()).alias("ended"))
                )

            return _let(_has_url(f, quality, host), go)

        return F.when(state["ended"], state).otherwise(_let(_fields(state["v"], quality, url_only=True), read))

    start = F.struct(v.alias("v"), v.isNull().alias("ended"))
    return F.aggregate(F.sequence(F.lit(0), most), start, onward, lambda state: state["v"])


def _hits(posts: DataFrame, post: str, quality: str, host: str, url_only: bool = False) -> DataFrame:
    """What the first level with a url holds in ``_hit``, null if there is none.

    With ``url_only`` no more fields are read than tell whether there is one.

    The outermost level is read as plain columns. Only what is open after it is walked down by an
    expression, and the level that the walk ends at is read like the outermost.
    """
    kept = [c for c in posts.columns if c != post]
    df = _level(posts.withColumnRenamed(post, "_v"), kept, quality, host, url_only)
    still = F.col("_open")
    below = F.when(still.isNotNull(), _descended(still, quality, host))
    return _level(_stage(df.withColumnRenamed("_v", "_open"), _v=below), kept, quality, host, url_only)


def _encoding_state(f: Column, quality: str) -> Column:
    """What the encodings yield: they are read in order up to the first with a url.

    Sizes carry over from one encoding to the next, the duration does not.
    """
    start = F.struct(
        F.lit(False).alias("done"),
        F.coalesce(f["width"], F.lit(0.0)).alias("width"),
        F.coalesce(f["height"], F.lit(0.0)).alias("height"),
        F.lit(0.0).alias("duration"),
        F.lit(None).cast("string").alias("quality"),
    )
    entries = F.array(
        *[
            F.struct(F.lit(q).alias("q"), f["encodings"][q].alias("e"))
            for q in _order(quality)
        ]
    )

    def read(state: Column, entry: Column) -> Column:
        e = entry["e"]
        return F.when(
            ~state["done"] & e.isNotNull(),
            F.struct(
                _any(e["path"], e["url"]).isNotNull().alias("done"),
                F.coalesce(e["width"], state["width"]).alias("width"),
                F.coalesce(e["height"], state["height"]).alias("height"),
                F.coalesce(e["duration_secs"], F.lit(0.0)).alias("duration"),
                entry["q"].alias("quality"),
            ),
        ).otherwise(state)

    return F.aggregate(entries, start, read)


def normalize_feed_posts(
    posts: DataFrame,
    post: str = "post",
    quality: str = "source",
    host: str = fv.FEED_VIDEO_HOST,
    keep_without_url: bool = False,
) -> DataFrame:
    """Row of every post that has a video url, from the post or a generation nested in it.

    The first level with a url is the one that is read, however deep it lies. No job runs while
    the plan is built.
    """
    kept = [c for c in posts.columns if c != post]
    df = _hits(posts, post, quality, host)
    hit = F.col("_hit")
    df = df.withColumn("found", hit.isNotNull())
    if not keep_without_url:
        df = df.filter("found")
    f, obj, item = hit["f"], hit["object"], hit["item"]
    df = _stage(
        df,
        _enc=_encoding_state(f, quality),
        _user=F.coalesce(_filled(f["user"]), _filled(f["author"])),
    )
    enc, user = F.col("_enc"), F.col("_user")
    # without any media the reader still takes the branch of an empty object
    as_object = ~hit["by_encoding"] & ~hit["by_url"] & (hit["no_media"] | obj.isNotNull())
    df = _stage(
        df,
        id=F.coalesce(
            _text(f["id"], "$"), _any(f["generation_id"], f["gen_id"], f["post_id"]), F.lit("unknown")
        ),
        title=F.coalesce(_any(f["title"], f["text"]), F.lit("")),
        created_at=F.coalesce(_any(f["created_at"], f["createdAt"]), F.lit("")),
        model=F.coalesce(truthy(f["model"]), F.lit("")),
        prompt=F.coalesce(
            truthy(f["prompt"]),
            F.array_join(F.map_values(f["actions"]), " | "),
            f["text"],
            F.lit(""),
        ),
        creator=F.coalesce(
            _any(
                F.try_variant_get(user, "$.username", "string"),
                F.try_variant_get(user, "$.name", "string"),
            ),
            F.lit("unknown"),
        ),
        quality=F.when(hit["by_url"] | as_object, F.lit("unknown")).otherwise(enc["quality"]),
        video_url=hit["url"],
        raw_post=hit["v"],
        width=F.coalesce(obj["width"], item["width"], enc["width"]),
        height=F.coalesce(obj["height"], item["height"], enc["height"]),
        duration=F.when(
            as_object, F.coalesce(obj["duration"], obj["duration_secs"], F.lit(0.0))
        ).otherwise(enc["duration"]),
    )
    return df.select(*kept, *ROW, "found")


def post_key(post: Column) -> Column:
    """Id under which a post's detail is stored."""
    return _first_text(post, "$.id", "$.post_id", "$.generation_id")


def with_detail_fallback(feed: DataFrame, detail: DataFrame, **options) -> DataFrame:
    """Posts without a url are read again from the detail table (key, detail).

    ``detail`` is a variant or JSON text; of text only what is joined is parsed. Only those posts
    are joined; the others pass through. Posts are read twice, once for their rows and
    once for those without any url, for which only urls are read; nothing is written in between.
    """
    keyed = feed.withColumn("_key", post_key(F.col("post")))
    direct = normalize_feed_posts(feed, **options)
    quality, host = options.get("quality", "source"), options.get("host", fv.FEED_VIDEO_HOST)
    lost = _hits(keyed, "post", quality, host, url_only=True).filter(F.col("_hit").isNull())
    found = lost.drop("_hit", "_v").join(
        detail.select(F.col("key").alias("_key"), F.col("detail").alias("post")), "_key"
    )
    if dict(detail.dtypes)["detail"] == "string":
        found = found.withColumn("post", F.parse_json("post"))
    return direct.unionByName(normalize_feed_posts(found, **options).drop("_key"))


def _listed(page: Column, key: str) -> Column:
    return F.try_variant_get(page, f"$.{key}", "array<variant>")


def extract_feed_pages(pages: DataFrame, page: str = "page") -> DataFrame:
    """Posts and next cursor of each page; further columns are kept.

    The first key that holds a list counts, even an empty one; a page that is a list
    is the posts themselves. has_more false means that there is no next page.
    """
    p = F.col(page)
    whole = F.try_variant_get(p, "$", "array<variant>")
    posts = F.coalesce(*[_listed(p, k) for k in fv.FEED_POST_KEYS], whole)
    cursor = _first_text(
        p,
        *[f"$.{k}" for k in fv.FEED_CURSOR_KEYS],
        *[f"$.pagination.{k}" for k in fv.FEED_NESTED_CURSOR_KEYS],
    )
    more = F.coalesce(_variant(p, "$.has_more"), _variant(p, "$.hasMore"))
    ended = more.isNotNull() & ~F.coalesce(
        F.to_json(more).isin("false", "null", "0", "0.0", '""', "[]", "{}") == F.lit(False), F.lit(True)
    )
    return (
        pages.withColumn("posts", F.coalesce(posts, F.array().cast("array<variant>")))
        .withColumn("next_cursor", F.when(~ended, cursor))
        .drop(page)
    )


def feed_posts(pages: DataFrame) -> DataFrame:
    """One row per post of the extracted pages, with its place in the page."""
    kept = [c for c in pages.columns if c not in ("posts", "next_cursor")]
    return pages.select(*kept, F.posexplode("posts").alias("pos", "post"))


def feed_cursor_chain(pages: DataFrame) -> DataFrame:
    """Number of each page on the way from the first page over the next cursors.

    ``pages`` holds request_cursor (null for the first page), next_cursor and posts.
    The way ends at a page without a next cursor, without posts, or that was met
    before; of a page that is stored more than once one copy counts. Every round doubles the distance that is known, so a way of n pages takes
    about log2(n) rounds of joins; the rounds go on from written tables.
    """
    full = cut_lineage(_one_copy(pages).select("cursor", "next_cursor"), "pages")
    jump = full.join(
        full.select(F.col("cursor").alias("next_cursor")).distinct(), "next_cursor", "left_semi"
    ).select("cursor", F.col("next_cursor").alias("to"))
    known = full.filter(F.col("cursor") == "").select(
        "cursor", F.lit(0).cast("bigint").alias("number")
    )
    for i in range(math.ceil(math.log2(max(full.count(), 1))) + 1):
        reached = known.join(jump, "cursor").select(
            F.col("to").alias("cursor"), (F.col("number") + F.lit(2**i)).alias("number")
        )
        nearer = known.unionByName(reached).groupBy("cursor").agg(F.min("number").alias("number"))
        further = jump.select(F.col("cursor").alias("to"), F.col("to").alias("_to"))
        twice = jump.join(further, "to").select("cursor", F.col("_to").alias("to"))
        # both tables of the round in one job
        both = cut_lineage(nearer.unionByName(twice, allowMissingColumns=True), "chain")
        known = both.filter(F.col("number").isNotNull()).select("cursor", "number")
        jump = both.filter(F.col("to").isNotNull()).select("cursor", "to")
    return known


def _one_copy(pages: DataFrame) -> DataFrame:
    """Pages with posts, one per request: the copy that goes on, then the first by its hash."""
    order = F.struct(
        F.col("next_cursor").isNull(), "next_cursor", F.xxhash64(F.to_json("posts"))
    )
    best = F.min_by(F.struct("next_cursor", "posts"), order).alias("page")
    cursor = F.coalesce("request_cursor", F.lit("")).alias("cursor")
    return pages.filter(F.size("posts") > 0).groupBy(cursor).agg(best).select("cursor", "page.*")


def in_feed_order(pages: DataFrame) -> DataFrame:
    """Posts of the pages on the chain with page number and place."""
    numbered = feed_cursor_chain(pages)
    joined = _one_copy(pages).join(numbered, "cursor").withColumnRenamed("number", "page_number")
    return feed_posts(joined.select("page_number", "posts"))


def cap_feed(videos: DataFrame, most: int = fv.MAX_FEED_VIDEOS) -> DataFrame:
    """First videos in feed order; 0 means all."""
    if not most:
        return videos
    return videos.orderBy("page_number", "pos").limit(most)


def media_filename(videos: DataFrame) -> DataFrame:
    """File name of a video: cleaned title or id, id, and the ending its url hints at."""
    title = sanitize_filename(F.coalesce(truthy(F.col("title")), F.col("id")))
    url = F.col("video_url")
    ending = (
        F.when(F.contains(url, F.lit(".webm")), ".webm")
        .when(F.contains(url, F.lit(".webp")), ".webp")
        .otherwise(".mp4")
    )
    stem = F.concat(title, F.lit("_"), F.col("id"))
    return videos.withColumn("media_file", F.concat(stem, ending)).withColumn(
        "sidecar_file", F.concat(stem, F.lit(".json"))
    )


def feed_sidecars(videos: DataFrame) -> DataFrame:
    """JSON text per video, without the raw post."""
    named = media_filename(videos)
    kept = [c for c in videos.columns if c not in ("raw_post", "found", "page_number", "pos")]
    return named.select("sidecar_file", F.to_json(F.struct(*kept)).alias("value"))
