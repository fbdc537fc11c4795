"""Incremental ingestion of posts: cut-offs per source, media routes, new keys only."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medialoom.functions import fixed_values as fv
from medialoom.functions.columns import any_endswith, day_text, extension, parse_day

POST_COLUMNS = ["filename", "label", "subreddit", "post_date", "reddit_id", "packaged"]


def labelled_sources(ai: DataFrame, real: DataFrame) -> DataFrame:
    """Both source lists (source, ord) with their label, one row per lower-cased name.

    A name that is listed twice, in whatever case, keeps its first spelling and label.
    """
    both = ai.select("source", "ord", F.lit("fake").alias("label"), F.lit(0).alias("part")).unionByName(
        real.select("source", "ord", F.lit("real").alias("label"), F.lit(1).alias("part"))
    )
    first = F.min_by(F.struct("source", "label"), F.struct("part", "ord")).alias("f")
    return both.groupBy(F.lower("source").alias("key")).agg(first).select("key", "f.*")


def listed_sources(
    spark: SparkSession, ai: list[str] = fv.AI_SOURCES, real: list[str] = fv.REAL_SOURCES
) -> DataFrame:
    """The default lists, or a caller's, as labelled sources."""
    tables = [
        spark.createDataFrame([(s, i) for i, s in enumerate(names)], "source string, ord int")
        for names in (ai, real)
    ]
    return labelled_sources(*tables)


def last_seen(metadata: DataFrame) -> DataFrame:
    """Newest stored day per source; dates that cannot be read are skipped."""
    day = metadata.select(
        F.lower("subreddit").alias("key"), parse_day(F.col("post_date")).alias("day")
    )
    return day.filter(F.col("day").isNotNull()).groupBy("key").agg(F.max("day").alias("last_day"))


def source_cutoffs(
    sources: DataFrame,
    last: DataFrame,
    now: dt.datetime,
    lookback: int = fv.LOOKBACK_DAYS,
    days_ago: int | None = None,
) -> DataFrame:
    """Cut-off per source: its newest stored day, else the look-back; or a fixed look-back."""
    if days_ago is not None:
        fixed = F.lit(now - dt.timedelta(days=days_ago)).cast("timestamp")
        return sources.withColumn("resumed", F.lit(False)).withColumn("cutoff", fixed)
    floor = F.lit(now - dt.timedelta(days=lookback)).cast("timestamp")
    joined = sources.join(last, "key", "left")
    return (
        joined.withColumn("resumed", F.col("last_day").isNotNull())
        .withColumn("cutoff", F.coalesce(F.col("last_day").cast("timestamp"), floor))
        .drop("last_day")
    )


def with_cutoff(posts: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """Posts of listed sources with key, label and cut-off of their source."""
    keyed = posts.withColumn("key", F.lower("source"))
    joined = keyed.join(cutoffs.drop("source"), "key", "left")
    return joined.filter(F.col("cutoff").isNotNull())


def after_cutoff(posts: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """Posts made at or after the cut-off of their source."""
    return with_cutoff(posts, cutoffs).filter(F.col("created_utc") >= F.col("cutoff"))


def route_media(posts: DataFrame) -> DataFrame:
    """image by the end of the url, else video with a stored stream; others drop."""
    image = any_endswith(F.lower("url"), fv.IMAGE_ENDINGS)
    video = F.col("is_video") & F.col("media.reddit_video").isNotNull()
    return posts.withColumn("route", F.when(image, "image").when(video, "video")).filter(
        F.col("route").isNotNull()
    )


def post_base(source: Column, created: Column, post_id: Column) -> Column:
    return F.format_string(fv.POST_NAME, F.lower(source), day_text(created), post_id)


def frame_name(base: Column, frame: Column) -> Column:
    return F.format_string(fv.POST_FRAME_NAME, base, frame)


def post_filenames(posts: DataFrame) -> DataFrame:
    """Base name, and the name that tells whether a post is known already."""
    base = post_base(F.col("source"), F.col("created_utc"), F.col("id"))
    image = F.concat("base_name", extension(F.col("url")))
    return posts.withColumn("base_name", base).withColumn(
        "filename",
        F.when(F.col("route") == "image", image).otherwise(
            frame_name(F.col("base_name"), F.lit(0))
        ),
    )


def candidates(posts: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """Posts to look at in this run, each file name once (the earliest post has it).

    Copies are reduced to one row in every task before the shuffle.
    """
    named = post_filenames(route_media(after_cutoff(posts, cutoffs)))
    kept = named.select(
        "filename", "created_utc", "id", "source", "base_name", "key", "label", "route", "url"
    )
    rest = [c for c in kept.columns if c != "filename"]
    one = kept.groupBy("filename").agg(F.min(F.struct(*rest)).alias("p"))
    return one.select("filename", "p.*")


def new_posts(found: DataFrame, metadata: DataFrame) -> DataFrame:
    """Posts whose file name is not in the metadata."""
    return found.join(metadata.select("filename"), "filename", "left_anti")


def known_since(metadata: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """Metadata whose post may be at or after the cut-off of its source, by the day in its name.

    Names without a day, and sources without a cut-off, are kept: a name is only left out if no
    post that passes the cut-off can have it.
    """
    days = F.regexp_extract_all("filename", F.lit(r"(\d{4}-\d{2}-\d{2})"), F.lit(1))
    bounds = cutoffs.select("key", day_text(F.col("cutoff")).alias("_since"))
    joined = metadata.withColumn("key", F.lower("subreddit")).join(bounds, "key", "left")
    before = (F.size(days) > 0) & (F.array_max(days) < F.col("_since"))
    return joined.filter(~F.coalesce(before, F.lit(False))).drop("_since")


def post_metadata_rows(posts: DataFrame, frames: int = fv.POST_FRAMES) -> DataFrame:
    """Metadata rows of new posts: one per image, one per frame of a video."""
    names = F.when(F.col("route") == "image", F.array("filename")).otherwise(
        F.transform(
            F.sequence(F.lit(0), F.lit(frames - 1)), lambda i: frame_name(F.col("base_name"), i)
        )
    )
    return posts.select(
        F.explode(names).alias("filename"),
        "label",
        F.col("key").alias("subreddit"),
        day_text(F.col("created_utc")).alias("post_date"),
        F.col("id").alias("reddit_id"),
        F.lit(False).alias("packaged"),
    )


def ingest(
    posts: DataFrame,
    metadata: DataFrame,
    sources: DataFrame,
    now: dt.datetime,
    days_ago: int | None = None,
) -> DataFrame:
    """Metadata rows that one run adds."""
    cutoffs = source_cutoffs(sources, last_seen(metadata), now, days_ago=days_ago)
    return post_metadata_rows(new_posts(candidates(posts, cutoffs), metadata))


def ingest_report(
    found: DataFrame,
    metadata: DataFrame,
    cutoffs: DataFrame,
    failures: DataFrame | None = None,
    frames: int = fv.POST_FRAMES,
) -> DataFrame:
    """Per source the rows added, the posts skipped as known, how it started and any error."""
    known = metadata.select("filename").distinct().withColumn("known", F.lit(True))
    flagged = found.join(known, "filename", "left")
    added = F.when(F.col("known"), 0).when(F.col("route") == "image", 1).otherwise(frames)
    counted = flagged.groupBy("key").agg(
        F.sum(added).alias("new"), F.count_if(F.col("known")).alias("skipped")
    )
    report = cutoffs.select("key", "label", "resumed").join(counted, "key", "left").fillna(
        0, ["new", "skipped"]
    )
    if failures is None:
        return report.withColumn("error", F.lit(None).cast("string"))
    return report.join(failures.select("key", "error"), "key", "left")


def start_counts(cutoffs: DataFrame) -> DataFrame:
    """How many sources go on from a stored day and how many start afresh."""
    return cutoffs.agg(
        F.count_if(F.col("resumed")).alias("resumed"),
        F.count_if(~F.col("resumed")).alias("fresh"),
    )


def late_policy(posts: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """Per source: posts ignored as late, read again on the cut-off day, and later ones."""
    joined = with_cutoff(posts, cutoffs)
    late = F.col("created_utc") < F.col("cutoff")
    same_day = ~late & (F.to_date("created_utc") == F.to_date("cutoff"))
    return joined.groupBy("key").agg(
        F.count_if(late).alias("late"),
        F.count_if(same_day).alias("read_again"),
        F.count_if(~late & ~same_day).alias("later"),
    )
