"""Post streams: incremental ingestion, bounded dedup, daily counts."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from medialoom import schemas
from medialoom.functions import fixed_values as fv
from medialoom.operators import posts as ops
from medialoom.sources.readers import read_table
from medialoom.sources.writers import append_table


#: State store that keeps the names of a run on disk, not in the executors' memory.
STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_new_posts(
    posts: DataFrame,
    sources: DataFrame,
    metadata_path: str,
    checkpoint: str,
    now: dt.datetime,
    days_ago: int | None = None,
    lookback: int = fv.LOOKBACK_DAYS,
) -> StreamingQuery:
    """Read what has arrived, keep what is new for its source, append its metadata.

    A run begins with the first call and goes on, over any number of failures and restarts under
    any clock, until ``end_run`` says that it is over. Its cut-offs, and the names that the metadata
    knew then and that can still pass them, are stored with the checkpoint when it begins. Names
    that the run has seen are keyed state of the stream, forgotten when a post is older than the
    look-back. So a batch reads no metadata; only the first after a start does, as it may repeat a
    batch whose rows were written before a failure.
    """
    session = posts.sparkSession
    run = open_run(checkpoint, sources, metadata_path, now, days_ago, lookback)
    named = ops.post_filenames(ops.route_media(ops.after_cutoff(posts, run.cutoffs)))
    once = named.withWatermark("created_utc", f"{lookback + 1} days").dropDuplicatesWithinWatermark(["filename"])
    fresh = once.join(run.known, "filename", "left_anti")
    first = True

    def add(batch: DataFrame, _: int) -> None:
        nonlocal first
        if first:
            batch = ops.new_posts(batch, read_table(batch.sparkSession, metadata_path, schemas.POST_METADATA))
            first = False
        append_table(ops.post_metadata_rows(batch), metadata_path)

    before = session.conf.get(STORE)
    session.conf.set(STORE, ROCKS)
    try:
        return (
            fresh.writeStream.foreachBatch(add)
            .option("checkpointLocation", f"{checkpoint.rstrip('/')}/stream")
            .trigger(availableNow=True)
            .start()
        )
    finally:
        session.conf.set(STORE, before)


@dataclass
class Run:
    """Cut-offs of a run and the names that were known and can pass them, both stored."""

    number: int
    cutoffs: DataFrame
    known: DataFrame


def open_run(
    checkpoint: str, sources: DataFrame, metadata_path: str, now: dt.datetime, days_ago: int | None, lookback: int
) -> Run:
    """The run that has not ended yet, else a new one that begins at ``now``."""
    session, place = sources.sparkSession, f"{checkpoint.rstrip('/')}/runs"
    number = last_ended(session, place) + 1
    metadata = read_table(session, metadata_path, schemas.POST_METADATA)
    cutoffs = ops.source_cutoffs(sources, ops.last_seen(metadata), now, lookback, days_ago)
    known_schema = "filename string"
    if read_table(session, f"{place}/begun/{number}", cutoffs.schema).isEmpty():
        cutoffs.write.mode("overwrite").parquet(f"{place}/cutoffs/{number}")
        cutoffs = read_table(session, f"{place}/cutoffs/{number}", cutoffs.schema)
        names = ops.known_since(metadata, cutoffs).select("filename")
        names.write.mode("overwrite").parquet(f"{place}/known/{number}")
        # last of all: a run has begun when this is there
        cutoffs.write.mode("overwrite").parquet(f"{place}/begun/{number}")
    return Run(
        number,
        read_table(session, f"{place}/begun/{number}", cutoffs.schema),
        read_table(session, f"{place}/known/{number}", known_schema),
    )


def last_ended(session: SparkSession, place: str) -> int:
    ended = read_table(session, f"{place}/ended", "run bigint")
    return ended.agg(F.coalesce(F.max("run"), F.lit(0))).head()[0]


def end_run(session: SparkSession, checkpoint: str) -> None:
    """Everything that a run was to read has been read: the next call begins a new one."""
    place = f"{checkpoint.rstrip('/')}/runs"
    append_table(session.range(1).select(F.lit(last_ended(session, place) + 1).cast("long").alias("run")), f"{place}/ended")


def dedup_stream(posts: DataFrame, horizon: str = "2 days") -> DataFrame:
    """Each post id once, with a state that forgets ids after the horizon."""
    return posts.withWatermark("created_utc", horizon).dropDuplicatesWithinWatermark(["id"])


def daily_source_counts(posts: DataFrame, horizon: str = "2 days") -> DataFrame:
    """Posts per source and day, closed when the watermark has passed the day."""
    return (
        posts.withWatermark("created_utc", horizon)
        .groupBy(F.window("created_utc", "1 day"), F.lower("source").alias("key"))
        .agg(F.count(F.lit(1)).alias("posts"))
        .select(F.col("window.start").alias("day"), "key", "posts")
    )


def file_stream(spark: SparkSession, folder: str, schema, pattern: str = "*.parquet", per_batch: int = 1000) -> DataFrame:
    """Parquet files of a folder as a stream."""
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", per_batch)
        .parquet(folder)
    )
