"""Packaging: projections, shards, upload plans, publish sets."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medialoom.functions import fixed_values as fv
from medialoom.functions.columns import base_name, int_div
from medialoom.operators.numbering import fixed_shards, ordered_index, row_total
from medialoom.session import cut_lineage
from medialoom.sources.readers import _empty, _if_there

IMAGE = "struct<bytes:binary,path:string>"


def fill_optional(df: DataFrame, columns: list[str]) -> DataFrame:
    """Optional text columns exist and hold no null."""
    for c in columns:
        there = F.coalesce(F.col(c).cast("string"), F.lit("")) if c in df.columns else F.lit("")
        df = df.withColumn(c, there)
    return df


def publish_projection(df: DataFrame, kind: str) -> DataFrame:
    """Columns of a published set: posts or generated images."""
    tails = {
        "posts": ["label", "subreddit", "post_date", "reddit_id"],
        "generated": ["prompt", "label", "model", "type", "release_date"],
    }
    columns = tails[kind]
    return fill_optional(df, columns).select(F.col("filename").alias("image"), *columns)


def only_unpackaged(df: DataFrame) -> DataFrame:
    return df.filter(~F.coalesce(F.col("packaged"), F.lit(False)))


def mark_packaged(df: DataFrame, shipped: DataFrame | None = None, key: str = "filename") -> DataFrame:
    """Set packaged: on every row, or on the rows whose key was shipped."""
    if shipped is None:
        return df.withColumn("packaged", F.lit(True))
    sent = shipped.select(key).distinct().withColumn("_sent", F.lit(True))
    joined = df.join(sent, key, "left")
    already = F.coalesce(F.col("packaged"), F.lit(False))
    return joined.withColumn("packaged", F.coalesce("_sent", already)).drop("_sent")


def present_files(metadata: DataFrame, files: DataFrame) -> DataFrame:
    """Metadata rows whose file exists."""
    return metadata.join(files.select(F.col("path").alias("filename")), "filename", "left_semi")


def dataset_summary(df: DataFrame, group: str, values: list[str]) -> DataFrame:
    """Number of distinct groups and the value counts of some columns, in one pass.

    Rows are counted per (group, values) first, so each further step works on counts.
    """
    cells = df.groupBy(group, *values).agg(F.count(F.lit(1)).alias("n"))
    listed = F.array(
        F.struct(F.lit(group).alias("column"), F.col(group).cast("string").alias("value")),
        *[
            F.struct(F.lit(v).alias("column"), F.col(v).cast("string").alias("value"))
            for v in values
        ],
    )
    counted = (
        cells.select("n", F.inline(listed)).groupBy("column", "value").agg(F.sum("n").alias("rows"))
    )
    groups = (
        counted.filter((F.col("column") == group) & F.col("value").isNotNull())
        .groupBy("column")
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(F.lit("distinct " + group).alias("column"), F.lit(None).cast("string").alias("value"), "rows")
    )
    return counted.filter(F.col("column") != group).unionByName(groups)


SKETCH_BITS = 14  # registers of a sketch, as a power of two: 16 KB, a standard error below 1 %
SUMMARY = "column string, value string, rows bigint, sketch binary, run string"


def summary_increment(df: DataFrame, group: str, values: list[str]) -> DataFrame:
    """(column, value, rows, sketch): what one run adds to the summary of a grown set.

    Value counts are exact and add up; the distinct groups are a sketch that can be merged. An
    empty run has one row, the sketch of nothing. The sketch and the counts of low-cardinality
    columns are made in each task before anything is shuffled.
    """
    listed = F.array(*[F.struct(F.lit(v).alias("column"), F.col(v).cast("string").alias("value")) for v in values])
    none = F.lit(None)
    counted = df.groupBy(*values).agg(F.count(F.lit(1)).alias("n")).select("n", F.inline(listed))
    counted = counted.groupBy("column", "value").agg(F.sum("n").alias("rows"))
    groups = df.agg(F.hll_sketch_agg(F.col(group).cast("string"), SKETCH_BITS).alias("sketch"))
    return counted.withColumn("sketch", none.cast("binary")).unionByName(
        groups.select(
            F.lit("distinct " + group).alias("column"), none.cast("string").alias("value"), none.cast("bigint").alias("rows"), "sketch"
        )
    )


def write_summary(increment: DataFrame, path: str, run: str) -> None:
    """Keep the increment of a run; a run that is repeated replaces what it wrote before."""
    (
        increment.withColumn("run", F.lit(run))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run")
        .parquet(path)
    )


def read_summaries(spark: SparkSession, path: str) -> DataFrame:
    """The increments of all runs so far; none if nothing has been written."""
    return _if_there(lambda: spark.read.schema(SUMMARY).parquet(path), lambda: _empty(spark, SUMMARY))


def merged_summary(increments: DataFrame) -> DataFrame:
    """The summary of all runs (columns as ``dataset_summary``) from their increments alone.

    Distinct groups are estimated by the merged sketches, within 2 % for more than a few.
    """
    merged = increments.groupBy("column", "value").agg(
        F.sum("rows").alias("_rows"), F.hll_union_agg("sketch").alias("_sketch"), F.count("sketch").alias("_sketches")
    )
    rows = F.when(F.col("_sketches") > 0, F.hll_sketch_estimate("_sketch")).otherwise(F.col("_rows"))
    return merged.select("column", "value", rows.alias("rows"))


def shard_sizes(planned: DataFrame, files: DataFrame) -> DataFrame:
    """Rows, bytes, megabytes and missing files of each planned shard."""
    sized = planned.join(
        files.select(F.col("path").alias("filename"), F.col("length").alias("_length")),
        "filename",
        "left",
    )
    size = F.coalesce(F.sum("_length"), F.lit(0))
    return sized.groupBy("shard").agg(
        F.count("_length").alias("rows"),
        size.alias("bytes"),
        (size / F.lit(1024 * 1024)).alias("megabytes"),
        F.count_if(F.col("_length").isNull()).alias("missing"),
    )


def total_gigabytes(files: DataFrame) -> DataFrame:
    return files.agg((F.coalesce(F.sum("length"), F.lit(0)) / F.lit(1024**3)).alias("gigabytes"))


def remaining_uploads(files: DataFrame, uploaded: DataFrame) -> DataFrame:
    """Files whose base name is not in the tracker."""
    named = files.withColumn("name", base_name(F.col("path")))
    return named.join(uploaded.select("name"), "name", "left_anti")


def upload_batches(
    files: DataFrame, uploaded: DataFrame, config: str, n: int = fv.FILES_PER_COMMIT
) -> DataFrame:
    """Commits of n remaining files in name order, with their size and message."""
    numbered = ordered_index(remaining_uploads(files, uploaded), ["path"])
    grouped = numbered.groupBy((int_div(F.col("idx"), n) + 1).alias("batch")).agg(
        F.count(F.lit(1)).alias("files"),
        (F.sum("length") / F.lit(1024 * 1024)).alias("megabytes"),
        F.min_by("name", "idx").alias("first_name"),
        F.max_by("name", "idx").alias("last_name"),
        F.transform(
            F.array_sort(F.collect_list(F.struct("idx", "name"))),  # n names at most
            lambda f: F.format_string(fv.UPLOAD_PATH, F.lit(config), f["name"]),
        ).alias("paths"),
    )
    message = F.format_string(fv.COMMIT_MESSAGE, F.lit(config), "first_name", "last_name")
    return grouped.withColumn("message", message).drop("first_name", "last_name")


def publish_union(configs: dict[str, DataFrame]) -> DataFrame:
    """Several published sets side by side; columns that a set lacks are null."""
    out = None
    for name, df in configs.items():
        part = df.withColumn("config", F.lit(name))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def shard_plan(metadata: DataFrame, size: int = fv.SHARD_ROWS, seed: object = fv.SHUFFLE_SEED) -> DataFrame:
    """Every row with its shard and the shard's file name."""
    return fixed_shards(metadata, ["filename"], size, seed)


def _read_bytes(locations: pd.Series) -> list[bytes | None]:
    out = []
    for place in locations:
        system, path = fs.FileSystem.from_uri(place)
        try:
            with system.open_input_stream(path) as stream:
                out.append(stream.read())
        except FileNotFoundError:  # gone since it was listed: skipped, as if never there
            out.append(None)
    return out


def attach_bytes(rows: DataFrame, location: str = "location", batch: int = 64) -> DataFrame:
    """Read the file of each row where the row is; rows without their file are dropped.

    The bytes are read in the task that writes them and never go through a shuffle.
    """
    kept = [f for f in rows.schema.fields if f.name != location]
    schema = ", ".join(
        [f"image {IMAGE}", *[f"`{f.name}` {f.dataType.simpleString()}" for f in kept]]
    )
    names = [f.name for f in kept]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for start in range(0, len(frame), batch):
                part = frame.iloc[start : start + batch]
                images = [
                    None if data is None else {"bytes": data, "path": name}
                    for data, name in zip(_read_bytes(part[location]), part["filename"])
                ]
                out = part[names].assign(image=images)
                yield out[out["image"].notna()]

    return rows.mapInPandas(run, schema)


def write_image_shards(
    metadata: DataFrame,
    files: DataFrame,
    path: str,
    size: int = fv.SHARD_ROWS,
    seed: object = fv.SHUFFLE_SEED,
) -> DataFrame:
    """Write the images that no shard holds yet, in new shards; returns the plan of these.

    What is packed is read from the shards themselves, so a later run on more rows packs
    every file once. Only rows whose file exists are numbered, after the last shard that is
    there. Shards and order are settled before any byte is read; one task writes one shard of
    ``size`` rows, reading the bytes as it goes. ``files`` holds path and location.
    """
    packed = packed_files(metadata.sparkSession, path)
    rows = fill_optional(metadata, ["label", "subreddit", "post_date", "reddit_id"])
    there = files.select(F.col("path").alias("filename"), "location")
    fresh = rows.join(there, "filename").join(packed.select("filename"), "filename", "left_anti")
    # written before the shards grow, since the plan is read again after them
    last = packed.agg(F.coalesce(F.max("shard") + 1, F.lit(0)).alias("n")).scalar()
    shards = last + int_div(row_total(fresh) + F.lit(size - 1), size)
    plan = shard_plan(fresh, size, seed).withColumn("shard", F.col("shard") + last)
    name = F.format_string(fv.SHARD_NAME, F.col("shard"), shards)
    plan = cut_lineage(plan.withColumn("shard_name", name), "shards")
    # the shard itself names the task: no two shards share one, and small partitions are not merged
    first, tasks = plan.agg(F.min("shard"), F.count_distinct("shard")).head()
    ordered = plan.repartitionById(max(1, tasks), (F.col("shard") - F.lit(first or 0)).cast("int"))
    ordered = ordered.sortWithinPartitions("shard", "idx")
    rows = attach_bytes(
        ordered.select(
            "filename", "label", "subreddit", "post_date", "reddit_id", "shard", "location"
        )
    )
    (
        rows.drop("filename")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("shard")
        .parquet(path)
    )
    return plan.drop("location")


def packed_files(spark: SparkSession, path: str) -> DataFrame:
    """Name and shard of every image in the shards below a path."""
    return _if_there(
        lambda: spark.read.parquet(path).select(
            F.col("image.path").alias("filename"), F.col("shard").cast("bigint").alias("shard")
        ),
        lambda: _empty(spark, "filename string, shard bigint"),
    )


def shard_count(df: DataFrame, size: int = fv.SHARD_ROWS) -> Column:
    return int_div(row_total(df) + F.lit(size - 1), size)
