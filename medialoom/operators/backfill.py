"""Recovering lost metadata from file names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medialoom.functions import fixed_values as fv
from medialoom.functions.columns import safe_name, truthy
from medialoom.operators.catalogue import release_date


def parse_generated_filename(files: DataFrame) -> DataFrame:
    """The two model names a file name can hold, and the date of the dated form.

    ``plain_stem`` ends before the index, ``dated_stem`` before date and index; both
    are null for names of another kind.
    """
    kind = F.startswith("filename", F.lit("hf_")) & F.endswith("filename", F.lit(".png"))
    stem = F.when(kind, F.substring("filename", F.lit(4), F.length("filename") - 7))
    plain = truthy(F.regexp_extract(stem, f"(?s)^(.*){fv.INDEX_TAIL}", 1))
    dated = truthy(F.regexp_extract(stem, f"(?s)^(.*?){fv.DATED_TAIL}", 1))
    date = truthy(F.regexp_extract(stem, fv.DATED_TAIL, 1))
    return files.withColumns({"plain_stem": plain, "dated_stem": dated, "file_date": date})


def model_names(registry: DataFrame) -> DataFrame:
    """File-name form of every registered model; of equal forms the last entry counts."""
    return registry.groupBy(safe_name(F.col("model_id")).alias("stem")).agg(
        F.max_by("model_id", "ord").alias("model"),
        F.count(F.lit(1)).alias("models"),
    )


def name_collisions(registry: DataFrame) -> DataFrame:
    return model_names(registry).filter(F.col("models") > 1).select("stem", "models")


def match_files_to_models(files: DataFrame, registry: DataFrame) -> DataFrame:
    """Model of each file by the longest registered name that leaves a valid tail.

    A name leaves a valid tail only if it is one of the two stems of the file, so
    the prefix search is two equality joins; the plain stem is the longer one. A file without
    a stem, and in the second join one that is matched, is joined on its own name under
    another mark, which no registered name has: it meets nothing and shares no task with the others.
    """

    def key(stem: Column) -> Column:
        return F.coalesce(F.concat(F.lit("s"), stem), F.concat(F.lit("f"), F.col("filename")))

    names = model_names(registry).select(F.concat(F.lit("s"), "stem").alias("_stem"), "model")
    parsed = parse_generated_filename(files)
    plain = names.withColumnRenamed("model", "_plain")
    joined = parsed.withColumn("_stem", key(F.col("plain_stem"))).join(plain, "_stem", "left")
    open_stem = F.when(F.col("_plain").isNull(), F.col("dated_stem"))
    dated = names.withColumnRenamed("model", "_dated")
    joined = joined.withColumn("_stem", key(open_stem)).join(dated, "_stem", "left")
    return joined.withColumn("model", F.coalesce("_plain", "_dated")).withColumn(
        "date", F.when(F.col("_dated").isNotNull(), F.col("file_date"))
    ).drop("_plain", "_dated", "_stem", "plain_stem", "dated_stem", "file_date")


def untracked_files(files: DataFrame, metadata: DataFrame) -> DataFrame:
    """Stored .png files that the metadata does not list."""
    images = files.filter(F.endswith("filename", F.lit(".png")))
    return images.join(metadata.select("filename"), "filename", "left_anti")


def images_per_model(matched: DataFrame) -> DataFrame:
    """Matched files per model, most first."""
    counted = (
        matched.filter(F.col("model").isNotNull())
        .groupBy("model")
        .agg(F.count(F.lit(1)).alias("images"))
    )
    return counted.orderBy(F.desc("images"), "model")


def infer_type_by_count(count: Column) -> Column:
    return (
        F.when(count >= fv.TYPE_BASE_COUNT, "Base")
        .when(count >= fv.TYPE_FINE_TUNE_COUNT, "Fine-tune")
        .otherwise("LoRA")
    )


def with_release_dates(rows: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Release date of each row's model, unknown where the catalogue has none."""
    dates = catalogue.select(
        F.col("id").alias("model"), release_date(F.col("created_at")).alias("release_date")
    )
    joined = rows.join(dates, "model", "left")
    return joined.withColumn("release_date", F.coalesce("release_date", F.lit("unknown")))


def backfill_rows(
    files: DataFrame,
    metadata: DataFrame,
    registry: DataFrame,
    catalogue: DataFrame,
    all_files: bool = False,
) -> DataFrame:
    """Metadata rows for untracked files. The type follows the number of untracked
    files of the model, or of all its files."""
    untracked = untracked_files(files, metadata)
    matched = match_files_to_models(untracked, registry).filter(F.col("model").isNotNull())
    counted_on = matched
    if all_files:
        counted_on = match_files_to_models(files, registry)
    types = images_per_model(counted_on).select(
        "model", infer_type_by_count(F.col("images")).alias("type")
    )
    typed = with_release_dates(matched.join(types, "model", "left"), catalogue)
    return typed.select(
        "filename",
        F.lit("").alias("prompt"),
        F.lit("fake").alias("label"),
        "model",
        "type",
        "release_date",
        F.lit(False).alias("packaged"),
    )
