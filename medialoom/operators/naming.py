"""File names and metadata rows of generated images."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medialoom.functions import fixed_values as fv
from medialoom.functions.columns import archive_key, safe_name


def generated_filename(model: Column, date: Column, index: Column) -> Column:
    return F.format_string(fv.GENERATED_NAME, safe_name(model), date, index)


def inpaint_filename(model: Column, date: Column, index: Column) -> Column:
    return F.format_string(fv.INPAINT_NAME, safe_name(model), date, index)


def video_frame_filename(model: Column, date: Column, index: Column, frame: Column) -> Column:
    return F.format_string(fv.VIDEO_FRAME_NAME, safe_name(model), date, index, frame)


def inpaint_metadata_rows(
    sample: DataFrame,
    date: str,
    image_base: str = fv.SOURCE_IMAGE_BASE,
    mask_base: str = fv.MASK_BASE,
) -> DataFrame:
    """Metadata of repainted images from sampled rows with model, type and release date."""
    return sample.select(
        inpaint_filename(F.col("id"), F.lit(date), F.col("rank")).alias("filename"),
        F.coalesce("generated_prompt", F.lit(fv.DEFAULT_PROMPT)).alias("prompt"),
        F.lit("fake").alias("label"),
        F.col("id").alias("model"),
        "type",
        "release_date",
        F.concat(F.lit(image_base + "/"), "ImageID", F.lit(".jpg")).alias("source_image_url"),
        F.concat(
            F.lit(mask_base), archive_key(F.col("MaskPath")), F.lit("/"), "MaskPath"
        ).alias("mask_url"),
        F.col("MaskPath").alias("mask_path"),
        F.col("ClassName").alias("class_name"),
    )


def legacy_description(rows: DataFrame) -> DataFrame:
    """Base description and mask file name of the older annotation export."""
    return rows.select(
        "image_id",
        "mask_label",
        F.format_string(fv.LEGACY_DESCRIPTION, "mask_label").alias("original_description"),
        F.concat(
            "image_id", F.lit("_"), F.replace("mask_label", F.lit(" "), F.lit("_")), F.lit(".png")
        ).alias("mask_file"),
    )
