"""Whole rounds made of the operators; nothing is written here."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medialoom.functions import fixed_values as fv
from medialoom.functions.columns import slice_task
from medialoom.operators import catalogue as cat
from medialoom.operators import naming
from medialoom.operators import packaging as pack
from medialoom.operators import sampling as smp
from medialoom.operators import scoring


class Round(NamedTuple):
    """Work of one round and the registry rows that it already settles."""

    manifest: DataFrame
    registry_changes: DataFrame


def _described(catalogue: DataFrame, registry: DataFrame, mode: str, only: list[str] | None) -> DataFrame:
    wanted = cat.top_models(catalogue) if only is None else catalogue
    chosen = cat.classify_models(cat.eligible_models(wanted, registry, mode, only), mode)
    return chosen.withColumn("release_date", cat.release_date(F.col("created_at")))


def _settled(catalogue: DataFrame, registry: DataFrame, models: DataFrame, mode: str, date: str, only: list[str] | None) -> DataFrame:
    wanted = cat.top_models(catalogue) if only is None else catalogue
    faults = cat.eligibility_faults(wanted, registry, mode, date, only)
    return faults.unionByName(cat.lora_without_base(models, date))


def _with_parent(models: DataFrame) -> DataFrame:
    return models.filter((F.col("type") != "LoRA") | (F.col("base") != fv.NO_BASE))


def _tasked(rows: DataFrame, models: DataFrame, mode: str) -> DataFrame:
    """Rows with what their model is, and the task that makes them."""
    kept = models.select("id", "type", "base", "release_date", "target")
    tasks = cat.task_fanout(F.col("target"), mode)
    return rows.join(kept, "id").withColumn(
        "task", slice_task(F.col("rank"), F.col("target").cast("bigint"), tasks)
    )


def generate_round(
    catalogue: DataFrame,
    registry: DataFrame,
    pool: DataFrame,
    key: list[str],
    date: str,
    only: list[str] | None = None,
) -> Round:
    """Text-to-image work: for each eligible model its prompts, file names and tasks."""
    models = _described(catalogue, registry, "generate", only)
    ready = _with_parent(models)
    drawn = smp.prompts_per_model(ready, pool, key)
    manifest = _tasked(drawn, ready, "generate").withColumn(
        "filename", naming.generated_filename(F.col("id"), F.lit(date), F.col("rank"))
    )
    return Round(manifest, _settled(catalogue, registry, models, "generate", date, only))


def inpaint_round(
    catalogue: DataFrame,
    registry: DataFrame,
    prompts: DataFrame,
    files: DataFrame,
    key: list[str],
    date: str,
    only: list[str] | None = None,
) -> Round:
    """Repainting work: models whose quota can be filled, with their rows and tasks."""
    models = _described(catalogue, registry, "inpaint", only)
    ready = _with_parent(models)
    sample = smp.sample_per_model(ready, prompts, files, key)
    short = smp.quota_shortfall(ready, prompts, files, date)
    filled = ready.join(short.select(F.col("model_id").alias("id")), "id", "left_anti")
    changes = _settled(catalogue, registry, models, "inpaint", date, only).unionByName(short)
    return Round(_tasked(sample, filled, "inpaint"), changes)


def posts_to_package(
    metadata: DataFrame,
    scores: DataFrame,
    files: DataFrame,
    new_only: bool = False,
    size: int = fv.SHARD_ROWS,
) -> DataFrame:
    """Safe, present post images with their shard and shard name."""
    rows = pack.only_unpackaged(metadata) if new_only else metadata
    safe = scoring.drop_unsafe(rows, scores)
    filled = pack.fill_optional(
        pack.present_files(safe, files), ["label", "subreddit", "post_date", "reddit_id"]
    )
    return pack.shard_plan(filled, size)
