"""Choosing models from the catalogue and describing the work each one needs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medialoom.functions import fixed_values as fv
from medialoom.functions.columns import any_contains, day_text, truthy


def _task() -> Column:
    return F.coalesce(F.col("pipeline_tag"), F.lit(""))


def _has_weights() -> Column:
    found = F.exists("files", lambda f: F.endswith(f, F.lit(fv.WEIGHT_SUFFIX)))
    return F.coalesce(found, F.lit(False))


def _bad_task(mode: str) -> Column:
    return any_contains(F.lower(_task()), fv.BANNED_TASK_WORDS[mode])


def _downloads() -> Column:
    return F.coalesce(F.col("downloads"), F.lit(0))


def top_models(catalogue: DataFrame, n: int = fv.CATALOGUE_LIMIT, tag: str = "diffusers") -> DataFrame:
    """Most downloaded models with the tag; ties by id."""
    tagged = catalogue.filter(F.array_contains("tags", tag))
    return tagged.orderBy(F.desc_nulls_last("downloads"), "id").limit(n)


def pending_models(catalogue: DataFrame, registry: DataFrame) -> DataFrame:
    """Models without a final state in the registry; faults of the machines are retried."""
    final = registry.filter(F.col("status").isin(fv.FINAL_STATUSES)).select(
        F.col("model_id").alias("id")
    )
    return catalogue.join(final, "id", "left_anti")


def _considered(
    catalogue: DataFrame, registry: DataFrame | None, mode: str, only: list[str] | None
) -> DataFrame:
    """Models that pass the checks which leave no trace in the registry."""
    models = catalogue if only is None else catalogue.filter(F.col("id").isin(only))
    if only is None or mode == "count":
        models = models.filter(_downloads() >= fv.DOWNLOAD_FLOOR)
    if mode == "count" or (mode == "inpaint" and only is not None):
        return models
    return pending_models(models, registry)


def eligible_models(
    catalogue: DataFrame,
    registry: DataFrame | None,
    mode: str,
    only: list[str] | None = None,
) -> DataFrame:
    """Models to work on. Explicit ids waive the download floor, and every check of inpaint."""
    models = _considered(catalogue, registry, mode, only)
    if mode == "inpaint" and only is not None:
        return models
    return models.filter(_has_weights() & ~_bad_task(mode))


def eligibility_faults(
    catalogue: DataFrame, registry: DataFrame, mode: str, date: str, only: list[str] | None = None
) -> DataFrame:
    """Registry rows for models that fail a check; the first failing check names the reason."""
    models = _considered(catalogue, registry, mode, only)
    no_weights = (~_has_weights(), F.lit(fv.REASON_NO_WEIGHTS))
    bad_task = (_bad_task(mode), F.format_string(fv.REASON_TASK, _task()))
    first, second = (bad_task, no_weights) if mode == "inpaint" else (no_weights, bad_task)
    if mode == "inpaint" and only is not None:
        models = models.filter(F.lit(False))
    reason = F.when(*first).when(*second)
    return (
        models.select(
            F.col("id").alias("model_id"),
            F.lit(fv.MODEL_FAULT).alias("status"),
            reason.alias("reason"),
            F.lit(date).alias("date"),
        )
        .filter(F.col("reason").isNotNull())
    )


def _lower_tags() -> Column:
    return F.transform(F.coalesce(F.col("tags"), F.array().cast("array<string>")), F.lower)


def resolve_base_model(
    variant: str = "generate", strip_relation: bool = False
) -> Column:
    """Parent model of a catalogue row, or the text None.

    The card may hold a text or a list (generate takes its first entry, inpaint its
    second); without one the first base_model tag counts, after its first colon.
    """
    card = F.col("base_model")
    listed = F.startswith(F.schema_of_variant(card), F.lit("ARRAY"))
    entry = "$[1]" if variant == "inpaint" else "$[0]"
    from_card = F.when(listed, F.try_variant_get(card, entry, "string")).otherwise(
        F.try_variant_get(card, "$", "string")
    )
    tags = F.filter(_lower_tags(), lambda t: F.startswith(t, F.lit(fv.BASE_TAG_PREFIX)))
    from_tag = F.get(F.split(F.get(tags, 0), ":", 2), 1)
    if strip_relation:
        from_tag = F.substring_index(from_tag, ":", -1)
    return F.coalesce(truthy(from_card), truthy(from_tag), F.lit(fv.NO_BASE))


def classify_models(catalogue: DataFrame, variant: str = "generate") -> DataFrame:
    """Type and quota of each model from its tags and its parent."""
    adapter = F.arrays_overlap(_lower_tags(), F.array(*[F.lit(t) for t in fv.ADAPTER_TAGS]))
    with_base = catalogue.withColumn("base", resolve_base_model(variant))
    kind = (
        F.when(adapter, "LoRA")
        .when(F.col("base") != fv.NO_BASE, "Fine-tune")
        .otherwise("Base")
    )
    quota = F.when(F.col("type") == "Base", fv.QUOTAS["Base"]).when(
        F.col("type") == "Fine-tune", fv.QUOTAS["Fine-tune"]
    ).otherwise(fv.QUOTAS["LoRA"])
    return with_base.withColumn("type", kind).withColumn("target", quota)


def lora_without_base(classified: DataFrame, date: str) -> DataFrame:
    """Registry rows for adapters whose parent is unknown."""
    lost = classified.filter((F.col("type") == "LoRA") & (F.col("base") == fv.NO_BASE))
    return lost.select(
        F.col("id").alias("model_id"),
        F.lit(fv.MODEL_FAULT).alias("status"),
        F.lit(fv.REASON_NO_BASE).alias("reason"),
        F.lit(date).alias("date"),
    )


def task_fanout(target: Column, variant: str = "generate") -> Column:
    """Number of tasks that share a quota."""
    return (
        F.when(target >= fv.QUOTAS["Base"], fv.TASKS["Base"])
        .when(target >= fv.QUOTAS["Fine-tune"], fv.TASKS["Fine-tune"])
        .otherwise(fv.TASKS["LoRA"][variant])
    )


def release_date(created_at: Column) -> Column:
    return F.coalesce(day_text(created_at), F.lit("unknown"))


def required_repos(classified: DataFrame) -> DataFrame:
    """Distinct model ids whose weights are needed: each model and each adapter's parent."""
    parent = F.when(
        (F.col("type") == "LoRA") & (F.col("base") != fv.NO_BASE), F.col("base")
    )
    both = classified.select(F.explode(F.array("id", parent)).alias("repo"))
    return both.filter(F.col("repo").isNotNull()).distinct()


def eligible_model_count(catalogue: DataFrame) -> DataFrame:
    """Number of models that pass the counting checks."""
    return eligible_models(catalogue, None, "count").agg(F.count(F.lit(1)).alias("models"))


def models_above_floor(catalogue: DataFrame) -> DataFrame:
    return catalogue.filter(_downloads() >= fv.DOWNLOAD_FLOOR).select("id", "downloads")
