"""The model registry: job results become states, one row per model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medialoom.functions import fixed_values as fv
from medialoom.functions.columns import any_contains, day_text


def _exit_kind(code: Column) -> Column:
    return (
        F.when(code == fv.EXIT_OK, "ok")
        .when(code == fv.EXIT_CODE_BUG, "halt")
        .when(code == fv.EXIT_MODEL_FAULT, "model")
        .when(code.isin(fv.MEMORY_EXITS), "memory")
        .when(code == fv.EXIT_DATA_FAULT, "data")
        .otherwise("other")
    )


def exit_to_status(attempts: DataFrame) -> DataFrame:
    """State and reason of each attempt from its exit code."""
    kind = F.col("_kind")
    status = (
        F.when(kind == "ok", fv.COMPLETED)
        .when(kind == "halt", fv.HALT)
        .when(kind == "model", fv.MODEL_FAULT)
        .otherwise(fv.INFRASTRUCTURE_FAULT)
    )
    names = F.create_map(*[F.lit(x) for pair in fv.EXIT_NAMES.items() for x in pair])
    reason = F.when(
        kind != "ok",
        F.format_string("%s (Exit %d)", F.try_element_at(names, kind), F.col("exit_code")),
    )
    return (
        attempts.withColumn("_kind", _exit_kind(F.col("exit_code")))
        .withColumn("status", status)
        .withColumn("reason", reason)
        .drop("_kind")
    )


def triage_errors(logs: DataFrame, variant: str = "image") -> DataFrame:
    """Exit code of a failed job from its error class and text, tested in order."""
    text = F.lower(F.coalesce(F.col("message"), F.lit("")))
    architecture = (
        fv.VIDEO_ARCHITECTURE_WORDS if variant == "video" else fv.ARCHITECTURE_WORDS
    )
    file_error = F.col("error_class").isin(fv.FILE_ERROR_CLASSES) | F.contains(
        text, F.lit(fv.MISSING_FILE_TEXT)
    )
    code = (
        F.when(F.contains(text, F.lit(fv.OUT_OF_MEMORY_TEXT)), fv.EXIT_MEMORY_FAULT)
        .when(
            file_error,
            F.when(any_contains(text, fv.MODEL_FILE_WORDS), fv.EXIT_MODEL_FAULT).otherwise(
                fv.EXIT_DATA_FAULT
            ),
        )
        .when(any_contains(text, architecture), fv.EXIT_MODEL_FAULT)
        .otherwise(fv.EXIT_CODE_BUG)
    )
    return logs.withColumn("triaged_exit", code)


def before_halt(attempts: DataFrame, run: str = "run", order: list[str] = ("ts", "seq")) -> DataFrame:
    """Attempts of each run before its first halt.

    Only the halting attempts are grouped, so a long run costs no more than a short one.
    """
    at = F.struct(*order)
    first = (
        attempts.filter(F.col("exit_code") == fv.EXIT_CODE_BUG)
        .groupBy(run)
        .agg(F.min(at).alias("_halt"))
    )
    kept = attempts.join(first, run, "left")
    return kept.filter(F.col("_halt").isNull() | (at < F.col("_halt"))).drop("_halt")


def registry_changes(attempts: DataFrame) -> DataFrame:
    """Rows that job results write to the registry; a halting job writes none."""
    judged = exit_to_status(before_halt(attempts))
    return judged.select(
        "model_id", "status", "reason", day_text(F.col("ts")).alias("date"), F.col("seq").alias("ord")
    )


def upsert_registry(old: DataFrame, changes: DataFrame) -> DataFrame:
    """One row per model: the newest by date; of one day a change beats the stored row.

    Partial maxima are taken before the shuffle, so a model with many changes is no
    heavier than another.
    """
    cols = ["model_id", "status", "reason", "date", "ord"]
    both = old.select(*cols, F.lit(0).alias("rank")).unionByName(
        changes.select(*cols, F.lit(1).alias("rank"))
    )
    newest = F.max_by(
        F.struct("status", "reason", "date", "ord"), F.struct("date", "rank", "ord")
    ).alias("r")
    return both.groupBy("model_id").agg(newest).select("model_id", "r.*")


def resource_tier(models: DataFrame, registry: DataFrame) -> DataFrame:
    """large for a retry after a memory fault, else default."""
    state = registry.select(
        F.col("model_id").alias("id"), F.col("status").alias("_status"), F.col("reason").alias("_reason")
    )
    memory = (F.col("_status") == fv.INFRASTRUCTURE_FAULT) & F.contains("_reason", F.lit("Memory"))
    joined = models.join(state, "id", "left")
    return joined.withColumn("tier", F.when(memory, "large").otherwise("default")).drop(
        "_status", "_reason"
    )


def evictable_models(registry: DataFrame) -> DataFrame:
    """Cache folders of models that need no retry."""
    done = registry.filter(F.col("status") != fv.INFRASTRUCTURE_FAULT)
    folder = F.concat(F.lit(fv.CACHE_FOLDER_PREFIX), F.replace("model_id", F.lit("/"), F.lit("--")))
    return done.select("model_id", folder.alias("cache_folder"))


def completed_models(registry: DataFrame) -> DataFrame:
    return registry.filter(F.col("status") == fv.COMPLETED).select("model_id")
