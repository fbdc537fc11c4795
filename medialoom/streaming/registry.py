"""Job results as a stream that keeps the registry current."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from medialoom import schemas
from medialoom.functions import fixed_values as fv
from medialoom.functions.columns import day_text
from medialoom.operators.registry import exit_to_status, upsert_registry
from medialoom.sources.readers import read_version
from medialoom.sources.writers import write_version


def status_changes(attempts: DataFrame) -> DataFrame:
    """Registry rows of job results; a halt writes none."""
    judged = exit_to_status(attempts).filter(F.col("status") != fv.HALT)
    return judged.select(
        "model_id", "status", "reason", day_text(F.col("ts")).alias("date"), F.col("seq").alias("ord")
    )


def stream_registry(attempts: DataFrame, registry_path: str, checkpoint: str) -> StreamingQuery:
    """Fold every batch into the newest registry version and write the next one.

    The version number is the batch number: a batch that is run again starts from
    the version before it and replaces its own.
    """

    def fold(batch: DataFrame, number: int) -> None:
        old = read_version(batch.sparkSession, registry_path, schemas.REGISTRY, below=number)
        write_version(upsert_registry(old, status_changes(batch)), registry_path, number)

    return (
        attempts.writeStream.foreachBatch(fold)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
