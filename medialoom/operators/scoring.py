"""Batched calls of a user's model: classifier scores, text generation, image jobs.

The caller passes a factory; it runs once in every Python worker, so that a model
is loaded once per worker and not once per batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medialoom.functions import fixed_values as fv
from medialoom.functions.columns import extract_prompt, unsafe_predicate

SCORES = T.ArrayType(
    T.StructType([T.StructField("label", T.StringType()), T.StructField("score", T.DoubleType())])
)


def micro_batches(frames: Iterator[pd.DataFrame], size: int) -> Iterator[pd.DataFrame]:
    """Consecutive batches of exactly ``size`` rows; the last may be smaller."""
    held = None
    for frame in frames:
        held = frame if held is None else pd.concat([held, frame], ignore_index=True)
        while len(held) >= size:
            yield held.iloc[:size].reset_index(drop=True)
            held = held.iloc[size:].reset_index(drop=True)
    if held is not None and len(held):
        yield held


def call_in_batches(
    df: DataFrame,
    factory: Callable[[], Callable[[pd.DataFrame], list]],
    column: str,
    kind: T.DataType,
    size: int,
) -> DataFrame:
    """Add a column that the model computes from batches of rows."""
    schema = T.StructType([*df.schema.fields, T.StructField(column, kind)])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = factory()
        for batch in micro_batches(frames, size):
            yield batch.assign(**{column: list(model(batch))})

    return df.mapInPandas(run, schema)


def score_files(
    df: DataFrame, factory: Callable[[], Callable], batch: int = fv.SCORE_BATCH
) -> DataFrame:
    """Classifier result per file: an array of label and score in column ``result``."""
    return call_in_batches(df, factory, "result", SCORES, batch)


def generate_text(
    df: DataFrame, factory: Callable[[], Callable], batch: int = fv.PROMPT_BATCH
) -> DataFrame:
    """Answers of a text model to column ``message`` and the prompt found in each."""
    answered = call_in_batches(df, factory, "response", T.StringType(), batch)
    return answered.withColumn("generated_prompt", extract_prompt(F.col("response")))


def unsafe_files(scores: DataFrame, threshold: float = fv.UNSAFE_THRESHOLD) -> DataFrame:
    flagged = scores.filter(unsafe_predicate(F.col("result"), threshold))
    return flagged.select("filename").distinct()


def drop_unsafe(
    metadata: DataFrame, scores: DataFrame, threshold: float = fv.UNSAFE_THRESHOLD
) -> DataFrame:
    """Metadata without the files that the classifier flags."""
    return metadata.join(unsafe_files(scores, threshold), "filename", "left_anti")


def _out_of_memory(error: Exception) -> bool:
    text = str(error).lower()
    return isinstance(error, MemoryError) or fv.OUT_OF_MEMORY_TEXT in text or "oom" in text


def adaptive_batches(
    df: DataFrame,
    factory: Callable[[], Callable[[pd.DataFrame], list]],
    start: int,
    column: str = "output",
    kind: T.DataType | None = None,
) -> DataFrame:
    """Call a model with batches that are halved whenever it runs out of memory.

    The smaller size is kept for the rest of the partition and no pending row is
    lost. A row that the model cannot do alone gets the memory exit code and no output;
    the rows after it go on one by one.
    """
    schema = T.StructType(
        [
            *df.schema.fields,
            T.StructField(column, kind or T.StringType()),
            T.StructField("batch_size", T.IntegerType()),
            T.StructField("exit_code", T.IntegerType()),
        ]
    )

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, size = factory(), max(start, 1)
        for pending in micro_batches(frames, start):
            while len(pending):
                rows = pending.iloc[:size].reset_index(drop=True)
                try:
                    output = list(model(rows))
                except Exception as error:  # the model may raise any class
                    if not _out_of_memory(error):
                        raise
                    if size > 1:
                        size //= 2
                        continue
                    output, code = [None], fv.EXIT_MEMORY_FAULT
                else:
                    code = fv.EXIT_OK
                yield rows.assign(
                    **{column: output, "batch_size": size, "exit_code": code}
                )
                pending = pending.iloc[len(rows) :].reset_index(drop=True)

    return df.mapInPandas(run, schema)


def transform_report(results: DataFrame, ok: str = "ok") -> DataFrame:
    """How many files a job changed and how many failed."""
    return results.agg(
        F.count_if(F.col(ok)).alias("succeeded"),
        F.count_if(~F.col(ok)).alias("failed"),
        F.count(F.lit(1)).alias("total"),
    )


def failures(results: DataFrame, ok: str = "ok") -> DataFrame:
    """The failed files with what went wrong."""
    return results.filter(~F.col(ok)).select("path", "info")
