"""Writers. Every append and overwrite is one committed Spark job."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medialoom import schemas
from medialoom.sources.readers import CSV_OPTIONS, _empty, _if_there


def columns_of(schema: str) -> list[str]:
    return [part.strip().split(" ")[0] for part in schema.split(",")]


def append_table(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def append_metadata(df: DataFrame, path: str, kind: str, file_format: str = "parquet") -> None:
    """Append rows with the fixed columns of their kind; writers may run side by side.

    Each job adds its own files when it commits. ``csv`` writes parts with a header
    that read_metadata reads back.
    """
    rows = df.select(*columns_of(schemas.METADATA[kind]))
    writer = rows.write.mode("append")
    if file_format == "csv":
        writer.options(**{k: v for k, v in CSV_OPTIONS.items() if k != "multiLine"}).csv(path)
    else:
        writer.parquet(path)


def write_version(df: DataFrame, path: str, version: int) -> None:
    """Write a table as a numbered version; older versions stay until they are dropped."""
    df.write.mode("overwrite").parquet(f"{path}/version={version}")


def finished_parts(spark: SparkSession, path: str, column: str = "shard") -> DataFrame:
    """Values of the partition column that are already written."""
    empty = f"{column} bigint"
    return _if_there(
        lambda: spark.read.parquet(path).select(F.col(column).cast("bigint")).distinct(),
        lambda: _empty(spark, empty),
    )


def unfinished(df: DataFrame, done: DataFrame, column: str = "shard") -> DataFrame:
    """Rows whose part is not written yet."""
    return df.join(done, column, "left_anti")


def write_prompt_shards(df: DataFrame, path: str) -> None:
    """Write rows by their column ``shard``, only the shards that are not there yet.

    The rebalance hint gathers the rows of a shard and splits a shard that is too
    large for one task.
    """
    todo = unfinished(df, finished_parts(df.sparkSession, path))
    (
        todo.hint("rebalance", F.col("shard"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("shard")
        .parquet(path)
    )


def write_manifest(df: DataFrame, path: str, model: str = "model") -> None:
    """Sampled rows of all models as one table, clustered by model.

    Rows of a model lie together, so reading one model skips the files and row groups
    of the others; there is no folder per model, of which there may be many.
    """
    rest = [c for c in df.columns if c != model]
    clustered = df.repartitionByRange(model, *rest).sortWithinPartitions(model, *rest)
    clustered.write.mode("overwrite").parquet(path)


def write_sidecars(df: DataFrame, path: str) -> None:
    """One JSON text per line."""
    df.select("value").write.mode("append").text(path)


def copy_sample(sample: DataFrame, files: DataFrame, path: str) -> DataFrame:
    """Write the sampled rows that have a file; returns the names that have none."""
    names = files.select(F.col("path").alias("filename"))
    sample.join(names, "filename", "left_semi").write.mode("overwrite").parquet(path)
    return sample.join(names, "filename", "left_anti").select("filename")


def write_binary_files(df: DataFrame, folder: str, name: str, content: str) -> int:
    """One file per row on shared storage, written by the tasks; returns how many.

    A file is written under its own name, so a task that runs again writes the same.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        system.create_dir(root, recursive=True)
        for frame in frames:
            for file, data in zip(frame[name], frame[content]):
                with system.open_output_stream(f"{root}/{file}") as out:
                    out.write(data)
            yield pd.DataFrame({"files": [len(frame)]})

    written = df.select(name, content).mapInPandas(run, "files bigint")
    return written.agg(F.sum("files")).first()[0] or 0
