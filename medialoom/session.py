"""Sessions and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


_watched: list[list[str]] = []  # scratch folders of the open ``scratch_removed`` blocks


def local_session(cpus: int | str = "*", **options: str) -> SparkSession:
    """Session for tests and benches on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("medialoom")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("MEDIALOOM_DRIVER_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in options.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below the shared checkpoint folder of the cluster.

    Only a local session without that setting gets a folder of its own machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="medialoom-")
        spark.conf.set("spark.checkpoint.dir", base)
    folder = f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"
    for folders in _watched:
        folders.append(folder)
    return folder


@contextmanager
def scratch_removed(spark: SparkSession) -> Iterator[None]:
    """Removes the tables that operators have written to the scratch folder inside the block.

    A result reads them until it has been written, so write it inside the block. They are
    removed after a failure too; tables from before the block stay.
    """
    folders: list[str] = []
    _watched.append(folders)
    try:
        yield
    finally:
        # by identity: two open blocks may hold equal lists
        _watched[:] = [other for other in _watched if other is not folders]
        for folder in folders:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def cut_lineage(df, purpose: str = "cut"):
    """Write the rows to the shared folder and go on from the written table."""
    folder = scratch_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
