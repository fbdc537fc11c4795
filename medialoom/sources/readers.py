"""Readers for every stored table. An absent file reads as an empty table."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medialoom import schemas
from medialoom.functions.columns import base_name

# Texts as Python's csv module writes them: quotes doubled, line breaks inside quotes.
CSV_OPTIONS = {"header": True, "multiLine": True, "quote": '"', "escape": '"'}
# The annotation tables hold no line breaks, so a large file is read by many tasks.
LINE_OPTIONS = {**CSV_OPTIONS, "multiLine": False}


def _if_there(read, empty) -> DataFrame:
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return empty()
        raise


def _empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


def with_file_order(df: DataFrame) -> DataFrame:
    """File, start of the scanned block and row as ``ord``: the order in which rows were stored.

    All of it comes from the scan, so it is the same however the rows are spread later.
    """
    return df.withColumn(
        "ord",
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ),
    )


def read_csv(spark: SparkSession, path: str, schema: str, na_values: str | None = None, **options) -> DataFrame:
    """CSV with a header and a given schema; only empty fields are null unless told otherwise."""
    settings = {**CSV_OPTIONS, **options}
    if na_values is not None:
        settings["nullValue"] = na_values
    return _if_there(
        lambda: spark.read.schema(schema).options(**settings).csv(path),
        lambda: _empty(spark, schema),
    )


def read_metadata(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Metadata table of one kind: generated, inpaint or posts."""
    return read_csv(spark, path, schemas.METADATA[kind], enforceSchema=False)


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Parquet table that this package wrote."""
    return _if_there(
        lambda: spark.read.schema(schema).parquet(path), lambda: _empty(spark, schema)
    )


def read_version(
    spark: SparkSession, path: str, schema: str, below: int | None = None
) -> DataFrame:
    """Newest version of a versioned table, or the newest below a number."""
    table = _if_there(
        lambda: spark.read.schema(f"{schema}, version bigint").parquet(path),
        lambda: _empty(spark, f"{schema}, version bigint"),
    )
    if below is not None:
        table = table.filter(F.col("version") < below)
    newest = table.agg(F.max("version").alias("v")).scalar()
    return table.filter(F.col("version") == newest).drop("version")


def read_prompt_pool(spark: SparkSession, path: str) -> DataFrame:
    """Column prompt of a CSV, null rows dropped."""
    table = spark.read.options(**CSV_OPTIONS).csv(path)
    return table.select("prompt").na.drop()


def read_prompt_shards(spark: SparkSession, pattern: str) -> DataFrame:
    """All shard CSVs as one table with the name of their shard."""
    table = read_csv(spark, pattern, schemas.PROMPT_ROWS)
    return table.withColumn(
        "shard_name", F.regexp_replace(base_name(F.input_file_name()), r"\.csv$", "")
    )


def read_classes(spark: SparkSession, path: str) -> DataFrame:
    """Label and class name of a CSV without a header, with the file order."""
    return with_file_order(read_csv(spark, path, schemas.CLASSES, header=False, multiLine=False))


def read_segmentations(spark: SparkSession, path: str) -> DataFrame:
    """The three used columns of the segmentation table, with the file order."""
    table = spark.read.options(**LINE_OPTIONS).csv(path)
    return with_file_order(table).select("ImageID", "MaskPath", "LabelName", "ord")


def read_relationships(spark: SparkSession, path: str) -> DataFrame:
    """Relationships; the relation column has one of two names; absent file: empty."""
    empty = "ImageID string, LabelName1 string, LabelName2 string, RelationshipLabel string, ord struct<file:string,block:bigint,row:bigint>"

    def read() -> DataFrame:
        table = spark.read.options(**LINE_OPTIONS).csv(path)
        if "RelationshipLabel" not in table.columns:
            table = table.withColumnRenamed("RelationLabel", "RelationshipLabel")
        return with_file_order(table).select(
            "ImageID", "LabelName1", "LabelName2", "RelationshipLabel", "ord"
        )

    return _if_there(read, lambda: _empty(spark, empty))


def read_narratives(spark: SparkSession, path: str) -> DataFrame:
    """Captions from JSON lines, with the file order."""
    table = _if_there(
        lambda: with_file_order(spark.read.schema(schemas.NARRATIVES).json(path)),
        lambda: _empty(spark, schemas.NARRATIVES + ", ord struct<file:string,block:bigint,row:bigint>"),
    )
    return table


def registry_rows(text: DataFrame) -> DataFrame:
    """Rows of a registry object in column ``value``, with their place in the object."""
    entries = F.map_entries(
        F.from_json("value", f"map<string, struct<{_ddl_fields(schemas.REGISTRY_ENTRY)}>>")
    )
    rows = text.select(F.posexplode(entries).alias("ord", "e"))
    return rows.select(
        F.col("e.key").alias("model_id"), "e.value.*", F.col("ord").cast("bigint").alias("ord")
    )


def _ddl_fields(ddl: str) -> str:
    return ", ".join(f.strip().replace(" ", ": ", 1) for f in ddl.split(","))


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """One JSON object of model entries as rows."""
    return _if_there(
        lambda: registry_rows(spark.read.text(path, wholetext=True)),
        lambda: _empty(spark, schemas.REGISTRY),
    )


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """Stored catalogue entries, one JSON object per line."""
    table = _if_there(
        lambda: spark.read.schema(schemas.CATALOGUE).json(path),
        lambda: _empty(spark, schemas.CATALOGUE),
    )
    return table.select(
        "id",
        "tags",
        F.col("cardData.base_model").alias("base_model"),
        "pipeline_tag",
        "downloads",
        "created_at",
        F.transform("siblings", lambda s: s["rfilename"]).alias("files"),
    )


def read_posts(spark: SparkSession, path: str) -> DataFrame:
    """Stored posts as JSON lines; the epoch becomes a timestamp."""
    table = _if_there(
        lambda: spark.read.schema(schemas.POSTS).json(path), lambda: _empty(spark, schemas.POSTS)
    )
    return table.withColumn("created_utc", F.timestamp_seconds("created_utc"))


def names_in_array(text: DataFrame) -> DataFrame:
    """Names of a JSON array in column ``value``."""
    return text.select(F.explode(F.from_json("value", "array<string>")).alias("name"))


def read_upload_tracker(spark: SparkSession, path: str) -> DataFrame:
    """JSON array of uploaded file names as rows."""
    return _if_there(
        lambda: names_in_array(spark.read.text(path, wholetext=True)),
        lambda: _empty(spark, schemas.UPLOADED),
    )


def read_feed_pages(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Stored feed pages, one JSON document per file or, with ``lines``, per line.

    What is no JSON reads as null. Every file costs a listing entry and an opening, so pages
    that are many and small are better stored as lines.
    """
    table = spark.read.text(path, wholetext=not lines)
    return table.select(
        F.col("_metadata.file_path").alias("path"), F.try_parse_json("value").alias("page")
    )


def list_files(
    spark: SparkSession, folder: str, extensions: list[str], ignore_case: bool = False
) -> DataFrame:
    """Names and sizes of the files of a folder; the bytes are never read."""
    if ignore_case:
        extensions = ["".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in e) for e in extensions]
    pattern = "{" + ",".join(f"*{e}" for e in extensions) + "}"
    found = _if_there(
        lambda: spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder),
        lambda: _empty(spark, "path string, length bigint"),
    )
    return found.select(base_name(F.col("path")).alias("path"), "length", F.col("path").alias("location"))


def read_images(spark: SparkSession, folder: str, extensions: list[str] = (".png",)) -> tuple[DataFrame, DataFrame]:
    """Decoded images, and the names of the files that could not be decoded."""
    decoded = (
        spark.read.format("image").option("dropInvalid", True).load(folder).select("image.*")
    )
    images = decoded.select(
        base_name(F.col("origin")).alias("path"), "height", "width", "nChannels", "data"
    )
    files = list_files(spark, folder, list(extensions))
    broken = files.join(images.select("path"), "path", "left_anti").select("path")
    return images, broken
