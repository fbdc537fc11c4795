"""What several operators share: words, binding of values in expressions, row keys, results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space between words, and a word.
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once for a row, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def word_count(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


#: Identity of a document row: rows that agree in id and text are one document.
KEY = ["_id", "_digest"]


def key_columns(docs: DataFrame) -> list[Column]:
    """The key of each row: its id and 64 bits of its text, which only have to tell apart the
    texts of one id. Nulls have a key of their own."""
    return [F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_digest")]


def key_order() -> Column:
    """Order of documents by their key; null ids come last."""
    return F.struct(F.col("_id").isNull().alias("absent"), *KEY)


def same_key(left: str, right: str) -> Column:
    """Join condition of two sides whose keys have these prefixes."""
    same = [F.col(left + k).eqNullSafe(F.col(right + k)) for k in KEY]
    return same[0] & same[1]


def replace_columns(docs: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Adds the columns at the end; columns of the input that have these names give way."""
    taken = {name.lower() for name in columns}
    rest = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in taken]
    return docs.select(*rest, *(value.alias(name) for name, value in columns.items()))


def whole_row(docs: DataFrame) -> Column:
    """All columns of a row as one, named ``row``: helper columns beside it can't clash with any."""
    return F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")


def own_columns(docs: DataFrame, results: tuple | list = ()) -> list[Column]:
    """The columns of ``row`` again, but for those that are named like results."""
    taken = {name.lower() for name in results}
    return [F.col("row")[c].alias(c) for c in docs.columns if c.lower() not in taken]


def row_hash(docs: DataFrame) -> Column:
    """64 bits of all columns of a row."""
    return F.xxhash64(*(F.col(f"`{c}`") for c in docs.columns))
