"""The corpus pipeline: documents through five stages, each written before the next begins."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medialoom.llm import byte_bpe, lines, mixing, near_copies, quality
from medialoom.llm.common import read, replace_columns
from medialoom.session import cut_lineage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the log-likelihood ratio."""
    judged = quality.judge(docs, read(spark, sf_dir, "labels"))
    return judged.where("kept").select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated windows of lines; n_chars follows where a text has changed."""
    cleaned = lines.without_repeats(docs)
    changed = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
    return replace_columns(cleaned, {"n_chars": changed.cast("long")}).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose five-word shingles agree to 0.8 or more."""
    return near_copies.without_near_copies(docs).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix(docs).select(*COLUMNS)


def byte_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of each text, and the digests of the ids and of what they decode to."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    found = byte_bpe.digests(docs, ranks, public_tokenizers.PATTERN)
    return found.select(
        "doc_id", "lang", "source", "n_chars", "n_tokens", "ids_sha256", "decoded_sha256"
    )


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_dedup),
    ("mixing sources", mix_sources),
    ("byte-level BPE", byte_encoding),
]

#: SimHash fingerprints, the cube method and byte pairs are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result but the last is written and read again."""
    docs = read(spark, sf_dir, "documents").select(*COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
