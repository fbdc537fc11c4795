"""SimHash near-duplicates by tiled exact comparison.

Each text gets a 64-bit fingerprint from its four-word shingles. Distinct fingerprints are put in
the order of their population counts (all 64 bits, then the 16-bit quarters) and cut into tiles.
Two fingerprints that differ in at most r bits differ by at most r in the sum of their quarters'
counts, so a pair of tiles whose ranges of counts lie further apart is skipped; of the
other pairs every task compares one, block by block with the same test, with exclusive-or and
bit counts in numpy. What a task finds leaves it as a forest, never as all pairs, and connected
components join the forests. The comparison is exact: no link is lost.

Equal fingerprints are made one before they are compared, so copies cost nothing. The number of
tile pairs grows with the square of the distinct fingerprints, less what the counts rule out;
each pair is a task of bounded size.

Defined results: a null text and one without words have fingerprint zero, which links like any
other. Rows that agree in id and text are one document. The smallest id names a component; null
ids only name components of nulls. A very long text is hashed in parts. An empty table gives no
rows. Columns of any name stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType
from pyspark.sql.window import Window

from medialoom.llm.common import KEY, key_columns, key_order, own_columns, row_hash, same_key, whole_row
from medialoom.llm.components import Forest, components
from medialoom.session import cut_lineage

SHINGLE, RADIUS, SEED = 4, 4, 42
TILE, BLOCK = 32_768, 512
#: Shingles whose bits are counted at once, so that a very long text needs little memory.
PART = 65_536


def shingle_hashes(text: str | None, width: int) -> Iterator[np.ndarray]:
    """Hashes of a text's shingles of ``width`` words, in parts; a shorter text is one shingle."""
    words = text.encode().lower().split() if text else []  # white space and letters of ASCII only
    if not words:
        return
    width = min(width, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-1]])
    n = len(words) - width + 1
    for i in range(0, n, PART):
        pairs = zip(starts[i : min(n, i + PART)].tolist(), (ends[i + width - 1 :] - 1).tolist(), strict=False)
        yield np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in pairs], dtype="<u8")


def fingerprint(text: str | None) -> int:
    """Bits that more than half of the shingles' hashes have; as a signed number."""
    n, counts = 0, np.zeros(64, np.int64)
    for hashes in shingle_hashes(text, SHINGLE):
        n += len(hashes)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits(2 * counts > n, bitorder="little")
    return int(packed.view("<i8")[0])


@F.pandas_udf(LongType())
def fingerprints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in batches:
        yield pd.Series([fingerprint(t) for t in batch], dtype="int64")


def as_hex(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def quarter(column: Column, i: int) -> Column:
    """Population count of one of the four 16-bit parts."""
    return F.bit_count(F.shiftrightunsigned(column, 16 * i).bitwiseAND(F.lit(0xFFFF)))


def tiles(distinct: DataFrame, tile: int = TILE) -> tuple[DataFrame, DataFrame]:
    """(fp, tile) for each fingerprint, and one row per tile with its ranges of counts.

    A cell holds the fingerprints of equal counts: at most 17^4 cells, whatever the input, so the
    running total over cells is small. A cell above the size of a tile is split by hash.
    """
    parts = [quarter(F.col("fp"), i).alias(f"q{i}") for i in range(4)]
    counted = distinct.select("fp", F.bit_count("fp").alias("all"), *parts)
    names = ["all", "q0", "q1", "q2", "q3"]
    running = Window.orderBy(*names).rowsBetween(Window.unboundedPreceding, -1)
    cells = counted.groupBy(*names).agg(F.count(F.lit(1)).alias("n"))
    cells = cells.withColumn("first", F.coalesce(F.sum("n").over(running), F.lit(0)))
    cells = cells.withColumn("start", F.floor(F.col("first") / tile)).withColumn(
        "parts", F.floor((F.col("n") - 1) / tile) + 1
    )
    cells = cut_lineage(cells, "cells")
    placed = counted.join(cells, names).select(
        "fp", (F.col("start") + F.pmod(F.xxhash64("fp"), F.col("parts"))).cast("int").alias("tile")
    )
    ranges = [f(c).alias(f"{k}_{c}") for c in names for k, f in (("low", F.min), ("high", F.max))]
    spans = cells.select(
        "*", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("parts") - 1)).alias("tile")
    )
    return placed, spans.groupBy(F.col("tile").cast("int").alias("tile")).agg(*ranges)


def tile_pairs(spans: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Pairs (tile, other), tile <= other, whose counts don't lie beyond the radius.

    Tiles meet on equal population counts, each widened by the radius on one side.
    """
    left = spans.withColumn("at", F.explode(F.sequence("low_all", F.col("high_all") + radius)))
    right = spans.select(*(F.col(c).alias(f"o_{c}") for c in spans.columns)).withColumn(
        "at", F.explode(F.sequence("o_low_all", F.col("o_high_all") + radius))
    )

    def gap(c: str) -> Column:
        return F.greatest(
            F.col(f"low_{c}") - F.col(f"o_high_{c}"), F.col(f"o_low_{c}") - F.col(f"high_{c}"), F.lit(0)
        )

    near = (gap("all") <= radius) & (sum((gap(f"q{i}") for i in range(4)), F.lit(0)) <= radius)
    met = left.join(right, "at").where((F.col("tile") <= F.col("o_tile")) & near)
    return met.select("tile", F.col("o_tile").alias("other")).distinct()


def counts_of(fps: np.ndarray) -> np.ndarray:
    """Population counts of the whole and of the four quarters, a row for each."""
    quarters = np.bitwise_count(fps.view("<u2").reshape(-1, 4)).astype(np.int16)
    return np.concatenate([quarters.sum(axis=1, keepdims=True), quarters], axis=1)


def compare(left: np.ndarray, right: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Forest of the links within ``left``, or between ``left`` and ``right``."""

    def blocks(fps: np.ndarray):
        counts = counts_of(fps)
        order = np.lexsort(counts.T[::-1])
        fps, counts = fps[order], counts[order]
        at = np.arange(0, len(fps), BLOCK)
        return fps, at, np.minimum.reduceat(counts, at), np.maximum.reduceat(counts, at)

    a, at_a, low_a, high_a = blocks(left)
    b, at_b, low_b, high_b = (a, at_a, low_a, high_a) if right is None else blocks(right)
    shift = 0 if right is None else len(a)
    forest = Forest(shift + len(b))
    for i, start in enumerate(at_a):
        gaps = np.maximum(np.maximum(low_b - high_a[i], low_a[i] - high_b), 0)
        near = (gaps[:, 0] <= radius) & (gaps[:, 1:].sum(axis=1) <= radius)
        if right is None:
            near[:i] = False
        mine = a[start : start + BLOCK]
        for j in np.flatnonzero(near):
            theirs = b[at_b[j] : at_b[j] + BLOCK]
            x, y = np.nonzero(np.bitwise_count(mine[:, None] ^ theirs[None, :]) <= radius)
            if len(x) > (len(mine) if right is None and i == j else 0):
                forest.link(x + start, y + shift + at_b[j])
    low, high = forest.edges()
    both = a if right is None else np.concatenate([a, b])
    return both[low], both[high]


def links(distinct: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Links (a, b) that join all fingerprints (fp) within the radius, directly or in steps."""
    placed, spans = tiles(distinct, tile)
    pairs = tile_pairs(cut_lineage(spans, "spans"), radius)
    seats = pairs.select("tile", "other", F.col("tile").alias("seat")).union(
        pairs.where("tile <> other").select("tile", "other", F.col("other").alias("seat"))
    )
    # a tile travels as one row: an array of at most a few more fingerprints than its size
    packed = placed.groupBy(F.col("tile").alias("seat")).agg(F.collect_list("fp").alias("fps"))
    sent = packed.join(seats, "seat")

    def run(group: pd.DataFrame) -> pd.DataFrame:
        fps = dict(zip(group["seat"], group["fps"], strict=True))
        one, two = group["tile"].iat[0], group["other"].iat[0]
        left, right = (np.asarray(fps[t]).astype("<i8").view("<u8") for t in (one, two))
        a, b = compare(left, None if one == two else right, radius)
        return pd.DataFrame({"a": a.view("<i8"), "b": b.view("<i8")})

    return sent.groupBy("tile", "other").applyInPandas(run, "a long, b long")


def grouped(found: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """``found`` (doc_id, fp, ...) with component_id. Give it a written table: it is read twice."""
    ids = found.groupBy("fp").agg(F.min("doc_id").alias("first"))
    ids = cut_lineage(ids, "distinct")
    joined = components(links(ids.select("fp"), radius, tile))
    named = ids.join(joined.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "component", F.coalesce("component", "fp")
    )
    smallest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    names = named.join(smallest, "component").select(F.col("fp").alias("_of"), "component_id")
    return found.join(names, F.col("fp") == F.col("_of")).drop("_of")


def component_ids(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One row per document: doc_id, fingerprint, component_id."""
    found = docs.select("doc_id", fingerprints("text").alias("fp"))
    rows = grouped(cut_lineage(found, "fingerprints"), radius)
    return rows.select("doc_id", as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def without_copies(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """The first document of each component, by id and then hash of the text, null ids last."""
    found = docs.select(*key_columns(docs), fingerprints("text").alias("fp"))
    found = cut_lineage(found, "fingerprints")
    joined = components(links(cut_lineage(found.select("fp").distinct(), "distinct"), radius))
    return first_of_each(docs, found.withColumnRenamed("fp", "node"), joined)


def first_of_each(docs: DataFrame, found: DataFrame, joined: DataFrame) -> DataFrame:
    """The first document of each component; ``found`` holds the node of each key.

    Of rows that agree in id and text the one whose columns have the smallest hash stays.
    """
    best = (
        found.join(joined, "node", "left")
        .groupBy(F.coalesce("component", "node").alias("component"))
        .agg(F.min(key_order()).alias("best"))
    )
    wanted = best.select(*(F.col("best")[k].alias(f"w{k}") for k in KEY))
    keys = [e.alias(f"k{k}") for k, e in zip(KEY, key_columns(docs), strict=True)]
    keyed = docs.select(whole_row(docs), row_hash(docs).alias("h"), *keys)
    kept = keyed.join(wanted, same_key("k", "w"), "left_semi")
    one = kept.groupBy(*(f"k{k}" for k in KEY)).agg(F.min_by("row", "h").alias("row"))
    return one.select(*own_columns(docs))
