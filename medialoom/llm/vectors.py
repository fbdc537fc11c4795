"""Near-duplicate vectors by randomised binary codes with correction factors.

A vector is scaled to length one, padded and rotated by a random orthogonal matrix; the signs of
the result are its code, and the inner product of the code (as a unit vector) with the rotated
vector is its stored factor. For any other vector, the inner product of the code with that
vector's rotation, divided by the factor, is an unbiased estimate of the cosine, whose deviation
is known from the factor. Pairs whose estimate lies below the threshold by more than ``SURE``
deviations are no links; all others are computed again from the vectors, in double precision.

Equal vectors are made one first. The distinct ones are dealt by hash to tiles of bounded size,
and every task compares one pair of tiles; it returns the number of links of each vector and a
forest of them, never the pairs. So all vectors are compared with all, in blocks; the work grows
with the square of the distinct vectors, and the bound on a task's memory does not.

Defined results: a vector that is null, empty, zero, or holds a null or non-finite component
links with nothing; neither do vectors of different length. Components may be as large or as
small as doubles can be. Repeated rows are vectors of their
own that link with each other. The smallest id names a component; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

from medialoom.llm.components import Forest, components
from medialoom.session import cut_lineage

THRESHOLD = 0.9
#: Deviations below the threshold from which a pair is left out without being computed.
SURE = 4.75
TILE, BLOCK, PAIRS, SEED = 8192, 512, 65_536, 7


def code_bits(dimension: int) -> int:
    return max(128, -(-dimension // 64) * 64)


@cache
def rotation(dimension: int) -> np.ndarray:
    """bits x dimension: the columns of a random orthogonal matrix that a padded vector meets."""
    rng = np.random.default_rng([SEED, dimension])
    q, r = np.linalg.qr(rng.standard_normal((code_bits(dimension),) * 2))
    return np.ascontiguousarray((q * np.sign(np.diag(r)))[:, :dimension])


def usable(vector) -> np.ndarray | None:
    """As doubles; None if it can't have a cosine."""
    if vector is None or len(vector) == 0:
        return None
    found = np.asarray([np.nan if x is None else x for x in vector] if None in vector else vector, float)
    return found + 0.0 if np.isfinite(found).all() and found.any() else None


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length one; divided by their largest component first, so that no square is lost."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt(np.einsum("ij,ij->i", vectors, vectors))[:, None]


def encode(vector: np.ndarray) -> tuple[bytes, float]:
    """Code and factor of a vector."""
    turned = rotation(len(vector)) @ unit(vector[None])[0]
    return np.packbits(turned > 0).tobytes(), float(np.abs(turned).sum() / np.sqrt(len(turned)))


CODED = StructType(
    [
        StructField("key", StringType()),
        StructField("width", IntegerType()),
        StructField("code", BinaryType()),
        StructField("factor", DoubleType()),
        StructField("data", BinaryType()),
    ]
)


@F.pandas_udf(CODED)
def encoded(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for given in batch:
            vector = usable(given)
            if vector is None:
                rows.append((None, 0, None, 0.0, None))
            else:
                data = vector.tobytes()
                rows.append((hashlib.md5(data).hexdigest(), len(vector), *encode(vector), data))
        yield pd.DataFrame(rows, columns=CODED.names, dtype=object)


class Tile:
    """Vectors of one tile, with what the estimates need."""

    def __init__(self, group: pd.DataFrame):
        self.n = len(group)
        self.key, self.times = group["key"].to_numpy(), group["times"].to_numpy()
        width = int(group["width"].iat[0])
        self.unit = unit(np.frombuffer(b"".join(group["data"])).reshape(self.n, width))
        bits = np.unpackbits(np.frombuffer(b"".join(group["code"]), np.uint8)).reshape(self.n, -1)
        self.signs = 2 * bits.astype(np.float32) - 1
        self.factor = group["factor"].to_numpy()

    def turned(self) -> np.ndarray:
        return (self.unit @ rotation(self.unit.shape[1]).T).astype(np.float32)


def compare(a: Tile, b: Tile | None, threshold: float) -> pd.DataFrame:
    """Links within ``a``, or between both: (node, other, n) with the forest and the numbers."""
    other = a if b is None else b
    shift = 0 if b is None else a.n
    times = a.times if b is None else np.concatenate([a.times, b.times])
    found, forest = np.zeros(len(times)), Forest(len(times))
    turned, width = other.turned(), a.signs.shape[1]
    # estimate = signs . turned / (sqrt(width) * factor), deviation sqrt(1 - factor^2) / factor / sqrt(width - 1)
    deviation = np.sqrt(np.maximum(0, 1 - a.factor**2)) / a.factor / np.sqrt(width - 1)
    least = ((threshold - SURE * deviation) * a.factor * np.sqrt(width)).astype(np.float32)
    for i in range(0, a.n, BLOCK):
        rest = i if b is None else 0
        near = a.signs[i : i + BLOCK] @ turned[rest:].T >= least[i : i + BLOCK, None]
        x, y = np.nonzero(near)
        x, y = x + i, y + rest
        if b is None:
            x, y = x[y > x], y[y > x]
        for k in range(0, len(x), PAIRS):
            p, q = x[k : k + PAIRS], y[k : k + PAIRS]
            linked = np.einsum("ij,ij->i", a.unit[p], other.unit[q]) >= threshold
            p, q = p[linked], q[linked] + shift
            found += np.bincount(p, times[q], len(times)) + np.bincount(q, times[p], len(times))
            forest.link(p, q)
    keys = a.key if b is None else np.concatenate([a.key, b.key])
    low, high = forest.edges()
    some = np.flatnonzero(found)
    return pd.DataFrame(
        {
            "node": np.concatenate([keys[low], keys[some]]),
            "other": np.concatenate([keys[high], np.full(len(some), None)]),
            "n": np.concatenate([np.zeros(len(low), np.int64), found[some].astype(np.int64)]),
        },
        dtype=object,
    )


def near_duplicates(
    vectors: DataFrame, threshold: float = THRESHOLD, tile: int = TILE
) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding): n_links, component_id, kept."""
    rows = vectors.select("vec_id", encoded("embedding").alias("e")).select("vec_id", "e.*")
    rows = cut_lineage(rows, "codes")
    usable_rows = rows.where("key is not null")
    distinct = usable_rows.groupBy("key").agg(
        F.count(F.lit(1)).alias("times"), F.min("vec_id").alias("first"),
        *(F.first(c).alias(c) for c in ("width", "code", "factor", "data")),
    )
    distinct = cut_lineage(distinct, "distinct")
    parts = -(-distinct.count() // tile) or 1
    dealt = distinct.drop("first").withColumn(
        "seat", F.pmod(F.xxhash64("key"), F.lit(parts)).cast("int")
    )
    others = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("o")
    sent = dealt.select("*", others).select(
        *dealt.columns, F.least("seat", "o").alias("one"), F.greatest("seat", "o").alias("two")
    )

    def run(group: pd.DataFrame) -> pd.DataFrame:
        first = group["seat"] == group["one"]
        alone = group["one"].iat[0] == group["two"].iat[0]
        if not alone and (first.all() or not first.any()):
            return pd.DataFrame({"node": [], "other": [], "n": []}, dtype=object)
        return compare(Tile(group[first]), None if alone else Tile(group[~first]), threshold)

    result = sent.groupBy("width", "one", "two").applyInPandas(
        run, "node string, other string, n long"
    )
    result = cut_lineage(result, "found")
    joined = components(result.select(F.col("node").alias("a"), F.col("other").alias("b")))
    numbers = result.where("other is null").groupBy(F.col("node").alias("key")).agg(
        F.sum("n").alias("n")
    )
    named = (
        distinct.select("key", "times", "first")
        .join(joined.withColumnRenamed("node", "key"), "key", "left")
        .join(numbers, "key", "left")
        .withColumn("component", F.coalesce("component", "key"))
    )
    smallest = named.groupBy("component").agg(F.min("first").alias("smallest"))
    names = named.join(smallest, "component").select(
        "key", "smallest", (F.coalesce("n", F.lit(0)) + F.col("times") - 1).alias("n_links")
    )
    component = F.coalesce("smallest", "vec_id")
    return rows.select("vec_id", "key").join(names, "key", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
