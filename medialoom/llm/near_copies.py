"""Near copies for the corpus: SimHash finds the pairs, their shingle sets decide.

Two texts are linked if the Jaccard similarity of their sets of five-word shingles is 0.8 or more.

Sets of at least ``SMALL`` shingles get a SimHash fingerprint of 256 bits. At a similarity of 0.8 two
fingerprints differ in 39 bits on average, with a deviation of 6, unrelated ones in 128 with a
deviation of 8: the radius of 72 lies five deviations and more from both. Bits of small sets
depend on one another, so **small sets are linked exactly**: two sets as similar as that share one
of the first ``n - ceil(0.8 n) + 1`` of their hashes, in any common order; the rarest come first. The
sets up to ``SMALL / 0.8`` shingles meet that way, so a pair needs the fingerprints only if both its
sets have ``SMALL`` shingles.

Equal sets are one node. Nodes are put in the order of their sizes and cut into tiles of bounded
nodes and shingles; tiles whose sizes rule out the similarity never meet (their population counts
would rule out nothing at this radius). One pass over the pairs of tiles finds the nodes with a
neighbour within the radius; only their sets go through the second, which checks the pairs that its
forest has not joined already, so a large group of near copies costs no check of all its pairs.
Small sets travel with their tiles. Connected components join the forests.

Defined results: texts without words, null ones too, are copies of each other. A text of less than
five words is one shingle. Of each group the first document stays, by id and then by a hash of its
text; null ids come last. Of rows that agree in id and text the one whose columns have the smallest
hash stays. A very long text is hashed in parts; its set is held by one task. An empty table gives no
rows. Columns of any name stay. The number of tile pairs grows with the square of the nodes of
like size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType
from pyspark.sql.window import Window

from medialoom.llm.common import KEY, key_columns, key_order, same_key
from medialoom.llm.components import components
from medialoom.llm.simhash import first_of_each, shingle_hashes
from medialoom.session import cut_lineage

SHINGLE, SIMILARITY = 5, 0.8
WORDS, RADIUS = 4, 72  # fingerprint in words of 64 bits
#: Shingles from which fingerprints find the pairs; sets up to this over SIMILARITY meet exactly.
SMALL = 64
#: A tile has at most so many nodes and, beyond one node, about so many shingles.
TILE, TILE_SHINGLES, BLOCK = 16_384, 6_000_000, 512
#: Sizes within a factor of this are one cell.
STEP = 1.02
PART = 16_384
SALTS = np.array([0x9E3779B97F4A7C15, 0xD1B54A32D192ED03, 0x8CB92BA72F3D8DD7, 0xAEF17502108EF2D9], "<u8")


def shingle_set(text: str | None) -> np.ndarray:
    """Distinct hashes of the shingles, in order."""
    parts = [np.unique(p) for p in shingle_hashes(text, SHINGLE)]
    return np.unique(np.concatenate(parts)) if parts else np.empty(0, "<u8")


def hash_bits(hashes: np.ndarray) -> np.ndarray:
    """256 bits of each hash, a row for each."""
    x = hashes[:, None] ^ SALTS
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return np.unpackbits(x.view(np.uint8).reshape(len(x), -1), axis=1, bitorder="little")


def fingerprint(hashes: np.ndarray) -> bytes:
    """Bits that more than half of a set's hashes have; the smallest hash settles ties."""
    if not len(hashes):
        return bytes(8 * WORDS)
    counts = hash_bits(hashes[:1])[0].astype(np.int64)
    for i in range(0, len(hashes), PART):
        counts += 2 * hash_bits(hashes[i : i + PART]).sum(axis=0, dtype=np.int64)
    return np.packbits(counts > len(hashes), bitorder="little").tobytes()


def meets_exactly(n: int) -> bool:
    return 4 <= n <= SMALL / SIMILARITY


@F.pandas_udf(
    StructType([
        StructField("node", BinaryType()), StructField("n", LongType()), StructField("fp", BinaryType()),
        StructField("hashes", BinaryType()),
    ])
)
def signatures(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for text in batch:
            hashes = shingle_set(text)
            small = hashes.tobytes() if meets_exactly(len(hashes)) else None
            rows.append((xxhash.xxh3_128_digest(hashes.tobytes()), len(hashes), fingerprint(hashes), small))
        yield pd.DataFrame(rows, columns=["node", "n", "fp", "hashes"])


@F.pandas_udf(BinaryType())
def shingle_sets(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in batches:
        yield pd.Series([shingle_set(t).tobytes() for t in batch], dtype=object)


def tiles(nodes: DataFrame, tile: int = TILE) -> tuple[DataFrame, DataFrame]:
    """The nodes with their tile, as ``seat``, and one row per tile with its range of cells.

    Some thousand cells hold any sizes, so the running total over them is small. A cell above the
    size of a tile is split by hash.
    """
    celled = nodes.withColumn("cell", F.floor(F.log(F.col("n")) / float(np.log(STEP))))
    weight = F.greatest(F.lit(1.0 / tile), F.col("n") / float(TILE_SHINGLES))
    cells = celled.groupBy("cell").agg(F.sum(weight).alias("weight"))
    running = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("start", F.floor(F.coalesce(F.sum("weight").over(running), F.lit(0.0))))
    cells = cut_lineage(cells.withColumn("parts", F.ceil("weight")), "cells")
    seat = (F.col("start") + F.pmod(F.xxhash64("node"), F.col("parts"))).cast("int")
    placed = celled.join(cells, "cell").select(*nodes.columns, seat.alias("seat"))
    spans = cells.select("cell", F.explode(F.sequence("start", F.col("start") + F.col("parts") - 1)).alias("at"))
    return placed, spans.groupBy(F.col("at").cast("int").alias("tile")).agg(
        F.min("cell").alias("low"), F.max("cell").alias("high")
    )


def tile_pairs(spans: DataFrame) -> DataFrame:
    """Pairs (tile, other), tile <= other, whose sizes allow the similarity."""
    reach = int(np.ceil(-np.log(SIMILARITY) / np.log(STEP))) + 1
    left = spans.withColumn("at", F.explode(F.sequence("low", F.col("high") + reach)))
    right = spans.select(F.col("tile").alias("other"), F.explode(F.sequence("low", F.col("high") + reach)).alias("at"))
    return left.join(right, "at").where("tile <= other").select("tile", "other").distinct()


def neighbours(n: np.ndarray, fps: np.ndarray, split: int | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of positions within the radius whose sizes allow the similarity, block by block.

    With ``split``, pairs between the positions before it and the others, else all pairs.
    """
    left = np.argsort(n[:split], kind="stable")
    right = left if split is None else split + np.argsort(n[split:], kind="stable")
    for i in range(0, len(left), BLOCK):
        a = left[i : i + BLOCK]
        for j in range(i if split is None else 0, len(right), BLOCK):
            b = right[j : j + BLOCK]
            if n[a[-1]] < SIMILARITY * n[b[0]] - 1e-6:
                break
            if n[b[-1]] < SIMILARITY * n[a[0]] - 1e-6:
                continue
            apart = np.zeros((len(a), len(b)), np.uint16)
            for k in range(WORDS):
                apart += np.bitwise_count(fps[a, k][:, None] ^ fps[b, k][None, :])
            x, y = np.nonzero(apart <= RADIUS)
            if split is None and i == j:
                x, y = x[x < y], y[x < y]
            if len(x):
                x, y = a[x], b[y]
                able = np.minimum(n[x], n[y]) >= SIMILARITY * np.maximum(n[x], n[y]) - 1e-6
                yield x[able], y[able]


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets, in order, have the similarity."""
    common = int((b[np.minimum(b.searchsorted(a), len(b) - 1)] == a).sum())
    return common >= SIMILARITY * (len(a) + len(b) - common) - 1e-6


def words_of(fps: list) -> np.ndarray:
    return np.frombuffer(b"".join(fps), "<u8").reshape(-1, WORDS)


def with_neighbour(group: pd.DataFrame) -> pd.DataFrame:
    """Of one pair of tiles, the nodes with a neighbour."""
    one, two = int(group["tile"].iat[0]), int(group["other"].iat[0])
    parts = dict(zip(group["seat"].tolist(), group["nodes"], strict=True))
    rows = [r for t in sorted({one, two}) for r in parts[t]]
    n, fps = np.array([r["n"] for r in rows]), words_of([r["fp"] for r in rows])
    near = np.zeros(len(rows), bool)
    for x, y in neighbours(n, fps, None if one == two else len(parts[one])):
        near[x] = near[y] = True
    nodes = [rows[i]["node"] for i in np.flatnonzero(near)]
    return pd.DataFrame({"tile": one, "other": two, "node": pd.Series(nodes, dtype=object)})


class Trees:
    """Unions of single pairs over 0..n-1; a root is the smallest of its tree."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = i = up[up[i]]
        return i

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """A link from every place that is not a root to its root."""
        root = np.array([self.root(i) for i in range(len(self.up))], np.int64)
        low = np.flatnonzero(root != np.arange(len(root)))
        return low, root[low]


def forest_of(pairs: Iterator[tuple[np.ndarray, np.ndarray]], sets: list[np.ndarray]) -> Trees:
    """Joins the pairs whose sets are alike; pairs that are joined already are not checked."""
    trees = Trees(len(sets))
    for x, y in pairs:
        for a, b in zip(x.tolist(), y.tolist(), strict=True):
            if trees.root(a) != trees.root(b) and alike(sets[a], sets[b]):
                trees.join(a, b)
    return trees


def checked(group: pd.DataFrame) -> pd.DataFrame:
    """Forest of the links of one pair of tiles."""
    one, two = int(group["tile"].iat[0]), int(group["other"].iat[0])
    group = group.sort_values(["seat", "node"], ignore_index=True)
    n, fps = group["n"].to_numpy(), words_of(group["fp"].tolist())
    sets = [np.frombuffer(s, "<u8") for s in group["hashes"]]
    pairs = neighbours(n, fps, None if one == two else int((group["seat"] == one).sum()))
    low, high = forest_of(pairs, sets).edges()
    nodes = group["node"].to_numpy()
    return pd.DataFrame({"a": nodes[low], "b": nodes[high]})


def prefix_pairs(sets: list[np.ndarray], split: int | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs that may be alike: those that share one of the first hashes of both, rarest first.

    With ``split``, pairs between the places before it and the others, else all pairs.
    """
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    hashes, place, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    order = np.lexsort([place, times[place], owner])
    rank = np.arange(len(order)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    first = sizes - np.ceil(SIMILARITY * sizes - 1e-6).astype(int) + 1
    picked = order[rank < first[owner[order]]]
    by_hash = picked[np.lexsort([owner[picked], place[picked]])]
    own, key = owner[by_hash], place[by_hash]
    for members in np.split(own, np.flatnonzero(np.diff(key)) + 1):
        if len(members) < 2:
            continue
        left = members if split is None else members[members < split]
        right = members if split is None else members[members >= split]
        for i in range(0, len(left), BLOCK):
            for j in range(i if split is None else 0, len(right), BLOCK):
                x, y = (m.ravel() for m in np.meshgrid(left[i : i + BLOCK], right[j : j + BLOCK], indexing="ij"))
                able = np.minimum(sizes[x], sizes[y]) >= SIMILARITY * np.maximum(sizes[x], sizes[y]) - 1e-6
                able &= x < y
                if able.any():
                    yield x[able], y[able]


def exactly(group: pd.DataFrame) -> pd.DataFrame:
    """Forest of the links of one pair of tiles of small sets."""
    one, two = int(group["tile"].iat[0]), int(group["other"].iat[0])
    parts = dict(zip(group["seat"].tolist(), group["nodes"], strict=True))
    rows = [r for t in sorted({one, two}) for r in parts[t]]
    sets = [np.frombuffer(r["hashes"], "<u8") for r in rows]
    low, high = forest_of(prefix_pairs(sets, None if one == two else len(parts[one])), sets).edges()
    nodes = np.array([r["node"] for r in rows], object)
    return pd.DataFrame({"a": nodes[low], "b": nodes[high]})


def meetings(nodes: DataFrame, columns: list[str], tile: int):
    """Tiles of the nodes, and (tile, other, seat, nodes): the two tiles of each pair, packed."""
    placed, spans = tiles(cut_lineage(nodes, "nodes"), tile)
    placed, pairs = cut_lineage(placed, "placed"), tile_pairs(cut_lineage(spans, "spans"))
    seats = pairs.select("tile", "other", F.col("tile").alias("seat")).union(
        pairs.where("tile <> other").select("tile", "other", F.col("other").alias("seat"))
    )
    packed = placed.groupBy("seat").agg(F.collect_list(F.struct(*columns)).alias("nodes"))
    return placed, packed.join(seats, "seat").groupBy("tile", "other")


def small_links(found: DataFrame, tile: int = TILE) -> DataFrame:
    """Links (a, b) that join all nodes of small sets with the similarity, directly or in steps."""
    nodes = found.where("hashes is not null").groupBy("node").agg(F.min("n").alias("n"), F.min("hashes").alias("hashes"))
    _, sent = meetings(nodes, ["node", "hashes"], tile)
    return sent.applyInPandas(exactly, "a binary, b binary")


def links(docs: DataFrame, found: DataFrame, tile: int = TILE) -> DataFrame:
    """Links (a, b) that join all nodes of ``found`` with the similarity, directly or in steps."""
    # smaller sets meet exactly; below four shingles only equal ones are similar enough
    nodes = found.where(F.col("n") >= SMALL).groupBy("node").agg(
        F.min("n").alias("n"), F.min("fp").alias("fp"), F.min(key_order()).alias("best")
    )
    placed, sent = meetings(nodes, ["node", "n", "fp"], tile)
    near = cut_lineage(sent.applyInPandas(with_neighbour, "tile int, other int, node binary"), "near")
    wanted = placed.join(near.select("node").distinct(), "node").select(
        "node", "n", "fp", "seat", *(F.col("best")[k].alias(f"_w{k}") for k in KEY)
    )
    texts = docs.select(*key_columns(docs), "text").join(wanted, same_key("", "_w")).dropDuplicates(["node"])
    sets = cut_lineage(texts.select("node", "n", "fp", "seat", shingle_sets("text").alias("hashes")), "sets")
    return near.join(sets, "node").groupBy("tile", "other").applyInPandas(checked, "a binary, b binary")


def without_near_copies(docs: DataFrame, tile: int = TILE) -> DataFrame:
    """The first document of each component, by id and then hash of the text, null ids last."""
    found = docs.select(*key_columns(docs), signatures("text").alias("s")).select(*KEY, "s.*")
    found = cut_lineage(found, "signatures")
    joined = components(links(docs, found, tile).union(small_links(found, tile)))
    return first_of_each(docs, found.select(*KEY, "node"), joined)
