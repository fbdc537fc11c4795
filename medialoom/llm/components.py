"""Connected components of a table of links, and a forest over the rows of one task."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medialoom.session import cut_lineage


class Forest:
    """Unions over 0..n-1, many links at a time; a root is the smallest of its tree."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def link(self, left: np.ndarray, right: np.ndarray) -> None:
        while True:
            a, b = self.root[left], self.root[right]
            apart = a != b
            if not apart.any():
                return
            left, right, a, b = left[apart], right[apart], a[apart], b[apart]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            while not np.array_equal(up := self.root[self.root], self.root):
                self.root = up

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """A link from every row that is not a root to its root."""
        low = np.flatnonzero(self.root != np.arange(len(self.root)))
        return low, self.root[low]


def components(links: DataFrame) -> DataFrame:
    """(node, component) of ``links`` (a, b): a component is its smallest node, which has no row
    of its own.

    Alternating stars: every node hands its larger neighbours, then its smaller ones, to the
    smallest; rounds until the table of links stays the same, a logarithmic number. Each round
    is written to the shared folder, so no lineage grows; nodes with many neighbours are
    aggregated before the shuffle and their joins can be split. Links with null ends are left out.
    """
    links = links.where("a is not null and b is not null and a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    links = cut_lineage(links.distinct(), "links")
    state = _state(links)
    while state[0]:
        around = links.union(links.select(F.col("b"), F.col("a")))
        low = around.groupBy(F.col("a").alias("c")).agg(F.min("b").alias("low"))
        low = low.select("c", F.least("c", "low").alias("low"))
        large = around.join(low, F.col("a") == F.col("c")).where("b > a").select(
            F.col("b").alias("a"), F.col("low").alias("b")
        )  # larger neighbours of a go to the smallest around it
        large = large.distinct()
        least = large.groupBy(F.col("a").alias("c")).agg(F.min("b").alias("low"))
        small = large.join(least, F.col("a") == F.col("c"))
        small = small.select(F.col("b").alias("a"), F.col("low").alias("b")).union(
            least.select("c", "low")
        )
        links = cut_lineage(small.where("a <> b").distinct(), "links")
        before, state = state, _state(links)
        if state == before:
            break
    return links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))


def _state(links: DataFrame) -> tuple:
    check = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(links.agg(F.count(F.lit(1)), check).head())
