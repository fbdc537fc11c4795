"""Mixing sources to target weights by the cube method of balanced sampling.

A source's target divided by its size says how often each of its documents is wanted: the
whole part is taken for sure, the fraction is the document's inclusion probability. In the
flight phase the probabilities of three documents at a time move along the null space of the
two balancing constraints, the token and the document total, until one of them is 0 or 1;
the direction of each move keeps all expectations. At the end of a block at most two are
undecided. They meet the undecided of the other blocks of their source, and so on, until one
block of each source is left, whose last two are decided by the landing: the outcome that
keeps the expected number of tokens best. Draws are hashes of ids, so reruns agree.

A source may hold any share of all documents: it is split into blocks of bounded size, and only
(id, source, size, hash of the text) goes through the shuffle.

Rows that agree in these are one unit. A unit of n rows takes the whole part of n times the chance
for sure; only what is left, a fraction of one row, goes into the flight. So many of its rows, in
any order, are taken once more than the others.

Defined results: a null text has size 0; documents of size 0 are taken as often as their source
says, by document total alone. A null source is a source of its own, the last.
An empty table, and a mix of total size 0, give targets 0. Documents of a source without words (target 0) are not taken.
Very long texts count like others; only their size travels. Columns of any name stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from medialoom.llm.common import own_columns, row_hash, whole_row, word_count
from medialoom.session import cut_lineage

WEIGHTS = (5, 2, 1)
MOST_TIMES = 3
BLOCK = 8192
#: Rows of one unit that a task numbers or expands.
CHUNK = 65_536
UNIT = ["_id", "_source", "_size", "_digest"]
UNDECIDED = 1e-9


def targets(units: DataFrame, weights: tuple = WEIGHTS, most: int = MOST_TIMES) -> DataFrame:
    """One row per source: source_size, target.

    With every source at min(most * size, level * weight), the level is the one at which the
    targets add up to all sizes. Sources are ordered by the level at which they reach their
    most; the first beyond which the rest can share by weight gives the level. The windows run
    over one row per source.
    """
    sizes = units.groupBy("_source").agg(F.sum(F.col("_size") * F.col("_rows")).alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("_source").asc_nulls_last())) - 1
    given = F.get(F.array(*(F.lit(float(w)) for w in weights)), (place % len(weights)).cast("int"))
    weighed = sizes.withColumn("weight", given)
    full = most * F.col("source_size").cast("double")
    order = Window.orderBy(full / F.col("weight"), F.col("_source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    left = F.sum("source_size").over(everything).cast("double") - F.coalesce(
        F.sum(full).over(before), F.lit(0.0)
    )
    level = left / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    levels = weighed.withColumn("level", level).withColumn("place", F.row_number().over(order))
    fits = F.when(F.col("level") <= full / F.col("weight"), F.struct("place", "level"))
    shared = F.min(fits).over(everything)
    return levels.select(
        "_source",
        "source_size",
        F.least(full, F.coalesce(shared["level"] * F.col("weight"), full)).alias("target"),
    )


def flight(sizes: np.ndarray, rows: np.ndarray, chances: np.ndarray, draws: np.ndarray) -> np.ndarray:
    """Moves the chances until at most two are left between 0 and 1.

    Words and rows of what a chance decides on are its coefficients in the two constraints. ``draws``
    (0 to 1) steer the moves. For three units the cross product of both rows of coefficients
    spans the null space.
    """
    p, s, r = chances.tolist(), sizes.tolist(), rows.tolist()
    held: list[int] = []
    for new in range(len(p)):
        if not UNDECIDED < p[new] < 1 - UNDECIDED:
            p[new] = round(p[new])
            continue
        held.append(new)
        while len(held) == 3:
            a, b, c = held
            v = (r[b] * s[c] - r[c] * s[b], r[c] * s[a] - r[a] * s[c], r[a] * s[b] - r[b] * s[a])
            if v == (0, 0, 0):  # both constraints say the same of these three
                v = (r[b], -r[a], 0)
            ups, downs = [], []
            for i, x in zip(held, v, strict=True):
                if x > 0:
                    ups.append((1 - p[i]) / x)
                    downs.append(p[i] / x)
                elif x < 0:
                    ups.append(p[i] / -x)
                    downs.append((1 - p[i]) / -x)
            up, down = min(ups), min(downs)
            step = up if draws[new] * (up + down) < down else -down
            for i, x in zip(held, v, strict=True):
                p[i] += step * x
                if p[i] < UNDECIDED or p[i] > 1 - UNDECIDED:
                    p[i] = round(p[i])
            held = [i for i in held if 0 < p[i] < 1]
    return np.array(p)


def land(sizes: np.ndarray, chances: np.ndarray) -> np.ndarray:
    """Decides the last one or two: the outcome nearest to the expected tokens, then rows."""
    out = np.round(chances) * ((chances <= 0) | (chances >= 1))
    open_ = np.flatnonzero((chances > 0) & (chances < 1))
    if len(open_):
        wish, rows = float(sizes[open_] @ chances[open_]), float(chances[open_].sum())
        picks = [[(k >> i) & 1 for i in range(len(open_))] for k in range(1 << len(open_))]
        out[open_] = min(picks, key=lambda x: (abs(sizes[open_] @ x - wish), abs(sum(x) - rows), x))
    return out


def move(units: DataFrame, last: bool) -> DataFrame:
    """One flight, and with ``last`` the landing, in each (_source, _block)."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        order = ["_draw", "_id", "_size", "_digest"]
        group = group.sort_values(order, na_position="first", ignore_index=True)
        sizes, chances, draws = (group[c].to_numpy(dtype=float) for c in ("_size", "_chance", "_draw"))
        moved = flight(sizes, np.ones(len(group)), chances, draws)
        group["_chance"] = land(sizes, moved) if last else moved
        return group

    return units.groupBy("_source", "_block").applyInPandas(run, units.schema)


def in_blocks(units: DataFrame, block: int, level: int) -> DataFrame:
    """Blocks of about ``block`` units, by a hash that is new at each level."""
    sizes = units.groupBy("_source").agg(F.ceil(F.count(F.lit(1)) / block).alias("_blocks"))
    joined = units.drop("_block").join(
        sizes.withColumnRenamed("_source", "_of"), F.col("_source").eqNullSafe(F.col("_of"))
    )
    spread = F.pmod(F.xxhash64(F.lit(level), "_id", "_size", "_digest"), F.col("_blocks")).cast("int")
    return joined.withColumn("_block", spread).select(*units.columns)


def decide(units: DataFrame, block: int = BLOCK) -> DataFrame:
    """``units`` (the columns of UNIT, _rows, _sure, _chance, _draw, _block) with chances 0 or 1.

    Levels go on until every source fits in one block; each leaves two units of a block at
    most, so three levels do for 10^11 documents.
    """
    done, level = [], 0
    while True:
        largest = units.groupBy("_source").count().agg(F.max("count")).head()[0] or 0
        last = largest <= block
        moved = cut_lineage(move(in_blocks(units, block, level), last), "cube")
        done.append(moved.where("_chance <= 0 or _chance >= 1"))
        if last:
            break
        units, level = moved.where("_chance > 0 and _chance < 1"), level + 1
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def unit_columns(doc_id: str, text: str, source: str) -> list[Column]:
    return [
        F.col(doc_id).cast("string").alias("_id"), F.col(source).alias("_source"),
        word_count(F.col(text)).alias("_size"), F.xxhash64(text).alias("_digest"),
    ]


def plan(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per unit: the columns of UNIT, _rows, source_size, target, whole, extra.

    Each row of a unit is taken ``whole`` times, and ``extra`` of them once more.
    """
    rows = docs.select(*unit_columns("doc_id", "text", "source"))
    units = cut_lineage(rows.groupBy(*UNIT).agg(F.count(F.lit(1)).alias("_rows")), "units")
    wanted = targets(units).withColumnRenamed("_source", "_of")
    times = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(times + UNDECIDED)
    same = F.col("_source").eqNullSafe(F.col("_of"))
    draw = (F.pmod(F.xxhash64(*UNIT), F.lit(1 << 40)) + 0.5) / float(1 << 40)
    share = F.col("_rows") * F.greatest(times - whole, F.lit(0.0))
    sure = F.floor(share + UNDECIDED)
    open_ = units.join(wanted, same).select(
        *UNIT, "_rows", sure.cast("long").alias("_sure"),
        F.greatest(share - sure, F.lit(0.0)).alias("_chance"),
        draw.alias("_draw"), F.lit(0).alias("_block"),
    )
    decided = decide(open_, block).join(wanted, same)
    planned = decided.select(
        *UNIT, "_rows", "source_size", "target", whole.cast("long").alias("whole"),
        (F.col("_sure") + F.col("_chance").cast("long")).alias("extra"),
    )
    return cut_lineage(planned, "plan")


def taken_words(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken."""
    planned = plan(docs, block)
    # a large unit is expanded by many tasks
    large = planned.where(F.col("_rows") > CHUNK).withColumn(
        "_from", F.explode(F.sequence(F.lit(1).cast("long"), "_rows", F.lit(CHUNK).cast("long")))
    )
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = planned.where(F.col("_rows") <= CHUNK).withColumn("_from", F.lit(1).cast("long")).unionByName(
        large.repartition(tasks, *UNIT, "_from")
    )
    to = F.least(F.col("_rows"), F.col("_from") + CHUNK - 1)
    each = parts.withColumn("_number", F.explode(F.sequence("_from", to)))
    times = F.col("whole") + (F.col("_number") <= F.col("extra")).cast("long")
    return each.select(
        F.col("_id").cast(docs.schema["doc_id"].dataType).alias("doc_id"), F.col("_size").alias("size"), "source_size", "target",
        (F.col("_size") * times).alias("taken"),
    )


def numbered(rows: DataFrame) -> DataFrame:
    """Written ``rows`` (_k columns, _rows, _mark, ...) with _number, from 1 on in each unit.

    Rows of a unit follow the hash of all their columns, so any partitioning gives the same rows. A
    unit is numbered in parts of about CHUNK rows, each from its offset; rows that agree in all
    columns are dealt to the parts at random, as it doesn't matter which of them is which.
    """
    unit = [f"_k{c}" for c in UNIT]
    parts = F.ceil(F.col("_rows") / CHUNK)
    # the hash's order decides; only a large unit has more than one part
    salt = F.when(parts > 1, F.pmod(F.xxhash64("_mark"), parts)).otherwise(F.lit(0))
    salted = rows.withColumn("_salt", salt)
    before = Window.partitionBy(*unit).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    counts = salted.groupBy(*unit, "_salt").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        *(F.col(c).alias(f"_o{c}") for c in [*unit, "_salt"]),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
    )
    place = F.row_number().over(Window.partitionBy(*unit, "_salt").orderBy("_mark"))
    same = [F.col(c).eqNullSafe(F.col(f"_o{c}")) for c in [*unit, "_salt"]]
    placed = salted.withColumn("_place", place).join(offsets, same)
    return placed.withColumn("_number", F.col("_place") + F.col("_offset"))


def mix(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """The documents as often as the mix takes them, with their own columns."""
    planned = plan(docs, block).select(
        *(F.col(c).alias(f"_p{c}") for c in UNIT),
        "_rows", F.col("whole").alias("_whole"), F.col("extra").alias("_extra"),
    )
    keys = [e.alias(f"_k{c}") for c, e in zip(UNIT, unit_columns("doc_id", "text", "source"), strict=True)]
    keyed = docs.select(whole_row(docs), row_hash(docs).alias("_mark"), *keys)
    same = [F.col(f"_k{c}").eqNullSafe(F.col(f"_p{c}")) for c in UNIT]
    torn = (F.col("_extra") > 0) & (F.col("_extra") < F.col("_rows"))
    alike = planned.where(~torn).withColumn("_times", F.col("_whole") + (F.col("_extra") > 0).cast("long"))
    found = keyed.join(alike.where("_times > 0"), same).select("row", "_times")
    if not planned.where(torn).isEmpty():
        parted = numbered(cut_lineage(keyed.join(planned.where(torn), same), "torn"))
        times = F.col("_whole") + (F.col("_number") <= F.col("_extra")).cast("long")
        found = found.union(parted.select("row", times.alias("_times")).where("_times > 0"))
    copies = found.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times").cast("int"))))
    return copies.select(*own_columns(docs))
