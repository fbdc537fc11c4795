"""Sharding by a permutation-filled lookup table.

Each shard has its own permutation of the slots of a table of prime size, from an offset and a
stride that are hashes of its name. Shards take turns; at its turn a shard claims the first
slot of its permutation that is still free. Slots differ by at most one between shards, and
when a shard comes or goes few other slots change hands. A document goes to the shard that
holds slot hash(key) mod size: one array access. The table is a literal of the plan: its size
is a parameter and does not grow with the data.

Defined results: null keys hash as the word ``null`` and share one slot; equal keys share a
shard, so repeated rows stay together. One key with a large part of all rows makes its shard
large; ``write_shards`` splits every shard into files by a hash of the whole row, so no task
takes a whole shard. An empty table gives no rows; without shards there is an error.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medialoom.llm.common import replace_columns

#: Slots of the table, a prime well above the number of shards.
SLOTS = 2053
SHARDS = [f"shard-{i:02d}" for i in range(16)]


def digest_number(text: str) -> int:
    """First 32 bits of the MD5 of a text."""
    return int(hashlib.md5(text.encode()).hexdigest()[:8], 16)


def preference(shard: str, slots: int) -> tuple[int, int]:
    """Offset and stride of a shard's permutation of the slots."""
    return digest_number(f"{shard}/offset") % slots, digest_number(f"{shard}/stride") % (slots - 1) + 1


def fill(shards: list[str], slots: int = SLOTS) -> list[int]:
    """Holder of each slot, as a position in ``shards``; names are distinct, slots prime."""
    if not shards or len(set(shards)) < len(shards) or len(shards) > slots:
        raise ValueError("shards must be distinct names, at least one and at most one per slot")
    if slots < 2 or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError("the number of slots must be a prime")
    holder = [-1] * slots
    places = [preference(shard, slots) for shard in shards]
    reached = [0] * len(shards)
    for turn in range(slots):
        i = turn % len(shards)
        offset, stride = places[i]
        while holder[slot := (offset + reached[i] * stride) % slots] >= 0:
            reached[i] += 1
        holder[slot] = i
    return holder


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """Slot of a key: the first 32 bits of the MD5 of its text, modulo the table's size."""
    text = F.md5(F.coalesce(key.cast("string"), F.lit("null")))
    number = F.conv(F.substring(text, 1, 8), 16, 10).cast("long")
    return (number % slots).cast("int")


def place(
    docs: DataFrame, key: str = "doc_id", shards: list[str] = SHARDS, slots: int = SLOTS
) -> DataFrame:
    """``docs`` with slot and shard."""
    names = F.array(*(F.lit(shards[i]) for i in fill(shards, slots)))
    placed = replace_columns(docs, {"slot": slot_of(F.col(key), slots)})
    return replace_columns(placed, {"shard": F.get(names, F.col("slot"))})


def write_shards(
    docs: DataFrame, path: str, key: str = "doc_id", shards: list[str] = SHARDS,
    slots: int = SLOTS, files: int = 4,
) -> None:
    """Writes the documents below ``path/shard=...``, each shard in up to ``files`` files."""
    placed = place(docs, key, shards, slots)
    part = F.pmod(F.xxhash64(*(F.col(f"`{c}`") for c in docs.columns)), F.lit(files))
    spread = placed.repartition(len(shards) * files, "shard", part).drop("slot")
    spread.write.partitionBy("shard").mode("overwrite").parquet(path)
