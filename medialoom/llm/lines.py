"""Line dedup by overlapping windows of three lines.

Texts are split at line feeds; lines without a word are left alone. Every three consecutive
other lines make a window, hashed to 128 bits. A window that occurs again, in the same text or in
another, is repeated; its first occurrence, by document id and place, stays, and later ones cover
their three lines. Overlapping covers merge, and covered lines go. What goes from a text has an
earlier occurrence of each of its lines, so no line is lost altogether.

All of it is SQL expressions: hashes are aggregated before the shuffle, a hot window is
split by the join, and a text is gathered in no task but its own row.

Defined results: a null text stays null with 0 lines. Texts with fewer than three lines with
words stay as they are. Null ids order last; rows that agree in id and text are one document and
are treated alike. A text that loses every line becomes empty; a very long one is split in its own
row. An empty table gives no rows. Columns named n_lines or n_removed give way, all others stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medialoom.llm.common import (
    BLANKS,
    KEY,
    key_columns,
    key_order,
    let,
    own_columns,
    same_key,
    whole_row,
)
from medialoom.session import cut_lineage

LINES = 3
HASH = ["h", "g"]


def spoken(lines: Column) -> Column:
    """Places of the lines that have a word."""
    placed = F.transform(
        lines, lambda x, i: F.when(F.btrim(x, F.lit(BLANKS)) != "", i)
    )
    return F.filter(placed, lambda i: i.isNotNull())


def windows_of(text: Column) -> Column:
    """Hashes and place of each window of a text."""

    def within(lines: Column, places: Column) -> Column:
        def window(k: Column) -> Column:
            parts = [F.get(lines, F.get(places, k + d)) for d in range(LINES)]
            return F.struct(
                F.xxhash64(*parts).alias("h"), F.xxhash64(F.lit(1), *parts).alias("g"), k.alias("at")
            )

        starts = F.sequence(F.lit(0), F.size(places) - LINES)
        return F.when(F.size(places) >= LINES, F.transform(starts, window))

    return let(F.split(text, "\n"), lambda x: let(spoken(x), lambda p: within(x, p)))


def later_windows(docs: DataFrame) -> DataFrame:
    """Key of a document and the places of its windows that have occurred before."""
    each = docs.select(*key_columns(docs), F.explode(windows_of(F.col("text"))).alias("w"))
    each = cut_lineage(each.select(*KEY, "w.h", "w.g", "w.at"), "windows")
    place = F.struct(key_order().alias("doc"), "at")
    first = each.groupBy(*HASH).agg(F.count(F.lit(1)).alias("times"), F.min(place).alias("first"))
    repeated = first.where("times > 1").select(*HASH, "first")
    later = each.join(repeated, HASH).where(place != F.col("first"))
    return later.groupBy(*KEY).agg(F.collect_set("at").alias("later"))


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the cleaned text, n_lines and n_removed."""
    later = later_windows(docs).select(*(F.col(k).alias(f"w{k}") for k in KEY), "later")
    keys = [e.alias(f"k{k}") for k, e in zip(KEY, key_columns(docs), strict=True)]
    joined = docs.select(whole_row(docs), *keys).join(later, same_key("k", "w"), "left")
    text = F.col("row")["text"]

    def rest(lines: Column, places: Column) -> Column:
        covers = F.transform("later", lambda k: F.slice(places, k + 1, F.lit(LINES)))
        everything = F.sequence(F.lit(0), F.size(lines) - 1)
        left = F.array_except(everything, F.flatten(covers))
        return F.struct(
            F.size(lines).alias("n"),
            F.concat_ws("\n", F.transform(left, lambda i: F.get(lines, i))).alias("text"),
            (F.size(lines) - F.size(left)).alias("removed"),
        )

    lines = F.split(text, "\n")
    result = F.when(
        F.col("later").isNotNull(), let(lines, lambda x: let(spoken(x), lambda p: rest(x, p)))
    )
    cleaned = joined.select("row", result.alias("rest"))
    whole = F.when(text.isNull(), 0).otherwise(F.regexp_count(text, F.lit("\n")) + 1)
    results = {
        "text": F.coalesce(F.col("rest")["text"], text),
        "n_lines": F.coalesce(F.col("rest")["n"], whole).cast("long"),
        "n_removed": F.coalesce(F.col("rest")["removed"], F.lit(0)).cast("long"),
    }
    return cleaned.select(*own_columns(docs, results), *(v.alias(c) for c, v in results.items()))
