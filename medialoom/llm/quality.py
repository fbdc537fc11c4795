"""Quality rules: fixed limits, then a log-likelihood ratio of hashed n-grams.

Unigrams and bigrams of letter runs and symbol runs fall into a fixed number of buckets by
their hash. Two multinomials over the buckets, one of a trusted target and one of the whole raw
corpus, both with add-one smoothing, give each bucket a log ratio; a document's score is the
mean over its n-grams, so long and short texts compare. A document stays if its score reaches
the threshold. Everything runs as SQL expressions: one pass counts, one pass scores, and only
bucket counts are shuffled.

Defined results: a null text has no words, so it fails the base rules; so does a text without
words. A document without n-grams, and every document if no row is trusted, has a null score
and passes the method's own verdict. Repeated rows are scored alike and count each. Columns of
the input that have the name of a result column give way to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medialoom.llm.common import WORD, let, replace_columns

BUCKETS = 10_000
#: The target is fitted on at most this many trusted documents, the first by a hash of their id.
TRUSTED = 20_000
#: Mean log ratio of an n-gram from which a document stays.
THRESHOLD = -0.3
#: Runs of letters, digits and underscores, and runs of other signs.
TOKEN = r"[\p{L}\p{M}\p{N}_]+|[^\s\p{L}\p{M}\p{N}_]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
FEWEST_WORDS = 10
MOST_REPEATED = 20


def repeated_words(words: Column) -> Column:
    """Words that lie in a window of five words which the text has twice or more.

    Windows are hashed; only a text in which hashes repeat is sorted, so no step is
    quadratic in the length of the text.
    """

    def window(i: Column) -> Column:
        return F.xxhash64(*(F.get(words, i + F.lit(k)) for k in range(WINDOW)))

    def covered(places: Column) -> Column:
        def reach(x: Column, k: Column) -> Column:
            return F.least(F.lit(WINDOW), F.coalesce(F.get(places, k + 1) - x, F.lit(WINDOW)))

        return F.aggregate(F.transform(places, reach), F.lit(0), lambda a, x: a + x)

    def places(ordered: Column) -> Column:
        def twice(e: Column, k: Column) -> Column:
            same = [F.get(ordered, k + d)["h"] == e["h"] for d in (-1, 1)]
            return F.coalesce(same[0], F.lit(False)) | F.coalesce(same[1], F.lit(False))

        return F.sort_array(F.transform(F.filter(ordered, twice), lambda e: e["at"]))

    def count(hashes: Column) -> Column:
        paired = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("at")))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(
            let(F.sort_array(paired), lambda s: let(places(s), covered))
        )

    starts = F.sequence(F.lit(0), F.size(words) - WINDOW)
    return F.when(F.size(words) <= WINDOW, 0).otherwise(let(F.transform(starts, window), count))


def base_rules(text: Column) -> dict[str, Column]:
    """Counts of a text, as expressions over its column."""

    def stripped(column: Column, signs: str) -> Column:
        return F.length(F.translate(column, signs, ""))

    filled = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(filled, "\n"), lambda x: F.btrim(x, F.lit(" \t\n\x0b\x0c\r")) != "")
    words = F.regexp_extract_all(filled, F.lit(WORD), F.lit(0))

    def judged(n: Column, repeated: Column) -> Column:
        failed = (n < FEWEST_WORDS) | (100 * repeated > MOST_REPEATED * n)
        return F.struct(n.alias("all"), repeated.alias("repeated"), failed.alias("failed"))

    counts = let(words, lambda w: let(repeated_words(w), lambda r: judged(F.size(w), r)))
    return {
        "_counts": counts,
        "word_chars": stripped(filled, " \t\n\x0b\x0c\r").cast("long"),
        "n_symbols": (F.length(filled) - stripped(filled, SYMBOLS)).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
    }


def gram_buckets(text: Column, buckets: int = BUCKETS) -> Column:
    """Buckets of the unigrams and bigrams of a text; empty for null."""

    def number(*parts: Column) -> Column:
        return F.pmod(F.xxhash64(*parts), F.lit(buckets)).cast("int")

    def both(tokens: Column) -> Column:
        ones = F.transform(tokens, lambda t: number(t))
        heads = F.slice(tokens, F.lit(1), F.greatest(F.size(tokens) - 1, F.lit(0)))
        return F.concat(
            ones, F.transform(heads, lambda t, i: number(t, F.get(tokens, i + 1)))
        )

    tokens = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), F.lit(0))
    return let(tokens, both)


def trusted_ids(labels: DataFrame, most: int = TRUSTED) -> DataFrame:
    """Ids of documents that every label calls good and none toxic: ``most`` at most."""
    agreed = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("low"), F.max(F.coalesce("toxic", F.lit(0))).alias("toxic"))
        .where("low = 1 and toxic = 0")
    )
    return agreed.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).select("doc_id")


def log_ratios(docs: DataFrame, labels: DataFrame, buckets: int, trusted: int) -> Column:
    """Array of the buckets' log ratios, as a scalar subquery; null if nothing is trusted.

    The ids of trusted documents are broadcast: at most ``trusted`` of them.
    """
    chosen = F.broadcast(
        trusted_ids(labels, trusted).select(F.col("doc_id").alias("_id"), F.lit(1).alias("_good"))
    )
    known = docs.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"))
    counted = (
        known.join(chosen, "_id", "left")
        .select("_good", F.explode(gram_buckets(F.col("_text"), buckets)).alias("bucket"))
        .groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("raw"), F.count("_good").alias("target"))
    )
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    table = every.join(counted, "bucket", "left").agg(
        F.sort_array(
            F.collect_list(
                F.struct("bucket", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("raw", "target")))
            )
        ).alias("rows"),
        F.sum("raw").alias("raw"),
        F.sum("target").alias("target"),
    )

    def share(count: Column, total: str) -> Column:
        return (count + 1) / (F.col(total) + buckets)

    ratio = F.transform(
        "rows", lambda r: F.log(share(r["target"], "target")) - F.log(share(r["raw"], "raw"))
    )
    return table.select(F.when(F.col("target") > 0, ratio).alias("ratios")).scalar()


def judge(
    docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, trusted: int = TRUSTED,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``docs`` (doc_id, text, ...) with the counts, base_failed, score and kept."""

    def mean(grams: Column) -> Column:
        total = F.aggregate(grams, F.lit(0.0), lambda a, g: a + F.get(F.col("_ratios"), g))
        return F.when(F.size(grams) > 0, total / F.size(grams))

    known = replace_columns(docs, {"_ratios": log_ratios(docs, labels, buckets, trusted)})
    counted = replace_columns(
        known, base_rules(F.col("text")) | {"score": let(gram_buckets(F.col("text"), buckets), mean)}
    )
    n, repeated = F.col("_counts")["all"].cast("long"), F.col("_counts")["repeated"].cast("long")
    judged = replace_columns(counted, {"n_words": n, "n_repeat_words": repeated})
    judged = replace_columns(judged, {"base_failed": F.col("_counts")["failed"]})
    passed = F.coalesce(F.col("score") >= threshold, F.lit(True))
    return replace_columns(judged, {"kept": ~F.col("base_failed") & passed}).drop("_counts", "_ratios")
