"""Dense positions and running totals without a one-task sort.

Rows are put in order-preserving buckets, the buckets are counted, and each
bucket is numbered on its own from its offset. The number of buckets follows the number of
rows, up to 65,536 of them, so the offset table, one row per bucket, can be broadcast. A shuffle's
buckets are hash prefixes; those of a natural order are the engine's range partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medialoom.functions.columns import int_div, order_hash, slice_task
from medialoom.functions import fixed_values as fv
from medialoom.session import cut_lineage

BUCKET = "_bucket"
SHUFFLE_KEY = "_shuffle_key"
PLACE = "_place"
BUCKET_ROWS = 1 << 16  # rows that a bucket should hold
MOST_DIGITS = 4  # hex digits of a bucket at most
MOST_RANGES = 1 << 16  # range partitions at most


def _number(
    df: DataFrame,
    order: list,
    parts: list[str],
    index: str | None,
    sums: dict[str, Column],
) -> DataFrame:
    measures = {f"_add{i}": value for i, value in enumerate(sums.values())}
    df = df.withColumns(measures) if measures else df
    counted = df.groupBy(*parts, BUCKET).agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(m).alias(f"{m}_sum") for m in measures]
    )
    before = (
        Window.partitionBy(*parts)
        .orderBy(BUCKET)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = counted.select(
        *parts,
        BUCKET,
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
        *[
            F.coalesce(F.sum(f"{m}_sum").over(before), F.lit(0)).alias(f"{m}_offset")
            for m in measures
        ],
    )
    if not parts:
        offsets = F.broadcast(offsets)  # one row per bucket, a fixed number
    inside = Window.partitionBy(*parts, BUCKET).orderBy(*order)
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # a left join: every bucket has an offset, and no null filter is pushed below it
    out = df.join(offsets, [*parts, BUCKET], "left")
    new = {}
    if index:
        new[index] = F.col("_offset") + F.row_number().over(inside) - F.lit(1)
    for name, m in zip(sums, measures):
        new[name] = F.col(f"{m}_offset") + F.sum(m).over(running)
    drop = [BUCKET, "_offset", *measures, *[f"{m}_offset" for m in measures]]
    return out.withColumns(new).drop(*drop)


def bucket_digits(df: DataFrame, bucket_rows: int = BUCKET_ROWS) -> Column:
    """Hex digits that make buckets of about ``bucket_rows`` rows, as a scalar subquery."""
    wanted = F.ceil(F.log(16.0, F.count(F.lit(1)) / bucket_rows)).cast("int")
    digits = F.when(F.count(F.lit(1)) > bucket_rows, F.least(wanted, F.lit(MOST_DIGITS)))
    return df.agg(F.coalesce(digits, F.lit(1)).alias("digits")).scalar()


def hash_index(
    df: DataFrame,
    key: list[str],
    seed: object = fv.SHUFFLE_SEED,
    index: str | None = "idx",
    parts: list[str] = (),
    sums: dict[str, Column] | None = None,
    bucket_rows: int = BUCKET_ROWS,
    digits: Column | None = None,
) -> DataFrame:
    """Position of each row in a seeded shuffle, from 0; key must be unique in parts.

    ``sums`` adds running totals in the same order. The first hex digits of the hash
    make the buckets, as many digits as the number of rows asks for, or ``digits`` if they are known.
    """
    parts = list(parts)
    digits = bucket_digits(df, bucket_rows) if digits is None else digits
    with_key = _hashed(df, [*parts, *key], seed, digits)
    numbered = _number(with_key, [SHUFFLE_KEY, *key], parts, index, sums or {})
    return numbered.drop(SHUFFLE_KEY)


def _hashed(df: DataFrame, key: list[str], seed: object, digits: Column) -> DataFrame:
    """``df`` with its shuffle key and bucket."""
    return df.withColumn(SHUFFLE_KEY, order_hash(seed, *key)).withColumn(
        BUCKET, F.substring(SHUFFLE_KEY, F.lit(1), digits)
    )


def hashed_total(df: DataFrame, key: list[str], seed: object, digits: Column) -> Column:
    """Number of rows as a scalar subquery: the sum of the counts that ``hash_index`` takes, so both share one pass."""
    counted = _hashed(df, key, seed, digits).groupBy(BUCKET).agg(F.count(F.lit(1)).alias("_n"))
    return counted.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n")).scalar()


def ranked_flags(
    df: DataFrame, flag: str, key: list[str], seed: object, digits: Column, index: str, missed: str
) -> DataFrame:
    """The rows of a seeded shuffle whose ``flag`` is true, numbered from 0 in ``index``.

    ``missed`` counts the rows without the flag right before each of them. A bucket is ranked on its
    own in one window. What it brings to the buckets after it is one row of a table that a
    pass over the key and the flag makes: how many rows it has of either kind, and how many
    without the flag lie before its last one with it.
    """
    ranked, inside = _ranked(df, flag, key, seed, digits)
    buckets = _flag_buckets(ranked, flag)
    before = Window.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = buckets.select(
        BUCKET,
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
        (F.col("_start") - F.coalesce(F.max(F.col("_start") + F.col("_last")).over(before), F.lit(0))).alias("_carried"),
    )
    found = ranked.filter(flag).withColumn("_previous", F.lag("_lost").over(inside))
    # one row per bucket, at most 65,536
    numbered = found.join(F.broadcast(offsets), BUCKET, "left").withColumns(
        {
            index: F.col("_offset") + F.col("_seen") - 1,
            missed: F.col("_lost") - F.coalesce(F.col("_previous"), -F.col("_carried")),
        }
    )
    return numbered.drop(
        BUCKET, SHUFFLE_KEY, "_seen", "_lost", "_previous", "_offset", "_carried"
    )


def flag_totals(df: DataFrame, flag: str, key: list[str], seed: object, digits: Column) -> Column:
    """How many rows of a shuffle have the flag (``found``), how many have not (``missing``), and how
    many of the latter lie before its last row with it (``met``), as a struct in a scalar subquery.

    All three are sums of the bucket table of ``ranked_flags``, so both share one pass.
    """
    buckets = _flag_buckets(_ranked(df, flag, key, seed, digits)[0], flag)
    sums = {"found": F.sum("_n"), "missing": F.sum("_gone"), "met": F.max(F.col("_start") + F.col("_last"))}
    totals = F.struct(*[F.coalesce(total, F.lit(0)).alias(name) for name, total in sums.items()])
    return buckets.agg(totals.alias("totals")).scalar()


def _ranked(df: DataFrame, flag: str, key: list[str], seed: object, digits: Column) -> tuple:
    """Every row with the number of those with and without the flag in its bucket up to it, and the window."""
    inside = Window.partitionBy(BUCKET).orderBy(SHUFFLE_KEY, *key)
    here = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = _hashed(df, key, seed, digits).withColumn(
        "_seen", F.sum(F.col(flag).cast("bigint")).over(here)
    )
    return ranked.withColumn("_lost", F.row_number().over(inside) - F.col("_seen")), inside


def _flag_buckets(ranked: DataFrame, flag: str) -> DataFrame:
    """One row per bucket: its rows with the flag, without it, those before its last one with it, and
    the rows without it in earlier buckets."""
    lost = F.when(F.col(flag), F.col("_lost"))  # grows along the shuffle, so its maximum is its last
    before = Window.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    return (
        ranked.groupBy(BUCKET)
        .agg(F.max("_seen").alias("_n"), F.max("_lost").alias("_gone"), F.max(lost).alias("_last"))
        .withColumn("_start", F.coalesce(F.sum("_gone").over(before), F.lit(0)))
    )


def in_ranges(df: DataFrame, order: list[str], bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Written rows in the engine's range partitions, sorted, with partition and place in it.

    As many partitions as the rows ask for. They are written, since a partition's number and the
    places in it only hold for what has been written.
    """
    ranges = min(MOST_RANGES, -(-df.count() // bucket_rows) or 1)
    place = F.monotonically_increasing_id()  # the partition, then 33 bits of the place in it
    sorted_rows = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    written = cut_lineage(sorted_rows.withColumn(PLACE, place), "ranges")
    return written.withColumns(
        {BUCKET: F.shiftright(PLACE, 33), PLACE: F.col(PLACE).bitwiseAND(F.lit((1 << 33) - 1))}
    )


def ordered_index(
    df: DataFrame,
    order: list[str],
    index: str | None = "idx",
    sums: dict[str, Column] | None = None,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Position of each row in a natural order, from 0; order must be total.

    The rows go through one range shuffle and one sort; a position is the offset of the row's
    partition and its place in it. Running totals are windows over the partitions.
    """
    ranged = in_ranges(df, order, bucket_rows)
    if sums:
        return _number(ranged.drop(PLACE), list(order), [], index, sums)
    before = Window.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    counted = ranged.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("_n"))
    offsets = counted.select(BUCKET, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    # at most MOST_RANGES rows, whatever the input
    numbered = ranged.join(F.broadcast(offsets), BUCKET, "left")
    return numbered.withColumn(index, F.col("_offset") + F.col(PLACE)).drop(BUCKET, PLACE, "_offset")


def row_total(df: DataFrame) -> Column:
    """Number of rows as a scalar subquery."""
    return df.agg(F.count(F.lit(1)).alias("n")).scalar()


def slice_range(df: DataFrame, order: list[str], tasks: int) -> DataFrame:
    """Cut rows in order into equal runs per task; the last task takes the remainder."""
    numbered = ordered_index(df, order)
    return numbered.withColumn("task", slice_task(F.col("idx"), row_total(df), tasks))


def fixed_shards(
    df: DataFrame,
    key: list[str],
    size: int = fv.SHARD_ROWS,
    seed: object = fv.SHUFFLE_SEED,
) -> DataFrame:
    """Shuffle by seed and cut into shards of ``size`` rows, with the shard file name."""
    total = row_total(df)
    numbered = hash_index(df, key, seed)
    shards = int_div(total + F.lit(size - 1), size)
    return numbered.withColumn("shard", int_div(F.col("idx"), size)).withColumn(
        "shard_name", F.format_string(fv.SHARD_NAME, F.col("shard"), shards)
    )


def size_bounded_shards(
    df: DataFrame,
    key: list[str],
    size: str,
    max_bytes: int = fv.SHARD_BYTES,
    seed: object = fv.SHUFFLE_SEED,
) -> DataFrame:
    """Cut a seeded shuffle into shards of at most ``max_bytes``, each filled until a file does not fit.

    A file above the cap is a shard of its own. Rows are numbered with their running bytes; each
    row then knows the row that would begin the next shard if it began one, and doubling that
    step finds all shards that really begin, in as many rounds as the number of shards has bits.
    """
    bytes_ = F.coalesce(F.col(size), F.lit(0)).cast("long")
    numbered = cut_lineage(hash_index(df, key, seed, sums={"bytes_to_here": bytes_}), "sized")
    end = F.col("bytes_to_here")
    rows = numbered.select("idx", (end - bytes_).alias("start"), end.alias("end"))
    starts = shard_starts(rows, max_bytes).withColumn("_first", F.lit(1))
    flagged = numbered.join(starts, "idx", "left").withColumns(
        {"_first": F.coalesce("_first", F.lit(0)), BUCKET: int_div(F.col("idx"), BUCKET_ROWS)}
    )
    shards = _number(flagged, ["idx"], [], None, {"shard": F.col("_first")})
    return shards.withColumn("shard", F.col("shard") - 1).drop("_first")


def shard_starts(rows: DataFrame, max_bytes: int) -> DataFrame:
    """(idx) of the rows that begin a shard; ``rows`` holds idx, start and end on one line of bytes.

    The next shard begins with the row that holds the byte ``max_bytes`` after the start. Rows and
    bytes meet in cells as wide as a row is long on average, so a cell holds few rows and all cells
    of all rows are about two for each.
    """
    n, total = rows.agg(F.count(F.lit(1)), F.max("end")).head()
    if not n:
        return rows.select("idx")
    width = max(1, (total or 0) // n)
    cells = rows.where(F.col("end") > F.col("start")).select(
        F.col("idx").alias("to"), F.col("start").alias("low"), F.col("end").alias("high"),
        F.explode(F.sequence(int_div(F.col("start"), width), int_div(F.col("end") - 1, width))).alias("cell"),
    )
    wanted = rows.select("idx", "start", "end", (F.col("start") + max_bytes).alias("byte"))
    own = wanted.where(F.col("end") - F.col("start") > max_bytes).select("idx", (F.col("idx") + 1).alias("to"))
    others = wanted.where(F.col("end") - F.col("start") <= max_bytes).withColumn("cell", int_div(F.col("byte"), width))
    held = (F.col("low") <= F.col("byte")) & (F.col("byte") < F.col("high"))
    steps = others.join(cells, "cell").where(held).select("idx", "to").union(own.where(F.col("to") < n))
    steps, found = cut_lineage(steps, "steps"), rows.where("idx = 0").select("idx")
    while True:
        further = found.join(steps, "idx").select(F.col("to").alias("idx"))
        grown = cut_lineage(found.union(further).distinct(), "starts")
        if grown.count() == found.count():
            return grown
        found = grown
        ahead = steps.select(F.col("idx").alias("to"), F.col("to").alias("beyond"))
        steps = cut_lineage(steps.join(ahead, "to").select("idx", F.col("beyond").alias("to")), "steps")


def first_n_per_key(df: DataFrame, key: list[str], order: list, n: int) -> DataFrame:
    """First n rows of every key in the given order.

    The rank filter is applied in each task before the shuffle too, so that a hot
    key sends at most n rows per task.
    """
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")
