"""Reproducible samples: per model, per label, by position, and cyclic draws.

Every choice follows a hash of keys and a seed, never the partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medialoom.functions import fixed_values as fv
from medialoom.functions.columns import archive_key, hash_number, int_div, order_hash
from medialoom.operators.numbering import (
    bucket_digits,
    flag_totals,
    hash_index,
    hashed_total,
    ordered_index,
    ranked_flags,
    row_total,
)
from medialoom.operators.skew import salted_flag

PREFIX = 3  # hex digits of the hash by which a sample counts rows: 4096 groups
HEAD_ROWS = 10_000  # rows that one task may merge
ROUNDS = 4  # half rounds of a permutation
WALK = 64  # steps back into the range; see permuted
PRIME = 2**31 - 1


def head_rows(df: DataFrame, n: int, order: list) -> DataFrame:
    """First n rows in the given order, sorted; of rows that tie at the cut any may stay.

    Up to HEAD_ROWS rows are merged from the heads of the tasks. More are numbered in range
    partitions and cut by number, so that no task holds n rows.
    """
    if n <= HEAD_ROWS:
        return df.orderBy(*order).limit(n)
    numbered = ordered_index(df, order, index="_head_place")
    return numbered.filter(F.col("_head_place") < n).orderBy("_head_place").drop("_head_place")


def preview(df: DataFrame, order: list, n: int = 5) -> DataFrame:
    """First rows of a dry run."""
    return head_rows(df, n, order)


def hash_shuffle(df: DataFrame, key: list[str], seed: object = fv.SHUFFLE_SEED) -> DataFrame:
    """All rows in a reproducible random order."""
    return df.orderBy(order_hash(seed, *key), *key)


def model_shuffle(df: DataFrame, key: list[str], model_id: str, index: str = "idx") -> DataFrame:
    """Position of every row in the shuffle that belongs to one model."""
    return hash_index(df, key, seed=model_id, index=index)


def hash_sample(df: DataFrame, key: list[str], n: int, seed: object = fv.SHUFFLE_SEED) -> DataFrame:
    """n random rows, or all if there are fewer.

    Rows are counted by the first digits of their hash; only those that lie below the
    digits at which the count reaches n are shuffled and numbered, so no task merges n rows.
    """
    digits = F.substring(order_hash(seed, *key), 1, PREFIX)
    counted = df.groupBy(digits.alias("digits")).agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.orderBy("digits").rowsBetween(Window.unboundedPreceding, -1)
    before = counted.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    last = before.filter(F.col("before") < n).agg(F.max("digits").alias("last")).scalar()
    numbered = hash_index(df.filter(digits <= last), key, seed, index="_place")
    return numbered.filter(F.col("_place") < n).drop("_place")


def sample_label(
    df: DataFrame, label: str, n: int, key: list[str], seed: object = fv.SHUFFLE_SEED
) -> DataFrame:
    """n random rows of one label, or all of them if there are fewer."""
    return hash_sample(df.filter(F.col("label") == label), key, n, seed)


def cap_needed(
    df: DataFrame, most: int | None, key: list[str], seed: object = fv.SHUFFLE_SEED
) -> DataFrame:
    """The optional cap for trial runs; without one, everything."""
    return df if not most else hash_sample(df, key, most, seed)


def pick_rows(
    df: DataFrame,
    order: list[str],
    count: int = 1,
    index: int | None = None,
    seed: object = fv.SHUFFLE_SEED,
) -> DataFrame:
    """``count`` picks: always the row at ``index``, or a random row for each pick.

    Random picks are made with replacement, each by its own hash of the seed.
    """
    numbered = ordered_index(df, order)
    if index is not None:
        return numbered.filter(F.col("idx") == index).select(
            F.explode(F.sequence(F.lit(1), F.lit(count))).alias("pick"), "*"
        )
    total = df.agg(F.count(F.lit(1)).alias("n"))
    picks = total.select(
        F.explode(F.sequence(F.lit(1), F.lit(count))).alias("pick"), "n"
    ).select("pick", F.pmod(hash_number(F.concat_ws("|", F.lit(str(seed)), "pick"), 15), "n").alias("idx"))
    return picks.join(numbered, "idx")


def skip_first(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """What comes after the first n rows, as for a resumed run."""
    return ordered_index(df, order).filter(F.col("idx") >= n).drop("idx")


# --- masks ------------------------------------------------------------------


def valid_masks(rows: DataFrame, files: DataFrame, path: str = "MaskPath") -> DataFrame:
    """Rows whose file exists."""
    return rows.join(files.select(F.col("path").alias(path)), path, "left_semi")


def missing_masks(rows: DataFrame, files: DataFrame, path: str = "MaskPath") -> DataFrame:
    return rows.join(files.select(F.col("path").alias(path)), path, "left_anti")


def flag_masks(
    rows: DataFrame, files: DataFrame, spread: list[str], path: str = "MaskPath"
) -> DataFrame:
    """All rows with a flag that tells whether their file exists; hot files are spread."""
    return salted_flag(rows, files.select(F.col("path").alias(path)), path, spread, "valid")


def needed_masks(shards: DataFrame) -> DataFrame:
    return shards.select("MaskPath").distinct()


def masks_with_archive(needed: DataFrame) -> DataFrame:
    """Every needed mask with the key of its archive: the sets, one row per member."""
    return needed.withColumn("archive", archive_key(F.col("MaskPath")))


def masks_by_archive(needed: DataFrame) -> DataFrame:
    """Number of masks of each archive, in key order."""
    counted = masks_with_archive(needed).groupBy("archive").agg(F.count(F.lit(1)).alias("masks"))
    return counted.orderBy("archive")


def resolve_mask_path(needed: DataFrame, files: DataFrame) -> DataFrame:
    """First existing of the three folder layouts for each mask, null if none.

    Each file tells for which masks it may stand, and masks are joined and grouped on their own
    name: one shuffle of either side, and no row for a place that no file holds.
    """
    mask, path = F.col("MaskPath"), F.col("path")
    prefix = fv.ARCHIVE_FOLDER_PREFIX
    folder = F.when(F.startswith(path, F.lit("///")), "/")  # the key of a name that begins with a slash
    folder = folder.when(F.startswith(path, F.lit(f"{prefix}///")), f"{prefix}/")
    folder = folder.when(F.contains(path, F.lit("/")), F.substring_index(path, "/", 1))
    known = files.select("path").withColumn("_folder", folder)
    rest = F.substring(path, F.length("_folder") + 2, F.length(path))
    inside = (
        F.when(F.col("_folder") == archive_key(rest), 1)
        .when(F.col("_folder") == F.concat(F.lit(prefix), archive_key(rest)), 2)
    )
    places = F.array(
        F.struct(path.alias("MaskPath"), F.lit(0).alias("place")),
        F.struct(rest.alias("MaskPath"), inside.alias("place")),
    )
    standing = known.select("path", F.inline(F.filter(places, lambda p: p["place"].isNotNull())))
    # a mask without a file has a null order, which min_by passes over
    return needed.select("MaskPath").join(standing, "MaskPath", "left").groupBy(mask).agg(
        F.min_by("path", "place").alias("path")
    )


def uncached_images(rows: DataFrame, files: DataFrame) -> DataFrame:
    """Distinct images that are not on disk yet."""
    wanted = rows.select("ImageID").distinct()
    there = files.select(F.col("image").alias("ImageID"))
    return wanted.join(there, "ImageID", "left_anti")


def cache_counts(rows: DataFrame, files: DataFrame) -> DataFrame:
    """How many distinct images are on disk and how many must be fetched."""
    wanted = rows.select("ImageID").distinct()
    there = files.select(F.col("image").alias("ImageID")).distinct()
    joined = wanted.join(there.withColumn("there", F.lit(True)), "ImageID", "left")
    return joined.agg(
        F.count_if(F.col("there").isNull()).alias("to_fetch"),
        F.count_if(F.col("there")).alias("cached"),
    )


# --- one sample per model ---------------------------------------------------


def permutation_keys(key: Column) -> Column:
    """The numbers that make the permutation of a key: two for each half round."""
    turns = F.sequence(F.lit(0), F.lit(2 * ROUNDS - 1))
    return F.transform(turns, lambda i: hash_number(F.concat_ws("|", key, i), 7))


def _shifted(value: Column, by: Column, turn: Column, size: Column, keys: Column) -> Column:
    """``value`` moved on, round about ``size``, by a keyed square of ``by``."""
    seed = (by + F.get(keys, 2 * turn)) % PRIME
    return (value + seed * seed % PRIME * (F.get(keys, 2 * turn + 1) + 1) % PRIME) % size


def _sent(place: Column, side: Column, other: Column, keys: Column) -> Column:
    """Where the half rounds of ``permuted`` send a place, as one expression."""

    def half(at: Column, turn: Column) -> Column:
        row, column = at["row"], at["column"]
        return F.when(
            turn % 2 == 0,
            F.struct(_shifted(row, column, turn, side, keys).alias("row"), column.alias("column")),
        ).otherwise(
            F.struct(row.alias("row"), _shifted(column, row, turn, other, keys).alias("column"))
        )

    start = F.struct(int_div(place, other).alias("row"), F.pmod(place, other).alias("column"))
    turns = F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    return F.aggregate(turns, start, half, lambda at: at["row"] * other + at["column"])


def permuted(df: DataFrame, place: str, size: str, keys: str, name: str) -> DataFrame:
    """``df`` with the number in 0..size-1 to which a permutation sends ``place``.

    ``keys`` holds the permutation's numbers. Places are cells of a grid as near to a square as
    can be. Each half round shifts a cell's row by a keyed hash of its column, or its column by
    one of its row, so cells only change places. The grid has fewer cells too many than it has
    rows; a place that lands on one of those goes on from there, and so comes back into the range.
    Up to 4096 places that takes at most WALK steps; beyond, longer walks have a chance below
    64 ** -WALK.
    """
    side = F.ceil(F.sqrt(F.col(size).cast("double"))).cast("bigint")
    grid = df.withColumn("_side", side).withColumn(
        "_other", int_div(F.col(size) + F.col("_side") - 1, F.col("_side"))
    )
    numbers, side, other = F.col(keys), F.col("_side"), F.col("_other")
    row, column = F.col("_row"), F.col("_column")
    moved = grid.withColumns({"_row": int_div(F.col(place), other), "_column": F.pmod(place, other)})
    for turn in range(ROUNDS):  # the first time as plain columns, so that it is generated code
        if turn % 2 == 0:
            moved = moved.withColumn("_row", _shifted(row, column, F.lit(turn), side, numbers))
        else:
            moved = moved.withColumn("_column", _shifted(column, row, F.lit(turn), other, numbers))
    first = moved.withColumn("_first", row * other + column)

    def onward(at: Column, step: Column) -> Column:
        return F.when(at < F.col(size), at).otherwise(_sent(at, side, other, numbers))

    walked = F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), F.col("_first"), onward)
    landed = F.when(F.col("_first") < F.col(size), F.col("_first")).otherwise(walked)
    return first.withColumn(name, landed).drop("_side", "_other", "_row", "_column", "_first")


def _slots(
    rows: DataFrame, files: DataFrame, key: list[str], seed: object, with_missing: bool
) -> tuple[DataFrame, Column]:
    """The valid rows with their number in the shuffle, from 0, and how many there are.

    ``missing_before`` counts the missing rows that the shuffle holds right before a
    valid one. There are as many buckets as all rows ask for, which is known without a join.
    """
    digits = bucket_digits(rows)
    if not with_missing:
        valid = valid_masks(rows, files)
        slots = hash_index(valid, key, seed, "slot", digits=digits)
        return slots, hashed_total(valid, key, seed, digits)
    flagged = flag_masks(rows, files, key)
    slots = ranked_flags(flagged, "valid", key, seed, digits, "slot", "missing_before")
    return slots.drop("valid"), flag_totals(flagged, "valid", key, seed, digits)["found"]


def missing_total(
    rows: DataFrame, files: DataFrame, key: list[str], seed: object = fv.SHUFFLE_SEED
) -> Column:
    """Number of rows without a file as a scalar subquery.

    It is made of the pass in which a sample drawn with_missing ranks the rows, so that a plan
    that holds both joins rows and files once.
    """
    flagged = flag_masks(rows, files, key)
    return flag_totals(flagged, "valid", key, seed, bucket_digits(rows))["missing"]


def sample_per_model(
    models: DataFrame,
    rows: DataFrame,
    files: DataFrame,
    key: list[str],
    seed: object = fv.SHUFFLE_SEED,
    with_missing: bool = False,
) -> DataFrame:
    """``target`` rows with an existing mask for every model (id, target).

    The rows are shuffled once and the valid ones numbered. Each model has its own
    permutation of the numbers and takes what its first ``target`` ranks are sent to. The work is
    one shuffle of the rows plus the sampled rows; no model is paired with rows it
    does not take. Nothing is written: buckets are counted in a pass over keys and paths alone.
    ``with_missing`` adds what the sampling report needs: how many missing rows a reader of
    the shuffle meets before each row.
    """
    slots, valid_count = _slots(rows, files, key, seed, with_missing)
    ranks = (
        _spread_models(models)
        .withColumn("_n", valid_count)
        .withColumn("_take", F.least(F.col("target").cast("bigint"), "_n"))
        .filter(F.col("_take") > 0)
        .withColumn("_keys", permutation_keys(F.col("id")))  # once per model, not per rank
        .select(
            "id",
            "_n",
            "_keys",
            F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_take") - 1)).alias("rank"),
        )
    )
    drawn = permuted(ranks, "rank", "_n", "_keys", "slot").select("id", "rank", "slot")
    return drawn.join(slots, "slot").drop("slot")


def _spread_models(models: DataFrame) -> DataFrame:
    """The models over a fixed number of tasks: few rows now, many after their ranks."""
    tasks = int(models.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return models.select("id", "target").repartition(tasks, "id")


def prompts_per_model(
    models: DataFrame, pool: DataFrame, key: list[str], seed: object = fv.SHUFFLE_SEED
) -> DataFrame:
    """``target`` prompts for every model (id, target), in the order of their rank.

    A model reads the shuffled pool in the order of its own permutation, as in
    sample_per_model, and starts again with another one whenever it has read it all.
    """
    slots = hash_index(pool, key, seed, index="slot")
    size = row_total(pool)
    ranks = (
        _spread_models(models)
        .withColumn("_n", size)
        .filter((F.col("_n") > 0) & (F.col("target") > 0))
        .withColumn("_last", F.col("target").cast("bigint") - 1)
        .withColumn("round", F.explode(F.sequence(F.lit(0).cast("bigint"), int_div(F.col("_last"), F.col("_n")))))
        .withColumn("_keys", permutation_keys(F.concat_ws("|", "id", "round")))
        .withColumn("_most", F.least(F.col("_n") - 1, F.col("_last") - F.col("round") * F.col("_n")))
        .withColumn("_place", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_most"))))
        .withColumn("rank", F.col("round") * F.col("_n") + F.col("_place"))
    )
    walked = permuted(ranks, "_place", "_n", "_keys", "slot")
    return walked.select("id", "rank", "round", "slot").join(slots, "slot").drop("slot")


def sampling_report(sample: DataFrame, models: DataFrame, missing_total: Column) -> DataFrame:
    """Per model the rows found and the missing masks met before the quota was filled.

    ``sample`` is drawn with_missing.

    A model whose quota was not filled has read the whole shuffle, so it met them all.
    """
    taken = sample.groupBy("id").agg(
        F.count(F.lit(1)).alias("found"), F.sum("missing_before").alias("_met")
    )
    joined = models.select("id", "target").join(taken, "id", "left")
    found = F.coalesce("found", F.lit(0))
    return joined.select(
        "id",
        "target",
        found.alias("found"),
        F.when(found < F.col("target"), missing_total).otherwise(F.col("_met")).alias("missing_met"),
    )


def quota_shortfall(models: DataFrame, rows: DataFrame, files: DataFrame, date: str) -> DataFrame:
    """Registry rows for models whose quota is larger than the number of valid rows.

    A sample holds all valid rows or the whole quota, so their number alone tells.
    """
    counted = models.withColumn("_n", row_total(valid_masks(rows, files)))
    joined = counted.withColumn("found", F.least(F.col("target").cast("bigint"), "_n"))
    return joined.filter(F.col("found") < F.col("target")).select(
        F.col("id").alias("model_id"),
        F.lit(fv.INFRASTRUCTURE_FAULT).alias("status"),
        F.format_string(fv.REASON_SHORT, "found", "target").alias("reason"),
        F.lit(date).alias("date"),
    )


def cyclic_prompts(
    pool: DataFrame, key: list[str], n: int | Column, seed: object = fv.SHUFFLE_SEED
) -> DataFrame:
    """n draws from the pool: it is read through and shuffled anew at every wrap.

    Each round is numbered on its own, with a seed made of the round; the position
    of a draw is round * size + place.
    """
    count = F.lit(n).cast("bigint") if isinstance(n, int) else n
    size = pool.agg(F.count(F.lit(1)).alias("n")).scalar()
    rounds = F.sequence(F.lit(0).cast("bigint"), int_div(count - 1, size))
    repeated = pool.withColumn("round", F.explode(F.when(count > 0, rounds)))
    numbered = hash_index(repeated, key, seed, index="_place", parts=["round"])
    drawn = numbered.withColumn("position", F.col("round") * size + F.col("_place"))
    return drawn.filter(F.col("position") < count).drop("_place")
