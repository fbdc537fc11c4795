"""Left join that spreads hot keys of the left side over many tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_KEYS = 1024  # the sketch names at most this many keys
TRACKED = 16_384  # counters of the frequency sketch
ROWS_PER_TASK = 1 << 20  # a key with more rows is spread, over as many tasks as that makes
SALT = "_salt"


def salts_of(df: DataFrame, key: str, rows_per_task: int = ROWS_PER_TASK) -> Column:
    """Map from each hot key to its number of tasks, as a scalar subquery over one narrow pass.

    A key is hot if it has more rows than one task should join, so both the choice of keys and
    the number of tasks follow the row counts. The sketch has a fixed size and is merged
    from partial sketches; no more than 1024 keys can hold a thousandth of all rows. It only
    decides how keys are spread; the join is exact whatever it says, and what lies below the
    heaviest keys is left to adaptive execution.
    """
    counted = df.select(F.col(key).alias("k")).agg(
        F.expr(f"approx_top_k(k, {HOT_KEYS}, {TRACKED})").alias("top")
    )
    hot = F.filter("top", lambda t: t["item"].isNotNull() & (t["count"] > rows_per_task))
    entries = F.transform(
        hot, lambda t: F.struct(t["item"], F.ceil(t["count"] / rows_per_task).cast("int"))
    )
    return counted.select(F.map_from_entries(entries).alias("salts")).scalar()


def salted_left_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    spread: list[str],
    rows_per_task: int = ROWS_PER_TASK,
    counted: DataFrame | None = None,
) -> DataFrame:
    """left ⟕ right on key. Rows of hot keys are spread by a hash of ``spread``,
    and only the matching right rows are repeated, once per salt.

    ``counted`` is a table with about as many rows of each key as ``left``: give the one that
    ``left`` was made from to count its keys without making it twice."""
    salts = salts_of(left if counted is None else counted, key, rows_per_task)
    repeated = (
        right.withColumn("_salts", salts)
        .withColumn(SALT, F.explode(F.sequence(F.lit(0), _tasks(key) - 1)))
        .drop("_salts")
    )
    return _salted(left, key, spread, salts).join(repeated, [key, SALT], "left").drop(SALT)


def salted_flag(
    left: DataFrame,
    right: DataFrame,
    key: str,
    spread: list[str],
    flag: str,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """left with a flag that tells whether right holds its key, as often as it may; salted alike.

    Keys of right are repeated first and made distinct with their salt, so one shuffle of them
    serves both that and the join. A key leaves the repetition as a new column, so that the
    filter for null keys is not pushed below it, where the key would be worked out once more.
    """
    salts = salts_of(left, key, rows_per_task)
    keys = right.select(key).withColumn("_salts", salts)
    repeated = keys.select(F.posexplode(F.array_repeat(key, _tasks(key))).alias(SALT, key))
    there = repeated.groupBy(key, SALT).agg(F.max(F.lit(True)).alias(flag))
    joined = _salted(left, key, spread, salts).join(there, [key, SALT], "left").drop(SALT)
    return joined.withColumn(flag, F.coalesce(flag, F.lit(False)))


def _tasks(key: str) -> Column:
    return F.coalesce(F.try_element_at(F.col("_salts"), F.col(key)), F.lit(1))


def _salted(left: DataFrame, key: str, spread: list[str], salts: Column) -> DataFrame:
    salted = left.withColumn("_salts", salts)
    return salted.withColumn(SALT, F.pmod(F.xxhash64(*spread), _tasks(key)).cast("int")).drop("_salts")
