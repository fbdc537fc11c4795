"""A third of all rows in one key: the results stay whole and no task gets them all."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from medialoom.operators import context as ctx
from medialoom.operators import posts
from medialoom.operators import registry as reg
from medialoom.operators import skew

N = 6000


def hot(column="id", name="hot"):
    return F.when(F.col(column) % 3 == 0, name).otherwise(F.concat(F.lit("k"), F.col(column).cast("string")))


@pytest.fixture
def segmentations(spark):
    return spark.range(N).select(
        F.format_string("%08d", "id").alias("ord"),
        hot().alias("ImageID"),
        F.format_string("m%d.png", "id").alias("MaskPath"),
        F.concat(F.lit("L"), (F.col("id") % 40).cast("string")).alias("LabelName"),
    )


@pytest.fixture
def classes(spark):
    return spark.range(40).select(
        F.concat(F.lit("L"), F.col("id").cast("string")).alias("LabelName"),
        F.format_string("class %02d", "id").alias("ClassName"),
        F.col("id").alias("ord"),
    )


def test_hot_image_keeps_every_row_and_is_spread(spark, segmentations, classes):
    narr = spark.createDataFrame([("hot", "seen often", 1)], "image_id string, caption string, ord bigint")
    rel = segmentations.select(
        "ImageID", F.col("LabelName").alias("LabelName1"), F.col("LabelName").alias("LabelName2"),
        F.lit("at").alias("RelationshipLabel"), "ord",
    )
    out = ctx.prompt_requests(segmentations, segmentations, narr, rel, classes)
    tiers = {r.tier: r.rows for r in ctx.tier_counts(out).collect()}
    assert tiers == {1: N // 3, 2: N - N // 3, 3: 0, 4: 0}
    lists = {r.ImageID: r.relationships for r in ctx.relationships_per_image(
        ctx.relationship_triplets(rel, ctx.class_lookup(classes))
    ).filter("ImageID = 'hot'").collect()}
    assert lists["hot"] == [f"class {i % 40:02d} at class {i % 40:02d}" for i in range(0, 24, 3)]
    scene = ctx.scene_objects(segmentations, ctx.class_lookup(classes)).filter("ImageID = 'hot'").first()
    assert scene.objects == [f"class {i:02d}" for i in range(40)]


def test_rows_of_a_hot_key_go_to_many_salts(spark, segmentations):
    # as many salts as the rows of a key make tasks of 300 rows
    salts = segmentations.select(skew.salts_of(segmentations, "ImageID", 300).alias("h")).first().h
    assert salts == {"hot": 7}
    right = spark.createDataFrame([("hot", 1)], "ImageID string, v int")
    joined = skew.salted_left_join(segmentations, right, "ImageID", ["ord"], rows_per_task=300)
    assert joined.filter("v = 1").count() == N // 3 and joined.count() == N


def test_one_hot_source(spark):
    sources = posts.labelled_sources(
        spark.createDataFrame([("hot", 0), ("b", 1)], "source string, ord int"),
        spark.createDataFrame([("c", 0)], "source string, ord int"),
    )
    created = F.timestamp_seconds(F.lit(1704067200) + F.col("id"))
    stored = spark.range(N).select(
        F.col("id").cast("string").alias("id"),
        F.when(F.col("id") % 3 == 0, "HOT").otherwise("b").alias("source"),
        created.alias("created_utc"),
        F.lit("u/x.png").alias("url"),
        F.lit(False).alias("is_video"),
        F.lit(None).cast("struct<reddit_video:struct<fallback_url:string>>").alias("media"),
    )
    none = spark.createDataFrame(
        [], "filename string, label string, subreddit string, post_date string, reddit_id string, packaged boolean"
    )
    copies = stored.unionByName(stored).unionByName(stored)
    added = posts.ingest(copies, none, sources, dt.datetime(2024, 2, 1))
    got = {r.subreddit: r["count"] for r in added.groupBy("subreddit").count().collect()}
    assert got == {"hot": N // 3, "b": N - N // 3}


def test_one_hot_run_and_model(spark):
    attempts = spark.range(N).select(
        hot().alias("run"),
        F.col("id").alias("seq"),
        hot(name="org/hot").alias("model_id"),
        F.when(F.col("id") == 3000, 14).otherwise(0).alias("exit_code"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id")).alias("ts"),
    )
    kept = reg.before_halt(attempts)
    assert kept.filter("run = 'hot'").count() == 1000
    assert kept.count() == N - 1000
    changes = reg.registry_changes(attempts)
    empty = spark.createDataFrame([], "model_id string, status string, reason string, date string, ord bigint")
    newest = reg.upsert_registry(empty, changes).filter("model_id = 'org/hot'").first()
    assert newest.ord == 2997


def test_no_window_over_all_rows(spark, segmentations):
    """A window without partitions only ever sees the bucket counts."""
    from medialoom.operators import numbering as num

    for df in (num.hash_index(segmentations, ["ord"]), num.ordered_index(segmentations, ["ord"])):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        for line in plan.splitlines():
            if "Window [" in line and "row_number" in line:
                assert "[_bucket" in line


@pytest.mark.parametrize("rows_per_task", [300, 1 << 20])
def test_salted_flag_keeps_every_row_once(spark, segmentations, rows_per_task):
    # keys named twice or null; a null key is never there
    right = spark.createDataFrame([("hot",), ("k1",), ("k1",), ("hot",), (None,), ("none",)], "ImageID string")
    left = segmentations.withColumn("ImageID", F.when(F.col("ImageID") != "k2", F.col("ImageID")))
    flagged = skew.salted_flag(left, right, "ImageID", ["ord"], "there", rows_per_task)
    got = {r.ord: r.there for r in flagged.select("ord", "there").collect()}
    assert flagged.count() == N == len(got)
    assert got == {f"{i:08d}": i % 3 == 0 or i == 1 for i in range(N)}
