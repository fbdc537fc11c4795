import pytest
from pyspark.sql import functions as F

from medialoom.operators import context as ctx


@pytest.fixture
def tables(spark):
    make = spark.createDataFrame
    classes = make(
        [(1, "L1", "Old"), (2, "L1", "Cat"), (3, "L2", "Dog"), (4, "L9", "Never")],
        "ord bigint, LabelName string, ClassName string",
    )
    seg = make(
        [
            (1, "told", "a.png", "L1"), (2, "told", "b.png", "L2"), (3, "related", "c.png", "L2"),
            (4, "seen", "d.png", "L1"), (5, "seen", "e.png", "L2"), (6, "seen", "f.png", "L2"),
            (7, "bare", "g.png", "L7"),
        ],
        "ord bigint, ImageID string, MaskPath string, LabelName string",
    )
    rel = make(
        [(i, "related", "L1", "L2", f"r{i}") for i in range(9)]
        + [(20, "related", "L1", "L7", None), (21, "told", "L8", "L2", "at")],
        "ord bigint, ImageID string, LabelName1 string, LabelName2 string, RelationshipLabel string",
    )
    narr = make(
        [
            (1, "told", ""), (2, "told", "x" * 299 + "\U0001f600" + "tail"), (3, "told", "second"),
            (4, "", "no image"), (5, "empty", ""),
        ],
        "ord bigint, image_id string, caption string",
    )
    return classes, seg, rel, narr


def test_class_lookup_last_wins(tables, rows):
    assert rows(ctx.class_lookup(tables[0])) == [("L1", "Cat"), ("L2", "Dog"), ("L9", "Never")]


def test_first_narrative(tables, rows):
    got = rows(ctx.first_narrative(tables[3]))
    assert got == [("told", "x" * 299 + "\U0001f600")]


def test_triplets_and_cap(tables, rows):
    classes, _, rel, _ = tables
    triplets = ctx.relationship_triplets(rel, ctx.class_lookup(classes))
    assert triplets.count() == 10  # the null relation is dropped
    assert ("told", "Object at Dog") in rows(triplets, "ImageID", "triplet")
    lists = dict(rows(ctx.relationships_per_image(triplets)))
    assert lists["related"] == [f"Cat r{i} Dog" for i in range(8)]


def test_scene_objects(tables, rows):
    classes, seg, _, _ = tables
    got = dict(rows(ctx.scene_objects(seg, ctx.class_lookup(classes))))
    assert got == {"told": ["Cat", "Dog"], "related": ["Dog"], "seen": ["Cat", "Dog"]}


@pytest.mark.parametrize("parts", [1, 7, 50])
def test_tiers_and_messages(tables, parts):
    classes, seg, rel, narr = tables
    out = ctx.prompt_requests(seg.repartition(parts), seg, narr, rel, classes)
    got = {r.MaskPath: r for r in out.collect()}
    assert [got[m].tier for m in ("a.png", "c.png", "d.png", "g.png")] == [1, 2, 3, 4]
    assert got["g.png"].context == "Object to replace: object"
    assert got["d.png"].context == "Objects in the image: Cat, Dog\nObject to replace: Cat"
    assert got["c.png"].context.startswith("Scene relationships: Cat r0 Dog; Cat r1 Dog")
    assert got["a.png"].context.endswith('"\nObject to replace: Cat')
    assert got["a.png"].message.startswith('Somebody told about this photo: "xxx')
    assert got["d.png"].message.count("the Cat") == 2
    counts = {r.tier: r.rows for r in ctx.tier_counts(out).collect()}
    assert counts == {1: 2, 2: 1, 3: 3, 4: 1}


def test_own_template(tables):
    classes, seg, rel, narr = tables
    joined = ctx.with_class_names(seg, ctx.class_lookup(classes)).withColumns(
        {c: F.lit(None).cast(k) for c, k in (("caption", "string"), ("relationships", "array<string>"), ("objects", "array<string>"))}
    )
    got = {r.MaskPath: r.message for r in ctx.build_user_message(joined, "<{target}> {context}.").collect()}
    assert got["a.png"] == "<Cat> There is a Cat in this photo."
    assert got["g.png"] == "<object> There is a object in this photo."


def test_tier_counts_zero_filled(spark):
    df = spark.createDataFrame([(2,), (2,)], "tier int")
    assert {r.tier: r.rows for r in ctx.tier_counts(df).collect()} == {1: 0, 2: 2, 3: 0, 4: 0}


def test_merge_shards_in_text_order(spark):
    a = spark.createDataFrame([("shard_2", 1)], "shard_name string, ord int")
    b = spark.createDataFrame([("shard_10", 5)], "shard_name string, ord int")
    assert [r.shard_name for r in ctx.merge_shards([a, b], order=True).collect()] == ["shard_10", "shard_2"]
