from medialoom.operators import sampling as smp


def test_first_existing_layout(spark, rows):
    needed = spark.createDataFrame([("Ab.png",), ("b.png",), ("c.png",), ("d.png",)], "MaskPath string")
    files = spark.createDataFrame(
        [("train-masks-a/Ab.png",), ("a/Ab.png",), ("b.png",), ("b/b.png",), ("train-masks-c/c.png",), ("x/d.png",)],
        "path string",
    )
    assert rows(smp.resolve_mask_path(needed, files)) == [
        ("Ab.png", "a/Ab.png"), ("b.png", "b.png"), ("c.png", "train-masks-c/c.png"), ("d.png", None)
    ]


def test_uncached_images(spark, rows):
    seen = spark.createDataFrame([("i",), ("i",), ("j",), ("k",)], "ImageID string")
    files = spark.createDataFrame([("j",), ("z",)], "image string")
    assert rows(smp.uncached_images(seen, files)) == [("i",), ("k",)]
    assert smp.cache_counts(seen, files).first().asDict() == {"to_fetch": 2, "cached": 1}


def test_layouts_of_odd_names(spark, rows):
    names = ["", "/", "/a", "//", "a", "A", "a/b", "a/a", "train-masks-a", "İx", "é.png", "train-masks-t/t", "z"]
    layouts = {m: [m, f"{m[:1].lower()}/{m}", f"train-masks-{m[:1].lower()}/{m}"] for m in names}
    others = ["train-masks-", "x/", "//a", "b/a", "/", "train-masks-//a", "a//a"]
    paths = sorted({p for i, m in enumerate(names) for p in layouts[m][i % 3 :]} | set(others))
    want = sorted(((m, next((p for p in layouts[m] if p in paths), None)) for m in names), key=repr)
    needed = spark.createDataFrame([(m,) for m in names], "MaskPath string")
    files = spark.createDataFrame([(p,) for p in paths], "path string")
    assert rows(smp.resolve_mask_path(needed, files)) == want


def test_masks_are_shuffled_by_their_own_name_only(spark):
    needed = spark.range(9).selectExpr("cast(id as string) as MaskPath")
    files = spark.range(9).selectExpr("cast(id as string) as path")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = smp.resolve_mask_path(needed, files)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2
