import pytest
from pyspark.sql import functions as F

from medialoom.functions import fixed_values as fv
from medialoom.operators import posts
from medialoom.plans import flows

KIND = (
    "id string, tags array<string>, base string, pipeline_tag string, downloads bigint, "
    "created string, files array<string>"
)


@pytest.fixture
def catalogue(spark):
    weights = ["x.safetensors"]
    data = [
        ("o/lora", ["diffusers", "lora"], '"o/base"', "text-to-image", 90000, "2024-01-02", weights),
        ("o/lost", ["diffusers", "lora"], None, "text-to-image", 80000, None, weights),
        ("o/base", ["diffusers"], None, "text-to-image", 70000, None, weights),
        ("o/bare", ["diffusers"], None, "text-to-image", 60000, None, []),
        ("o/done", ["diffusers"], None, "text-to-image", 50000, None, weights),
        ("o/other", [], None, "text-to-image", 50000, None, weights),
    ]
    df = spark.createDataFrame(data, KIND)
    return df.select(
        "id", "tags", F.parse_json("base").alias("base_model"), "pipeline_tag", "downloads",
        F.to_timestamp("created").alias("created_at"), "files",
    )


@pytest.fixture
def registry(spark):
    return spark.createDataFrame(
        [("o/done", "COMPLETED", None, "d", 0)],
        "model_id string, status string, reason string, date string, ord bigint",
    )


def test_generate_round(spark, catalogue, registry):
    pool = spark.range(700).select(F.col("id").alias("n"), F.format_string("prompt %d", "id").alias("prompt"))
    work = flows.generate_round(catalogue, registry, pool, ["n"], "2026-04-08")
    rows = work.manifest.collect()
    by_model = {m: [r for r in rows if r.id == m] for m in {r.id for r in rows}}
    assert {m: len(v) for m, v in by_model.items()} == {"o/lora": 2000, "o/base": 10000}
    lora = by_model["o/lora"]
    assert sorted(r.rank for r in lora) == list(range(2000))
    assert {r.filename for r in lora} == {f"hf_o_lora_2026-04-08_{i}.png" for i in range(2000)}
    assert {t: sum(r.task == t for r in lora) for t in (0, 1)} == {0: 1000, 1: 1000}
    for number in (0, 1):  # every round of the pool holds each prompt once
        assert sorted(r.n for r in lora if r["round"] == number) == list(range(700))
    first, second = ([r.n for r in sorted(lora, key=lambda r: r.rank) if r["round"] == i] for i in (0, 1))
    assert first != second
    assert {r.release_date for r in lora} == {"2024-01-02"}
    changes = {r.model_id: r.reason for r in work.registry_changes.collect()}
    assert changes == {"o/lost": fv.REASON_NO_BASE, "o/bare": fv.REASON_NO_WEIGHTS}


def test_inpaint_round_leaves_out_models_that_fall_short(spark, catalogue, registry):
    prompts = spark.range(3000).select(F.format_string("m%d.png", "id").alias("MaskPath"))
    files = prompts.filter("MaskPath <> 'm7.png'").select(F.col("MaskPath").alias("path"))
    work = flows.inpaint_round(catalogue, registry, prompts, files, ["MaskPath"], "d")
    rows = work.manifest.collect()
    assert {r.id for r in rows} == {"o/lora"} and len(rows) == 2000
    assert len({r.MaskPath for r in rows}) == 2000 and "m7.png" not in {r.MaskPath for r in rows}
    assert {r.task for r in rows} == {0, 1, 2}
    changes = {r.model_id: r.reason for r in work.registry_changes.collect()}
    assert changes["o/base"] == "Only 2999 masks available, need 10000"
    assert set(changes) == {"o/lost", "o/bare", "o/base"}


def test_explicit_models(spark, catalogue, registry):
    pool = spark.range(10).select(F.col("id").alias("n"))
    work = flows.generate_round(catalogue, registry, pool, ["n"], "d", only=["o/other", "o/done"])
    assert {r.id for r in work.manifest.select("id").distinct().collect()} == {"o/other"}


def test_posts_to_package(spark):
    metadata = spark.createDataFrame(
        [(f"f{i}", "real", "s", None, f"{i}", i % 2 == 0) for i in range(10)],
        "filename string, label string, subreddit string, post_date string, reddit_id string, packaged boolean",
    )
    scores = spark.createDataFrame([("f1", [("nsfw", 0.9)])], "filename string, result array<struct<label:string,score:double>>")
    files = spark.createDataFrame([(f"f{i}",) for i in range(9)], "path string")
    names = {r.filename for r in flows.posts_to_package(metadata, scores, files).collect()}
    assert names == {f"f{i}" for i in range(9)} - {"f1"}
    new = flows.posts_to_package(metadata, scores, files, new_only=True, size=2).collect()
    assert {r.filename for r in new} == {"f3", "f5", "f7"} and {r.shard for r in new} == {0, 1}


def test_default_sources(spark):
    listed = posts.listed_sources(spark).collect()
    keys = [r.key for r in listed]
    assert len(keys) == len(set(keys)) == 16 + 18
    assert {r.source for r in listed if r.key == "aigeneratedart"} == {"aigeneratedart"}
