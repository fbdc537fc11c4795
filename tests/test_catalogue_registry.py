import pytest
from pyspark.sql import functions as F

from medialoom.operators import catalogue as cat
from medialoom.operators import registry as reg


@pytest.fixture
def catalogue(spark):
    data = [
        ("a/low", ["diffusers"], None, "text-to-image", 29999, ["x.safetensors"]),
        ("a/edge", ["diffusers"], None, "text-to-image", 30000, ["x.safetensors"]),
        ("a/null", ["diffusers"], None, None, None, ["x.safetensors"]),
        ("a/video", ["diffusers"], '"b/base"', "text-to-video", 50000, ["x.safetensors"]),
        ("a/3d", [], '["b/one"]', "text-to-3D", 50000, ["x.bin"]),
        ("a/lora", ["LoRA"], '["b/one","b/two"]', "text-to-image", 50000, ["d/x.safetensors"]),
        ("a/peft", ["peft"], "[]", "text-to-image", 50000, ["x.safetensors"]),
        ("a/tag", ["base_model:adapter:Org/M", "base_model:z"], '""', "text-to-image", 50000, ["x.safetensors"]),
        ("a/adapter", ["Adapter"], None, "", 50000, []),
        ("a/done", ["diffusers"], None, "text-to-image", 90000, ["x.safetensors"]),
        ("a/retry", ["diffusers"], None, "text-to-image", 90000, ["x.safetensors"]),
    ]
    df = spark.createDataFrame(
        data, "id string, tags array<string>, base string, pipeline_tag string, downloads bigint, files array<string>"
    )
    return df.select("id", "tags", F.parse_json("base").alias("base_model"), "pipeline_tag", "downloads", "files")


@pytest.fixture
def registry(spark):
    return spark.createDataFrame(
        [
            ("a/done", "COMPLETED", None, "2026-01-01", 0),
            ("a/peft", "MODEL_FAULT", "x", "2026-01-01", 1),
            ("a/retry", "INFRASTRUCTURE_FAULT", "Node/GPU Out of Memory (Exit 12)", "2026-01-01", 2),
            ("a/edge", "INFRASTRUCTURE_FAULT", None, "2026-01-01", 3),
        ],
        "model_id string, status string, reason string, date string, ord bigint",
    )


def ids(df, column="id"):
    return sorted(r[0] for r in df.select(column).collect())


def test_eligible_models(catalogue, registry):
    common = ["a/edge", "a/lora", "a/retry", "a/tag"]
    assert ids(cat.eligible_models(catalogue, registry, "inpaint")) == common
    assert ids(cat.eligible_models(catalogue, registry, "generate")) == sorted(common + ["a/video"])
    assert ids(cat.eligible_models(catalogue, None, "count")) == sorted(common + ["a/done", "a/peft"])


def test_explicit_ids(catalogue, registry):
    only = ["a/low", "a/done", "a/3d"]
    assert ids(cat.eligible_models(catalogue, registry, "generate", only)) == ["a/low"]
    assert ids(cat.eligible_models(catalogue, registry, "inpaint", only)) == sorted(only)


def test_fault_reason_follows_the_order_of_checks(catalogue, registry):
    def reasons(mode):
        rows = cat.eligibility_faults(catalogue, registry, mode, "d").collect()
        return {r.model_id: r.reason for r in rows}

    assert reasons("generate") == {
        "a/3d": "No safetensors found", "a/adapter": "No safetensors found",
    }
    assert reasons("inpaint") == {
        "a/3d": "Incompatible task: text-to-3D", "a/adapter": "No safetensors found",
        "a/video": "Incompatible task: text-to-video",
    }


def test_classes_and_parents(catalogue):
    got = {r.id: (r.type, r.target, r.base) for r in cat.classify_models(catalogue).collect()}
    assert got["a/edge"] == ("Base", 10000, "None")
    assert got["a/video"] == ("Fine-tune", 5000, "b/base")
    assert got["a/3d"] == ("Fine-tune", 5000, "b/one")
    assert got["a/lora"] == ("LoRA", 2000, "b/one")
    assert got["a/peft"] == ("LoRA", 2000, "None")
    assert got["a/tag"] == ("Fine-tune", 5000, "adapter:org/m")
    second = {r.id: r.base for r in cat.classify_models(catalogue, "inpaint").collect()}
    assert second["a/lora"] == "b/two" and second["a/3d"] == "None"
    stripped = {r.id: r.b for r in catalogue.select("id", cat.resolve_base_model(strip_relation=True).alias("b")).collect()}
    assert stripped["a/tag"] == "org/m"


def test_lost_adapters_and_repos(catalogue):
    classified = cat.classify_models(catalogue)
    assert ids(cat.lora_without_base(classified, "d"), "model_id") == ["a/adapter", "a/peft"]
    repos = ids(cat.required_repos(classified), "repo")
    assert "b/one" in repos and "b/base" not in repos and len(repos) == 12


def test_tier(catalogue, registry):
    got = {r.id: r.tier for r in reg.resource_tier(catalogue, registry).collect()}
    assert got["a/retry"] == "large" and got["a/edge"] == "default" and got["a/done"] == "default"


@pytest.fixture
def attempts(spark):
    codes = [0, 9, 10, 11, 12, 137, 1]
    data = [("r1", i, f"m{i}", c, "RuntimeError", "", f"2026-01-0{i + 1} 00:00:00") for i, c in enumerate(codes)]
    data += [
        ("r1", 20, "halting", 14, "ValueError", "", "2026-02-01 00:00:00"),
        ("r1", 21, "after", 0, "", "", "2026-02-01 00:00:00"),
        ("r1", 22, "m0", 12, "", "", "2026-02-02 00:00:00"),
        ("r2", 23, "m1", 0, "", "", "2026-02-03 00:00:00"),
        ("r2", 24, "m1", 11, "", "", "2026-02-03 00:00:00"),
    ]
    df = spark.createDataFrame(
        data, "run string, seq bigint, model_id string, exit_code int, error_class string, message string, ts string"
    )
    return df.withColumn("ts", F.to_timestamp("ts"))


def test_exit_to_status(attempts):
    got = {r.exit_code: (r.status, r.reason) for r in reg.exit_to_status(attempts).collect()}
    assert got[0] == ("COMPLETED", None)
    assert got[9] == ("INFRASTRUCTURE_FAULT", "Node/GPU Out of Memory (Exit 9)")
    assert got[10] == ("INFRASTRUCTURE_FAULT", "Data/Path Typo (Exit 10)")
    assert got[11] == ("MODEL_FAULT", "Incompatible Architecture (Exit 11)")
    assert got[137][1].endswith("(Exit 137)")
    assert got[1] == ("INFRASTRUCTURE_FAULT", "Generic Slurm/Job Failure (Exit 1)")
    assert got[14][0] == "HALT"


def test_nothing_after_a_halt(attempts):
    kept = {(r.run, r.seq) for r in reg.before_halt(attempts).collect()}
    assert kept == {("r1", i) for i in range(7)} | {("r2", 23), ("r2", 24)}


def test_upsert_is_newest_and_idempotent(attempts, registry, rows):
    changes = reg.registry_changes(attempts)
    once = reg.upsert_registry(registry, changes)
    twice = reg.upsert_registry(once, changes)
    assert rows(once) == rows(twice)
    got = {r.model_id: r.status for r in once.collect()}
    assert got["m1"] == "MODEL_FAULT" and got["m0"] == "COMPLETED"
    assert "halting" not in got and "after" not in got and got["a/done"] == "COMPLETED"


def test_triage(spark):
    data = [
        ("E", "CUDA Out Of Memory: ..."), ("FileNotFoundError", "missing Config.json"),
        ("OSError", "prompts.csv"), ("E", "No such file or directory: a"), ("E", "bad dimension"),
        ("E", "other"), ("E", "Black Image"), ("E", None),
    ]
    logs = spark.createDataFrame([(i, *d) for i, d in enumerate(data)], "i int, error_class string, message string")
    image = [r.triaged_exit for r in reg.triage_errors(logs).orderBy("i").collect()]
    video = [r.triaged_exit for r in reg.triage_errors(logs, "video").orderBy("i").collect()]
    assert image == [12, 11, 10, 10, 11, 14, 14, 14]
    assert video == [12, 11, 10, 10, 11, 14, 11, 14]


def test_evictable_and_completed(registry):
    folders = {r.cache_folder for r in reg.evictable_models(registry).collect()}
    assert folders == {"models--a--done", "models--a--peft"}
    assert ids(reg.completed_models(registry), "model_id") == ["a/done"]


def test_a_change_beats_the_stored_row_of_its_day(spark):
    kind = "model_id string, status string, reason string, date string, ord bigint"
    old = spark.createDataFrame([("m", "MODEL_FAULT", "x", "2026-01-02", 5000)], kind)
    new = spark.createDataFrame([("m", "COMPLETED", None, "2026-01-02", 3)], kind)
    assert reg.upsert_registry(old, new).first().status == "COMPLETED"
    late = spark.createDataFrame([("m", "COMPLETED", None, "2026-01-01", 9000)], kind)
    assert reg.upsert_registry(old, late).first().status == "MODEL_FAULT"
