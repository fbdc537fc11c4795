import json
import zipfile
from collections import Counter
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F

from medialoom import schemas
from medialoom.operators import backfill as back
from medialoom.operators import masks as mask_ops
from medialoom.operators import packaging as pack
from medialoom.operators import scoring
from medialoom.plans import all_queries, source_queries
from medialoom.session import scratch_folder
from medialoom.sources import archives, readers, writers

NASTY = 'say "hi", then\nnew line\\ and \'quote\''


# --- readers ----------------------------------------------------------------


@pytest.mark.parametrize("kind", ["generated", "inpaint", "posts"])
def test_absent_files_are_empty_tables(spark, tmp_path, kind):
    df = readers.read_metadata(spark, str(tmp_path / "none.csv"), kind)
    assert df.count() == 0 and df.columns == writers.columns_of(schemas.METADATA[kind])


def test_absent_annotation_files(spark, tmp_path):
    none = str(tmp_path / "none")
    for read in (readers.read_relationships, readers.read_narratives, readers.read_registry,
                 readers.read_upload_tracker, readers.read_catalogue, readers.read_posts):
        assert read(spark, none).count() == 0


def test_csv_as_python_writes_it(spark, tmp_path):
    path = tmp_path / "metadata.csv"
    pd.DataFrame(
        [["a.png", NASTY, "fake", "m", "Base", "unknown", False], ["b.png", None, "fake", "m", "Base", "NA", True]],
        columns=writers.columns_of(schemas.GENERATED_METADATA),
    ).to_csv(path, index=False)
    got = {r.filename: r for r in readers.read_metadata(spark, str(path), "generated").collect()}
    assert got["a.png"].prompt == NASTY and got["b.png"].prompt is None
    assert got["b.png"].release_date == "NA" and got["b.png"].packaged is True


def test_append_metadata_round_trip(spark, tmp_path):
    row = spark.createDataFrame([("a.png", NASTY, "fake", "m", "Base", "unknown", False)], schemas.GENERATED_METADATA)
    for kind in ("parquet", "csv"):
        path = str(tmp_path / kind)
        writers.append_metadata(row, path, "generated", kind)
        writers.append_metadata(row.withColumn("extra", F.lit(1)), path, "generated", kind)
        read = readers.read_metadata(spark, path, "generated") if kind == "csv" else spark.read.parquet(path)
        assert [r.prompt for r in read.collect()] == [NASTY, NASTY]


def test_classes_relationships_narratives(spark, tmp_path):
    (tmp_path / "classes.csv").write_text("L1,Old\nL2,Dog\nL1,Cat\n")
    from medialoom.operators.context import class_lookup, first_narrative

    lookup = class_lookup(readers.read_classes(spark, str(tmp_path / "classes.csv")))
    assert {r.LabelName: r.ClassName for r in lookup.collect()} == {"L1": "Cat", "L2": "Dog"}
    for name in ("RelationshipLabel", "RelationLabel"):
        (tmp_path / "vrd.csv").write_text(f"ImageID,LabelName1,Extra,LabelName2,{name}\ni,L1,9,L2,at\n")
        r = readers.read_relationships(spark, str(tmp_path / "vrd.csv")).first()
        assert (r.ImageID, r.LabelName1, r.LabelName2, r.RelationshipLabel) == ("i", "L1", "L2", "at")
    lines = [{"image_id": "i", "caption": ""}, {"image_id": "i", "caption": "first"}, {"image_id": "i", "caption": "next"}]
    (tmp_path / "n.jsonl").write_text("\n".join(json.dumps(x) for x in lines))
    assert first_narrative(readers.read_narratives(spark, str(tmp_path / "n.jsonl"))).first().caption == "first"


def test_registry_tracker_and_shards(spark, tmp_path):
    entries = {"b/x": {"status": "COMPLETED", "date": "d"}, "a/y": {"status": "MODEL_FAULT", "reason": "r", "date": "d"}}
    (tmp_path / "registry.json").write_text(json.dumps(entries, indent=4))
    got = [(r.ord, r.model_id, r.status, r.reason) for r in readers.read_registry(spark, str(tmp_path / "registry.json")).orderBy("ord").collect()]
    assert got == [(0, "b/x", "COMPLETED", None), (1, "a/y", "MODEL_FAULT", "r")]
    (tmp_path / ".uploaded.json").write_text('["x.parquet", "y.parquet"]')
    (tmp_path / "uploaded.json").write_text('["x.parquet", "y.parquet"]')
    assert readers.read_upload_tracker(spark, str(tmp_path / "uploaded.json")).count() == 2
    for i in (2, 10):
        (tmp_path / f"shard_{i}.csv").write_text(f'ImageID,MaskPath,LabelName,ClassName,generated_prompt\ni{i},m,l,c,"a ""b"""\n')
    shards = readers.read_prompt_shards(spark, str(tmp_path / "shard_*.csv")).collect()
    assert {(r.shard_name, r.ImageID, r.generated_prompt) for r in shards} == {("shard_2", "i2", 'a "b"'), ("shard_10", "i10", 'a "b"')}


def test_images_and_listing(spark, tmp_path):
    (tmp_path / "ok.png").write_bytes(mask_ops.png_bytes(bytes([0, 255, 9, 0, 0, 1]), 2, 3))
    (tmp_path / "bad.PNG").write_bytes(b"no image")
    (tmp_path / "note.txt").write_text("x")
    names = {r.path for r in readers.list_files(spark, str(tmp_path), [".png"], ignore_case=True).collect()}
    assert names == {"ok.png", "bad.PNG"}
    images, broken = readers.read_images(spark, str(tmp_path), [".png", ".PNG"])
    r = images.first()
    assert (r.path, r.height, r.width, bytes(r.data)) == ("ok.png", 2, 3, bytes([0, 255, 9, 0, 0, 1]))
    assert [b.path for b in broken.collect()] == ["bad.PNG"]


def test_archives(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "train-masks-a.zip", "w") as z:
        for i in range(30):
            z.writestr(f"a{i}.png", bytes([i]))
    with zipfile.ZipFile(tmp_path / "train-masks-b.zip", "w") as z:
        z.writestr("b0.png", b"zero")
    (tmp_path / "train-masks-c.zip").write_bytes(b"corrupt")
    with zipfile.ZipFile(tmp_path / "train-masks-d.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("d0.png", b"fine")
        z.writestr("d1.png", bytes(range(256)) * 9)
    with zipfile.ZipFile(tmp_path / "train-masks-d.zip") as z:
        start = z.getinfo("d1.png").header_offset + 30 + len("d1.png")
    spoiled = bytearray((tmp_path / "train-masks-d.zip").read_bytes())
    spoiled[start : start + 20] = b"\xff" * 20
    (tmp_path / "train-masks-d.zip").write_bytes(bytes(spoiled))
    wanted = spark.createDataFrame([(f"a{i}.png",) for i in range(0, 30, 2)] + [("b0.png",), ("c.png",), ("d0.png",), ("d1.png",)], "MaskPath string")
    listed = archives.list_archives(spark, str(tmp_path))
    content, broken = archives.extract_archive_members(listed, wanted, piece_bytes=8)
    got = {r.path: bytes(r.content) for r in content.collect()}
    assert got == {**{f"a{i}.png": bytes([i]) for i in range(0, 30, 2)}, "b0.png": b"zero", "d0.png": b"fine"}
    assert sorted((r.archive, r.member) for r in broken.collect()) == [
        ("train-masks-c.zip", None), ("train-masks-d.zip", "d1.png"),
    ]
    contents = archives.archive_contents(listed, piece_bytes=8).filter("archive = 'train-masks-a.zip'").orderBy("place").collect()
    assert [(r.member, r.bytes, r.piece) for r in contents] == [(f"a{i}.png", 1, i // 8) for i in range(30)]
    assert content.rdd.getNumPartitions() >= 4  # a task for each piece
    written = spark.read.parquet(*{f.rsplit("/", 1)[0] for f in content.inputFiles()})
    assert "content" not in written.columns
    members = archives.archive_members(listed)
    assert [r.MaskPath for r in archives.not_found(members, wanted).collect()] == ["c.png"]


# --- packaging --------------------------------------------------------------


def test_image_shards_resume_and_skip_missing(spark, tmp_path):
    folder, out = tmp_path / "files", str(tmp_path / "out")
    folder.mkdir()
    for i in range(24):
        (folder / f"f{i}.jpg").write_bytes(bytes([i]))
    metadata = spark.createDataFrame([(f"f{i}.jpg", "real" if i % 2 else None) for i in range(25)], "filename string, label string")
    files = readers.list_files(spark, str(folder), [".jpg"])
    plan = pack.write_image_shards(metadata, files, out, size=10)
    stored = spark.read.parquet(out)
    assert stored.count() == 24 and stored.filter("label is null").count() == 0
    assert all(bytes(r.image.bytes) == bytes([int(r.image.path[1:-4])]) for r in stored.collect())
    shards = {r.filename: r.shard for r in plan.collect()}
    assert all(shards[r.image.path] == r.shard for r in stored.collect())
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "out").glob("shard=*/*.parquet")}
    pack.write_image_shards(metadata, files, out, size=10)
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "out").glob("shard=*/*.parquet")}
    assert before == after and len(before) == 3


def test_image_shards_take_new_rows_once(spark, tmp_path):
    folder, out = tmp_path / "files", str(tmp_path / "out")
    folder.mkdir()
    metadata = spark.createDataFrame([(f"f{i}.jpg", "real") for i in range(47)], "filename string, label string")
    for known in (20, 40, 40, 47):  # files that are late are packed by a later run
        for i in range(known):
            (folder / f"f{i}.jpg").write_bytes(bytes([i]))
        files = readers.list_files(spark, str(folder), [".jpg"])
        pack.write_image_shards(metadata, files, out, size=15)
        stored = spark.read.parquet(out).select("image.path", "shard").collect()
        assert sorted(r.path for r in stored) == sorted(f"f{i}.jpg" for i in range(known))
    sizes = {}
    for r in stored:
        sizes[r.shard] = sizes.get(r.shard, 0) + 1
    assert sizes == {0: 15, 1: 5, 2: 15, 3: 5, 4: 7}


def test_prompt_shards_resume(spark, tmp_path):
    path = str(tmp_path / "shards")
    df = spark.range(40).select("id", (F.col("id") % 4).alias("shard"))
    writers.write_prompt_shards(df.filter("shard < 2").withColumn("run", F.lit(1)), path)
    writers.write_prompt_shards(df.withColumn("run", F.lit(2)), path)
    got = {(r.shard, r.run): r["count"] for r in spark.read.parquet(path).groupBy("shard", "run").count().collect()}
    assert got == {(0, 1): 10, (1, 1): 10, (2, 2): 10, (3, 2): 10}


def test_mark_summary_and_uploads(spark):
    rows = spark.createDataFrame(
        [("a", "real", "s1", None), ("b", "fake", "s2", True), ("c", None, "s1", False)],
        "filename string, label string, subreddit string, packaged boolean",
    )
    shipped = rows.filter("filename = 'a'")
    assert {r.filename: r.packaged for r in pack.mark_packaged(rows, shipped).collect()} == {"a": True, "b": True, "c": False}
    assert all(r.packaged for r in pack.mark_packaged(rows).collect())
    assert {r.filename for r in pack.only_unpackaged(rows).collect()} == {"a", "c"}
    summary = {(r.column, r.value): r.rows for r in pack.dataset_summary(rows, "subreddit", ["label"]).collect()}
    assert summary == {("label", "real"): 1, ("label", "fake"): 1, ("label", None): 1, ("distinct subreddit", None): 2}
    files = spark.createDataFrame([(f"d/p{i:02d}.parquet", 1024 * 1024) for i in range(23)], "path string, length bigint")
    done = spark.createDataFrame([("p03.parquet",)], "name string")
    batches = {r.batch: r for r in pack.upload_batches(files, done, "posts").collect()}
    assert {b: (r.files, r.megabytes) for b, r in batches.items()} == {1: (10, 10.0), 2: (10, 10.0), 3: (2, 2.0)}
    assert batches[1].message == "Add posts shards: p00.parquet to p10.parquet"
    assert batches[3].paths == ["posts/train/p21.parquet", "posts/train/p22.parquet"]


# --- scoring ----------------------------------------------------------------


def test_batches_have_the_asked_size(spark):
    def sizes():
        return lambda batch: [len(batch)] * len(batch)

    from pyspark.sql import types as T

    df = spark.range(70).repartition(1)
    got = [r.n for r in scoring.call_in_batches(df, sizes, "n", T.LongType(), 32).collect()]
    assert sorted(got) == [6] * 6 + [32] * 64


def test_score_and_drop(spark):
    def scorer():
        return lambda batch: [[{"label": "nsfw", "score": 0.7 if f == "b" else 0.69}] for f in batch["filename"]]

    files = spark.createDataFrame([("a",), ("b",)], "filename string")
    scores = scoring.score_files(files, scorer)
    assert [r.filename for r in scoring.drop_unsafe(files, scores).collect()] == ["a"]


def test_adaptive_batches_keep_every_row(spark):
    def narrow():
        def run(batch):
            if len(batch) > 2:
                raise RuntimeError("CUDA out of memory")
            return [str(i) for i in batch["id"]]

        return run

    rows = scoring.adaptive_batches(spark.range(31).repartition(2), narrow, 12).collect()
    assert sorted(int(r.output) for r in rows) == list(range(31))
    assert all(r.exit_code == 0 for r in rows) and {r.batch_size for r in rows} == {1}


def test_adaptive_batches_fail_at_one(spark):
    def hopeless():
        def run(batch):
            raise MemoryError("no room")

        return run

    rows = scoring.adaptive_batches(spark.range(30).repartition(1), hopeless, 4).collect()
    assert len(rows) == 30 and {(r.output, r.exit_code) for r in rows} == {(None, 12)}


def test_adaptive_batches_give_up_one_row_only(spark):
    def poisoned():
        def run(batch):
            if (batch["id"] == 37).any():
                raise RuntimeError("CUDA out of memory")
            return [str(i) for i in batch["id"]]

        return run

    rows = scoring.adaptive_batches(spark.range(100).repartition(1), poisoned, 16).collect()
    assert {(r.id, r.exit_code) for r in rows if r.output is None} == {(37, 12)} and len(rows) == 100
    assert all(r.output == str(r.id) and r.exit_code == 0 for r in rows if r.id != 37)


# --- backfill ---------------------------------------------------------------


MATCHES = {
    "hf_org_m_5.png": ("org/m", None),
    "hf_org_m_2026-04-08_5.png": ("org/m_2026-04-08", None),
    "hf_org_m_2_7.png": ("org/m_2", None),
    "hf_org_m_2026-04-08_2026-04-09_1.png": ("org/m_2026-04-08", "2026-04-09"),
    "hf_org_m_x.png": (None, None),
    "org_m_5.png": (None, None),
    "hf_org_m_5.jpg": (None, None),
    "hf_a_b_c_1.png": ("a_b/c", None),
    "hf_org_m_2_x_2025-01-01_3.png": ("org/m_2/x", "2025-01-01"),
    "hf_o_é_3.png": ("o/é", None),
    "hf_.png": (None, None),
    "hf_org_m_2_2.png": ("org/m_2", None),
    "hf_org_m_2_2026-04-08_2.png": ("org/m_2", "2026-04-08"),
}


def test_summary_of_runs(spark, tmp_path):
    """Increments add up to the summary of all rows; a repeated run replaces itself."""
    path = str(tmp_path / "summary")
    rows = spark.range(40_000).select(
        F.format_string("user%d", F.col("id") % 30_000).alias("author"),
        F.when(F.col("id") % 7 != 0, F.col("id") % 3).cast("string").alias("label"),
        (F.col("id") % 4).alias("run"),
    )
    assert pack.merged_summary(pack.read_summaries(spark, path)).count() == 0
    for run in (0, 1, 2, 3, 2):
        pack.write_summary(pack.summary_increment(rows.filter(F.col("run") == run), "author", ["label"]), path, f"r{run}")
    got = {(r.column, r.value): r.rows for r in pack.merged_summary(pack.read_summaries(spark, path)).collect()}
    exact = {(r.column, r.value): r.rows for r in pack.dataset_summary(rows, "author", ["label"]).collect()}
    assert got.keys() == exact.keys()
    distinct = ("distinct author", None)
    assert abs(got.pop(distinct) - 30_000) <= 0.02 * 30_000 and exact.pop(distinct) == 30_000
    assert got == exact
    nothing = pack.summary_increment(rows.filter("false"), "author", ["label"])
    pack.write_summary(nothing, path, "r2")  # the run is known, now without rows
    left = {(r.column, r.value): r.rows for r in pack.merged_summary(pack.read_summaries(spark, path)).collect()}
    assert left[("label", None)] == rows.filter("label is null and run <> 2").count()


def test_match_files_to_models(spark):
    registry = ["org/m", "org/m_2", "org/m_2026-04-08", "a/b_c", "a_b/c", "org/m_2/x", "o/é"]
    reg = spark.createDataFrame([(m, i) for i, m in enumerate(registry)], "model_id string, ord bigint")
    files = spark.createDataFrame([(n,) for n in MATCHES], "filename string")
    got = {r.filename: (r.model, r.date) for r in back.match_files_to_models(files, reg).collect()}
    assert got == MATCHES
    plan = back.match_files_to_models(files, reg)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan
    assert {r.stem: r.models for r in back.name_collisions(reg).collect()} == {"a_b_c": 2}


def test_files_without_a_stem_share_no_task(spark):
    """Two thirds of the files have no stem, the others are matched before the second join."""
    reg = spark.createDataFrame([("o/m", 0)], "model_id string, ord bigint")
    names = [f"img_{i}.png" for i in range(600)] + [f"hf_o_m_{i}.png" for i in range(300)] + [None]
    files = spark.createDataFrame([(n,) for n in names], "filename string")
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        matched = back.match_files_to_models(files, reg).withColumn("task", F.spark_partition_id())
        rows = matched.collect()
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert len(rows) == 901 and sum(r.model == "o/m" for r in rows) == 300
    most = max(Counter(r.task for r in rows).values())
    assert most < 901 / 3


def test_backfill_types(spark):
    reg = spark.createDataFrame([("o/big", 0), ("o/mid", 1), ("o/small", 2)], "model_id string, ord bigint")
    sizes = {"big": 8000, "mid": 4000, "small": 3999}
    parts = [spark.range(n).select(F.format_string(f"hf_o_{m}_%d.png", "id").alias("filename")) for m, n in sizes.items()]
    files = parts[0].union(parts[1]).union(parts[2])
    catalogue = spark.createDataFrame([("o/big", "2024-05-06 07:00:00")], "id string, t string").select(
        "id", F.to_timestamp("t").alias("created_at")
    )
    tracked = spark.createDataFrame([("hf_o_mid_0.png",)], "filename string")
    rows = back.backfill_rows(files, tracked, reg, catalogue)
    got = {(r.model, r.type, r.release_date): r["count"] for r in rows.groupBy("model", "type", "release_date").count().collect()}
    assert got == {("o/big", "Base", "2024-05-06"): 8000, ("o/mid", "LoRA", "unknown"): 3999, ("o/small", "LoRA", "unknown"): 3999}
    whole = back.backfill_rows(files, tracked, reg, catalogue, all_files=True)
    assert {(r.model, r.type) for r in whole.select("model", "type").distinct().collect()} == {
        ("o/big", "Base"), ("o/mid", "Fine-tune"), ("o/small", "LoRA")
    }


def test_feed_pages_per_file_or_per_line(spark, tmp_path):
    (tmp_path / "files").mkdir()
    (tmp_path / "files" / "a.json").write_text('{"items": [1,\n 2]}\n')
    (tmp_path / "files" / "b.json").write_text("no json")
    (tmp_path / "lines.json").write_text('{"items": [1]}\nno json\n{"items": []}\n')
    size = F.size(F.try_variant_get("page", "$.items", "array<variant>")).alias("n")
    files = readers.read_feed_pages(spark, str(tmp_path / "files"))
    assert [r.n for r in files.orderBy("path").select(size).collect()] == [2, None]
    lines = readers.read_feed_pages(spark, str(tmp_path / "lines.json"), lines=True)
    assert sorted((r.n is None, r.n) for r in lines.select(size).collect()) == [(False, 0), (False, 1), (True, None)]


def written_by(spark, monkeypatch, query):
    """Files and folders of the scratch folder that a query at sf0.01 writes, and its rows."""
    folders = []

    def noted(session, purpose):
        folders.append(scratch_folder(session, purpose))
        return folders[-1]

    monkeypatch.setattr(source_queries, "scratch_folder", noted)
    rows = all_queries.QUERIES[query](spark, "/root/testdata/sf0.01").count()
    found = [p for folder in folders for p in Path(folder).rglob("[!._]*")]
    return [p for p in found if p.is_file()], [p for p in found if p.is_dir()], rows


def test_feed_pages_take_no_folder_each(spark, monkeypatch):
    files, folders, rows = written_by(spark, monkeypatch, "read_feed_pages")
    assert (len(files) <= 4, folders, rows) == (True, [], 8334)  # 200 pages, four tasks


@pytest.mark.parametrize("query, count", [("read_upload_tracker_file", 399), ("read_registry_file", 1500)])
def test_whole_files_take_no_folder_each(spark, monkeypatch, query, count):
    files, folders, rows = written_by(spark, monkeypatch, query)
    assert (len(files), folders, rows) == (1, [], count)


def test_whole_files_hold_one_text_each(spark, monkeypatch):
    monkeypatch.setattr(source_queries, "FILE_ENTRIES", 100)
    files, folders, rows = written_by(spark, monkeypatch, "read_upload_tracker_file")
    assert (len(files), folders, rows) == (10, [], 399)  # ids up to 1,000
