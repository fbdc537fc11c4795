import hashlib
import math
from functools import partial
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from medialoom.operators import context, registry
from medialoom.operators import numbering as num
from medialoom.operators import sampling as smp
from medialoom.operators import skew
from medialoom.session import cut_lineage, scratch_removed


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


@pytest.mark.parametrize("parts", [1, 7, 60])
def test_hash_index_is_the_same_for_any_partitioning(spark, parts):
    df = spark.range(500).withColumnRenamed("id", "k").repartition(parts)
    got = {r.k: r.idx for r in num.hash_index(df, ["k"]).collect()}
    order = sorted(range(500), key=lambda k: (md5(f"42|{k}"), k))
    assert got == {k: i for i, k in enumerate(order)}


@pytest.mark.parametrize("bucket_rows,digits", [(500, 1), (20, 2), (1, 3)])
def test_hash_buckets_follow_the_number_of_rows(spark, bucket_rows, digits):
    df = spark.range(500).withColumnRenamed("id", "k")
    numbered = num.hash_index(df, ["k"], bucket_rows=bucket_rows)
    assert [r.idx for r in numbered.orderBy(F.md5(F.concat(F.lit("42|"), "k"))).collect()] == list(range(500))
    assert num.hash_index(df.filter("k < 0"), ["k"], bucket_rows=bucket_rows).count() == 0
    assert spark.range(1).select(num.bucket_digits(df, bucket_rows)).first()[0] == digits


@pytest.mark.parametrize("n,parts", [(0, 1), (1, 1), (3000, 5)])
def test_ordered_index(spark, n, parts):
    df = spark.range(n).select(F.format_string("f%d", "id").alias("name")).repartition(parts)
    got = {r.name: r.idx for r in num.ordered_index(df, ["name"]).collect()}
    assert got == {name: i for i, name in enumerate(sorted(f"f{k}" for k in range(n)))}


@pytest.mark.parametrize("n", [500, 4000])
def test_range_buckets_follow_the_rows(spark, n):
    """As many range partitions as the rows ask for, none of them much larger than asked."""
    df = spark.range(n).select((F.col("id") * 7919 % n).alias("k")).repartition(3)
    ranged = num.in_ranges(df, ["k"], bucket_rows=100)
    sizes = [r["count"] for r in ranged.groupBy("_bucket").count().collect()]
    assert 0.8 * n / 100 <= len(sizes) <= n / 100 and max(sizes) < 300
    got = [(r.k, r.idx) for r in num.ordered_index(df, ["k"], bucket_rows=100).collect()]
    assert sorted(got) == [(i, i) for i in range(n)]
    sums = num.ordered_index(df, ["k"], "i", {"total": F.col("k")}, 100).collect()
    assert all(r.i == r.k and r.total == r.k * (r.k + 1) // 2 for r in sums)


def test_ordered_index_on_two_columns(spark):
    pairs = [(a, b) for a in range(20) for b in range(20)]
    df = spark.createDataFrame(pairs, "a int, b int").repartition(6)
    got = {(r.a, r.b): r.idx for r in num.ordered_index(df, ["b", "a"]).collect()}
    assert got == {p: i for i, p in enumerate(sorted(pairs, key=lambda p: (p[1], p[0])))}


@pytest.mark.parametrize("n", [0, 1, 499, 500, 501, 1200])
def test_fixed_shards(spark, n):
    df = spark.range(n).withColumnRenamed("id", "k")
    counts = {}
    for r in num.fixed_shards(df, ["k"]).collect():
        counts[(r.shard, r.shard_name)] = counts.get((r.shard, r.shard_name), 0) + 1
    shards = math.ceil(n / 500)
    assert counts == {
        (s, f"train-{s:05d}-of-{shards:05d}.parquet"): min(500, n - 500 * s) for s in range(shards)
    }


@pytest.mark.parametrize("cap", [1, 60, 101, 350, 10_000, 10**9])
def test_shards_never_pass_the_cap(spark, cap):
    sizes = {k: 0 if k % 11 == 0 else (k * 37) % 101 if k % 50 else 700 for k in range(300)} | {300: None}
    df = spark.createDataFrame(list(sizes.items()), "k int, size bigint").repartition(5)
    got = {r.k: (r.bytes_to_here, r.shard) for r in num.size_bounded_shards(df, ["k"], "size", cap).collect()}
    total, shard, filled, expected = 0, 0, 0, {}
    for i, k in enumerate(sorted(sizes, key=lambda k: (md5(f"42|{k}"), k))):
        size = sizes[k] or 0
        if i and filled + size > cap:
            shard, filled = shard + 1, 0
        total, filled = total + size, filled + size
        expected[k] = (total, shard)
    assert got == expected
    held = {}
    for k, (_, s) in got.items():
        held.setdefault(s, []).append(sizes[k] or 0)
    assert all(sum(x) <= cap or sum(1 for v in x if v) == 1 for x in held.values())
    assert num.size_bounded_shards(df.filter("k < 0"), ["k"], "size", cap).count() == 0


def test_cyclic_prompts_read_the_pool_round_by_round(spark):
    pool = spark.range(7).withColumnRenamed("id", "k")
    got = [r.k for r in smp.cyclic_prompts(pool, ["k"], 18).orderBy("position").collect()]
    assert len(got) == 18
    assert sorted(got[:7]) == sorted(got[7:14]) == list(range(7))
    assert got[:7] != got[7:14]
    assert len(set(got[14:])) == 4


def test_skip_pick_and_cap(spark):
    df = spark.range(50).select(F.format_string("f%02d", "id").alias("name"))
    assert sorted(r.name for r in smp.skip_first(df, 45, ["name"]).collect()) == [f"f{i}" for i in range(45, 50)]
    at = smp.pick_rows(df, ["name"], 3, index=4).collect()
    assert [(r.pick, r.name) for r in at] == [(1, "f04"), (2, "f04"), (3, "f04")]
    random = smp.pick_rows(df, ["name"], 3).collect()
    assert sorted(r.pick for r in random) == [1, 2, 3]
    assert smp.cap_needed(df, None, ["name"]).count() == 50
    assert smp.cap_needed(df, 8, ["name"]).count() == 8


def test_salted_join_equals_plain_join(spark):
    left = spark.range(4000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 400)).alias("key")
    )
    right = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3), ("k2", 4)], "key string, v int")
    salted = skew.salted_left_join(left, right, "key", ["id"], rows_per_task=100)
    plain = left.join(right, "key", "left")
    assert sorted(map(repr, salted.select("id", "key", "v").collect())) == sorted(
        map(repr, plain.select("id", "key", "v").collect())
    )
    assert left.select(skew.salts_of(left, "key", 100).alias("h")).first().h == {"hot": 14}
    assert left.filter("id < 0").select(skew.salts_of(left, "key")).count() == 0
    unsalted = skew.salted_left_join(left, right, "key", ["id"], counted=right)
    assert unsalted.count() == plain.count()


def test_no_job_runs_while_a_plan_is_built(spark):
    attempts = spark.createDataFrame([("r", 1, 0, 1)], "run string, ts int, exit_code int, seq int")
    classes = spark.createDataFrame([("l", "c")], "LabelName string, ClassName string")
    spark.sparkContext.setJobGroup("planning", "plans only")
    registry.before_halt(attempts)
    context.with_class_names(classes.select("LabelName"), classes)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("planning")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not jobs


def test_first_n_limits_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = num.first_n_per_key(df, ["k"], ["id"], 4)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


# --- one sample per model ---------------------------------------------------


def sample_inputs(spark, rows=200, missing=lambda k: k % 5 == 0):
    data = spark.range(rows).select(
        F.col("id").alias("ord"), F.concat(F.lit("m"), F.col("id")).alias("MaskPath")
    )
    files = spark.createDataFrame([(f"m{k}",) for k in range(rows) if not missing(k)], "path string")
    models = spark.createDataFrame([("org/a", 50), ("org/b", 160), ("org/c", 500)], "id string, target int")
    return data, files, models


def test_sample_per_model(spark):
    data, files, models = sample_inputs(spark)
    sample = smp.sample_per_model(models, data, files, ["ord"])
    taken = {}
    for r in sample.collect():
        taken.setdefault(r.id, []).append((r.rank, r.ord))
    valid = {k for k in range(200) if k % 5}
    assert {m: len(v) for m, v in taken.items()} == {"org/a": 50, "org/b": 160, "org/c": 160}
    for picks in taken.values():
        keys = [k for _, k in picks]
        assert len(set(keys)) == len(keys) and set(keys) <= valid
        assert sorted(r for r, _ in picks) == list(range(len(picks)))
    first = {m: {k for r, k in v if r < 50} for m, v in taken.items()}
    assert first["org/a"] != first["org/b"]
    again = smp.sample_per_model(models, data.repartition(9), files, ["ord"])
    assert sorted(map(repr, again.select("id", "rank", "ord").collect())) == sorted(
        map(repr, sample.select("id", "rank", "ord").collect())
    )


@pytest.mark.parametrize("n", [1, 2, 3, 7, 100, 1000, 1023])
def test_permutations_send_every_place_to_a_place_of_its_own(spark, n):
    keys = spark.createDataFrame([("a",), ("b",)], "key string")
    places = keys.crossJoin(spark.range(n)).withColumn("n", F.lit(n).cast("bigint"))
    places = places.withColumn("numbers", smp.permutation_keys(F.col("key")))
    rows = smp.permuted(places, "id", "n", "numbers", "slot").collect()
    by_key = {k: [r.slot for r in sorted(rows, key=lambda r: r.id) if r.key == k] for k in "ab"}
    assert all(sorted(v) == list(range(n)) for v in by_key.values())
    if n >= 1000:
        # the first tenth of both: a hundredth of all is shared, give or take four deviations
        shared = len(set(by_key["a"][: n // 10]) & set(by_key["b"][: n // 10]))
        assert abs(shared - n / 100) <= 12
        # no common stride: steps from place to place differ
        steps = {(y - x) % n for x, y in zip(by_key["a"], by_key["a"][1:])}
        assert len(steps) > n / 3


def test_hash_sample_takes_the_lowest_hashes(spark):
    rows = spark.range(500).select(F.col("id").alias("k"))
    for n in (0, 1, 20, 499, 500, 900):
        got = {r.k for r in smp.hash_sample(rows, ["k"], n, 7).collect()}
        assert got == set(sorted(range(500), key=lambda k: (md5(f"7|{k}"), str(k)))[:n])
    assert smp.hash_sample(rows.filter("k < 0"), ["k"], 5).count() == 0


def test_sampling_report_counts_the_missing_rows_on_the_way(spark):
    data, files, models = sample_inputs(spark)
    sample = smp.sample_per_model(models, data, files, ["ord"], with_missing=True)
    missing = num.row_total(smp.missing_masks(data, files))
    report = {r.id: r for r in smp.sampling_report(sample, models, missing).collect()}
    # brute force: walk the shuffle, each valid row with the missing rows before it
    before, gap = {}, 0
    for k in sorted(range(200), key=lambda k: (md5(f"42|{k}"), k)):
        if k % 5 == 0:
            gap += 1
        else:
            before[k], gap = gap, 0
    picked = {r.ord for r in sample.filter("id = 'org/a'").collect()}
    assert report["org/a"].missing_met == sum(before[k] for k in picked)
    assert report["org/c"].found == 160 and report["org/c"].missing_met == 40
    short = smp.quota_shortfall(models, data, files, "2026-01-01").collect()
    assert [(r.model_id, r.status, r.reason) for r in short] == [
        ("org/c", "INFRASTRUCTURE_FAULT", "Only 160 masks available, need 500")
    ]


def test_a_sampling_report_reads_rows_and_files_once(spark):
    data, files, models = sample_inputs(spark)
    read = {name: spark.sparkContext.accumulator(0) for name in ("rows", "files")}

    def counted(name):
        def see(path):
            read[name].add(1)
            return path

        return F.udf(see, "string")

    data = data.withColumn("MaskPath", counted("rows")("MaskPath"))
    files = files.select(counted("files")("path").alias("path"))
    smp.sample_per_model(models, data, files, ["ord"], with_missing=True).count()
    # rows a second time for the sketch of hot keys
    assert (read["rows"].value, read["files"].value) == (400, 160)
    sample = smp.sample_per_model(models, data, files, ["ord"], with_missing=True)
    report = smp.sampling_report(sample, models, smp.missing_total(data, files, ["ord"])).collect()
    assert (read["rows"].value, read["files"].value) == (800, 320)
    assert {r.id: (r.found, r.missing_met) for r in report if r.id == "org/c"} == {"org/c": (160, 40)}


@pytest.mark.parametrize("every", [1, 2, 40, 1000])
def test_flag_totals(spark, every):
    rows = spark.range(300).select(F.col("id").alias("k"), (F.col("id") % every == every - 1).alias("there"))
    for n in (300, 0):
        some = rows.filter(F.col("k") < n)
        got = spark.range(1).select(num.flag_totals(some, "there", ["k"], 5, F.lit(2))).first()[0]
        order = sorted(range(n), key=lambda k: (md5(f"5|{k}"), k))
        flags = [k % every == every - 1 for k in order]
        last = max((i for i, flag in enumerate(flags) if flag), default=-1)
        assert tuple(got) == (sum(flags), n - sum(flags), flags[: last + 1].count(False))


@pytest.mark.parametrize("every", [1, 2, 40, 150, 1000])
@pytest.mark.parametrize("digits", [1, 2])
def test_ranked_flags_carry_over_buckets(spark, every, digits):
    # with few flags most buckets hold none, so the count before a row spans several of them
    rows = spark.range(300).select(
        F.col("id").alias("k"), (F.col("id") % every == every - 1).alias("there")
    )
    got = num.ranked_flags(rows, "there", ["k"], 5, F.lit(digits), "slot", "missed").collect()
    want, gap = [], 0
    for k in sorted(range(300), key=lambda k: (md5(f"5|{k}"), k)):
        if k % every == every - 1:
            want.append((len(want), k, gap))
            gap = 0
        else:
            gap += 1
    assert sorted((r.slot, r.k, r.missed) for r in got) == want


@pytest.mark.parametrize("n", [0, 9, 10, 11, 250, 499, 500, 900])
def test_head_rows_on_both_ways(spark, monkeypatch, n):
    monkeypatch.setattr(smp, "HEAD_ROWS", 10)
    monkeypatch.setattr(smp, "ordered_index", partial(num.ordered_index, bucket_rows=64))
    rows = spark.range(500).select((F.col("id") * 7 % 500).alias("k"), (F.col("id") % 3).alias("third"))
    got = [(r.third, r.k) for r in smp.head_rows(rows, n, [F.col("third").desc(), "k"]).collect()]
    assert got == sorted(((i % 3, i * 7 % 500) for i in range(500)), key=lambda r: (-r[0], r[1]))[:n]


def test_scratch_is_removed_after_its_block(spark, monkeypatch, tmp_path):
    kept = cut_lineage(spark.range(3), "kept")
    with pytest.raises(ValueError), scratch_removed(spark):
        with scratch_removed(spark):
            inner = cut_lineage(spark.range(5), "inner")
            inner.write.parquet(str(tmp_path / "out"))
        outer = cut_lineage(spark.range(4), "outer")
        raise ValueError
    assert kept.count() == 3 and spark.read.parquet(str(tmp_path / "out")).count() == 5
    for removed in (inner, outer):
        (file, *_) = removed.inputFiles()
        assert not Path(file.removeprefix("file://")).exists()


def test_a_sample_writes_nothing(spark, monkeypatch):
    def refuse(*_):
        raise AssertionError("a table was written")

    monkeypatch.setattr("medialoom.session.scratch_folder", refuse)
    data, files, models = sample_inputs(spark)
    for with_missing in (False, True):
        assert smp.sample_per_model(models, data, files, ["ord"], with_missing=with_missing).count() == 370


def test_sample_without_any_mask(spark):
    data, _, models = sample_inputs(spark)
    nothing = spark.createDataFrame([], "path string")
    sample = smp.sample_per_model(models, data, nothing, ["ord"])
    assert sample.count() == 0
    assert smp.quota_shortfall(models, data, nothing, "d").count() == 3


def test_sample_plan_pairs_no_model_with_all_rows(spark):
    data, files, models = sample_inputs(spark)
    plan = smp.sample_per_model(models, data, files, ["ord"])._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
