import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from medialoom import schemas
from medialoom.operators import posts as ops
from medialoom.sources.readers import read_table, read_version
from medialoom.sources.writers import append_table
from medialoom.streaming import posts as streams
from medialoom.streaming.registry import status_changes, stream_registry
from medialoom.operators.registry import upsert_registry

NOW = dt.datetime(2024, 3, 1)
SCHEMA = (
    "id string, source string, created_utc timestamp, url string, is_video boolean, "
    "media struct<reddit_video:struct<fallback_url:string>>"
)
VIDEO = (("http://v",),)


@pytest.fixture
def sources(spark):
    ai = spark.createDataFrame([("AiArt", 0), ("aiart", 1), ("vids", 2), ("vids", 3)], "source string, ord int")
    real = spark.createDataFrame([("pics", 0), ("VIDS", 1)], "source string, ord int")
    return ops.labelled_sources(ai, real)


@pytest.fixture
def metadata(spark):
    return spark.createDataFrame(
        [
            ("reddit_aiart_2024-01-10_k1.jpg", "fake", "AiArt", "2024-01-10", "k1", False),
            ("old.jpg", "fake", "aiart", "2024-1-9", "x", False),
            ("bad.jpg", "fake", "AIART", "not-a-date", "x", False),
            ("empty.jpg", "real", "pics", "", "x", False),
        ],
        schemas.POST_METADATA,
    )


def day(text):
    return dt.datetime.fromisoformat(text)


@pytest.fixture
def posts(spark):
    data = [
        ("k1", "AiArt", day("2024-01-10 05:00:00"), "u/a.jpg", False, None),  # known
        ("p1", "aiart", day("2024-01-10 00:00:00"), "u/A.JPG", False, None),  # at the cut-off
        ("p2", "aiart", day("2024-01-09 23:59:59"), "u/b.jpg", False, None),  # late
        ("p3", "AIART", day("2024-01-11 00:00:00"), "u/c.jpeg?x=1", False, None),  # no image
        ("p4", "vids", day("2024-01-01 00:00:00"), "u/d", True, VIDEO),
        ("p5", "vids", day("2024-01-01 00:00:00"), "u/e", True, None),  # no stream
        ("p6", "pics", day("2024-02-01 00:00:00"), "u/f.png", False, None),
        ("p6", "pics", day("2024-02-01 00:00:00"), "u/f.png", False, None),  # twice
        ("p7", "unlisted", day("2024-02-01 00:00:00"), "u/g.png", False, None),
    ]
    return spark.createDataFrame(data, SCHEMA)


def test_sources(sources, rows):
    assert rows(sources) == [
        ("aiart", "AiArt", "fake"), ("pics", "pics", "real"), ("vids", "vids", "fake")
    ]


def test_last_seen_and_cutoffs(sources, metadata):
    cut = {r.key: (r.resumed, r.cutoff) for r in ops.source_cutoffs(sources, ops.last_seen(metadata), NOW).collect()}
    assert cut["aiart"] == (True, day("2024-01-10"))
    assert cut["pics"] == (False, NOW - dt.timedelta(days=1000))
    fixed = ops.source_cutoffs(sources, ops.last_seen(metadata), NOW, days_ago=30).collect()
    assert {r.cutoff for r in fixed} == {NOW - dt.timedelta(days=30)}


def test_ingest(posts, metadata, sources):
    got = sorted(r.filename for r in ops.ingest(posts, metadata, sources, NOW).collect())
    videos = sorted(f"reddit_vids_2024-01-01_p4_frame_{i}.jpg" for i in range(15))
    assert got == sorted(["reddit_aiart_2024-01-10_p1.JPG", "reddit_pics_2024-02-01_p6.png"] + videos)


def test_ingest_twice_adds_nothing(posts, metadata, sources):
    added = ops.ingest(posts, metadata, sources, NOW)
    both = metadata.unionByName(added)
    assert ops.ingest(posts, both, sources, NOW).count() == 0


def test_report(posts, metadata, sources, spark):
    cutoffs = ops.source_cutoffs(sources, ops.last_seen(metadata), NOW)
    failed = spark.createDataFrame([("vids", "403")], "key string, error string")
    got = {
        r.key: (r.new, r.skipped, r.resumed, r.error)
        for r in ops.ingest_report(ops.candidates(posts, cutoffs), metadata, cutoffs, failed).collect()
    }
    assert got == {"aiart": (1, 1, True, None), "pics": (1, 0, False, None), "vids": (15, 0, False, "403")}
    assert ops.start_counts(cutoffs).first().asDict() == {"resumed": 1, "fresh": 2}


def test_late_policy(posts, metadata, sources):
    cutoffs = ops.source_cutoffs(sources, ops.last_seen(metadata), NOW)
    got = {r.key: (r.late, r.read_again, r.later) for r in ops.late_policy(posts, cutoffs).collect()}
    assert got["aiart"] == (1, 2, 1)


def folder(tmp_path):
    return str(tmp_path / uuid.uuid4().hex)


def test_stream_equals_batch_and_survives_restarts(spark, posts, metadata, sources, tmp_path):
    incoming, meta, state = folder(tmp_path), folder(tmp_path), folder(tmp_path)
    append_table(metadata, meta)
    first, second = posts.filter("id < 'p4'"), posts.filter("id >= 'p4'")
    for part in (first, second, first):  # the last repeats what was seen
        append_table(part.coalesce(1), incoming)
        stream = streams.file_stream(spark, incoming, SCHEMA, per_batch=1)
        streams.stream_new_posts(stream, sources, meta, state, NOW).awaitTermination()
    stored = read_table(spark, meta, schemas.POST_METADATA)
    batch = metadata.unionByName(ops.ingest(posts, metadata, sources, NOW))
    assert sorted(map(repr, stored.collect())) == sorted(map(repr, batch.collect()))


def made_posts(spark, rows):
    made = spark.createDataFrame(rows, "id string, source string, created_utc timestamp, url string")
    return made.select(*[
        made[f.name] if f.name in made.columns else F.lit(None).cast(f.dataType).alias(f.name)
        for f in spark.createDataFrame([], SCHEMA).schema
    ])


def test_an_ended_run_moves_the_cutoffs_on(spark, sources, tmp_path):
    incoming, meta, state = folder(tmp_path), folder(tmp_path), folder(tmp_path)
    name = sources.select("source").first()[0]
    days = [NOW - dt.timedelta(days=d) for d in (2, 5, 2, 1)]
    every = made_posts(spark, [(f"q{i}", name, t, "http://x/a.jpg") for i, t in enumerate(days)])

    def run(now):
        stream = streams.file_stream(spark, incoming, SCHEMA, per_batch=1)
        query = streams.stream_new_posts(stream, sources, meta, state, now)
        query.awaitTermination()
        return query

    append_table(every.filter("id = 'q0'").coalesce(1), incoming)
    run(NOW)
    streams.end_run(spark, state)
    # q1 lies before the newest stored day now, q2 on it, q3 after it; q0 comes again
    append_table(every.coalesce(1), incoming)
    query = run(NOW + dt.timedelta(days=3))
    ids = [r.reddit_id for r in read_table(spark, meta, schemas.POST_METADATA).collect()]
    assert sorted(ids) == ["q0", "q2", "q3"]
    append_table(every.coalesce(1), incoming)
    run(NOW + dt.timedelta(days=9))
    assert read_table(spark, meta, schemas.POST_METADATA).count() == 3
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] > 0


def test_only_the_first_batch_reads_the_metadata(spark, sources, tmp_path, monkeypatch):
    incoming, meta, state = folder(tmp_path), folder(tmp_path), folder(tmp_path)
    name = sources.select("source").first()[0]
    every = made_posts(spark, [(f"q{i}", name, NOW - dt.timedelta(days=i), "http://x/a.jpg") for i in range(4)])
    for i in range(4):
        append_table(every.filter(f"id = 'q{i}'").coalesce(1), incoming)
    read, plain = [], streams.read_table
    monkeypatch.setattr(streams, "read_table", lambda s, path, schema: read.append(path) or plain(s, path, schema))
    stream = streams.file_stream(spark, incoming, SCHEMA, per_batch=1)
    query = streams.stream_new_posts(stream, sources, meta, state, NOW)
    query.awaitTermination()
    assert plain(spark, meta, schemas.POST_METADATA).count() == 4
    assert len(query.recentProgress) >= 4 and read.count(meta) == 2  # when the run begins, and for the first batch


def test_names_that_can_pass_a_cutoff(spark):
    kept = [
        ("reddit_a_2024-03-05_x.jpg", "A"), ("reddit_a_2024-03-09_x.jpg", "a"), ("odd.jpg", "a"), ("reddit_z_2020-01-01_x.jpg", "z"),
        ("reddit_a_2024-01-01_2025-01-01.jpg", "a"),
    ]
    rows = [*kept, ("reddit_a_2024-03-04_x.jpg", "a")]
    metadata = spark.createDataFrame(rows, "filename string, subreddit string")
    cutoffs = spark.createDataFrame([("a", day("2024-03-05 12:00:00"))], "key string, cutoff timestamp")
    assert sorted(r.filename for r in ops.known_since(metadata, cutoffs).collect()) == sorted(n for n, _ in kept)


def test_cutoffs_hold_for_a_whole_run(spark, sources, tmp_path):
    """Newer posts that are read first don't hide older ones, also after a restart under another clock."""
    incoming, meta, state = folder(tmp_path), folder(tmp_path), folder(tmp_path)
    empty = spark.createDataFrame([], schemas.POST_METADATA)
    name = sources.select("source").first()[0]
    days = [NOW - dt.timedelta(days=d) for d in (1, 2, 3, 4)]
    rows = [(f"q{i}", name, t, "http://x/a.jpg") for i, t in enumerate(days)]
    every = made_posts(spark, rows)
    for i, part in enumerate(("id = 'q0'", "id in ('q1', 'q2')", "id = 'q3'")):  # the second call is a restart
        append_table(every.filter(part).coalesce(1), incoming)
        stream = streams.file_stream(spark, incoming, SCHEMA, per_batch=1)
        streams.stream_new_posts(stream, sources, meta, state, NOW + dt.timedelta(days=i)).awaitTermination()
    stored = read_table(spark, meta, schemas.POST_METADATA)
    assert sorted(r.reddit_id for r in stored.collect()) == ["q0", "q1", "q2", "q3"]
    assert stored.count() == ops.ingest(every, empty, sources, NOW).count()


def test_dedup_stream(spark, posts, tmp_path):
    incoming, out, state = folder(tmp_path), folder(tmp_path), folder(tmp_path)
    for _ in range(2):
        append_table(posts, incoming)
        stream = streams.dedup_stream(streams.file_stream(spark, incoming, SCHEMA), "900 days")
        stream.writeStream.option("path", out).option("checkpointLocation", state).format("parquet").trigger(
            availableNow=True
        ).start().awaitTermination()
    ids = [r.id for r in spark.read.parquet(out).collect()]
    assert sorted(ids) == sorted({r.id for r in posts.collect()})


def test_stream_registry(spark, tmp_path):
    incoming, table, state = folder(tmp_path), folder(tmp_path), folder(tmp_path)
    kind = "run string, seq bigint, model_id string, exit_code int, ts timestamp"
    data = [("r", i, f"m{i % 3}", (0, 11, 12, 14)[i % 4], day(f"2024-01-{1 + i:02d}")) for i in range(12)]
    attempts = spark.createDataFrame(data, kind)
    for low in (0, 6):
        append_table(attempts.filter(F.col("seq").between(low, low + 5)).coalesce(1), incoming)
        stream_registry(streams.file_stream(spark, incoming, kind), table, state).awaitTermination()
    empty = spark.createDataFrame([], schemas.REGISTRY)
    expected = upsert_registry(empty, status_changes(attempts))
    stored = read_version(spark, table, schemas.REGISTRY)
    assert sorted(map(repr, stored.collect())) == sorted(map(repr, expected.collect()))
