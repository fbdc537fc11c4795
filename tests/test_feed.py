import json

import pytest
from pyspark.sql import functions as F

from medialoom.operators import feed


def parsed(spark, items, name="post"):
    df = spark.createDataFrame([(i, json.dumps(p)) for i, p in enumerate(items)], "n int, j string")
    return df.select("n", F.parse_json("j").alias(name))


POSTS = [
    {"id": "a", "title": "T", "encodings": {"source": {"path": "http://x/a.mp4", "width": 10, "height": 5, "duration_secs": 2.5}},
     "user": {"username": "u"}, "actions": {"100": "one", "200": "two"}},
    {"id": 0, "post_id": "b", "encodings": {"source": {"width": 7, "duration_secs": 9}, "md": {"url": "http://x/b.webm"}}, "width": 1, "height": 2},
    {"gen_id": "c", "url": "http://x/c.mp4", "text": "hello", "author": {"name": "who"}},
    {"id": "d", "media": {"source": "s", "duration_secs": 3}},
    {"id": "e", "media": [{"type": "image", "url": "no"}, {"url": "yes", "width": 3}]},
    {"id": "f", "generation": {"id": "g", "generations": [{"id": "h", "url": "http://videos.openai.com/z"}]}},
    {"id": "i", "url": "http://x/page.html"},
    {"id": "j", "generation": {"generation": {"generation": {"generation": {"url": "x.mp4"}}}}},
    {"id": "k", "generation": {"generation": {"generation": {"id": "deep", "url": "x.mp4"}}}},
    {"id": "l", "encodings": {"ld": "text", "md": {}}, "video": {"path": "v", "width": 4, "height": 6}, "user": {}, "author": {"username": "w"}},
    {"id": "m", "prompt": "p", "text": "t", "actions": {}, "url": "a.mp4", "title": ""},
    {"id": "n", "actions": ["x"], "text": None, "videoUrl": "b.mp4"},
]


def test_normalize(spark):
    got = {r.n: r for r in feed.normalize_feed_posts(parsed(spark, POSTS)).collect()}
    short = {n: (r.id, r.video_url, r.width, r.height, r.duration, r.quality) for n, r in got.items()}
    assert short[0] == ("a", "http://x/a.mp4", 10, 5, 2.5, "source")
    assert short[1] == ("b", "http://x/b.webm", 7, 2, 0, "md")
    assert short[2] == ("c", "http://x/c.mp4", 0, 0, 0, "unknown")
    assert short[3] == ("d", "s", 0, 0, 3, "unknown")
    assert short[4] == ("e", "yes", 3, 0, 0, None)
    assert short[5] == ("h", "http://videos.openai.com/z", 0, 0, 0, "unknown")
    assert short[8][:2] == ("deep", "x.mp4")
    assert short[9] == ("l", "v", 4, 6, 0, "unknown")
    assert set(got) == {0, 1, 2, 3, 4, 5, 7, 8, 9, 10, 11}
    assert (got[0].prompt, got[0].creator, got[2].prompt, got[2].creator) == ("one | two", "u", "hello", "who")
    assert (got[9].creator, got[10].prompt, got[10].title, got[11].prompt) == ("w", "p", "t", "")


def test_nesting_of_any_depth(spark):
    def wrapped(depth):
        post = {"id": f"d{depth}", "url": "x.mp4"}
        for i in range(depth):
            post = {"generation": post} if i % 2 else {"generations": [post]}
        return post

    posts = [wrapped(depth) for depth in (0, 1, 3, 4, 7, 13)] + [{"generation": {"id": "none"}}]
    found = feed.normalize_feed_posts(parsed(spark, posts)).collect()
    assert sorted(r.id for r in found) == ["d0", "d1", "d13", "d3", "d4", "d7"]
    rows = feed.normalize_feed_posts(parsed(spark, posts), keep_without_url=True).collect()
    assert len(rows) == len(posts) and [r.found for r in rows].count(False) == 1


def test_reading_runs_no_job_while_the_plan_is_built(spark, monkeypatch):
    wide = {"generations": [{"id": "first", "generation": {"id": "in", "url": "x.mp4"}}] + [{"generation": {}}] * 500}
    posts = parsed(spark, [wide, {"id": "flat", "url": "y.mp4"}, {"generations": [{"generation": {}}] * 500}])
    details = spark.createDataFrame([("none", "{}")], "key string, j string").select(
        "key", F.parse_json("j").alias("detail")
    )

    def refuse(*_, **__):
        raise AssertionError("a job ran")

    with monkeypatch.context() as patched:
        for name in ("first", "head", "count", "collect", "isEmpty"):
            patched.setattr(type(posts), name, refuse)
        patched.setattr("medialoom.session.scratch_folder", refuse)
        found = feed.normalize_feed_posts(posts)
        feed.with_detail_fallback(posts, details)
    assert sorted(r.id for r in found.collect()) == ["flat", "in"]


def test_repeated_pages_count_once(spark):
    pages = [(f"c{i}" if i else None, f"c{i + 1}" if i < 19 else None, '[{"id": %d}]' % i) for i in range(20)]
    stored = spark.createDataFrame(pages * 3, "request_cursor string, next_cursor string, body string").select(
        "request_cursor", "next_cursor", F.parse_json("body").cast("array<variant>").alias("posts")
    )
    assert sorted(r.number for r in feed.feed_cursor_chain(stored).collect()) == list(range(20))
    assert sorted(r.page_number for r in feed.in_feed_order(stored).collect()) == list(range(20))


def test_other_quality_first(spark):
    post = {"id": "a", "encodings": {"source": {"path": "s"}, "hd": {"path": "h"}}}
    assert feed.normalize_feed_posts(parsed(spark, [post]), quality="hd").first().video_url == "h"


PAGES = [
    ({"posts": [{}], "cursor": "x"}, 1, "x"),
    ({"items": [{}, {}], "pagination": {"next": "y"}}, 2, "y"),
    ({"data": [], "generations": [{}], "next": 5}, 0, "5"),
    ([{}, {}], 2, None),
    ({"posts": [], "next_page": "q", "hasMore": True}, 0, "q"),
    ({"posts": [{}], "next": "z", "has_more": None}, 1, None),
    ({"posts": [{}], "next": "z", "has_more": False}, 1, None),
    ({"posts": "text", "results": [{}], "cursor": "", "nextCursor": "n"}, 1, "n"),
    ({}, 0, None),
]


def test_pages(spark):
    got = {r.n: (r.size, r.next_cursor) for r in feed.extract_feed_pages(
        parsed(spark, [p for p, _, _ in PAGES], "page")
    ).select("n", F.size("posts").alias("size"), "next_cursor").collect()}
    assert got == {i: (n, c) for i, (_, n, c) in enumerate(PAGES)}


def chain(spark, pages):
    df = spark.createDataFrame(pages, "request_cursor string, next_cursor string, n int")
    df = df.withColumn("posts", F.sequence(F.lit(1), F.col("n")))
    df = df.withColumn("posts", F.when(F.col("n") > 0, F.col("posts")).otherwise(F.array().cast("array<int>")))
    return {r.cursor: r.number for r in feed.feed_cursor_chain(df).collect()}


def test_chain_of_many_pages(spark):
    pages = [(None if i == 0 else f"c{i}", f"c{i + 1}" if i < 36 else None, 1) for i in range(37)]
    assert chain(spark, pages) == {"" if i == 0 else f"c{i}": i for i in range(37)}


def test_chain_ends_at_empty_and_lost_pages_and_at_circles(spark):
    assert chain(spark, [(None, "a", 1), ("a", "b", 0), ("b", None, 1), ("z", "a", 1)]) == {"": 0}
    assert chain(spark, [(None, "a", 1), ("a", "b", 1), ("b", "a", 1)]) == {"": 0, "a": 1, "b": 2}
    assert chain(spark, [("a", "b", 1)]) == {}


def test_names(spark):
    df = spark.createDataFrame(
        [("v1", " a/b. ", "u.webm?x"), ("v2", "", "u"), ("v3", "..", "u.webp")],
        "id string, title string, video_url string",
    )
    got = {r.id: (r.media_file, r.sidecar_file) for r in feed.media_filename(df).collect()}
    assert got == {
        "v1": ("a_b_v1.webm", "a_b_v1.json"), "v2": ("v2_v2.mp4", "v2_v2.json"),
        "v3": ("untitled_v3.webp", "untitled_v3.json"),
    }


@pytest.mark.parametrize("most,expected", [(2, 2), (0, 4), (9, 4)])
def test_cap(spark, most, expected):
    df = spark.createDataFrame([(p, i) for p in range(2) for i in range(2)], "page_number int, pos int")
    assert feed.cap_feed(df, most).count() == expected


def test_detail_is_read_only_where_the_feed_has_no_url(spark):
    detail = parsed(spark, [{"id": "x", "url": "d.mp4"}, {"id": "y", "url": "no.mp4"}], "detail").select(
        F.when(F.col("n") == 0, "i").otherwise("a").alias("key"), "detail"
    )
    got = {r.n: r.video_url for r in feed.with_detail_fallback(parsed(spark, POSTS), detail).collect()}
    assert got[6] == "d.mp4" and got[0] == "http://x/a.mp4" and 7 in got


def test_detail_may_be_text_and_is_parsed_after_the_join(spark):
    posts = parsed(spark, [{"id": "a"}, {"id": "b", "url": "b.mp4"}])
    texts = [("a", '{"id": "a", "url": "d.mp4"}'), ("unasked", "no json")]
    detail = spark.createDataFrame(texts, "key string, detail string")
    assert sorted(r.video_url for r in feed.with_detail_fallback(posts, detail).collect()) == ["b.mp4", "d.mp4"]
