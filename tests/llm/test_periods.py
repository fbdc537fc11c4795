"""Periodic runs of words against a scan of all lags."""

import hashlib
import random
import zlib

import pytest

from medialoom.llm import periods, queries

from .helpers import ODD, corpus, documents


def brute(words):
    """(start, length, period) of all runs."""
    n, out = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(12, 2 * q):
                out.setdefault((i, j + q), q)
            i = j + 1
    return sorted(((s, e - s, q) for (s, e), q in out.items()), key=lambda r: (r[0], r[2]))


def collapse(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def random_words(rng):
    letters, words = rng.choice([1, 2, 2, 3, 5, 50]), []
    for _ in range(rng.randint(0, 6)):
        kind = rng.random()
        if kind < 0.3:
            words += [rng.randint(1, letters) for _ in range(rng.randint(1, 60))]
        elif kind < 0.7:
            unit = [rng.randint(1, letters) for _ in range(rng.choice([1, 2, 3, 7, 20, 40, 90]))]
            n = rng.randint(1, 5 * len(unit) + 30)
            words += (unit * (n // len(unit) + 1))[:n]
        elif words:
            words += words[-rng.randint(1, len(words)) :] * rng.randint(1, 2)
    return [b"%d" % w for w in words[:400]]


@pytest.mark.parametrize("seed", range(4))
def test_runs_of_random_texts(seed):
    rng = random.Random(seed)
    for _ in range(60):
        texts = [random_words(rng) for _ in range(rng.randint(1, 5))]
        assert periods.runs_of_texts(texts) == [brute(t) for t in texts]


@pytest.mark.parametrize("n", [13, 24, 25, 47, 48, 96, 130])
def test_squares_inside_runs_of_a_short_period(n):
    for unit in ([b"a", b"b"], [b"a", b"a", b"b"], [b"a", b"b", b"a", b"c", b"b"]):
        left = (unit * n)[:n]
        for m in (n, n + 1, 2 * n):
            text = [b"z", *left, *(unit * m)[:m], b"y"]
            assert periods.runs_of_texts([text]) == [brute(text)]


def test_long_texts():
    found = periods.runs_of_texts([[b"a"] * 300_000, [], [b"%d" % (i % 5000) for i in range(100_000)]])
    assert found == [[(0, 300_000, 1)], [], [(0, 100_000, 5000)]]


def test_documents(spark):
    rng = random.Random(8)
    rows = [*ODD, *corpus(30), *((200 + i, "  ".join(w.decode() for w in random_words(rng)) + " \n", "en", "a") for i in range(30))]
    docs = documents(spark, rows)
    found = periods.periodic_runs(docs)
    assert found.columns == [*docs.columns, "runs", "collapsed"]
    got = sorted(((r.doc_id, r.text, [tuple(x) for x in r.runs], r.collapsed) for r in found.collect()), key=repr)
    wanted = []
    for r in rows:
        words = [w.decode() for w in (r[1] or "").encode().split()]
        wanted.append((*r[:2], brute(words) if len(words) < 3000 else [(0, 54_000, 8793)], None))
        wanted[-1] = (*wanted[-1][:3], collapse(words, wanted[-1][2]))
    wanted.sort(key=repr)
    assert [r for r in got if r not in wanted] == [r for r in wanted if r not in got] == []
    assert periods.periodic_runs(documents(spark, [])).count() == 0


def test_clashing_names(spark):
    docs = documents(spark, ODD[:8])
    for name in ("runs", "collapsed", "row", "found", "best", "start"):
        docs = docs.withColumn(name, docs.doc_id)
    found = periods.periodic_runs(docs)
    assert sorted(found.columns) == sorted(docs.columns)
    assert {(r.row, r.found, r.best, r.start) for r in found.collect()} == {(i,) * 4 for i in range(1, 9)}


def planted(doc, text):
    words, h = [w.decode() for w in (text or "").encode().split()], None if doc is None else zlib.crc32(str(doc).encode())
    if h is not None and h % 10 == 0 and words:
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def test_query(spark, tmp_path):
    rows = [*ODD, *corpus(120), *((1000 + i, "one two three " * 9, "en", "a") for i in range(60))]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in queries.QUERIES["op12_periodic_runs"](spark, str(tmp_path)).collect()]
    wanted = []
    for r in rows:
        words = planted(*r[:2])
        runs = brute(words) if len(words) < 3000 else periods.runs_of_texts([words])[0]
        best = min(((-n, s, q) for s, n, q in runs), default=None)
        found = (best[1], -best[0], best[2], -1000 * best[0] // best[2]) if best else (None,) * 4
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, collapse(words, runs))]
        wanted.append((r[0], len(runs), *found, *digests))
    assert sorted(got, key=repr) == sorted(wanted, key=repr)
    assert sum(r[1] for r in wanted) > 20
