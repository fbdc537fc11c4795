"""Suffix-array dedup against plain Python."""

import random

import numpy as np
import pytest

from medialoom.llm import suffixes

from .helpers import ODD, corpus, documents


def brute(rows, length):
    """{(doc_id, text): (kept, n_removed, n_spans)} from a dictionary of all strings."""
    order = sorted({r[:2] for r in rows}, key=lambda r: (r[0] is None, r[0] or 0, suffixes_key(r[1])))
    first, out = {}, {}
    for row in order:
        data = (row[1] or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            piece = data[i : i + length]
            if first.setdefault(piece, (row, i)) != (row, i):
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(data, gone) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[row] = (kept, sum(gone), runs)
    return out


def suffixes_key(text):
    import hashlib

    return hashlib.sha256((text or "").encode()).digest()


def found(df):
    return sorted(((r.doc_id, r.text, bytes(r.kept), r.n_removed, r.n_spans, r.n_bytes) for r in df.collect()), key=repr)


def wanted(rows, length):
    plain = brute(rows, length)
    return sorted(((*r[:2], *plain[r[:2]], len((r[1] or "").encode())) for r in rows), key=repr)


@pytest.mark.parametrize("depth", [2, 3, 7, 30, 100])
def test_ranks_follow_the_order_of_prefixes(depth):
    rng = random.Random(depth)
    for _ in range(60):
        s = [rng.randint(1, rng.choice([1, 2, 4, 200])) for _ in range(rng.randint(1, 300))]
        s = rng.choice([s, [*s, 0, *s, 0, *s[: len(s) // 2]]])
        ranks = suffixes.suffix_ranks(np.array(s), depth)
        prefix = [tuple((s + [0] * depth)[i : i + depth]) for i in range(len(s))]
        order = sorted(range(len(s)), key=lambda i: ranks[i])
        for a, b in zip(order, order[1:]):
            assert prefix[a] <= prefix[b]
            assert ranks[a] < ranks[b] or prefix[a] == prefix[b]


def passages(n, seed=3):
    """Texts with copies, shared passages, periodic stretches and edits."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 8))) for _ in range(300)]
    shared = [" ".join(rng.choices(words, k=rng.randint(15, 60))) for _ in range(5)]
    rows = []
    for i in range(n):
        kind = rng.random()
        text = " ".join(rng.choices(words, k=rng.randint(1, 120)))
        if rows and kind < 0.2:
            text = rows[rng.randrange(len(rows))][1]
        elif rows and kind < 0.4:
            base = rows[rng.randrange(len(rows))][1]
            at = rng.randint(0, len(base))
            text = base[:at] + rng.choice(["x", "", "new words "]) + base[at + 1 :]
        elif kind < 0.7:
            at = rng.randint(0, len(text))
            text = text[:at] + rng.choice(shared) + text[at:] + rng.choice(["", rng.choice(shared)])
        elif kind < 0.8:
            text = rng.choice(["ab", "x", "abc ", words[0] * 9]) * rng.randint(1, 300)
        rows.append((n - i if i % 7 else i, text, "en", "a"))
    return rows


def test_against_all_strings(spark):
    rows = passages(150)
    assert found(suffixes.without_repeats(documents(spark, rows))) == wanted(rows, 100)
    assert sum(r[3] for r in wanted(rows, 100)) > 1000


def test_in_small_parts_with_split_names(spark, monkeypatch):
    for name, value in {"PART": 3000, "HOT": 3, "RUN": 50, "GATHER": 4000, "BUCKET": 5000}.items():
        monkeypatch.setattr(suffixes, name, value)
    texts = list(passages(60, seed=9))
    data = [(r[0], r[1].encode()) for r in texts]
    # without workers, so that the changed sizes count
    import pandas as pd

    batch = pd.DataFrame({"text": [r[1] for r in texts], "tid": [hash(r[1]) for r in texts]})
    asked = pd.concat(list(suffixes.ask(iter([batch[:30], batch[30:]]), 100, 3)))
    told = pd.concat([suffixes.answer(g) for _, g in asked.groupby("bucket")])
    hot = {n for t, n in zip(told["tid"], told["name"]) if t is pd.NA}
    assert hot
    by_text = {}
    for t, n in zip(told["tid"], told["name"]):
        if t is not pd.NA:
            by_text.setdefault(int(t), set()).add(int(n))
    first = {}
    for doc, text in sorted({r[:2] for r in texts}, key=lambda r: (r[0], suffixes_key(r[1]))):
        first.setdefault(text, doc)
    rows = [(d, suffixes_key(t), t, list(by_text.get(hash(t), ())), [n for n in by_text.get(hash(t), ()) if n in hot])
            for t, d in first.items() if len(t.encode()) >= 100]
    sent = list(suffixes.send(iter([pd.DataFrame(rows, columns=["_id", "sha", "text", "names", "hot"])]), 100, 3))
    groups = pd.concat(sent)
    spans = pd.concat([suffixes.settle(g, 100) for _, g in groups.groupby("bucket")])
    plain = brute([(d, t) for t, d in first.items()], 100)
    for text, doc in first.items():
        size = len(text.encode())
        mine = spans[spans["sha"] == suffixes_key(text)]
        gone = suffixes.merged([{"from": a, "to": z} for a, z in zip(mine["from"], mine["to"])])
        assert (sum(z - a for a, z in gone), len(gone)) == plain[doc, text][1:], (doc, size)
    assert data


def test_odd_documents_and_other_lengths(spark, rows):
    odd = [*ODD, (20, "z" * 500, "en", "a"), (20, "z" * 300, "en", "a"), (None, "z" * 99 + "y", "en", "b"), (21, "z" * 100, None, None)]
    docs = documents(spark, odd)
    assert found(suffixes.without_repeats(docs)) == wanted(odd, 100)
    assert suffixes.without_repeats(docs).columns == ["doc_id", "text", "lang", "source", "n_chars", "_key", "h", "score", "n_bytes", "n_removed", "n_spans", "kept"]
    some = corpus(40)
    assert found(suffixes.without_repeats(documents(spark, some), 30)) == wanted(some, 30)
    assert found(suffixes.without_repeats(documents(spark, []))) == []


def test_clashing_names(spark):
    names = ["_id", "sha", "tid", "n", "row", "spans", "copy", "first", "names", "hot", "bucket", "from", "to", "r", "_sha", "_of", "n_removed"]
    docs = documents(spark, passages(20)).select("doc_id", "text")
    for name in names:
        docs = docs.withColumn(name, docs.doc_id)
    got = suffixes.without_repeats(docs)
    assert [c for c in got.columns] == ["doc_id", "text", *names[:-1], "n_bytes", "n_removed", "n_spans", "kept"]
    assert found(got) == wanted(passages(20), 100)


def test_digests_travel_instead_of_bytes(spark):
    import hashlib

    docs = documents(spark, passages(20))
    whole = {(r.doc_id, r.sha): r.kept for r in suffixes.repeats(docs).collect()}
    short = {(r.doc_id, r.sha): r.kept for r in suffixes.repeats(docs, digest=True).collect()}
    assert short == {k: v if v is None else hashlib.sha256(v).hexdigest() for k, v in whole.items()}
    assert any(short.values())
