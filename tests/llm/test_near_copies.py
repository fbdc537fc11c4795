"""Near copies of the pipeline against the Jaccard similarity of all pairs."""

import random
from collections import Counter

import pytest

import corpus_pipeline
from medialoom.llm import near_copies

from .helpers import ODD, corpus, documents
from .helpers import components as plain_components


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def edited(n=60, seed=9):
    """Texts of 200 words, each with a copy in which 1 to 5 words are replaced."""
    rng, rows = random.Random(seed), []
    for i in range(n):
        words = [f"w{rng.randrange(5000)}" for _ in range(200)]
        changed = list(words)
        for at in rng.sample(range(200), 1 + i % 5):
            changed[at] = "other"
        rows += [(2 * i, " ".join(words), "en", "s"), (2 * i + 1, " ".join(changed), "en", "s")]
    return rows


@pytest.mark.parametrize("rows,tile", [(ODD, 4), (corpus(150), 16), (edited(), 16384)], ids=["odd", "corpus", "edited"])
def test_near_copies_against_all_pairs(spark, rows, tile):
    sets = [shingles(r[1]) for r in rows]
    links = [
        (a, b) for a in range(len(rows)) for b in range(a)
        if sets[a] == sets[b] or 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])
    ]
    first = {}
    for r, root in zip(rows, plain_components(len(rows), links)):
        if root not in first or (r[0] is None, r[0]) < (first[root] is None, first[root]):
            first[root] = r[0]
    kept = [r.doc_id for r in near_copies.without_near_copies(documents(spark, rows), tile).collect()]
    assert sorted(kept, key=repr) == sorted(first.values(), key=repr)


def short(n=150, seed=21):
    """Groups of texts of 4 to 90 shingles, edited at the start, the end and in between."""
    rng, rows = random.Random(seed), []
    for i in range(n):
        words = [f"v{rng.randrange(900)}" for _ in range(rng.choice([8, 9, 10, 11, 12, 14, 17, 20, 24, 40, 70, 90]))]
        for _ in range(4):
            other, kind = list(words), rng.random()
            if kind < 0.4:
                other = other[: len(other) - rng.randint(0, 4)]
            elif kind < 0.7:
                other += [f"v{rng.randrange(900)}" for _ in range(rng.randint(1, 6))]
            else:
                other[rng.choice([0, 1, -1, -2, len(other) // 2])] = "changed"
            rows.append((len(rows), " ".join(other), "en", "s"))
    return rows


@pytest.mark.parametrize("tile", [50, 16384])
def test_short_texts_lose_no_pair(spark, tile):
    rows = short()
    sets = [shingles(r[1]) for r in rows]
    links = [(a, b) for a in range(len(rows)) for b in range(a) if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    few = [(a, b) for a, b in links if sets[a] != sets[b] and min(len(sets[a]), len(sets[b])) <= 20]
    assert len(few) > 80
    roots = sorted(set(plain_components(len(rows), links)))
    kept = near_copies.without_near_copies(documents(spark, rows), tile).collect()
    assert sorted(r.doc_id for r in kept) == roots


def alike_pairs(sets):
    """Pairs with the similarity, by a prefix filter over all sets and an exact test."""
    times = Counter(x for s in sets for x in s)
    index, found = {}, []
    for i, s in enumerate(sets):
        order = sorted(s, key=lambda x: (times[x], x))
        seen = set()
        for x in order[: len(s) - -(-4 * len(s) // 5) + 1]:
            for j in index.setdefault(x, []):
                if j not in seen and 5 * len(s & sets[j]) >= 4 * len(s | sets[j]):
                    found.append((i, j))
                seen.add(j)
            index[x].append(i)
    return found


def test_recall_on_a_given_table(spark):
    """All pairs at 0.8 of the documents at sf0.01 are joined, directly or in steps, and no others."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    texts = {}
    for r in sorted(rows):
        texts.setdefault(frozenset(shingles(r.text)), r.doc_id)
    sets, ids = list(texts), list(texts.values())
    links = alike_pairs(sets)
    wanted = sorted({ids[r] for r in plain_components(len(sets), links)})
    kept = sorted(r.doc_id for r in near_copies.without_near_copies(docs).collect())
    assert kept == wanted and len(links) > 0


def test_equal_rows_are_settled_by_their_columns(spark):
    rows = [(1, "one text of several words", lang, "s") for lang in ("en", "es", "de", "fr")] * 2
    kept = set()
    for parts in (1, 2, 3, 5):
        docs = documents(spark, rows).repartition(parts)
        kept.add(tuple(near_copies.without_near_copies(docs).collect()))
    assert len(kept) == 1 and len(next(iter(kept))) == 1


def test_the_stage_takes_near_copies_of_08(spark):
    docs = documents(spark, edited()).select(*corpus_pipeline.COLUMNS)
    kept = corpus_pipeline.near_dedup(spark, docs, "")
    assert kept.columns == corpus_pipeline.COLUMNS
    sets = {r[0]: shingles(r[1]) for r in edited()}
    ids = {r.doc_id for r in kept.collect()}
    assert all((i in ids) == (5 * len(sets[i] & sets[i - 1]) < 4 * len(sets[i] | sets[i - 1])) for i in range(1, 120, 2))
    assert near_copies.without_near_copies(docs.where("false")).count() == 0
