"""SimHash, vectors, components, sharding, mixing, urls and languages."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from medialoom.llm import language, mixing, sharding, simhash, urls, vectors
from medialoom.llm.components import Forest, components

from .helpers import ODD, corpus, documents
from .helpers import components as plain_components


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("rows", [ODD, corpus(150)], ids=["odd", "corpus"])
def test_simhash_against_plain_python(spark, rows):
    got = simhash.component_ids(documents(spark, rows)).collect()
    prints = [brute_fingerprint(r[1]) for r in rows]
    links = [(a, b) for a in range(len(rows)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 4]
    roots = plain_components(len(rows), links)
    smallest = {}
    for r, root in zip(rows, roots):
        if r[0] is not None:
            smallest[root] = min(smallest.get(root, r[0]), r[0])
    wanted = [(r[0], f"{p:016x}", smallest.get(root)) for r, p, root in zip(rows, prints, roots)]
    assert sorted(map(tuple, got), key=repr) == sorted(wanted, key=repr)


def test_one_document_of_each_group_stays(spark):
    rows = corpus(150)
    docs = documents(spark, rows)
    kept = simhash.without_copies(docs)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert ids == {r.component_id for r in simhash.component_ids(docs).collect()}
    assert simhash.without_copies(documents(spark)).where("doc_id in (1, 2, 3, 8)").count() == 2
    assert simhash.component_ids(docs.where("false")).count() == 0
    assert simhash.without_copies(docs.where("false")).count() == 0


def test_tiles_lose_no_link(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(-(2**63), 2**63 - 1, 700)
    flips = [int(x) ^ (1 << int(b) if b < 63 else 0) for x, b in zip(rng.choice(base, 300), rng.integers(0, 63, 300))]
    fps = sorted({*map(int, base), *flips})
    found = components(simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long"), tile=64)).collect()
    links = [(a, b) for a in range(len(fps)) for b in range(a) if ((fps[a] ^ fps[b]) & (2**64 - 1)).bit_count() <= 4]
    roots = plain_components(len(fps), links)
    got = {r.node: r.component for r in found}
    assert [got.get(f, f) for f in fps] == [fps[r] for r in roots]
    assert any(f != fps[r] for f, r in zip(fps, roots))


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(1, x) for x in range(2, 40)] + [(7, 7), (None, 3), (90, None)]
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == {i: 100 for i in range(101, 161)} | {i: 1 for i in range(2, 40)}
    forest = Forest(6)
    forest.link(np.array([5, 3, 4]), np.array([4, 1, 3]))
    assert forest.root.tolist() == [0, 1, 2, 1, 1, 1]


def test_vectors_against_all_pairs(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((120, 24))
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    rows += [(200 + i, (base[i % 40] + rng.standard_normal(24) * s).tolist()) for i, s in enumerate(rng.uniform(0, 0.8, 150))]
    rows += [(400 + i, base[0].tolist()) for i in range(5)] + [(500, (base[1] * 7).tolist())]
    odd = [(600, None), (601, []), (602, [0.0] * 24), (603, [float("nan")] + [1.0] * 23), (604, [None] + [1.0] * 23),
           (605, [1.0, 0.0]), (606, [2.0, 0.0]), (607, [float("inf")] * 24), (0, base[0].tolist())]
    data = spark.createDataFrame([(*r, 1, 2) for r in rows + odd], "vec_id long, embedding array<double>, key int, n_links int")
    got = sorted((tuple(r) for r in vectors.near_duplicates(data, tile=64).collect()), key=repr)
    every = rows + odd

    def good(v):
        return v and None not in v and np.isfinite(v).all() and np.any(v)

    links = []
    for a, (_, x) in enumerate(every):
        for b in range(a):
            y = every[b][1]
            if good(x) and good(y) and len(x) == len(y):
                x_, y_ = np.array(x), np.array(y)
                if x_ @ y_ / np.sqrt(x_ @ x_) / np.sqrt(y_ @ y_) >= 0.9:
                    links.append((a, b))
    number = Counter(i for pair in links for i in pair)
    roots = plain_components(len(every), links)
    low = {}
    for (i, _), r in zip(every, roots):
        low[r] = min(i, low.get(r, i))
    wanted = [(i, number[k], low[r], i == low[r]) for k, ((i, _), r) in enumerate(zip(every, roots))]
    assert got == sorted(wanted, key=repr)
    assert vectors.near_duplicates(data.where("false")).count() == 0


def test_vectors_of_very_large_and_very_small_components(spark):
    tiny = 5e-324
    rows = [
        (1, [1e200, 1e200]), (2, [1e200, 1e200]), (3, [1e-200, 1e-200]), (4, [tiny, tiny]), (5, [1.0, 1.1]), (6, [-1e308, 1e308]),
        (7, [1e308, -1e308]), (8, [0.0, 0.0]), (9, [float("inf"), 1.0]), (10, [-1.7e308, 1.7e308]), (11, [1e308, 1e-308]), (12, [tiny, 0.0]),
    ]
    got = vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    wanted = {1: (4, 1), 2: (4, 1), 3: (4, 1), 4: (4, 1), 5: (4, 1), 6: (1, 6), 7: (0, 7), 8: (0, 8), 9: (0, 9), 10: (1, 6), 11: (1, 11), 12: (1, 11)}
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == wanted


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(8)
    x, errors = rng.standard_normal((4000, 64)), []
    y = x + rng.standard_normal((4000, 64)) * 0.4
    turn = vectors.rotation(64)
    a, b = vectors.unit(x) @ turn.T, vectors.unit(y) @ turn.T
    width = a.shape[1]
    factor = np.abs(a).sum(axis=1) / np.sqrt(width)
    estimate = (np.sign(a) * b).sum(axis=1) / np.sqrt(width) / factor
    true = (vectors.unit(x) * vectors.unit(y)).sum(axis=1)
    errors = (estimate - true) / (np.sqrt(1 - factor**2) / factor / np.sqrt(width - 1))
    assert abs((estimate - true).mean()) < 0.003
    assert np.abs(errors).max() < vectors.SURE


def plain_table(shards, slots):
    orders = []
    for s in shards:
        offset, stride = sharding.preference(s, slots)
        orders.append(iter([(offset + k * stride) % slots for k in range(slots)]))
    table = {}
    while len(table) < slots:
        for i, order in enumerate(orders):
            if len(table) < slots:
                table[next(x for x in order if x not in table)] = i
    return [table[k] for k in range(slots)]


def test_sharding(spark, tmp_path):
    assert sharding.fill(sharding.SHARDS, 211) == plain_table(sharding.SHARDS, 211)
    sizes = Counter(sharding.fill(sharding.SHARDS)).values()
    assert max(sizes) - min(sizes) <= 1
    less = sharding.fill(sharding.SHARDS[:-1])
    full = sharding.fill(sharding.SHARDS)
    moved = sum(sharding.SHARDS[a] != sharding.SHARDS[b] for a, b in zip(full, less))
    assert moved < 0.2 * len(full)
    docs = documents(spark)
    placed = sharding.place(docs)
    rows = placed.collect()
    assert len(rows) == len(ODD) and all(r.shard == sharding.SHARDS[full[r.slot]] for r in rows)
    sharding.write_shards(docs, str(tmp_path / "shards"), files=2)
    assert spark.read.parquet(str(tmp_path / "shards")).count() == len(ODD)
    assert sharding.place(docs.where("false")).count() == 0
    for bad in ([], ["a", "a"]):
        with pytest.raises(ValueError):
            sharding.fill(bad)
    with pytest.raises(ValueError):
        sharding.fill(["a"], 10)


def plain_targets(sizes):
    """Shares by weight; what is above three times the size is shared anew until none is."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in capped]
        left = total - sum(capped.values())
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return capped | share
        capped |= {s: 3 * sizes[s] for s in over}


@pytest.mark.parametrize("block", [8192, 16])
def test_mixing(spark, block):
    rows = corpus(400) + [(1000 + i, "w " * (i + 1), "en", "tiny") for i in range(3)] + [(2000, "a b c", "en", None), (2001, None, "en", "void")]
    rows += [rows[0], rows[0]]
    docs = documents(spark, rows)
    got = mixing.taken_words(docs, block).collect()
    assert sorted(r.doc_id for r in got) == sorted(r[0] for r in rows)
    source = {r[0]: r[3] for r in rows}
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len((r[1] or "").split())
    targets = plain_targets(dict(sizes))
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[source[r.doc_id]]
        assert r.target == pytest.approx(targets[source[r.doc_id]])
        assert r["size"] == 0 or r.taken % r["size"] == 0
        assert r.taken <= 3 * r["size"]
        taken[source[r.doc_id]] += r.taken
    longest = max(len((r[1] or "").split()) for r in rows)
    for s, target in targets.items():
        assert abs(taken[s] - target) <= 2 * longest
    again = mixing.taken_words(docs.repartition(7), block).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))
    mixed = mixing.mix(docs, block)
    assert mixed.columns == docs.columns
    copies = Counter(r.doc_id for r in mixed.collect())
    once = Counter(r.doc_id for r in got)
    assert all(copies[r.doc_id] == once[r.doc_id] * (r.taken // r["size"]) for r in got if r["size"])


def test_mixing_of_odd_documents(spark):
    docs = documents(spark)
    assert mixing.taken_words(docs).count() == len(ODD)
    assert mixing.taken_words(docs.where("false")).count() == 0
    assert mixing.mix(docs.where("false")).count() == 0
    nothing = mixing.taken_words(docs.where("text is null or doc_id < 3")).collect()
    assert {(r["size"], r.target, r.taken) for r in nothing} == {(0, 0.0, 0)}


def test_flight_keeps_totals():
    rng = np.random.default_rng(1)
    sizes, rows = rng.integers(1, 500, 300).astype(float), np.ones(300)
    moved = mixing.flight(sizes, rows, np.full(300, 0.37), rng.random(300))
    assert ((moved > 0) & (moved < 1)).sum() <= 2
    assert moved.sum() == pytest.approx(0.37 * 300)
    assert moved @ sizes == pytest.approx(0.37 * sizes.sum())


URLS = [
    ("http://Net/", "net", "/", "net/", "block"), ("http://a.b.NET/x?y", "a.b.net", "/x", "net/", "block"),
    ("https://www.example.net/en/1#t", "www.example.net", "/en/1", "example.net/en/", "allow"),
    ("http://example.net", "example.net", "", None, "allow"), ("http://xexample.com/de/", "xexample.com", "/de/", None, "allow"),
    ("http://example.com/de/q", "example.com", "/de/q", "example.com/de/", "block"), ("http://a.org/fr/", "a.org", "/fr/", "org/fr/", "allow"),
    ("http://a.com/x.net/", "a.com", "/x.net/", None, "allow"), ("no url", "", "", None, "allow"), (None, "", "", None, "allow"),
    ("http://ads.foo.com/p", "ads.foo.com", "/p", None, "block"), ("http://a.com/b/wp-login.php?x", "a.com", "/b/wp-login.php", None, "block"),
    ("http://a.com/s.mpé", "a.com", "/s.mpé", None, "block"), ("http://a.com/s.mpéé", "a.com", "/s.mpéé", None, "allow"),
    ("http://a.com/" + "x" * 50_000 + "/login", "a.com", "/" + "x" * 50_000 + "/login", None, "block"), ("", "", "", None, "allow"),
    ("x://://y.net/", ":", "//y.net/", None, "allow"), ("http://É.net/", "É.net", "/", "net/", "block"),
]


def test_url_rules(spark):
    pages = spark.createDataFrame([(i, u[0], "mine", "x") for i, u in enumerate(URLS)], "page_id long, url string, rule string, _judged string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge(pages).collect()}
    assert got == {i: u[1:] for i, u in enumerate(URLS)}
    assert urls.judge(pages.where("false")).count() == 0
    assert {r.verdict for r in urls.judge(pages, rules=[], blocked=[]).collect()} == {"allow"}


def test_globs_against_expressions():
    globs = ["a*b", "a**b", "*", "**", "?", "a?c", "\\*x", "x**", "*.net/**", "aa*aa", "é?", "", "a" * 70 + "*" + "b" * 70]
    def expression(g):
        g = re.escape(g.replace("\\*", "\x00")).replace(r"\*\*", "(?s:.*)").replace(r"\*", "[^/]*").replace(r"\?", "[^/]")
        return re.compile(g.replace("\x00", r"\*"))
    texts = ["", "a", "ab", "a/b", "axxb", "abc", "a/c", "aéc", "*x", "yx", "x/y", "q.net/", "q/r.net/", "aaaa", "aaa", "aa/aa", "éü",
             "a" * 70 + "zz" + "b" * 70, "a" * 70 + "b" * 69, "x" * 300]
    fits = urls.Automaton(globs).fits([t.encode() for t in texts])
    wanted = [[bool(expression(g).fullmatch(t)) for g in globs] for t in texts]
    assert fits.tolist() == wanted


def sentences(n):
    rng = np.random.default_rng(2)
    parts = {"aa": ["the", "ing", "wh", "ou"], "bb": ["ción", "ñ", "ll", "os"], "cc": ["sch", "ü", "ung", "ein"]}
    rows = []
    for i in range(n):
        lang = "abc"[i % 3] * 2
        words = ["".join(rng.choice(parts[lang], rng.integers(1, 4))) for _ in range(60)]
        rows.append((i, " ".join(words), lang, "s"))
    return rows


def test_held_out_accuracy(spark):
    rows = sentences(240) + [(900, None, "aa", "s"), (901, "", "bb", "s"), (902, "12 !?", "cc", "s"), (None, "the ing", None, "s")]
    docs = documents(spark, rows)
    held = language.held_out_fold()
    learned = language.learning_rows(docs, held)
    unseen = [r[1] for r in rows if r[1] and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 4 == 2]
    assert not {w for w, _ in learned} & {language.spread_windows(t).astype("<u2").tobytes() for t in unseen}
    net = language.learn(learned, steps=60)
    got = language.identify(docs, net).withColumn("held_out", held).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    assert all((by_id[i].lang_pred, by_id[i].score) == ("und", 0.0) for i in (900, 901, 902))
    test = [(r.lang_pred, r.lang) for r in got if r.held_out and r.doc_id < 900]
    assert len(test) > 30 and np.mean([a == b for a, b in test]) > 0.95
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert all(0 <= r.score <= 1 for r in got)
    nothing = language.learn(language.learning_rows(docs.where("false"), held))
    assert nothing is None
    assert {r.lang_pred for r in language.identify(docs, nothing).select(F.col("lang_pred")).collect()} == {"und"}


def test_slopes_of_the_network():
    """Backpropagation through time against differences."""
    rng = np.random.default_rng(0)
    data, h = rng.integers(0, 257, (7, 5)), 3
    table, back = rng.normal(size=(3 * h, 257)), rng.normal(size=(3 * h, h))
    weight = rng.normal(size=(7, h, 5))

    def loss(t, b):
        return float((language.run_kept(t, b, data)[0] * weight).sum())

    _, gates = language.run_kept(table, back, data)
    slope_table, slope_back = language.unroll(back, gates, data, weight)
    for i, j in ((0, 0), (4, 1), (8, 2)):
        step = np.zeros_like(back)
        step[i, j] = 1e-6
        assert slope_back[i, j] == pytest.approx((loss(table, back + step) - loss(table, back - step)) / 2e-6, abs=1e-3)
    byte = int(data[2, 2])
    for i in (0, 4, 8):
        step = np.zeros_like(table)
        step[i, byte] = 1e-6
        assert slope_table[byte, i] == pytest.approx((loss(table + step, back) - loss(table - step, back)) / 2e-6, abs=1e-3)
    fast = language.run_layer(table.astype("f"), back.astype("f"), data)
    assert np.allclose(fast, language.run_kept(table, back, data)[0], atol=1e-4)
