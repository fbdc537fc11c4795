"""Mixing with a third of a source's rows sharing one id."""

from collections import Counter

import pytest

from medialoom.llm import mixing

from .helpers import documents


@pytest.mark.parametrize("chunk", [65_536, 100])
def test_a_hot_unit_meets_the_target(spark, monkeypatch, chunk):
    monkeypatch.setattr(mixing, "CHUNK", chunk)
    rows = [(7, "w " * 10, "en", "a")] * 1000 + [(100 + i, "w " * (5 + i % 11), "en", "a") for i in range(2000)]
    rows += [(9000 + i, "w " * 10, "en", "b") for i in range(4000)] + [(None, "v " * 9, "en", "b")] * 3
    docs = documents(spark, rows)
    got = mixing.taken_words(docs).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    source = {r[0]: r[3] for r in rows}
    mixed = Counter(r.doc_id for r in mixing.mix(docs).collect())
    for s in "ab":
        mine = [r for r in got if source[r.doc_id] == s]
        assert 0.1 < mine[0].target / mine[0].source_size % 1 < 0.9
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 2 * 15
    times = Counter()
    for r in got:
        times[r.doc_id] += r.taken // r["size"]
    assert mixed == +times
