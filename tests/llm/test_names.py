"""No operator loses a column, or fails, because of a name that it uses itself."""

import public_tokenizers as P
import pytest

from medialoom.llm import byte_bpe, language, lines, mixing, near_copies, quality, sharding, simhash, token_counts
from .helpers import ODD, documents

HELPERS = [
    "_id", "_digest", "_times", "_rows", "_whole", "_extra", "_p_id", "_p_source", "_k_id", "_kid", "_w_id", "w_id", "k_id", "kk",
    "_later", "later", "_rest", "rest", "_label", "found", "row", "h", "node", "component", "best", "_mark", "_number", "_copy",
    "_size", "_source", "_salt", "_offset", "_place", "hashes", "rank", "hash", "windows", "top", "of", "fp", "n",
]


def crowded(spark):
    docs = documents(spark, [r for r in ODD if r[0] != 11]).drop("h")
    return docs.selectExpr("*", *(f"concat('own ', doc_id) as `{n}`" for n in HELPERS))


@pytest.mark.parametrize("apply", [
    lambda d: lines.without_repeats(d), lambda d: mixing.mix(d), lambda d: near_copies.without_near_copies(d),
    lambda d: simhash.without_copies(d), lambda d: sharding.place(d),
    lambda d: language.identify(d, language.learn([(language.spread_windows("some text").astype("<u2").tobytes(), "en")], steps=2)),
], ids=["lines", "mix", "near", "simhash", "place", "language"])
def test_helper_names(spark, apply):
    docs = crowded(spark)
    found = apply(docs)
    assert set(docs.columns) <= set(found.columns)
    rows = found.collect()
    assert rows
    for r in rows:
        own = None if r.doc_id is None else f"own {r.doc_id}"
        assert {r[n] for n in HELPERS} == {own}
