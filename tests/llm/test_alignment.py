"""Alignment of two tokenizers against plain loops over bytes."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from medialoom.llm import alignment, queries

from .helpers import ODD, corpus, documents

PATHS = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
HARD = [
    (30, "a\u2581b  two  spaces\t\ttabs\r\n\x00 nul", "en", "a"), (31, "<|endoftext|> </s><unk> <0x41>", "en", "a"),
    (32, "ﬁ ligature Å Å half-width ｶﾅ １２", "en", "a"), (33, "🙂🙃👩‍👩‍👧 ሀሁ ｗｉｄｅ", "en", "a"), (34, " lead and trail  ", "en", "a"),
    (35, "\ufeffbom \u200b zero", "en", "a"), (35, "same id", "en", "a"), (36, "aaaa" * 300, "en", "a"), (37, "\n", "en", "a"),
]


def gpt_letters():
    """Byte of each letter, asked from the library: the letters of a text of one byte each."""
    import tokenizers.pre_tokenizers as pre

    level = pre.ByteLevel(add_prefix_space=False, use_regex=False)
    out = {}
    for code in range(0x110000):
        if code in range(0xD800, 0xE000) or (code >= 0x3000 and code % 4096):
            continue
        data = chr(code).encode()
        out |= dict(zip(level.pre_tokenize_str(chr(code))[0][0], data))
    return out


LETTERS = gpt_letters()
A = Tokenizer.from_file(PATHS[0])
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])


def tokens(text):
    data = b" " + (text or "").encode()
    if not text:
        return [], []
    e = A.encode(" " + text, add_special_tokens=False)
    a = [(i, bytes(LETTERS[c] for c in t)) for i, t in zip(e.ids, e.tokens)]
    b = []
    for i in B.encode(text):
        piece = B.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if B.is_byte(i) else piece.replace("\u2581", " ").encode()))
    if b"".join(x for _, x in a) != data or b"".join(x for _, x in b) != data:
        return [], []
    return a, b


def spans(side):
    out, at = [], 0
    for i, data in side:
        out.append((i, at, at + len(data)))
        at += len(data)
    return out


def brute(rows):
    linked, all_groups = [], []
    for r in rows:
        a, b = map(spans, tokens(r[1]))
        linked.append([(x, y, min(e, z) - max(s, t)) for x, (_, s, e) in enumerate(a) for y, (_, t, z) in enumerate(b) if s < z and t < e])
        ends = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, low = [], 0
        for end in ends:
            groups.append([[k for k, (_, s, e) in enumerate(side) if low <= s and e <= end] for side in (a, b)])
            low = end
        all_groups.append((a, b, groups))
    pairs = [[(g[0][x][0], g[1][y][0]) for x, y, _ in found] for found, g in zip(linked, all_groups)]
    count = Counter(p for some in pairs for p in some)
    most = {}
    for (_, y), n in count.items():
        most[y] = max(n, most.get(y, 0))
    out = []
    for r, some, (a, b, groups) in zip(rows, pairs, all_groups):
        text = ";".join(",".join(str(a[i][0]) for i in x) + "|" + ",".join(str(b[i][0]) for i in y) for x, y in groups)
        out.append((r[0], len(a), len(b), len(groups), len(some), sum(count[p] == most[p[1]] for p in some), sum(count[p] for p in some), text))
    return out, linked, all_groups


def some_rows():
    return [r for r in ODD if r[0] != 11] + HARD + corpus(30)


def test_product_of_random_matrices():
    rng = random.Random(2)
    for _ in range(60):
        n, k, m = (rng.randint(0, 9) for _ in range(3))
        x, y = ((np.random.default_rng(rng.randint(0, 9**9)).random(s) < 0.4).astype(int) for s in ((n, k), (k, m)))
        def rows(z):
            return alignment.Rows(np.r_[0, np.cumsum(z.sum(axis=1))].astype(int), np.nonzero(z)[1], z.shape[1])
        got = alignment.product(rows(x), rows(y))
        dense = np.zeros((n, m), int)
        dense[got.row_numbers(), got.columns] = got.values
        assert (dense == x @ y).all() and len(got.columns) == (x @ y > 0).sum()
        back = rows(y).transposed()
        assert (np.nonzero(y.T)[1] == back.columns).all() and len(back.begin) == m + 1


@pytest.mark.parametrize("small", [8_000_000, 0])
def test_alignment_of_documents(spark, monkeypatch, small):
    monkeypatch.setattr(alignment, "SMALL", small)
    rows = some_rows()
    docs = documents(spark, rows)
    found = alignment.align(docs, *PATHS)
    assert found.columns == docs.columns + alignment.NAMES
    got = sorted((tuple(r[c] for c in ["doc_id", *alignment.NAMES]) for r in found.collect()), key=repr)
    wanted = brute(rows)[0]
    assert got == sorted(wanted, key=repr)
    assert sum(w[1] == 0 for w in wanted) >= 2 and sum(w[4] for w in wanted) > 1000
    assert alignment.align(documents(spark, []), *PATHS).count() == 0


def test_words_in_small_parts(monkeypatch):
    """Texts cut at spaces, with few words remembered, give what whole texts give."""
    for name, value in {"GATHER": 300, "REMEMBERED": 40, "JOINED": 7}.items():
        monkeypatch.setattr(alignment, name, value)
    rng = random.Random(4)
    letters = ["a", "b", "é", " ", " ", "  ", "\n", "\t", "\u3000", "\xa0", "\x1c", "\u0301", "'s", "12", "<s>", "▁", "🙂", "ﬁ", "日"]
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 25))) for _ in range(400)]
    texts += ["same words here", " same words", "same words "] * 5
    pair, rows = alignment.Pair(*PATHS), [(i, t) for i, t in enumerate(texts)]
    assert pair.parts_at_spaces
    words = alignment.Words(pair)
    got = []
    for part in alignment.gathered(texts):
        if len(words) > alignment.REMEMBERED:
            words.forget()
        found = alignment.measured(part, words, None)
        got += [tuple(r) for r in found[["n_a", "n_b", "n_groups", "n_links", "groups"]].itertuples(index=False)]
    assert got == [(*w[1:5], w[7]) for w in brute(rows)[0]]


def test_links(spark):
    rows = [r for r in some_rows() if r[0] is not None and r[0] not in (8, 35)][:30]
    rows = list({r[0]: r for r in rows}.values())
    docs = documents(spark, rows)
    _, linked, groups = brute(rows)
    got = {r.doc_id: [tuple(x) for x in r.links] for r in alignment.links(docs, *PATHS).collect()}
    assert got == {r[0]: found for r, found in zip(rows, linked)}
    got = {r.doc_id: [(x.a, x.b) for x in r.links] for r in alignment.links(docs, *PATHS, groups=True).collect()}
    assert got == {r[0]: sorted((i, j) for x, y in g[2] for i in x for j in y) for r, g in zip(rows, groups)}


def test_clashing_names_and_query(spark, tmp_path):
    rows = some_rows()
    docs = documents(spark, rows)
    for name in ("id", "given", "found", "a", "b", "t", "key", "n_a", "of", "best"):
        docs = docs.withColumn(name, docs.doc_id)
    got = alignment.align(docs, *PATHS)
    assert got.columns == [c for c in docs.columns if c != "n_a"] + alignment.NAMES
    assert all(r.id == r.given == r.key == r.doc_id for r in got.collect())
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, queries.QUERIES["op11_alignment"](spark, str(tmp_path)).collect()), key=repr)
    wanted = [(*r[:-1], hashlib.sha256(r[-1].encode()).hexdigest() if r[1] else "") for r in brute(rows)[0]]
    assert got == sorted(wanted, key=repr)
