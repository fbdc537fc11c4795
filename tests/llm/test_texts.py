"""Quality rules, token counts, byte-level BPE and line dedup against plain Python and libraries."""

import hashlib
import math
import random
import re
from collections import Counter

import public_tokenizers as P
import pytest
import regex
import tiktoken
import xxhash
from tokenizers import Tokenizer

from medialoom.llm import byte_bpe, lines, quality, token_counts

from .helpers import LONG, ODD, corpus, documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def chained(*parts):
    """Spark's hash of several strings: each one's seed is the hash before."""
    seed = 42
    for p in parts:
        seed = xxhash.xxh64_intdigest(p.encode(), seed)
    return signed(seed)


def brute_base(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(5)}
    spoken = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""),
        len(spoken) - len(set(spoken)), len(covered),
    )


def brute_scores(docs, trusted, buckets):
    token = regex.compile(r"[\p{L}\p{M}\p{N}_]+|[^\s\p{L}\p{M}\p{N}_]+")

    def grams(text):
        t = token.findall(text or "")
        return [chained(x) % buckets for x in t] + [chained(*x) % buckets for x in zip(t, t[1:])]

    raw, target = Counter(), Counter()
    for i, text in docs:
        raw.update(grams(text))
        if i in trusted:
            target.update(grams(text))
    r, t = sum(raw.values()) + buckets, sum(target.values()) + buckets
    ratio = [math.log((target[b] + 1) / t) - math.log((raw[b] + 1) / r) for b in range(buckets)]
    return [sum(ratio[g] for g in gs) / len(gs) if (gs := grams(x)) else None for _, x in docs]


def test_quality_against_plain_python(spark):
    rows = corpus(60) + [(100 + i, f"!!! {i} ### word{i} ### ||| $$$ " * 9, "en", "s9") for i in range(5)]
    docs = documents(spark, rows)
    labels = [(i, 1, 0) for i in range(40)] + [(3, 0, 0), (4, 1, 1), (None, 1, 0), (5, None, None)]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    trusted = set(range(40)) - {3, 4}
    got = {r.doc_id: r for r in quality.judge(docs, table, buckets=997).collect()}
    scores = brute_scores([r[:2] for r in rows], trusted, 997)
    assert len(got) == len(rows)
    for (i, text, *_), score in zip(rows, scores):
        r = got[i]
        base = brute_base(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base
        assert r.base_failed == (base[0] < 10 or 100 * base[4] > 20 * base[0])
        assert r.score == pytest.approx(score, abs=1e-9)
        assert r.kept == (not r.base_failed and score >= quality.THRESHOLD)
    assert not any(got[100 + i].kept for i in range(5))


def test_quality_of_odd_documents(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = documents(spark)
    got = quality.judge(docs, labels)
    assert got.columns[-3:] == ["n_repeat_words", "base_failed", "kept"]
    rows = {(r.doc_id, r.text): r for r in got.collect()}
    for i, text, *_ in ODD:
        r = rows[i, text]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_base(text)
        assert r.score is None and r.kept == (not r.base_failed)
    assert quality.judge(docs.where("false"), labels).count() == 0


def mixed_texts(n, seed):
    rng = random.Random(seed)
    kinds = ["ab", "aaaa", "the ing on", "éèçñ ßÀÈ", "  \n\t", "0123²½", " a", "XYZ!?#'s't'll", "日本語", "🙂🤣", "ΣΑς", "\u0130\u0301"]
    return ["".join(rng.choice(rng.choice(kinds)) for _ in range(rng.choice([3, 40, 400]))) for _ in range(n)]


def test_token_counts_as_the_library(spark):
    path = P.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    texts = [r[1] for r in ODD] + mixed_texts(150, 1) + ["<|endoftext|> a<|startoftext|>b", "z" * 5000]
    docs = documents(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])
    got = {r.doc_id: r for r in token_counts.count_tokens(docs, path, limit=50).collect()}
    for i, t in enumerate(texts):
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        assert (got[i].n_tokens, got[i].n_bytes, got[i].over_limit) == (n, len((t or "").encode()), n > 50)
    assert token_counts.count_tokens(docs.where("false"), path).count() == 0


def reference_codec(path):
    ranks = byte_bpe.read_ranks(path)
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe_as_the_library(spark):
    path = P.path("byte_bpe_50k.tiktoken")
    library = reference_codec(path)
    texts = [r[1] for r in ODD] + mixed_texts(150, 2) + ["a" * 3001 + "b" * 7 + "ab" * 900, "<|endoftext|>", " " * 777]
    docs = documents(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])
    got = {r.doc_id: r for r in byte_bpe.digests(docs, path, P.PATTERN).collect()}
    for i, t in enumerate(texts):
        ids = library.encode_ordinary(t or "")
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    whole = byte_bpe.decode(byte_bpe.encode(docs, path, P.PATTERN), path, P.PATTERN).collect()
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in whole)
    assert all(list(r.ids) == library.encode_ordinary(r.text or "") for r in whole)


def test_any_cut_of_a_piece_joins_to_its_encoding():
    path = P.path("byte_bpe_50k.tiktoken")
    library, codec = reference_codec(path), byte_bpe.Codec(byte_bpe.read_ranks(path), P.PATTERN)
    for word in ("internationalisation", "aaaaaaaaaaaaaaaaaaaaaaa", "thththeringthethe", "éèéèéèé", "xaxbxaxbxaxb" * 5):
        data = word.encode()
        for cut in range(len(data) + 1):
            joined = codec.join(codec.halves(data[:cut]), codec.halves(data[cut:]))
            assert joined == codec.direct(data) == codec.by_heap([data[i : i + 1] for i in range(len(data))])
        assert codec.direct(data) == library.encode_ordinary(word) or len(codec.pattern.findall(word)) > 1


def brute_lines(rows):
    """Cleaned text of each (doc_id, text); equal rows are one document."""
    seen, out = {}, {}
    order = sorted({r for r in rows if r[1] is not None}, key=lambda r: (r[0] is None, r[0] or 0))
    for row in order:
        spoken = [i for i, x in enumerate(row[1].split("\n")) if WORD.search(x)]
        parts, gone = row[1].split("\n"), set()
        for k in range(len(spoken) - 2):
            window = tuple(parts[i] for i in spoken[k : k + 3])
            if seen.setdefault(window, (row, k)) != (row, k):
                gone |= set(spoken[k : k + 3])
        left = [x for i, x in enumerate(parts) if i not in gone]
        out[row] = ("\n".join(left), len(parts), len(gone))
    return out


@pytest.mark.parametrize("rows", [ODD, corpus(200)], ids=["odd", "corpus"])
def test_line_dedup_against_plain_python(spark, rows):
    got = lines.without_repeats(documents(spark, rows)).collect()
    wanted = brute_lines([r[:2] for r in rows])
    assert len(got) == len(rows)
    expected = [(r[0], *(wanted[r[:2]] if r[1] is not None else (None, 0, 0))) for r in rows]
    assert sorted(((r.doc_id, r.text, r.n_lines, r.n_removed) for r in got), key=repr) == sorted(expected, key=repr)
    assert lines.without_repeats(documents(spark).where("false")).count() == 0


def test_long_text_without_lines_is_left_alone(spark):
    got = lines.without_repeats(documents(spark, [(1, LONG, "en", "s")])).first()
    assert got.text == LONG and got.n_removed == 0


def test_a_merge_looks_up_new_neighbours_only():
    class Counted(dict):
        asked = 0

        def get(self, *key):
            Counted.asked += 1
            return super().get(*key)

    codec = byte_bpe.Codec(Counted(byte_bpe.read_ranks(P.path("byte_bpe_50k.tiktoken"))), P.PATTERN)
    data = b"internationalis"
    codec.direct(data)
    assert Counted.asked <= 3 * len(data)
