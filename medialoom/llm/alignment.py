"""Alignment of the tokens of two tokenizers by sparse incidence matrices.

Both tokenizers encode the same bytes. For each of them a matrix says which token holds which byte:
A has a row for each token of the first, B one for each of the second, stored as compressed rows
(where each row begins, and the columns of its entries). The product A Bᵀ, row by row after
Gustavson, has an entry wherever tokens overlap; its value is the number of bytes they share.
Where tokens of both end at one byte, a group ends; the matrices of tokens by groups give, by the
same product, all pairs that share a group. Texts lie end to end in one matrix, no token
crosses from one to the next, and the product of many texts is a few array operations.

Neither tokenizer ever joins a space to what stands before it (each checks that of its vocabulary
when it is read; otherwise texts stay whole). So a text falls at its spaces into words that can be
encoded, multiplied and written as groups by themselves, and a worker does that once for each
different word, many words in one matrix; up to ``REMEMBERED`` words are kept. A text's numbers are
sums over its words.

How often an overlap links two ids in the whole corpus is counted first: each task adds up its
pairs before they are sent, and a bucket adds up what the tasks have sent. There are at most as
many pairs of ids as the vocabularies' sizes multiplied. A table of up to ``SMALL`` pairs is
broadcast; a larger one is joined to the distinct pairs of each text.

Defined results: a null or an empty text has no tokens, as one whose bytes the tokens don't give
back; all its numbers are zero and its groups are an empty text. Every row is encoded and counted by
itself, repeated rows repeatedly; null ids are kept. A text of any length is encoded whole. Equal
counts tie: each pair with the highest count of its second id is a best one. An empty table gives
no rows. Columns of the input that are named like results give way, all others stay.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medialoom.session import cut_lineage

#: Pairs of ids that are broadcast at most (17 bytes each), and buckets of pairs.
SMALL, BUCKETS = 4_000_000, 64
#: Characters of text that a worker takes at once, words it remembers, words encoded as one string.
GATHER, REMEMBERED, JOINED = 4_000_000, 400_000, 1000
#: A space after something that is no white space, but not the last character of a text; and a
#: space that follows white space.
CUT, RUN_ON = re.compile(r"(?<=\S)(?= .)", re.DOTALL), re.compile(r"\s ")


# -- the two tokenizers -------------------------------------------------------------------------


def visible_bytes() -> dict[str, int]:
    """The byte behind each letter of a byte-level vocabulary: printable bytes stand for themselves,
    the others for the letters from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class First:
    """A byte-level tokenizer of the tokenizers library; it gets a space before the text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are parallel already
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        self.library.no_truncation()
        self.library.no_padding()
        plan = json.loads(self.library.to_str())
        split = plan.get("pre_tokenizer") or {}
        self.parts_at_spaces = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not plan.get("normalizer")
        letter = visible_bytes()
        found = {i: bytes(letter[c] for c in t) for t, i in self.library.get_vocab().items() if all(c in letter for c in t)}
        self.bytes = [found.get(i, b"") for i in range(max(self.library.get_vocab().values()) + 1)]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch([" " + t for t in texts], add_special_tokens=False)]


class Second:
    """A sentencepiece tokenizer, which puts the space itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = []
        for i in range(self.library.get_piece_size()):
            piece = self.library.id_to_piece(i)
            self.bytes.append(bytes([int(piece[3:5], 16)]) if self.library.is_byte(i) else piece.replace("▁", " ").encode())
        self.parts_at_spaces = not any(b" " in x.lstrip(b" ") for x in self.bytes)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.library.encode(texts, num_threads=1)


class Pair:
    """Both tokenizers of a worker, with the bytes and their numbers by id."""

    def __init__(self, first: str, second: str):
        self.a, self.b = First(first), Second(second)
        self.parts_at_spaces = self.a.parts_at_spaces and self.b.parts_at_spaces
        self.sizes_a, self.sizes_b = (np.array([len(x) for x in t.bytes], np.int64) for t in (self.a, self.b))
        self.marked = {
            side: [b"%d%c" % (i, m) for i in range(len(sizes)) for m in marks]
            for side, sizes, marks in (("a", self.sizes_a, b",|"), ("b", self.sizes_b, b",;"))
        }

    def encode(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """Ids of both as four-byte numbers; empty where the tokens don't give the text back."""
        out = []
        for text, a, b in zip(texts, self.a.encode(texts), self.b.encode(texts), strict=True):
            data = b" " + text.encode()
            same = text and all(
                b"".join([t.bytes[i] for i in ids]) == data for t, ids in ((self.a, a), (self.b, b))
            )
            out.append((np.array(a, "<u4").tobytes(), np.array(b, "<u4").tobytes()) if same else (b"", b""))
        return out


_PAIRS: dict[tuple[str, str], Pair] = {}


def pair_of(paths: tuple[str, str]) -> Pair:
    """The worker's tokenizers; read once."""
    if paths not in _PAIRS:
        _PAIRS[paths] = Pair(*paths)
    return _PAIRS[paths]


# -- sparse matrices by compressed rows ---------------------------------------------------------


@dataclass
class Rows:
    """``begin``: where each row begins in ``columns``, and the end; entries are ones or ``values``."""

    begin: np.ndarray
    columns: np.ndarray
    width: int
    values: np.ndarray | None = None

    def transposed(self) -> Rows:
        order = np.argsort(self.columns, kind="stable")
        row = np.repeat(np.arange(len(self.begin) - 1), np.diff(self.begin))
        begin = np.concatenate([[0], np.cumsum(np.bincount(self.columns, minlength=self.width))])
        return Rows(begin, row[order], len(self.begin) - 1)

    def row_numbers(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.begin) - 1), np.diff(self.begin))


def incidence(ends: np.ndarray) -> Rows:
    """Tokens by bytes: each row has the columns from the end before to its own."""
    total = int(ends[-1]) if len(ends) else 0
    return Rows(np.concatenate([[0], ends]), np.arange(total), total)


def product(a: Rows, b: Rows) -> Rows:
    """The product of two matrices of ones, row by row: each entry of a row of ``a`` brings the row of
    ``b`` that its column names; equal columns of one row add up."""
    counts = np.diff(b.begin)[a.columns]
    total = int(counts.sum())
    row = np.repeat(a.row_numbers(), counts)
    skipped = np.repeat(np.cumsum(counts) - counts, counts)
    column = b.columns[np.repeat(b.begin[:-1][a.columns], counts) + np.arange(total) - skipped]
    key = row * max(1, b.width) + column
    if total and (np.diff(key) < 0).any():
        key.sort()
    head = np.flatnonzero(np.r_[True, key[1:] != key[:-1]][:total])
    key = key[head]
    row = key // max(1, b.width)
    begin = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(a.begin) - 1))]).astype(np.int64)
    return Rows(begin, key - row * max(1, b.width), b.width, np.diff(np.r_[head, total]))


class Texts:
    """The tokens of many texts end to end, their overlaps and their groups."""

    def __init__(self, a: list[bytes], b: list[bytes], pair: Pair):
        self.a, self.b = (np.frombuffer(b"".join(x), "<u4").astype(np.int64) for x in (a, b))
        self.ends_a, self.ends_b = np.cumsum(pair.sizes_a[self.a]), np.cumsum(pair.sizes_b[self.b])
        self.pair = pair

    def overlaps(self) -> Rows:
        """Tokens by tokens that share a byte; the values are the numbers of shared bytes."""
        return product(incidence(self.ends_a), incidence(self.ends_b).transposed())

    def group_ends(self) -> np.ndarray:
        """Bytes at which tokens of both sides end."""
        return np.intersect1d(self.ends_a, self.ends_b, assume_unique=True)

    def groups(self) -> tuple[Rows, Rows]:
        """Both sides' tokens by groups."""
        ends = self.group_ends()
        sides = (np.searchsorted(ends, x) for x in (self.ends_a, self.ends_b))
        return tuple(Rows(np.arange(len(s) + 1), s, len(ends)) for s in sides)

    def shared_groups(self) -> Rows:
        """Tokens by tokens of the same group."""
        a, b = self.groups()
        return product(a, b.transposed())

    def link_keys(self, links: Rows) -> np.ndarray:
        """Both ids of each link as one number."""
        return self.a[links.row_numbers()] << 32 | self.b[links.columns]

    def group_texts(self, count_a: np.ndarray, count_b: np.ndarray) -> list[bytes]:
        """The groups as ``a1,a2|b1;a3|b2``, for stretches of so many tokens of both."""
        a, b = self.groups()
        size = len(self.a) + len(self.b)
        place = np.argsort(np.concatenate([2 * a.columns, 2 * b.columns + 1]), kind="stable")
        last_a, last_b = (np.r_[x[1:] != x[:-1], True][: len(x)] for x in (a.columns, b.columns))
        code = np.concatenate([2 * self.a + last_a, 2 * self.b + last_b])[place]
        of_a = place < len(self.a)
        pieces = np.empty(size, object)
        for side, mask in (("a", of_a), ("b", ~of_a)):
            table = self.pair.marked[side]
            pieces[mask] = [table[i] for i in code[mask].tolist()]
        ends = np.cumsum(count_a + count_b).tolist()
        found = pieces.tolist()
        return [b"".join(found[s:e])[:-1] for s, e in zip([0, *ends], ends, strict=False)]


# -- words --------------------------------------------------------------------------------------


class Words(dict):
    """The different words of a worker, by number, with their tokens' links and groups."""

    def __init__(self, pair: Pair, with_groups: bool = True):
        super().__init__()
        self.pair, self.with_groups = pair, with_groups
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.groups: list[bytes] = []
        self.parts: dict[str, list[np.ndarray]] = {x: [] for x in ("same", "n_a", "n_b", "n_groups", "n_links", "keys")}

    def column(self, name: str) -> np.ndarray:
        """One value for each word; ``keys``: one for each link."""
        if len(self.parts[name]) > 1:
            self.parts[name] = [np.concatenate(self.parts[name])]
        return self.parts[name][0] if self.parts[name] else np.empty(0, np.int64)

    def split(self, text: str) -> list[str]:
        """The words of a text, each without the space before it."""
        if not text:
            return []
        if not self.pair.parts_at_spaces:
            return [text]
        if " " not in (text[0], text[-1]) and not RUN_ON.search(text):
            return text.split(" ")
        return [w[1:] for w in CUT.split(" " + text)]

    def learn(self, words: list[str]) -> None:
        """Encodes new words: many in one string if a word can be followed by another."""
        joined = [w for w in words if w and not w[-1].isspace()] if self.pair.parts_at_spaces else []
        kept = set(joined)
        strings = [joined[i : i + JOINED] for i in range(0, len(joined), JOINED)] + [[w] for w in words if w not in kept]
        for i in range(0, len(strings), 64):
            some = strings[i : i + 64]
            found = self.pair.encode([" ".join(x) for x in some])
            again = [[w] for x, (a, _) in zip(some, found, strict=True) if not a and len(x) > 1 for w in x]
            some, found = zip(*[(x, f) for x, f in zip(some, found, strict=True) if f[0] or len(x) == 1], strict=True) if any(
                f[0] or len(x) == 1 for x, f in zip(some, found, strict=True)
            ) else ((), ())
            if again:
                some, found = (*some, *again), (*found, *self.pair.encode([w for w, in again]))
            self.measure([w for x in some for w in x], [len(x) for x in some], list(found))

    def measure(self, words: list[str], counts: list[int], tokens: list[tuple[bytes, bytes]]) -> None:
        """Adds words whose strings, of ``counts`` words each, have these tokens."""
        texts = Texts([a for a, _ in tokens], [b for _, b in tokens], self.pair)
        same = np.repeat([bool(a) for a, _ in tokens], counts)
        sizes = np.array([len(w.encode()) + 1 for w in words]) * same
        ends = np.cumsum(sizes)
        at_a, at_b = (np.searchsorted(x, ends, "right") for x in (texts.ends_a, texts.ends_b))
        links = texts.overlaps()
        at_links = links.begin[at_a]
        n_a, n_b, n_links = (np.diff(x, prepend=0) for x in (at_a, at_b, at_links))
        n_groups = np.diff(np.searchsorted(texts.group_ends(), ends, "right"), prepend=0)
        self.update(zip(words, range(len(self), len(self) + len(words)), strict=True))
        if self.with_groups:
            self.groups += texts.group_texts(n_a, n_b)
        found = {"same": same, "n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_links, "keys": texts.link_keys(links)}
        for name, values in found.items():
            self.parts[name].append(values)

    def numbers(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The words of all texts by number, and how many each text has."""
        split = [self.split(t) for t in texts]
        words = [w for x in split for w in x]
        new = [w for w in dict.fromkeys(words) if w not in self]
        if new:
            self.learn(new)
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words)), np.array([len(x) for x in split], np.int64)

    def of_links(self, values: np.ndarray) -> np.ndarray:
        """Sums over the links of each word."""
        total = np.concatenate([[0], np.cumsum(values)])
        ends = np.cumsum(self.column("n_links"))
        return total[ends] - total[ends - self.column("n_links")]


_WORDS: dict[tuple[str, str], Words] = {}


def words_of(paths: tuple[str, str]) -> Words:
    """The worker's words."""
    if paths not in _WORDS:
        _WORDS[paths] = Words(pair_of(paths))
    return _WORDS[paths]


def gathered(texts: list[str]) -> Iterator[list[str]]:
    """Texts in parts of about GATHER characters."""
    part, size = [], 0
    for text in texts:
        if part and size + len(text) > GATHER:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text)
    if part:
        yield part


def sums(counts: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of values over texts that hold so many of them each."""
    total = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


# -- counts of the corpus -----------------------------------------------------------------------


def bucket_of(keys: np.ndarray) -> np.ndarray:
    """The bucket of a pair is that of its second id."""
    return ((keys & 0xFFFFFFFF) * 2654435761 >> 7) % BUCKETS


def added(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    head = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][: len(keys)])
    return keys[head], np.add.reduceat(counts, head) if len(head) else counts


def by_bucket(keys: np.ndarray, counts: np.ndarray) -> pd.DataFrame:
    buckets = bucket_of(keys)
    rows = [(b, keys[buckets == b].tobytes(), counts[buckets == b].tobytes()) for b in np.unique(buckets).tolist()]
    return pd.DataFrame(rows, columns=["bucket", "keys", "counts"])


def pair_counts(docs: DataFrame, paths: tuple[str, str]) -> DataFrame:
    """(key, n, best) of each pair of ids that is linked somewhere; best: its n is the highest of
    its second id."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = Words(pair_of(paths), with_groups=False)
        times = np.empty(0, np.int64)

        def flush() -> pd.DataFrame:
            weights = np.zeros(len(words), np.int64)
            weights[: len(times)] = times
            return by_bucket(*added(words.column("keys"), np.repeat(weights, words.column("n_links"))))

        for batch in batches:
            for part in gathered(batch["text"].tolist()):
                numbers, counts = words.numbers(part)
                whole = sums(counts, ~words.column("same")[numbers]) == 0
                seen = np.bincount(numbers[np.repeat(whole, counts)], minlength=len(words))
                seen[: len(times)] += times
                times = seen
                if len(words) > REMEMBERED:
                    yield flush()
                    words.forget()
                    times = times[:0]
        yield flush()

    def total(group: pd.DataFrame) -> pd.DataFrame:
        keys, counts = (np.frombuffer(b"".join(group[c]), np.int64) for c in ("keys", "counts"))
        keys, counts = added(keys, counts)
        keys, counts = keys[counts > 0], counts[counts > 0]
        second, place = np.unique(keys & 0xFFFFFFFF, return_inverse=True)
        most = np.zeros(len(second), np.int64)
        np.maximum.at(most, place, counts)
        return pd.DataFrame({"key": keys, "n": counts, "best": counts == most[place]})

    sent = docs.select(F.coalesce("text", F.lit("")).alias("text")).mapInPandas(count, "bucket int, keys binary, counts binary")
    return sent.groupBy("bucket").applyInPandas(total, "key long, n long, best boolean")


Table = tuple[np.ndarray, np.ndarray, np.ndarray]


def measured(texts: list[str], words: Words, table: Table | None) -> pd.DataFrame:
    """The numbers of each text; ``table`` has all pairs by rising key, their counts and best."""
    numbers, counts = words.numbers(texts)
    whole = sums(counts, ~words.column("same")[numbers]) == 0
    values = {c: words.column(c) for c in ("n_a", "n_b", "n_groups", "n_links")}
    if table is not None:
        at = np.searchsorted(table[0], words.column("keys"))
        # pairs of words that no whole text has are in no table; nothing asks for their counts
        at = np.minimum(at, max(0, len(table[0]) - 1))
        known = table[0][at] == words.column("keys") if len(table[0]) else np.zeros(len(at), bool)
        values["n_best"] = words.of_links((table[2][at] & known).astype(np.int64) if len(table[0]) else known.astype(np.int64))
        values["count_sum"] = words.of_links(table[1][at] * known if len(table[0]) else known.astype(np.int64))
    found = {c: sums(counts, v[numbers]) * whole for c, v in values.items()}
    texts_of = list(map(words.groups.__getitem__, numbers.tolist()))
    ends = np.cumsum(counts).tolist()
    groups = [
        b";".join(texts_of[s:e]).decode() if ok else "" for s, e, ok in zip([0, *ends], ends, whole.tolist(), strict=False)
    ]
    return pd.DataFrame(found | {"groups": groups})


NAMES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]


def numbers_of(paths: tuple[str, str], sent=None):
    """The numbers of each text as a function on its column, from a broadcast table if there is one."""
    names = [c for c in NAMES if sent is not None or c not in ("n_best", "count_sum")]

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        words, table = words_of(paths), None if sent is None else sent.value
        for batch in batches:
            for part in gathered(batch.tolist()):  # groups are long: no batch is held whole
                if len(words) > REMEMBERED:
                    words.forget()
                yield measured(part, words, table)[names]

    schema = ", ".join(f"{c} {'string' if c == 'groups' else 'long'}" for c in names)
    return F.pandas_udf(run, schema)


def broadcast_table(counts: DataFrame):
    found = counts.toPandas().sort_values("key")
    arrays = found["key"].to_numpy(np.int64), found["n"].to_numpy(np.int64), found["best"].to_numpy(bool)
    return counts.sparkSession.sparkContext.broadcast(arrays)


def joined_counts(texts: DataFrame, counts: DataFrame, paths: tuple[str, str]) -> DataFrame:
    """(id, n_best, count_sum) by a join of the distinct pairs of each text with the table."""

    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = words_of(paths)
        for batch in batches:
            for i, text in zip(batch["id"], batch["text"], strict=True):
                if len(words) > REMEMBERED:
                    words.forget()
                numbers, _ = words.numbers([text])
                if words.column("same")[numbers].all():
                    n = words.column("n_links")
                    begin = np.cumsum(n) - n
                    own = [words.column("keys")[begin[w] : begin[w] + n[w]] for w in numbers.tolist()]
                    keys, times = np.unique(np.concatenate([np.empty(0, np.int64), *own]), return_counts=True)
                    yield pd.DataFrame({"id": i, "key": keys, "times": times})

    each = texts.select("id", F.coalesce("text", F.lit("")).alias("text")).mapInPandas(pairs, "id long, key long, times long")
    return each.join(counts, "key").groupBy("id").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("n") * F.col("times")).alias("count_sum"),
    )


def align(docs: DataFrame, first: str, second: str) -> DataFrame:
    """``docs`` with n_a, n_b, n_groups, n_links, n_best, count_sum and groups.

    ``first`` is a file of the tokenizers library, byte-level; ``second`` one of sentencepiece. Every
    machine has both files. Only a table of pairs above ``SMALL`` needs the documents written with
    a number for each row.
    """
    paths = first, second
    counts = cut_lineage(pair_counts(docs, paths), "pairs")
    given = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("given")
    text = F.coalesce("text", F.lit(""))
    if counts.count() <= SMALL:
        found = docs.select(given, numbers_of(paths, broadcast_table(counts))(text).alias("found"))
        values = {c: F.col("found")[c] for c in NAMES}
    else:
        rows = cut_lineage(docs.select(F.monotonically_increasing_id().alias("id"), given, text.alias("text")), "rows")
        added_up = joined_counts(rows, counts, paths).withColumnRenamed("id", "of")
        found = rows.select("id", "given", numbers_of(paths)("text").alias("found"))
        found = found.join(added_up, F.col("id") == F.col("of"), "left")
        zero = F.lit(0).cast("long")
        values = {c: F.coalesce(c, zero) if c in added_up.columns else F.col("found")[c] for c in NAMES}
    own = [F.col("given")[c].alias(c) for c in docs.columns if c.lower() not in NAMES]
    return found.select(*own, *(v.alias(c) for c, v in values.items()))


def links(docs: DataFrame, first: str, second: str, groups: bool = False) -> DataFrame:
    """``docs`` with links, pairs of token numbers of each text: those that share bytes, or with
    ``groups`` those that share a group; value: the bytes, or 1."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        pair = pair_of((first, second))
        for batch in batches:
            out = []
            for tokens in pair.encode(batch.tolist()):
                texts = Texts(*([x] for x in tokens), pair)
                found = texts.shared_groups() if groups else texts.overlaps()
                rows = zip(found.row_numbers().tolist(), found.columns.tolist(), found.values.tolist(), strict=True)
                out.append([{"a": i, "b": j, "value": v} for i, j, v in rows])
            yield pd.Series(out, dtype=object)

    found = F.pandas_udf(run, "array<struct<a:long,b:long,value:long>>")(F.coalesce("text", F.lit("")))
    given = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("given")
    own = [F.col("given")[c].alias(c) for c in docs.columns if c.lower() != "links"]
    return docs.select(given, found.alias("found")).select(*own, F.col("found").alias("links"))
