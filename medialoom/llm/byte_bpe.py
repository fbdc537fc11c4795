"""Byte-level BPE as a tree reduction: halves are encoded on their own, then joined.

A piece of text is cut in halves down to short leaves. To join two neighbours, the tokens
around their border are encoded anew, in a window that doubles until both tokens next to the
window are stable. A sequence of tokens is the encoding of its bytes if and only if every
neighbouring pair is the encoding of its own bytes; both halves hold that already, the window
does as an encoding, so testing the pair at each end of the window proves the whole.
Decoding concatenates the bytes of the tokens up the same tree.

Defined results: a null text counts as empty: no tokens, the digests of no bytes. Every row
is encoded by itself. A piece of any length takes n log n steps.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medialoom.llm.common import replace_columns

LEAF = 12
#: Pieces and pairs that a worker remembers at most, and the longest such piece in bytes.
REMEMBERED, LONGEST = 500_000, 48


class Codec(dict):
    """Encodes and decodes by ranks; as a dict: (ids as text, count, bytes) by piece."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        super().__init__()
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.bytes = {rank: token for token, rank in ranks.items()}
        self.pairs: dict[tuple[int, int], bool] = {}

    def direct(self, data: bytes) -> list[int]:
        """Encoding of a few bytes: the neighbours of lowest rank merge first, leftmost of equals."""
        ranks = self.ranks
        parts = [data[i : i + 1] for i in range(len(data))]
        if len(parts) > 2 * LEAF:
            return self.by_heap(parts)
        none = len(self.bytes) + 256
        found = [ranks.get(a + b, none) for a, b in zip(parts, parts[1:], strict=False)]
        while found and (best := min(found)) != none:
            at = found.index(best)
            parts[at : at + 2] = [merged := parts[at] + parts[at + 1]]
            del found[at]  # only the neighbours of what merged have new pairs
            if at < len(found):
                found[at] = ranks.get(merged + parts[at + 1], none)
            if at:
                found[at - 1] = ranks.get(parts[at - 1] + merged, none)
        return [ranks[p] for p in parts]

    def by_heap(self, parts: list[bytes]) -> list[int]:
        """The same for many parts: a heap of pairs over a linked list, n log n."""
        ranks, n = self.ranks, len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := ranks.get(parts[i] + parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if j >= n or not parts[i] or ranks.get(parts[i] + parts[j]) != rank:
                continue
            parts[i], parts[j] = parts[i] + parts[j], b""
            after[i] = k = after[j]
            for x, y in ((before[i], i), (i, k)):
                if x >= 0 and y < n:
                    before[y] = x
                    if (r := ranks.get(parts[x] + parts[y])) is not None:
                        heapq.heappush(heap, (r, x))
        return [ranks[p] for p in parts if p]

    def stable(self, left: int, right: int) -> bool:
        """Whether the two tokens side by side are the encoding of their bytes."""
        key = (left, right)
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) > REMEMBERED:
                self.pairs.clear()
            known = self.direct(self.bytes[left] + self.bytes[right]) == [left, right]
            self.pairs[key] = known
        return known

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """Encoding of the bytes of two encodings one after the other."""
        if not left or not right or self.stable(left[-1], right[0]):
            return left + right
        width = 2
        while True:
            head, tail = left[:-width], right[width:]
            window = self.direct(self.decode(left[-width:] + right[:width]))
            if (not head or self.stable(head[-1], window[0])) and (
                not tail or self.stable(window[-1], tail[0])
            ):
                return head + window + tail
            width *= 2

    def halves(self, data: bytes) -> list[int]:
        """Encoding of both halves, joined; the depth is the logarithm of the length."""
        if len(data) <= LEAF:
            return self.direct(data)
        middle = len(data) // 2
        return self.join(self.halves(data[:middle]), self.halves(data[middle:]))

    def encode_piece(self, data: bytes) -> list[int]:
        whole = self.ranks.get(data)
        return [whole] if whole is not None else self.halves(data)

    def decode(self, ids: list[int]) -> bytes:
        """Bytes of both halves, concatenated up the tree."""
        if len(ids) <= LEAF:
            return b"".join([self.bytes[i] for i in ids])
        middle = len(ids) // 2
        return self.decode(ids[:middle]) + self.decode(ids[middle:])

    def __missing__(self, piece: str) -> tuple[str, int, bytes]:
        data = piece.encode()
        ids = self.encode_piece(data)
        entry = (" ".join(map(str, ids)), len(ids), self.decode(ids))
        if len(data) <= LONGEST:
            self[piece] = entry
        return entry

    def encode(self, text: str) -> list[int]:
        return [i for p in self.pattern.findall(text) for i in self.encode_piece(p.encode())]

    def digest(self, text: str) -> tuple[int, str, str]:
        """Number of tokens, digest of the ids and digest of the decoded bytes."""
        entries = list(map(self.__getitem__, self.pattern.findall(text)))
        if len(self) > REMEMBERED:
            self.clear()
        ids = " ".join([e[0] for e in entries]).encode()
        decoded = b"".join([e[2] for e in entries])
        n = sum([e[1] for e in entries])
        return n, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest()


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in file if line.strip())}


_CODECS: dict[tuple[str, str], Codec] = {}


def codec_of(path: str, pattern: str, sent) -> Codec:
    """The worker's codec; built once from the ranks that the driver has broadcast."""
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = Codec(sent.value, pattern)
    return _CODECS[path, pattern]


def encode(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """``docs`` with ``ids``, the token ids of each text."""
    sent = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks))

    @F.pandas_udf("array<int>")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = codec_of(ranks, pattern, sent)
        for batch in batches:
            yield pd.Series([codec.encode(t) for t in batch])

    return replace_columns(docs, {"ids": ids(F.coalesce("text", F.lit("")))})


def decode(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """``docs`` with ``decoded``, the bytes of the column ``ids``; null ids give no bytes."""
    sent = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks))

    @F.pandas_udf("binary")
    def data(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = codec_of(ranks, pattern, sent)
        for batch in batches:
            yield pd.Series([codec.decode(list(x)) if x is not None else b"" for x in batch])

    return replace_columns(docs, {"decoded": data("ids")})


def digests(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """``docs`` with n_tokens, ids_sha256 and decoded_sha256, in one pass over the text."""
    sent = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks))

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        codec = codec_of(ranks, pattern, sent)
        for batch in batches:
            yield pd.DataFrame(
                [codec.digest(t) for t in batch],
                columns=["n_tokens", "ids_sha256", "decoded_sha256"],
                dtype=object,
            )

    found = replace_columns(docs, {"_digest": digest(F.coalesce("text", F.lit("")))})
    names = ("n_tokens", "ids_sha256", "decoded_sha256")
    return replace_columns(found, {n: F.col("_digest")[n] for n in names}).drop("_digest")
