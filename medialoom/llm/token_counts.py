"""Token counts of a byte-pair vocabulary with word ends, without building identifiers.

Each word starts as one symbol per byte, the last with the word's end. A heap holds the
neighbouring pairs that have a rank, a linked list the symbols: the pair of lowest rank, then
the leftmost, is popped and merged until none is left. The count is the number of symbols at
the start less the number of merges. A word's count is kept for later texts of the same worker.

Defined results: a null text counts as empty (0 tokens, 0 bytes). Special strings of the
vocabulary count as one token where they stand in a text. Rows are counted one by one, so
repeated rows and ties change nothing; the longest text costs n log n in its longest word.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medialoom.llm.common import replace_columns

#: Words that a worker remembers at most, and the longest of them.
REMEMBERED, LONGEST = 1_000_000, 48
LIMIT = 2048
#: Fixed values of the vocabulary: white space, contractions, the end of a word.
SPACE = r"\t-\r \x85\xa0  -     　"
SHORT = "'s|'t|'re|'ve|'m|'ll|'d"
WORD_END = "</w>"
PIECES = regex.compile(rf"{SHORT}|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+")
ASCII_PIECES = re.compile(rf"{SHORT}|[a-z]+|[0-9]|[^\t-\r a-z0-9]+")


def byte_signs() -> list[str]:
    """The visible sign of each byte: itself where it prints, else one from 256 on."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    signs, spare = [], 256
    for b in range(256):
        signs.append(chr(b) if b in prints else chr(spare))
        spare += b not in prints
    return signs


def merges_made(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """How many merges the pairs of lowest rank allow."""
    n = len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i) for i in range(n - 1) if (r := ranks.get((symbols[i], symbols[i + 1]))) is not None]
    heapq.heapify(heap)
    made = 0
    while heap:
        rank, i = heapq.heappop(heap)
        j = after[i]
        if j >= n or symbols[i] is None or ranks.get((symbols[i], symbols[j])) != rank:
            continue  # one of the two has gone into another pair
        symbols[i] += symbols[j]
        symbols[j] = None
        made += 1
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            if (r := ranks.get((symbols[i], symbols[k]))) is not None:
                heapq.heappush(heap, (r, i))
        if (h := before[i]) >= 0 and (r := ranks.get((symbols[h], symbols[i]))) is not None:
            heapq.heappush(heap, (r, h))
    return made


class Counter(dict):
    """Tokens by word; a word that is missing is merged and, if short, remembered."""

    def __init__(self, merges: list[tuple[str, str]], special: list[str]):
        super().__init__()
        self.ranks = {tuple(pair): rank for rank, pair in enumerate(merges)}
        self.signs = byte_signs()
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True))) or r"(?!)")

    def __missing__(self, word: str) -> int:
        symbols = [self.signs[b] for b in word.encode()]
        symbols[-1] += WORD_END
        count = len(symbols)
        count -= merges_made(symbols, self.ranks)
        if len(word) <= LONGEST:
            self[word] = count
        return count

    def text(self, text: str) -> int:
        """Tokens of a whole text."""
        parts = self.special.split(text)
        total = len(parts) - 1
        for part in parts:
            if part.isascii():
                words = ASCII_PIECES.findall(part.lower())
            else:
                # lower case sign by sign: a sigma at the end of a word is not another letter
                lowered = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
                words = PIECES.findall(lowered)
            total += sum(map(self.__getitem__, words))
        if len(self) > REMEMBERED:
            self.clear()
        return total


_COUNTERS: dict[str, Counter] = {}


def counts_of(docs: DataFrame, vocabulary: str, text: Column) -> Column:
    """Tokens of each text. The vocabulary file is read by the driver and broadcast."""
    with open(vocabulary, encoding="utf-8") as file:
        held = json.load(file)
    special = [x["content"] for x in held["added_tokens"]]
    sent = docs.sparkSession.sparkContext.broadcast((held["model"]["merges"], special))

    @F.pandas_udf("long")
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        if vocabulary not in _COUNTERS:
            _COUNTERS[vocabulary] = Counter(*sent.value)
        counter = _COUNTERS[vocabulary]
        for batch in batches:
            yield pd.Series([counter.text(t) if t else 0 for t in batch], dtype="int64")

    return tokens(F.coalesce(text, F.lit("")))


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = LIMIT) -> DataFrame:
    """``docs`` with n_bytes, n_tokens and over_limit."""
    counted = replace_columns(
        docs,
        {
            "n_bytes": F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"),
            "n_tokens": counts_of(docs, vocabulary, F.col("text")),
        },
    )
    return replace_columns(counted, {"over_limit": F.col("n_tokens") > limit})
