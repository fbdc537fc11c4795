"""URL filters by a bit-parallel wildcard automaton.

Rules are globs over the canonical url, that is host and path: ``*`` is any run of
characters without a slash, ``**`` any run, ``?`` one character but a slash, a backslash makes
the next character plain. Each glob has a bit for every number of its items that have been
read; the bits of all globs lie side by side in 64-bit words. For each byte there is one mask
of bits that may move on and one of bits that may stay, so a step of all globs over all urls of a
batch is a shift with carry, two ands and an or. A glob fits if its last bit is set at the end.

Defined results: the host of a null url and of one without ``://`` is empty, and so is the path;
no rule fits it and it is allowed. Of the rules that fit the longest wins, of equals the
first. If no rule fits, the default globs decide: block if one fits, else allow. Urls are judged
row by row, so repeated rows change nothing; very long ones go through in small batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medialoom.llm.common import replace_columns

#: Rules in the order of the contract: verdict, host, path.
RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]
#: Globs that block a url that no rule fits: advertising hosts, sessions, shops, binaries.
DEFAULT_BLOCKED = [
    "ads.*/**", "*.ads.*/**", "*doubleclick.*/**", "**/wp-admin/**", "**/wp-login.php",
    "**/login", "**/signin/**", "**/cart/**", "**/checkout/**", "**.exe", "**.zip", "**.mp?",
]
#: Bytes of urls that are simulated at once.
CELLS = 4_000_000
END = 256


def escape(text: str) -> str:
    return "".join("\\" + c if c in "*?\\" else c for c in text)


@dataclass(frozen=True)
class Rule:
    """``length``: of the rule as written; the longest that fits wins."""

    name: str
    verdict: str
    globs: tuple[str, ...]
    length: int


def host_rule(verdict: str, host: str, path: str) -> Rule:
    """Fits the host and its subdomains if the path starts with the rule's."""
    body = escape(host) + escape(path) + "**"
    return Rule(host + path, verdict, (body, "*." + body), len(host + path))


class Automaton:
    """All globs at once."""

    def __init__(self, globs: list[str]):
        items = [self.items(g) for g in globs]
        firsts = np.cumsum([0] + [len(i) + 1 for i, _ in items])
        words = -(-int(firsts[-1]) // 64)
        go = np.zeros((257, words * 64), bool)
        stay = np.zeros((257, words * 64), bool)
        start = np.zeros(words * 64, bool)
        stay[END] = True
        for (wanted, loops), first in zip(items, firsts[:-1].tolist(), strict=True):
            start[first] = True
            for k, accepted in enumerate(wanted):
                go[accepted, first + k] = True
            for k, accepted in loops:
                stay[accepted, first + k] = True
        self.go, self.stay, self.start = self.pack(go), self.pack(stay), self.pack(start[None])[0]
        self.last = (firsts[1:] - 1).astype(int)

    @staticmethod
    def items(glob: str) -> tuple[list[list[int]], list[tuple[int, list[int]]]]:
        """Bytes that each item takes, and (item, bytes) of the loops before it."""
        plain = [b for b in range(256) if b != ord("/")]
        first = [b for b in plain if not 0x80 <= b < 0xC0]
        wanted: list[list[int]] = []
        loops: list[tuple[int, list[int]]] = []
        i = 0
        while i < len(glob):
            c = glob[i]
            if c == "*":
                run = glob[i:].startswith("**")
                loops.append((len(wanted), list(range(256)) if run else plain))
                i += 1 + run
                continue
            if c == "?":
                wanted.append(first)  # a character's first byte; its others stay
                loops.append((len(wanted), list(range(0x80, 0xC0))))
            else:
                i += c == "\\" and i + 1 < len(glob)
                wanted += [[b] for b in glob[i].encode()]
            i += 1
        return wanted, loops

    @staticmethod
    def pack(bits: np.ndarray) -> np.ndarray:
        return np.packbits(bits, axis=1, bitorder="little").view("<u8")

    def fits(self, texts: list[bytes]) -> np.ndarray:
        """Texts x globs: whether each glob fits the whole text."""
        out = np.zeros((len(texts), len(self.last)), bool)
        order = sorted(range(len(texts)), key=lambda i: len(texts[i]))
        done = 0
        while done < len(order):
            width = max(1, len(texts[order[done]]))
            many = max(1, CELLS // (4 * width))
            chosen = order[done : done + many]
            while len(chosen) > 1 and len(texts[chosen[-1]]) * len(chosen) > CELLS:
                chosen = chosen[: len(chosen) // 2]
            out[chosen] = self.simulate([texts[i] for i in chosen])
            done += len(chosen)
        return out

    def simulate(self, texts: list[bytes]) -> np.ndarray:
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        codes = np.full((max(1, int(sizes.max())), len(texts)), END, np.int16)
        flat = np.frombuffer(b"".join(texts), np.uint8)
        row = np.repeat(np.arange(len(texts)), sizes)
        codes[np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes), row] = flat
        state = np.tile(self.start, (len(texts), 1))
        for column in codes:
            moved = state & self.go[column]
            carry = moved >> np.uint64(63)
            moved <<= np.uint64(1)
            moved[:, 1:] |= carry[:, :-1]
            state &= self.stay[column]
            state |= moved
        return (state[:, self.last // 64] >> (self.last % 64).astype(np.uint64) & np.uint64(1)) > 0


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next slash, question mark or hash; A-Z lower-cased."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """From the end of the host up to a question mark or hash."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def judge(
    pages: DataFrame, rules: list[Rule] | None = None, blocked: list[str] = DEFAULT_BLOCKED
) -> DataFrame:
    """``pages`` (url, ...) with host, path, rule and verdict."""
    rules = [host_rule(*r) for r in RULES] if rules is None else rules
    ranked = sorted(rules, key=lambda r: -r.length)  # stable: the first of equals
    globs = [(g, i) for i, r in enumerate(ranked) for g in r.globs]
    globs += [(g, len(ranked)) for g in blocked]
    owner = np.array([i for _, i in globs], dtype=int)
    names = [r.name for r in ranked] + [None, None]
    verdicts = [r.verdict for r in ranked] + ["block", "allow"]

    @F.pandas_udf("rule string, verdict string")
    def decide(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton = Automaton([g for g, _ in globs])
        for batch in batches:
            fits = automaton.fits([u.encode() for u in batch])
            best = np.where(fits, owner, len(ranked) + 1).min(axis=1, initial=len(ranked) + 1)
            rows = [(names[i], verdicts[i]) for i in best]
            yield pd.DataFrame(rows, columns=["rule", "verdict"], dtype=object)

    split = replace_columns(pages, {"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    judged = replace_columns(split, {"_judged": decide(F.concat("host", "path"))})
    found = {c: F.col("_judged")[c] for c in ("rule", "verdict")}
    return replace_columns(judged, found).drop("_judged")
