"""Periodic runs of words, found by minimizers at several scales.

A run is a stretch that repeats with a period of q words, has at least ``max(LEAST, 2 q)`` of them
and cannot be made longer; q is its smallest period. Texts are laid end to end in one array of word
numbers, longest first, with a number of its own after each, so no run leaves its text.

* **Short periods** (below twice the smallest gram): one scan for each lag.
* **Longer ones**, a scale for each doubling: every window of as many grams as a gram has words is
  represented by the gram of smallest hash. A run whose period exceeds the span of a window holds
  a window together with its copy one period later, so both have the same minimum at that
  distance. Pairs of equal minima at the distances of the scale are seeds; each is extended both
  ways. Grams that themselves repeat within half their length lie in runs that smaller scales have
  found and are no minima; so equal ones lie apart and there are few pairs to each.
* **Squares inside short periods**: if all grams of the first copy are such, it and its copy lie in
  two runs of one short period that touch; their lags are those that align them.

Defined results: a null text and one without words have no run and collapse to an empty text. Of
runs with equal length the first, then the one of smaller period, is the longest. Each row is
treated by itself, whatever other rows hold; an empty table gives no rows. A text of any length is
scanned whole. Columns of the input that are named like results give way, all others stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medialoom.llm.common import WORD, replace_columns

#: Words of the shortest run, and of the smallest gram, which must not be longer than that run.
LEAST, GRAM = 12, 12
#: Words that are scanned at once; a longer text is scanned by itself.
GATHER = 1 << 18
NONE = np.uint64(2**64 - 1)
BASE = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hashes:
    """Hashes of all stretches of a sequence, by prefix sums."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        self.up = np.multiply.accumulate(np.r_[np.uint64(1), np.full(n, BASE)])
        self.down = np.multiply.accumulate(np.r_[np.uint64(1), np.full(n, pow(int(BASE), -1, 1 << 64), np.uint64)])
        self.total = np.zeros(n + 1, np.uint64)
        np.cumsum(mixed(words.astype(np.uint64) + BASE) * self.up[:-1], out=self.total[1:])

    def grams(self, width: int, start: int, stop: int) -> np.ndarray:
        """Hashes of the stretches of ``width`` that lie in start..stop."""
        low, high = self.total[start : stop - width + 1], self.total[start + width : stop + 1]
        return mixed((high - low) * self.down[start : start + len(low)])


def sliding(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """``pick`` over every ``width`` neighbours, by doubling."""
    reach = 1
    while 2 * reach <= width:
        values = pick(values[:-reach], values[reach:])
        reach *= 2
    rest = width - reach
    return pick(values[: len(values) - rest], values[rest:]) if rest else values


class Runs:
    """The runs of a sequence found so far: their ends by start and end, the smallest period stays."""

    def __init__(self, words: np.ndarray):
        self.words, self.found = words, {}
        self.reached: dict[int, list[tuple[int, int]]] = {}  # by lag: the last stretch extended

    def add(self, start: int, end: int, lag: int) -> None:
        if end - start >= max(LEAST, 2 * lag):
            self.found[start, end] = min(lag, self.found.get((start, end), lag))

    def extend(self, at: int, lag: int) -> tuple[int, int]:
        """The whole stretch around ``at`` whose words equal those ``lag`` later."""
        w, step, left, right = self.words, 16, at, at
        while True:
            step = min(step, len(w) - lag - right)
            differ = np.flatnonzero(w[right : right + step] != w[right + lag : right + lag + step])
            right += int(differ[0]) if len(differ) else step
            if len(differ) or not step:
                break
            step *= 2
        step = 16
        while True:
            step = min(step, left)
            differ = np.flatnonzero(w[left - step : left] != w[left - step + lag : left + lag])
            left -= step - 1 - int(differ[-1]) if len(differ) else step
            if len(differ) or not step:
                break
            step *= 2
        return left, right + lag

    def seed(self, at: np.ndarray, lag: np.ndarray) -> None:
        """Extends seeds, those that lie in the stretch of another with the same lag once."""
        order = np.lexsort([at, lag])
        last, end = -1, -1
        for p, q in zip(at[order].tolist(), lag[order].tolist(), strict=True):
            if q == last and p + q < end:
                continue
            start, stop = self.extend(p, q)
            if stop - start > q:
                last, end = q, stop
                self.add(start, stop, q)

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.found:
            return (np.empty(0, np.int64),) * 3
        spans = np.array(list(self.found), np.int64)
        return spans[:, 0], spans[:, 1], np.fromiter(self.found.values(), np.int64, len(spans))


def scan_lag(runs: Runs, lag: int) -> None:
    """All stretches of one lag that are long enough."""
    w = runs.words
    if len(w) <= lag:
        return
    differ = np.flatnonzero(w[:-lag] != w[lag:])
    edges = np.concatenate([[-1], differ, [len(w) - lag]])
    long = np.flatnonzero(np.diff(edges) - 1 >= max(LEAST, 2 * lag) - lag)
    for a, z in zip((edges[long] + 1).tolist(), edges[long + 1].tolist(), strict=True):
        runs.add(a, z + lag, lag)


def seeds_of_scale(runs: Runs, hashes: Hashes, gram: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, lag) of equal minima among the first ``n`` words; lags of this scale only."""
    least, most = 2 * gram - 1, 4 * gram - 1
    h = hashes.grams(gram, 0, n)
    starts, ends, periods = runs.arrays()
    periodic = (2 * periods <= gram) & (ends - starts >= gram) & (ends <= n)
    if periodic.any():
        inside = np.zeros(len(h) + 1, np.int32)
        np.add.at(inside, starts[periodic], 1)
        np.add.at(inside, ends[periodic] - gram + 1, -1)
        h = np.where(np.cumsum(inside[:-1]) > 0, NONE, h)
    low = sliding(h, gram, np.minimum)
    edge = np.zeros(gram - 1, np.uint64)
    best = sliding(np.concatenate([edge, low, edge]), gram, np.maximum)
    at = np.flatnonzero((best == h) & (h != NONE))
    at = at[np.argsort(h[at], kind="stable")]
    own = h[at]
    places, lags, reach = [], [], 1
    while reach < len(at):
        apart = at[reach:] - at[:-reach]
        same = (own[reach:] == own[:-reach]) & (apart < most)
        if not same.any():
            break
        hit = same & (apart >= least)
        places.append(at[:-reach][hit])
        lags.append(apart[hit])
        reach += 1
    empty = np.empty(0, np.int64)
    return np.concatenate([empty, *places]), np.concatenate([empty, *lags])


def squares_of_touching_runs(runs: Runs, hashes: Hashes) -> None:
    """Runs whose first copy lies in one run of a short period, and the next in another."""
    starts, ends, periods = runs.arrays()
    order = np.lexsort([starts, periods])
    starts, ends, periods = starts[order], ends[order], periods[order]
    near = (periods[1:] == periods[:-1]) & (starts[1:] <= ends[:-1])
    for i in np.flatnonzero(near).tolist():
        s, e, t, z, q0 = int(starts[i]), int(ends[i]), int(starts[i + 1]), int(ends[i + 1]), int(periods[i])
        most = min(e - s, z - t)
        # the lag that aligns both runs, one among each q0 neighbours
        window = hashes.grams(q0, t - 2 * q0 + 1, t) if t - 2 * q0 + 1 >= s else np.empty(0, np.uint64)
        hit = np.flatnonzero(window == hashes.grams(q0, t, t + q0)[0])
        if not len(hit):
            continue
        first = t - (t - 2 * q0 + 1 + int(hit[-1]))
        for lag in range(first, most + 1, q0):
            at = max(s, t - lag)
            if at + lag <= e:
                a, b = (at, min(e, z - lag) + lag) if s != t - lag and e != z - lag else runs.extend(at, lag)
                runs.add(a, b, lag)


def find_runs(words: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs; ``sizes``: words of each text with its end, falling."""
    runs, hashes = Runs(words), Hashes(words)
    for lag in range(1, 2 * GRAM - 1):
        scan_lag(runs, lag)
    squares_of_touching_runs(runs, hashes)
    gram, ends = GRAM, np.cumsum(sizes)
    while True:
        able = int(np.searchsorted(-sizes, -(2 * (2 * gram - 1)), "right"))  # texts that hold such a run
        if not able or not len(words):
            break
        before = len(runs.found)
        runs.seed(*seeds_of_scale(runs, hashes, gram, int(ends[able - 1])))
        if len(runs.found) > before:
            squares_of_touching_runs(runs, hashes)
        gram *= 2
    return runs.arrays()


def runs_of_texts(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of each text, by start and period."""
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    number: dict = {}
    words: list[int] = []
    for i in order:
        words += [number.setdefault(w, len(number)) for w in texts[i]]
        words.append(number.setdefault(i, len(number)))  # an end that equals no word
    sizes = np.array([len(texts[i]) + 1 for i in order], np.int64)
    start, end, period = find_runs(np.array(words, np.int32), sizes)
    bounds = np.cumsum(sizes) - sizes
    owner = np.searchsorted(bounds, start, "right") - 1
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for o, a, z, q in zip(owner.tolist(), start.tolist(), end.tolist(), period.tolist(), strict=True):
        out[order[o]].append((a - int(bounds[o]), z - a, q))
    return [sorted(x, key=lambda r: (r[0], r[2])) for x in out]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> str:
    """The words without those that a run repeats, joined by one space."""
    if runs:
        gone = np.zeros(len(words) + 1, np.int32)
        for start, length, period in runs:
            gone[start + period] += 1
            gone[start + length] -= 1
        words = [words[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()]
    return b" ".join(words).decode()


FOUND = "runs array<struct<start:long,length:long,period:long>>, collapsed string"


def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows, held, size = [], [], 0

        def flush() -> None:
            for words, found in zip(held, runs_of_texts(held), strict=True):
                runs = [{"start": s, "length": n, "period": q} for s, n, q in found]
                rows.append((runs, collapsed(words, found)))
            held.clear()

        for text in batch:
            words = text.encode().split()  # white space of ASCII only
            if held and size + len(words) > GATHER:
                flush()
                size = 0
            held.append(words)
            size += len(words)
        flush()
        yield pd.DataFrame(rows, columns=["runs", "collapsed"])


def periodic_runs(docs: DataFrame) -> DataFrame:
    """``docs`` with runs (start, length, period; by start) and collapsed, the text without what
    they repeat."""
    found = F.pandas_udf(scan, FOUND)(F.coalesce("text", F.lit("")))
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    both = docs.select(row, found.alias("found"))
    own = [F.col("row")[c].alias(c) for c in docs.columns if c.lower() not in ("runs", "collapsed")]
    return both.select(*own, F.col("found")["runs"].alias("runs"), F.col("found")["collapsed"].alias("collapsed"))


def longest(runs: Column) -> Column:
    """The longest run; ties go to the first, then to the smallest period. Null without a run."""
    keys = F.transform(runs, lambda r: F.struct((-r["length"]).alias("n"), r["start"].alias("s"), r["period"].alias("q")))
    best = F.array_min(keys)
    return F.when(best.isNotNull(), F.struct(best["s"].alias("start"), (-best["n"]).alias("length"), best["q"].alias("period")))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """Documents of which one in ten repeats itself from some word on, by the crc32 of its id.

    The other texts stay as they are; those of null ids too.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all(F.col("text"), F.lit(f"({WORD})"), F.lit(1))

    def repeated(w: Column) -> Column:
        n, g = F.size(w), F.floor(h / 10)
        a = F.pmod(g, n).cast("int")
        p = (1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))).cast("int")
        told = F.transform(w, lambda x, i: F.when(i < a, x).otherwise(F.get(w, (a + F.pmod(i - a, p)).cast("int"))))
        return F.array_join(told, " ")

    changed = F.get(F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, repeated(w)).otherwise("")), F.lit(0))
    return replace_columns(docs, {"text": F.when(F.coalesce(h % 10 == 0, F.lit(False)), changed).otherwise(F.col("text"))})
