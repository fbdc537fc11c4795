"""Removal of repeated strings by a distributed difference-cover suffix sort.

Every byte that lies in a string of ``LENGTH`` bytes which also starts earlier (in a smaller
document, or earlier in the same one) is removed. Equal strings are found by sorting suffixes:

* **Where suffixes go.** Every window of ``LENGTH`` bytes is named after the smallest hash of its
  grams. Equal windows have the same name, so a window whose name occurs once in the corpus has no
  equal and leaves the work; what is left travels to the bucket of its name, in runs of windows
  of one name. A name that very many texts have is split further by the hash of the window.
* **What a bucket does.** It sorts the suffixes of its runs by the difference cover of period
  three: triples at two of three places are sorted and named, the names are sorted by recursion,
  the remaining suffixes are merged in, and neighbours in the order are compared by their first
  ``LENGTH`` bytes. Only that many bytes count, so the recursion ends after log3 of it. A bucket is
  sorted in parts of bounded size, names kept together.

Equal texts are settled before by their SHA-256, and equal runs by their bytes in each task that
makes or takes them, so a group of copies costs one run for each task that holds some of it.

Defined results: a null text counts as empty; a text shorter than ``LENGTH`` loses nothing. Rows
that agree in id and text are one document and are treated alike; texts that share an id follow
their SHA-256. Null ids come last. A text may lose all its bytes. Very long texts are cut in
runs of bounded size. What is left may not be UTF-8 and is therefore binary. An empty table gives
no rows. Columns of the input that are named like results give way, all others stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from medialoom.session import cut_lineage

LENGTH = 100
#: Bytes of a gram; the window of LENGTH bytes holds LENGTH - GRAM + 1 of them.
GRAM = 32
#: Bytes of text that ask for a bucket of their own, and texts from which a name is split.
BUCKET, HOT = 16_000_000, 4096
#: Windows of a run at most, symbols that are sorted at once at most, text that a task gathers.
RUN, PART, GATHER = 4096, 1 << 20, 8_000_000
#: Fixed random numbers: one for each byte, and the odd base of the rolling hash.
BYTES = np.random.default_rng(13).integers(0, 1 << 63, 256, dtype=np.uint64)
BASE = 0x9E3779B97F4A7C15


# -- names of windows ---------------------------------------------------------------------------


class Powers:
    """Powers of the base and of its inverse modulo 2^64, as many as a text has needed."""

    def __init__(self):
        self.up = self.down = np.empty(0, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 1 << 14)
            inverse = pow(BASE, -1, 1 << 64)
            self.up, self.down = (
                np.multiply.accumulate(np.r_[np.uint64(1), np.full(size - 1, b, np.uint64)]) for b in (BASE, inverse)
            )
        return self.up[:n], self.down[:n]


POWERS = Powers()


def rolled(data: np.ndarray, widths: tuple[int, ...]) -> list[np.ndarray]:
    """Hashes of all strings of each width."""
    up, down = POWERS.to(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTES[data] * up[:-1], out=total[1:])
    found = []
    for width in widths:
        h = (total[width:] - total[:-width]) * down[: len(data) - width + 1]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        found.append(h)
    return found


def sliding(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """``pick`` (minimum or maximum) over every ``width`` neighbours, by doubling."""
    reach = 1
    while 2 * reach <= width:
        values = pick(values[:-reach], values[reach:])
        reach *= 2
    rest = width - reach
    return pick(values[: len(values) - rest], values[rest:]) if rest else values


def window_names(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Name of each window, and the names at each place that gives one (repeats included)."""
    grams = rolled(data, (min(GRAM, length),))[0]
    width = length - min(GRAM, length) + 1
    names = sliding(grams, width, np.minimum)
    edge = np.zeros(width - 1, np.uint64)
    best = sliding(np.concatenate([edge, names, edge]), width, np.maximum)
    return names, grams[best == grams]


def bucket_of(names: np.ndarray, buckets: int) -> np.ndarray:
    """Names are minima and so mostly small: their bits are spread first."""
    spread = names * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(32)
    return (spread * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def grouped_slices(keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each key with the places that have it."""
    order = np.argsort(keys, kind="stable")
    cuts = np.flatnonzero(np.diff(keys[order])) + 1
    for places in np.split(order, cuts) if len(order) else []:
        yield int(keys[places[0]]), places


def ask(batches: Iterator[pd.DataFrame], length: int, buckets: int) -> Iterator[pd.DataFrame]:
    """Which names the texts have, by bucket of the name.

    A name that several texts of the task have is known to occur again: its texts go on by their
    own bucket (``known``), and the bucket of the name only learns their number.
    """
    held: dict[int, np.ndarray] = {}
    size = 0

    def flush() -> pd.DataFrame:
        names = np.concatenate([n for n, _ in held.values()])
        again = np.concatenate([m for _, m in held.values()])
        texts = np.repeat(np.fromiter(held, np.int64, len(held)), [len(n) for n, _ in held.values()])
        distinct, place, times = np.unique(names, return_inverse=True, return_counts=True)
        several = times[place] > 1
        rows = []
        known = texts[several].view(np.uint64)
        for b, at in grouped_slices((known % np.uint64(buckets)).astype(np.int64)):
            rows.append((b, True, names[several][at].tobytes(), texts[several][at].tobytes(), b""))
        many = times > 1
        out = np.concatenate([names[~several], distinct[many]])
        ids = np.concatenate([texts[~several], np.zeros(many.sum(), np.int64)])
        count = np.concatenate([np.where(again[~several], -1, 1), times[many]]).astype(np.int64)
        for b, at in grouped_slices(bucket_of(out, buckets)):
            rows.append((b, False, out[at].tobytes(), ids[at].tobytes(), count[at].tobytes()))
        held.clear()
        return pd.DataFrame(rows, columns=["bucket", "known", "names", "texts", "times"])

    for batch in batches:
        for text, key in zip(batch["text"], batch["tid"].tolist(), strict=True):
            data = np.frombuffer(text.encode(), np.uint8)
            if key not in held and len(data) >= length:
                names, times = np.unique(window_names(data, length)[1], return_counts=True)
                held[key] = names, times > 1
                size += len(data)
                if size > GATHER:
                    yield flush()
                    size = 0
    if held:
        yield flush()


ASKED = "bucket int, known boolean, names binary, texts binary, times binary"


def answer(group: pd.DataFrame) -> pd.DataFrame:
    """(tid, name) of the names that occur again; (null, name) of those to be split.

    ``times`` is 1 for one text, -1 for one text that has the name twice, and else the number of
    the texts of a task that have it.
    """
    known = group["known"].to_numpy(dtype=bool)
    names, texts = (np.frombuffer(b"".join(group[c][known]), t) for c, t in (("names", "u8"), ("texts", "i8")))
    asked = group[~known]
    asking, by, times = (
        np.frombuffer(b"".join(asked[c]), t) for c, t in (("names", "u8"), ("texts", "i8"), ("times", "i8"))
    )
    distinct, place = np.unique(asking, return_inverse=True)
    single = np.abs(times) == 1
    # copies of a text in other tasks are the same text
    order = np.lexsort([by, place])
    fresh = np.r_[True, (np.diff(place[order]) != 0) | (np.diff(by[order]) != 0)][: len(order)]
    count = np.bincount(place[order][fresh & single[order]], minlength=len(distinct))
    count += np.bincount(place[~single], times[~single], len(distinct)).astype(np.int64)
    twice = np.bincount(place[times == -1], minlength=len(distinct)) > 0
    told = fresh & single[order] & ((count > 1) | twice)[place[order]]
    hot = distinct[count >= HOT]
    names = np.concatenate([names, asking[order][told], hot]).view(np.int64)
    tid = pd.array(np.concatenate([texts, by[order][told], np.zeros(len(hot), np.int64)]), "Int64")
    tid[len(tid) - len(hot) :] = pd.NA
    return pd.DataFrame({"tid": tid, "name": names})


def shared_names(texts: DataFrame, length: int, buckets: int) -> DataFrame:
    """(tid, names, hot): of each text the names that occur again, and those of them to be split."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return ask(batches, length, buckets)

    asked = texts.select("tid", "text").mapInPandas(run, ASKED)
    told = cut_lineage(asked.groupBy("bucket").applyInPandas(answer, "tid long, name long"), "names")
    hot = told.where("tid is null").select("name", F.lit(True).alias("hot"))
    pairs = told.where("tid is not null").join(hot, "name", "left")
    return pairs.groupBy("tid").agg(
        F.collect_set("name").alias("names"),
        F.collect_set(F.when(F.col("hot"), F.col("name"))).alias("hot"),
    )


# -- runs of windows ----------------------------------------------------------------------------


def runs_of(data: np.ndarray, shared: np.ndarray, hot: np.ndarray, length: int):
    """(name, first window, windows, whether the name has several places) of the shared names.

    ``shared`` and ``hot`` are sorted. Hot names come as single windows with a name of their own.
    """
    names, places = window_names(data, length)
    distinct, times = np.unique(places, return_counts=True)
    cuts = np.flatnonzero(np.r_[True, names[1:] != names[:-1]])
    sizes = np.diff(np.r_[cuts, len(names)])
    own = names[cuts]
    found = np.isin(own, shared, assume_unique=False)
    cuts, sizes, own = cuts[found], sizes[found], own[found]
    several = times[np.searchsorted(distinct, own)] > 1
    split = np.isin(own, hot)
    if split.any():
        single = np.concatenate([np.arange(a, a + n) for a, n in zip(cuts[split], sizes[split], strict=True)])
        whole = rolled(data, (length,))[0][single] ^ names[single]
        cuts, sizes, own, several = (
            np.concatenate([x[~split], y])
            for x, y in ((cuts, single), (sizes, np.ones_like(single)), (own, whole), (several, np.zeros(len(single), bool)))
        )
    for name, at, n, more in zip(own.tolist(), cuts.tolist(), sizes.tolist(), several.tolist(), strict=True):
        for part in range(0, n, RUN):
            yield name, at + part, min(RUN, n - part), more or n > RUN


def send(batches: Iterator[pd.DataFrame], length: int, buckets: int) -> Iterator[pd.DataFrame]:
    """Runs by the bucket of their name. Of equal runs of the task only the first goes on; the
    others lie in spans that are known to be removed."""
    firsts: dict[tuple[int, bytes], tuple] = {}
    docs: list[tuple] = []
    gone: list[tuple] = []
    size = 0

    def flush() -> pd.DataFrame:
        rows = []
        names = np.fromiter((k[0] for k in firsts), np.uint64, len(firsts))
        runs = list(firsts.items())
        for b, at in grouped_slices(bucket_of(names, buckets)):
            picked = [runs[i] for i in at.tolist()]
            used = sorted({v[1] for _, v in picked})
            number = {d: i for i, d in enumerate(used)}
            rows.append((
                b, names[at].tobytes(), np.array([len(k[1]) for k, _ in picked], "<i8").tobytes(),
                np.array([v[2] for _, v in picked], "<i8").tobytes(),
                np.array([number[v[1]] for _, v in picked], "<i8").tobytes(),
                np.array([v[3] for _, v in picked], bool).tobytes(), b"".join(k[1] for k, _ in picked),
                [docs[d][1] for d in used], b"".join(docs[d][2] for d in used), None, None, None,
            ))
        rows += [(i % buckets, *[None] * 8, docs[d][2], a, z) for i, (d, a, z) in enumerate(gone)]
        for x in (firsts, docs, gone):
            x.clear()
        return pd.DataFrame(rows, columns=SENT_NAMES).astype({"from": "Int64", "to": "Int64"})

    for batch in batches:
        for doc, sha, text, names, hot in zip(
            batch["_id"].astype(object), batch["sha"], batch["text"], batch["names"], batch["hot"], strict=True
        ):
            doc = None if pd.isna(doc) else doc
            data = text.encode()
            docs.append(((doc is None, doc, sha), doc, sha))
            d = len(docs) - 1
            shared, split = (np.sort(np.asarray(x, np.int64).view(np.uint64)) for x in (names, hot))
            for name, at, n, more in runs_of(np.frombuffer(data, np.uint8), shared, split, length):
                key = (name, data[at : at + n - 1 + length])
                known = firsts.get(key)
                if known is None:
                    firsts[key] = (docs[d][0], d, at, more)
                    size += len(key[1])
                    continue
                # of two equal runs the one that starts earlier goes on
                if (docs[d][0][0], docs[d][0][1] if doc is not None else 0, sha, at) < (
                    known[0][0], known[0][1] if known[0][1] is not None else 0, known[0][2], known[2]
                ):
                    firsts[key] = (docs[d][0], d, at, more or known[3])
                    gone.append((known[1], known[2], known[2] + len(key[1])))
                elif (docs[known[1]][2], known[2]) != (sha, at):
                    gone.append((d, at, at + len(key[1])))
            if size > 4 * GATHER or len(gone) > GATHER // 16:
                yield flush()
                size = 0
    if docs:
        yield flush()


SENT_NAMES = ["bucket", "names", "sizes", "at", "doc", "several", "data", "ids", "shas", "sha", "from", "to"]


def sent_schema(id_type: str) -> str:
    return (
        "bucket int, names binary, sizes binary, at binary, doc binary, several binary, data binary, "
        f"ids array<{id_type}>, shas binary, sha binary, from long, to long"
    )


# -- the difference cover -----------------------------------------------------------------------


def dense(keys: np.ndarray) -> np.ndarray:
    """Names of keys in their order, from 1."""
    return np.unique(keys, return_inverse=True)[1] + 1


def suffix_ranks(s: np.ndarray, depth: int) -> np.ndarray:
    """Ranks of all suffixes of ``s``; symbols lie below 2^21.

    Suffixes that differ in their first ``depth`` symbols are in their order; others may tie, or
    follow each other in any order.
    """
    n = len(s)
    padded = np.concatenate([s, np.zeros(3, s.dtype)]).astype(np.int64)
    triples = (padded[:-3] << 42) | (padded[1:-2] << 21) | padded[2:-1]
    if depth <= 3 or n < 3:
        return dense(triples)
    # sort and name the sampled triples, then sort the names by recursion
    names = dense(np.concatenate([triples[1::3], triples[2::3]]))
    ones = len(triples[1::3])
    if names.max() < len(names):
        inner = suffix_ranks(np.concatenate([names[:ones], [0], names[ones:]]), -(-depth // 3))
        names = dense(np.concatenate([inner[:ones], inner[ones + 1 :]]))
    rank = np.zeros(n + 3, np.int64)
    rank[1:n:3], rank[2:n:3] = names[:ones], names[ones:]
    # merge the remaining suffixes: by symbol and the rank of the next suffix against the first
    # class, by two symbols and the rank of the one after next against the second
    one, two = np.arange(1, n, 3), np.arange(2, n, 3)
    rest = np.arange(0, n, 3)
    short = (padded[:n] << 21) | rank[1 : n + 1]
    rest = rest[np.argsort(short[rest], kind="stable")]

    def long_key(at: np.ndarray) -> np.ndarray:
        return (padded[at] << 42) | (padded[at + 1] << 21) | rank[at + 2]

    before = np.sort(short[one]).searchsorted(short[rest]) + np.sort(long_key(two)).searchsorted(long_key(rest))
    before = np.maximum.accumulate(before)  # among ties beyond the depth both counts may disagree
    sampled = np.concatenate([one, two])
    sampled = sampled[np.argsort(rank[sampled], kind="stable")]
    place = np.empty(n, np.int64)
    place[rest] = before + np.arange(len(rest))
    place[sampled] = np.arange(len(sampled)) + np.searchsorted(before, np.arange(len(sampled)), "right")
    order = np.empty(n, np.int64)
    order[place] = np.arange(n)
    # equal neighbours of one class share a rank, so that their names go on being equal
    kind = order % 3 == 0
    value = np.where(kind, short[order], rank[order])
    step = np.r_[True, (value[1:] != value[:-1]) | (kind[1:] != kind[:-1])]
    out = np.empty(n, np.int64)
    out[order] = np.cumsum(step)
    return out


def later_windows(data: bytes, sizes: np.ndarray, first: np.ndarray, length: int) -> np.ndarray:
    """Whether each window of the runs also starts earlier; ``first``: order of each run's start.

    Windows are given run by run; a run of m bytes has m - length + 1 of them.
    """
    ends = np.cumsum(sizes + 1)
    symbols = np.zeros(int(ends[-1]), np.int64)
    inside = np.ones(len(symbols), bool)
    inside[ends - 1] = False  # a zero parts the runs
    symbols[inside] = np.frombuffer(data, np.uint8).astype(np.int64) + 1
    windows = sizes - length + 1
    skipped = np.repeat(np.cumsum(windows) - windows, windows)
    within = np.arange(int(windows.sum())) - skipped
    starts = np.repeat(ends - sizes - 1, windows) + within
    order = np.argsort(suffix_ranks(symbols, length)[starts], kind="stable")
    # compare neighbours by their first bytes
    rows = np.lib.stride_tricks.sliding_window_view(symbols.astype(np.uint8), length)
    same = np.zeros(len(order), bool)
    for i in range(1, len(order), 65_536):
        a, b = starts[order[i - 1 : i + 65_535]], starts[order[i : i + 65_536]]
        same[i : i + len(b)] = (rows[a[: len(b)]] == rows[b]).all(axis=1)
    heads = np.flatnonzero(~same)
    when = (np.repeat(first, windows) + within)[order]
    least = np.minimum.reduceat(when, heads)
    later = np.empty(len(order), bool)
    later[order] = when > np.repeat(least, np.diff(np.r_[heads, len(order)]))
    return later


def settle(group: pd.DataFrame, length: int) -> pd.DataFrame:
    """Spans of one bucket that are removed: (sha, from, to)."""
    told = group[group["from"].notna()]
    out = [(told["sha"], told["from"].astype(np.int64), told["to"].astype(np.int64))]
    spans: list[tuple[bytes, int, int]] = []
    group = group[group["from"].isna()]
    docs: list[tuple] = []
    runs: dict[tuple[int, bytes], list] = {}
    owners, numbers = [], []
    for ids, shas in zip(group["ids"], group["shas"], strict=True):
        base = len(docs)
        for i, doc in enumerate(ids):
            doc = None if pd.isna(doc) else doc
            docs.append((doc is None, doc if doc is not None else 0, shas[32 * i : 32 * i + 32]))
        owners.append(base)
    ranked = {d: i for i, d in enumerate(sorted(set(docs)))}
    numbers = [ranked[d] for d in docs]
    shas = {i: d[2] for d, i in ranked.items()}
    for base, row in zip(owners, group.itertuples(index=False), strict=True):
        names, sizes, at, doc = (
            np.frombuffer(x, t).tolist() for x, t in ((row.names, "u8"), (row.sizes, "i8"), (row.at, "i8"), (row.doc, "i8"))
        )
        place = 0
        for name, size, start, d, more in zip(names, sizes, at, doc, row.several, strict=True):
            bytes_ = row.data[place : place + size]
            place += size
            when = (numbers[base + d], start)
            known = runs.setdefault((name, bytes_), [when, more])
            known[1] |= more
            if when != known[0]:
                gone, known[0] = max(when, known[0]), min(when, known[0])
                spans.append((shas[gone[0]], gone[1], gone[1] + size))
    names = np.fromiter((k[0] for k in runs), np.uint64, len(runs))
    items = list(runs.items())
    part: list = []
    size = 0

    def sort_part() -> None:
        sizes = np.array([len(k[1]) for k, _ in part])
        first = np.array([(w[0] << 40) + w[1] for _, (w, _) in part])
        later = later_windows(b"".join(k[1] for k, _ in part), sizes, first, length)
        windows = sizes - length + 1
        bounds = np.cumsum(windows) - windows
        edges = np.diff(np.concatenate([[0], later.view(np.int8), [0]]))
        # a run of later windows ends where the next run of windows begins
        cut = np.unique(np.concatenate([np.flatnonzero(edges == 1), bounds[later[bounds]]]))
        stop = np.unique(np.concatenate([np.flatnonzero(edges == -1), bounds[1:][later[bounds[1:] - 1]]]))
        owner = np.searchsorted(bounds, cut, "right") - 1
        for o, a, z in zip(owner.tolist(), (cut - bounds[owner]).tolist(), (stop - bounds[owner]).tolist(), strict=True):
            doc, start = part[o][1][0]
            spans.append((shas[doc], start + a, start + z - 1 + length))

    for _, places in grouped_slices(names.view(np.int64)):
        own = [items[i] for i in places.tolist()]
        if len(own) == 1 and not own[0][1][1]:
            continue  # nothing else has the name, and the run has it at one place
        part += own
        size += sum(len(k[1]) for k, _ in own)
        if size > PART:
            sort_part()
            part, size = [], 0
    if part:
        sort_part()
    found = pd.DataFrame(spans, columns=["sha", "from", "to"])
    return pd.concat([found, pd.DataFrame(dict(zip(found.columns, out[0], strict=True)))], ignore_index=True)


# -- the operator -------------------------------------------------------------------------------


def key_columns() -> list[Column]:
    """Id and SHA-256 of the text of each row."""
    return [F.col("doc_id").alias("_id"), F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("sha")]


def same_document(left: str, right: str) -> Column:
    """Join condition of two sides whose keys have these prefixes."""
    return (F.col(left + "sha") == F.col(right + "sha")) & F.col(left + "_id").eqNullSafe(F.col(right + "_id"))


def prefixed(rows: DataFrame, prefix: str) -> DataFrame:
    return rows.withColumnsRenamed({c: prefix + c for c in ("_id", "sha")})


def merged(found) -> list[tuple[int, int]]:
    """Spans in order, without overlaps; touching ones are one."""
    out: list[list[int]] = []
    for a, z in sorted((x["from"], x["to"]) for x in found):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], z)
        else:
            out.append([a, z])
    return [(a, z) for a, z in out]


def cut_out(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    """What is left of each text without its spans, and the merged spans."""
    for texts, lists in batches:
        rows = []
        for text, found in zip(texts, lists, strict=True):
            data = text.encode()
            gone = merged(found)
            begins, ends = [a for a, _ in gone], [z for _, z in gone]
            kept = b"".join(data[a:z] for a, z in zip([0, *ends], [*begins, len(data)], strict=True))
            rows.append((kept, [{"from": a, "to": z} for a, z in gone]))
        yield pd.DataFrame(rows, columns=["kept", "spans"])


SPANS = "array<struct<from:long,to:long>>"


def repeats(docs: DataFrame, length: int = LENGTH, digest: bool = False) -> DataFrame:
    """One row per document: doc_id, sha (of its text), n_bytes, spans that are removed, and kept,
    the bytes left; kept is null where nothing is removed. With ``digest`` kept is the SHA-256 of these
    bytes as hexadecimal text: they are neither written nor shuffled to their rows.

    Only texts that share a name with another go through a shuffle, once to be given their names
    and once to be cut; all else is ids and hashes.
    """
    session, text = docs.sparkSession, F.coalesce("text", F.lit(""))
    rows = cut_lineage(
        docs.select(*key_columns(), F.xxhash64(text).alias("tid"), F.octet_length(text).cast("long").alias("n")), "texts"
    )
    total = rows.agg(F.sum("n")).head()[0] or 0
    buckets = max(int(session.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET))
    long_texts = docs.where(F.octet_length("text") >= length)
    shared = shared_names(long_texts.select("text", F.xxhash64("text").alias("tid")), length, buckets)
    order = F.struct(F.col("_id").isNull().alias("absent"), "_id")
    first = rows.where(F.col("n") >= length).groupBy("sha").agg(F.min(order).alias("o"), F.first("tid").alias("tid"))
    first = cut_lineage(first.select("tid", F.col("o")["_id"].alias("_id"), "sha"), "firsts")
    suspects = prefixed(first.join(shared, "tid"), "s_")
    texts = long_texts.select(*key_columns(), "text").join(suspects, same_document("", "s_"), "inner")
    texts = cut_lineage(texts.select("_id", "sha", "text", "names", "hot"), "suspects")

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return send(batches, length, buckets)

    def run(group: pd.DataFrame) -> pd.DataFrame:
        return settle(group, length)

    def told(kept: Column) -> Column:
        return F.sha2(kept, 256) if digest else kept

    id_type = docs.schema["doc_id"].dataType.simpleString()
    sent = texts.mapInPandas(make, StructType.fromDDL(sent_schema(id_type)))
    settled = sent.groupBy("bucket").applyInPandas(run, "sha binary, from long, to long")
    settled = settled.groupBy("sha").agg(F.collect_list(F.struct("from", "to")).alias("found"))
    cut = F.pandas_udf(cut_out, f"kept binary, spans {SPANS}")
    mine = texts.select("_id", "sha", "text").dropDuplicates(["sha"]).join(settled, "sha")
    mine = mine.select("_id", "sha", cut("text", "found").alias("r"))
    left = told(F.col("r")["kept"]).alias("kept")
    mine = cut_lineage(mine.select("_id", "sha", F.struct(left, F.col("r")["spans"].alias("spans")).alias("r")), "spans")
    named = rows.join(first.select("sha", F.col("_id").alias("f_id"), F.lit(True).alias("long")), "sha", "left")
    joined = named.join(prefixed(mine, "m_"), same_document("", "m_"), "left")
    copy = F.col("long") & ~F.col("_id").eqNullSafe(F.col("f_id"))
    whole = F.array(F.struct(F.lit(0).cast("long").alias("from"), F.col("n").alias("to")))
    return joined.select(
        F.col("_id").alias("doc_id"), "sha", F.col("n").alias("n_bytes"),
        F.when(copy, whole).otherwise(F.coalesce(F.col("r")["spans"], F.array().cast(SPANS))).alias("spans"),
        F.when(copy, told(F.lit(b""))).otherwise(F.col("r")["kept"]).alias("kept"),
    )


def removed_bytes(found: Column) -> Column:
    return F.aggregate(found, F.lit(0).cast("long"), lambda n, x: n + x["to"] - x["from"])


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with n_bytes, n_removed, n_spans and kept, the bytes that are left."""
    found = repeats(docs, length).where(F.size("spans") > 0).withColumnRenamed("doc_id", "_id")
    found = prefixed(found.dropDuplicates(["_id", "sha"]), "r_").drop("n_bytes")
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    joined = docs.select(row, *key_columns()).join(found, same_document("", "r_"), "left")
    text = F.coalesce(F.col("row")["text"], F.lit(""))
    result = {
        "n_bytes": F.octet_length(text).cast("long"),
        "n_removed": F.coalesce(removed_bytes(F.col("spans")), F.lit(0)).cast("long"),
        "n_spans": F.coalesce(F.size("spans"), F.lit(0)).cast("long"),
        "kept": F.coalesce("kept", F.encode(text, "utf-8")),
    }
    own = [F.col("row")[c].alias(c) for c in docs.columns if c.lower() not in result]
    return joined.select(*own, *(v.alias(c) for c, v in result.items()))
