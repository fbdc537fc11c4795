"""Language identification by a bidirectional gated recurrent network over bytes.

Texts are lower-cased, written as UTF-8 and cut into windows of a fixed number of bytes. Two
recurrent layers read each window, one from each end; at every position both states together
give a label, and the probabilities of all positions of a document are averaged. The network
is trained in numpy by backpropagation through time on the driver, from a bounded sample of
labelled rows; prediction runs over every byte of every text, many windows side by side. The
windows to learn from are cut in the tasks, so no whole text reaches the driver. Every language is
learned: states and steps grow with their number.

Defined results: ``und`` with score 0 for a null text, a text without a letter, and every text
if nothing could be learned, also because the table is empty. Ties between languages go to the
first by code point. Only text and lang of learning rows are ever used; a prediction depends on the
text alone, so repeated rows and null ids get what their text gets. A text of any length is read
whole. Columns named lang_pred or score give way, all others stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from medialoom.llm.common import own_columns, replace_columns, whole_row

#: Learning uses at most ROWS rows of a language; many languages share BUDGET rows, one each at least.
ROWS, BUDGET = 200, 20_000
#: Windows taken from a learning row at most, spread evenly over the whole text.
SPREAD = 8
#: Bytes of a window; states of a layer; windows that are run side by side.
WINDOW, STATES, SIDE = 96, 8, 4096
STEPS, BATCH, RATE, SEED = 300, 96, 0.02, 11
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")


@dataclass
class Network:
    """``table``: gates by byte, for both layers; ``back``: gates by state; ``out``: labels."""

    labels: list[str]
    table: np.ndarray  # 2, 257, 3 * states; the last row is the padding
    back: np.ndarray  # 2, 3 * states, states
    out: np.ndarray  # labels, 2 * states
    bias: np.ndarray  # labels


def soft(x: np.ndarray) -> np.ndarray:
    """x / (1 + |x|), in place of the hyperbolic tangent and, scaled to 0..1, of the logistic."""
    return x / (1 + np.abs(x))


def run_layer(table: np.ndarray, back: np.ndarray, data: np.ndarray) -> np.ndarray:
    """States after each byte; data: positions x windows. Buffers are used again at each step."""
    n, h = data.shape[1], back.shape[1]
    states = np.empty((len(data) + 1, h, n), np.float32)
    states[0] = 0
    given, recalled, size = (np.empty((3 * h, n), np.float32) for _ in range(3))
    for t, column in enumerate(data):
        state, fresh, gates = states[t + 1], given[2 * h :], given[: 2 * h]
        np.take(table, column, axis=1, out=given, mode="clip")
        np.matmul(back, states[t], out=recalled)
        gates += recalled[: 2 * h]
        np.abs(gates, out=size[: 2 * h])
        size[: 2 * h] += 1
        gates /= size[: 2 * h]
        gates += 1  # twice the gate
        np.multiply(given[h : 2 * h], recalled[2 * h :], out=state)
        state *= 0.5
        fresh += state
        np.abs(fresh, out=size[:h])
        size[:h] += 1
        fresh /= size[:h]
        np.subtract(states[t], fresh, out=state)
        state *= given[:h]
        state *= 0.5
        state += fresh
    return states[1:]


def run_kept(table: np.ndarray, back: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, list]:
    """The same states, with what the way back needs of each step."""
    h = back.shape[1]
    state, states, gates = np.zeros((h, data.shape[1]), np.float32), [], []
    for column in data:
        given, recalled = table[:, column], back @ state
        both = 0.5 * soft(given[: 2 * h] + recalled[: 2 * h]) + 0.5
        update, reset = both[:h], both[h:]
        fresh = soft(given[2 * h :] + reset * recalled[2 * h :])
        gates.append((state, update, reset, fresh, recalled[2 * h :]))
        state = fresh + update * (state - fresh)
        states.append(state)
    return np.stack(states), gates


def tables(net: Network) -> np.ndarray:
    return np.ascontiguousarray(net.table.transpose(0, 2, 1))


def position_scores(net: Network, ahead: np.ndarray, behind: np.ndarray) -> np.ndarray:
    """Label scores of every position: positions x labels x windows."""
    h = ahead.shape[1]
    scores = np.matmul(net.out[:, :h], ahead)
    scores += np.matmul(net.out[:, h:], behind[::-1])
    scores += net.bias[:, None]
    return scores


def chances(net: Network, data: np.ndarray) -> np.ndarray:
    """Probability of each label at every position."""
    both = tables(net)
    ahead = run_layer(both[0], net.back[0], data)
    return softmax(position_scores(net, ahead, run_layer(both[1], net.back[1], data[::-1])))


def softmax(scores: np.ndarray) -> np.ndarray:
    """Over the labels, in place."""
    scores -= scores.max(axis=1, keepdims=True)
    np.exp(scores, out=scores)
    scores /= scores.sum(axis=1, keepdims=True)
    return scores


def unroll(back: np.ndarray, gates: list, data: np.ndarray, wanted: np.ndarray):
    """Backpropagation through time of one layer: slopes of its table and its weights."""
    h = back.shape[1]
    slope_table = np.zeros((257, 3 * h), np.float32)
    slope_back = np.zeros_like(back)
    carried = np.zeros_like(wanted[0])
    for t in range(len(gates) - 1, -1, -1):
        state, update, reset, fresh, recalled = gates[t]
        d = wanted[t] + carried
        # the slope of soft is the square of 1 - |soft|; a gate is half of one, plus a half
        d_fresh = d * (1 - update) * (1 - np.abs(fresh)) ** 2
        d_update = d * (state - fresh) * 0.5 * (1 - np.abs(2 * update - 1)) ** 2
        d_reset = d_fresh * recalled * 0.5 * (1 - np.abs(2 * reset - 1)) ** 2
        d_recalled = np.concatenate([d_update, d_reset, d_fresh * reset])
        d_given = np.concatenate([d_update, d_reset, d_fresh])
        slope_table += (data[t] == np.arange(257)[:, None]).astype(np.float32) @ d_given.T
        slope_back += d_recalled @ state.T
        carried = d * update + back.T @ d_recalled
    return slope_table, slope_back


def states_for(labels: int) -> int:
    """States of a layer: STATES for a dozen languages, more for more of them."""
    return STATES if labels <= 12 else min(96, STATES + labels // 4)


def train(windows: np.ndarray, answers: np.ndarray, labels: list[str], steps: int | None = None) -> Network:
    """Fits the network to windows (n x bytes, padded with 256) and the label of each."""
    rng = np.random.default_rng(SEED)
    h, k = states_for(len(labels)), len(labels)
    steps = STEPS if steps is None else steps

    def start(*shape: int) -> np.ndarray:
        return (rng.standard_normal(shape) * 0.3).astype(np.float32)

    net = Network(labels, start(2, 257, 3 * h), start(2, 3 * h, h), start(k, 2 * h), np.zeros(k, np.float32))
    values = [net.table, net.back, net.out, net.bias]
    means = [np.zeros_like(v) for v in values]
    squares = [np.zeros_like(v) for v in values]
    def flat(x: np.ndarray) -> np.ndarray:
        return x.transpose(1, 0, 2).reshape(x.shape[1], -1)

    groups = [np.flatnonzero(answers == c) for c in range(k)]
    for step in range(1, steps + 1):
        # as many windows of each language, whatever its share of the sample
        picked = np.concatenate([rng.choice(g, -(-BATCH // k)) for g in drawn(groups, rng)])
        data, truth = np.ascontiguousarray(windows[picked].T), answers[picked]
        (ahead, gates_a), (behind, gates_b) = (
            run_kept(table, back, way)
            for table, back, way in zip(tables(net), net.back, (data, data[::-1]), strict=True)
        )
        slope = softmax(position_scores(net, ahead, behind))
        slope[:, truth, np.arange(len(picked))] -= 1
        slope *= (data < 256)[:, None, :] / max(1, (data < 256).sum())
        wanted = np.matmul(net.out.T, slope)
        sides = [
            unroll(net.back[0], gates_a, data, wanted[:, :h]),
            unroll(net.back[1], gates_b, data[::-1], wanted[::-1, h:]),
        ]
        slopes = [
            np.stack([s[0] for s in sides]), np.stack([s[1] for s in sides]),
            np.concatenate([flat(slope) @ flat(way).T for way in (ahead, behind[::-1])], axis=1),
            slope.sum(axis=(0, 2)),
        ]
        norm = np.sqrt(sum(float((g * g).sum()) for g in slopes))
        rate = RATE * (1 - 0.9 * step / steps)
        for v, g, m, s in zip(values, slopes, means, squares, strict=True):
            g *= min(1.0, 1.0 / max(norm, 1e-9))
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            v -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
    return net


def drawn(groups: list[np.ndarray], rng: np.random.Generator) -> list[np.ndarray]:
    """The languages of a step: all, or so many of many that a step stays small."""
    most = 4 * BATCH
    return groups if len(groups) <= most else [groups[i] for i in rng.permutation(len(groups))[:most]]


def cut(text: str) -> np.ndarray:
    """All bytes of a text in windows; the last is padded."""
    data = np.frombuffer(text.lower().encode(), np.uint8).astype(np.int32)
    rows = -(-len(data) // WINDOW)
    padded = np.full(rows * WINDOW, 256, np.int32)
    padded[: len(data)] = data
    return padded.reshape(rows, WINDOW)


def spread_windows(text: str) -> np.ndarray:
    """Windows to learn from, at most SPREAD, evenly over the whole text."""
    found = cut(text)
    return found[np.unique(np.linspace(0, len(found) - 1, SPREAD).astype(int))]


def learn(rows: list[tuple[bytes, str]], steps: int | None = None) -> Network | None:
    """Network from (windows, lang) rows, as ``learning_rows`` gives them; None without a window."""
    labels = sorted({lang for data, lang in rows if data})
    number = {lang: i for i, lang in enumerate(labels)}
    windows = [np.frombuffer(data, "<u2").reshape(-1, WINDOW).astype(np.int32) for data, _ in rows if data]
    if not windows:
        return None
    answers = np.repeat([number[lang] for data, lang in rows if data], [len(w) for w in windows])
    return train(np.concatenate(windows), answers, labels, steps)


def cut_windows(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in batches:
        yield pd.Series([spread_windows(t).astype("<u2").tobytes() for t in batch], dtype=object)


def learning_rows(docs: DataFrame, held_out: Column) -> list[tuple[bytes, str]]:
    """(windows, lang) of the first texts of each language by a hash of the text: ROWS of them, or an
    equal share of BUDGET if there are many languages, one at least.

    The distinct hashes of the texts of each language are counted first; then only texts whose hash
    lies in the lowest share, one that holds about twice as many, are made distinct and ranked.
    Copies and empty texts don't change what is learned from. What reaches the driver is at
    most SPREAD windows a row.
    """
    known = docs.where(F.col("lang").isNotNull() & ~held_out & (F.col("text") != ""))
    hashes = known.groupBy("lang", F.xxhash64("text").alias("hash")).agg(F.count(F.lit(1)).alias("n"))
    languages = hashes.groupBy("lang").agg(F.count(F.lit(1)).alias("texts"))
    n = languages.count()
    if not n:
        return []
    rows = max(1, min(ROWS, BUDGET // n))
    # the lowest of 2^53 ranges of hashes, as many as the share says
    share = F.least(F.lit(1.0), F.lit(2.0 * rows) / F.col("texts"))
    top = F.when(share >= 1.0, F.lit(2**63 - 1)).otherwise(
        F.shiftleft(F.floor(share * float(2**53)), 11).bitwiseXOR(F.lit(-(2**63)))
    )
    bounds = languages.select(F.col("lang").alias("of"), top.alias("top"))
    if n <= BUDGET:  # a row for each language: texts beyond their bound go before any shuffle
        bounds = F.broadcast(bounds)
    given = known.select("lang", "text", F.xxhash64("text").alias("hash"))
    low = given.join(bounds, F.col("lang") == F.col("of")).where("hash <= top")
    order = Window.partitionBy("lang").orderBy("hash", "text")
    ranked = low.select("lang", "text", "hash").distinct().withColumn("rank", F.row_number().over(order))
    first = ranked.where(F.col("rank") <= rows).select("lang", "rank", F.pandas_udf(cut_windows, "binary")("text").alias("windows"))
    return [(bytes(r["windows"]), r["lang"]) for r in first.orderBy("lang", "rank").collect()]


def label_texts(net: Network, texts: list[str]) -> list[tuple[str, float]]:
    """Label and mean probability of each text, from all its positions."""
    sums = np.zeros((len(texts), len(net.labels)))
    sizes = np.zeros(len(texts))
    held, owners, waiting = [], [], 0

    def flush() -> None:
        nonlocal waiting
        if not held:
            return
        data, owner = np.concatenate(held), np.concatenate(owners)
        for i in range(0, len(data), SIDE):
            part, own = data[i : i + SIDE], owner[i : i + SIDE]
            real = part < 256
            found = chances(net, np.ascontiguousarray(part.T, dtype=np.intp))
            found *= real.T[:, None, :]
            np.add.at(sums, own, found.sum(axis=0).T)
            np.add.at(sizes, own, real.sum(axis=1))
        held.clear()
        owners.clear()
        waiting = 0

    for at, text in enumerate(texts):
        if text and LETTER.search(text):
            windows = cut(text)
            for i in range(0, len(windows), SIDE):  # a very long text goes through in parts
                held.append(windows[i : i + SIDE])
                owners.append(np.full(len(held[-1]), at))
                waiting += len(held[-1])
                if waiting >= SIDE:
                    flush()
    flush()
    best = sums.argmax(axis=1)
    return [
        (net.labels[b], float(min(1.0, sums[i, b] / sizes[i]))) if sizes[i] else (UNKNOWN, 0.0)
        for i, b in enumerate(best)
    ]


def identify(docs: DataFrame, net: Network | None) -> DataFrame:
    """``docs`` with lang_pred and score. The network has a fixed size and goes with the tasks."""
    if net is None:
        return replace_columns(docs, {"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})

    @F.pandas_udf("label string, score double")
    def label(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = label_texts(net, list(batch))
            yield pd.DataFrame(rows, columns=["label", "score"], dtype=object)

    found = docs.select(whole_row(docs), label(F.coalesce("text", F.lit(""))).alias("found"))
    results = {"lang_pred": F.col("found")["label"], "score": F.col("found")["score"]}
    return found.select(*own_columns(docs, results), *(v.alias(c) for c, v in results.items()))


def held_out_fold(doc_id: str = "doc_id") -> Column:
    """Rows that are kept out of learning: crc32 of the id as text leaves 2; false for null ids."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))
