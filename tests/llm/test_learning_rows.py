"""Learning rows of languages of any number, that are mostly copies or empty texts, and pooling."""

import random
from collections import Counter

import numpy as np

from pyspark.sql import functions as F

from medialoom.llm import language


def test_copies_and_empty_texts_leave_200_texts(spark):
    copies = spark.range(20_000).select(F.lit("aa").alias("lang"), F.concat(F.lit("text "), (F.col("id") % 300).cast("string")).alias("text"))
    empty = spark.range(20_000).select(F.lit("bb").alias("lang"), F.when(F.col("id") < 250, F.concat(F.lit("b "), F.col("id").cast("string"))).otherwise("").alias("text"))
    learned = language.learning_rows(copies.union(empty), F.lit(False))
    assert Counter(lang for _, lang in learned) == {"aa": 200, "bb": 200}
    assert len(set(learned)) == 400


def test_every_one_of_150_languages_can_be_predicted(spark):
    rng = random.Random(1)
    sounds = ["".join(rng.choice("bcdfghjklmnpqrstvwxyz") + rng.choice("aeiou") for _ in range(3)) for _ in range(150)]
    rows = [(f"l{i:03d}", " ".join(rng.choice([s, s[:4], s[2:]]) for _ in range(12))) for i, s in enumerate(sounds) for _ in range(4)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    learned = language.learning_rows(docs, F.lit(False))
    assert len({lang for _, lang in learned}) == 150
    assert all(len(data) <= 2 * language.SPREAD * language.WINDOW for data, _ in learned)
    net = language.learn(learned, steps=600)
    assert len(net.labels) == 150
    named = language.label_texts(net, [t for _, t in rows])
    right = [lang for (lang, _), (got, _) in zip(rows, named) if lang == got]
    assert len(set(right)) >= 140 and len(right) > 0.85 * len(rows)


def test_pooling_over_many_windows_against_a_plain_loop():
    rng = np.random.default_rng(3)
    texts = ["", "short", "é" * 500, "words and more " * 80, "x" * 96, "y" * 97, "1 2 3", None, "z" * 1000]
    net = language.train(rng.integers(0, 256, (12, language.WINDOW)), np.arange(12) % 3, ["a", "b", "c"], steps=3)
    for text, (label, score) in zip(texts, language.label_texts(net, texts)):
        if not text or not language.LETTER.search(text):
            assert (label, score) == ("und", 0.0)
            continue
        data, total, n = text.lower().encode(), np.zeros(3), 0
        for i in range(0, len(data), language.WINDOW):
            window = np.full(language.WINDOW, 256)
            part = np.frombuffer(data[i : i + language.WINDOW], np.uint8)
            window[: len(part)] = part
            for chance in language.chances(net, window[:, None].astype(np.intp))[: len(part), :, 0]:
                total, n = total + chance, n + 1
        assert label == net.labels[int(total.argmax())] and abs(score - total.max() / n) < 1e-5
