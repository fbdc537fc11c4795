"""Fixtures of the tests for training text: odd documents and a small seeded corpus."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, _key int, h string, score string"

LONG = " ".join(f"w{i % 977} " + "x" * (i % 5) for i in range(30_000))

ODD = [
    (1, None, "en", "a"), (2, "", "en", "a"), (3, " \t\n\r\x0b\x0c ", None, "a"), (4, "one", "en", None),
    (5, "one two three four five six seven eight nine ten", "en", "b"),
    (6, "one two three four five six seven eight nine ten", "en", "b"),
    (7, "a b c d e a b c d e a b c d e", "de", "b"), (8, "l1\nl2\nl3\nl4", "en", "c"),
    (9, "x\nl1\nl2\nl3\ny", "en", "c"), (10, "é" * 300 + " ÇA 日本 🙂", "fr", "c"), (11, LONG, "en", "c"),
    (None, "no id at all", "en", "b"), (8, "l1\nl2\nl3\nl4", "en", "c"), (12, "l2\n\nl3\n \nl4\nz", "en", "a"),
    (13, "same\n" * 9, "en", "a"), (14, "123 !! ??", "en", "a"),
]


def documents(spark, rows=ODD):
    """Documents with further columns whose names the operators use themselves."""
    full = [(*r, len(r[1]) if r[1] is not None else None, "mine", 3, "h", "s") for r in rows]
    return spark.createDataFrame(full, DOCS)


def corpus(n=160, seed=5):
    """(doc_id, text, lang, source): texts with copies, near copies and shared lines."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    shared = [" ".join(rng.choices(words, k=12)) for _ in range(6)]
    rows = []
    for i in range(n):
        kind = rng.random()
        if rows and kind < 0.15:
            text = rows[rng.randrange(len(rows))][1]
        elif rows and kind < 0.3:
            parts = rows[rng.randrange(len(rows))][1].split(" ")
            parts[rng.randrange(len(parts))] = "changed"
            text = " ".join(parts)
        else:
            lines = [" ".join(rng.choices(words, k=rng.randint(1, 30))) for _ in range(rng.randint(1, 9))]
            if kind > 0.8:
                at = rng.randint(0, len(lines))
                lines[at:at] = shared[: rng.randint(2, 6)]
            text = "\n".join(lines)
        rows.append((i, text, "en", rng.choice(["s1", "s1", "s1", "s2", "s3"])))
    return rows


def components(n, linked):
    """Smallest index that each index reaches, by plain search."""
    root = list(range(n))
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(root[a], root[b])
            if (root[a], root[b]) != (low, low):
                root[a] = root[b] = low
                changed = True
    return root
