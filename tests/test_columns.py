import posixpath

import pytest
from pyspark.sql import functions as F

from medialoom.functions import columns as col


def values(spark, kind, data, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


PROMPTS = {
    '{"prompt": " a red chair "}': "a red chair",
    '{"prompt": "x", "n": 1} and more': "x",
    'Sure! {"prompt": "wood"} ok': "wood",
    '{"prompt": "a \\"quoted\\" word"}': 'a "quoted" word',
    "{'prompt': 'single'}": "{'prompt': 'single'}",
    '["prompt"]': '["prompt"]',
    '{"other": "x"}': '{"other": "x"}',
    "\n raw text \n": "raw text",
    '{"prompt": "a"}, {"prompt": "b"}': "a",
    '{"prompt": "line\\nbreak"}': "line\nbreak",
    "{broken": "{broken",
    "": "",
}


def test_extract_prompt(spark):
    assert values(spark, "string", list(PROMPTS), col.extract_prompt) == list(PROMPTS.values())


FILE_NAMES = {
    "a/b:c": "a_b_c",
    " ..x.. ": "x",
    "": "untitled",
    "...": "untitled",
    'q<>"|?*\\': "q_______",
    "t\x01ab": "t_ab",
    "é" * 100: "é" * 80,
    "a" * 79 + ". b": "a" * 79,
}


def test_sanitize_filename(spark):
    assert values(spark, "string", list(FILE_NAMES), col.sanitize_filename) == list(FILE_NAMES.values())


def test_extension_and_base_name(spark):
    paths = ["a/b.JPG", "x.tar.gz", ".hidden", "a.b/c", "..x.png", "u/i.jpeg?x=1", "plain"]
    assert values(spark, "string", paths, col.extension) == [posixpath.splitext(p)[1] for p in paths]
    assert values(spark, "string", paths, col.base_name) == [posixpath.basename(p) for p in paths]


FRAMES = {
    0: ([], []),
    1: ([0] * 15, [0]),
    7: ([0, 1, 2, 3, 4, 5] + [6] * 9, [0, 1, 2, 3, 4, 5, 6]),
    14: ([*range(14), 13], [0, 1, 2, 4, 5, 7, 8, 9, 11, 12]),
    15: ([*range(15)], [0, 1, 3, 4, 6, 7, 9, 10, 12, 13]),
    16: ([*range(15)], [0, 1, 3, 4, 6, 8, 9, 11, 12, 14]),
    29: ([*range(15)], [0, 2, 5, 8, 11, 14, 17, 20, 23, 26]),
    30: ([*range(0, 30, 2)], [*range(0, 30, 3)]),
    100: ([*range(0, 90, 6)], [*range(0, 100, 10)]),
}


def test_frame_plans(spark):
    assert values(spark, "int", list(FRAMES), col.frame_plan) == [a for a, _ in FRAMES.values()]
    assert values(spark, "int", list(FRAMES), col.frame_plan_even) == [b for _, b in FRAMES.values()]


SLICES = {
    (10, 3): [0, 0, 0, 1, 1, 1, 2, 2, 2, 2],
    (2, 5): [4, 4],
    (9, 3): [0, 0, 0, 1, 1, 1, 2, 2, 2],
    (0, 4): [],
    (1, 1): [0],
}


@pytest.mark.parametrize("n,tasks", list(SLICES))
def test_slice_task(spark, n, tasks):
    got = values(spark, "bigint", list(range(n)), lambda v: col.slice_task(v, F.lit(n).cast("bigint"), tasks))
    assert got == SLICES[n, tasks]


def test_parse_day_skips_what_is_no_date(spark):
    texts = ["2024-01-05", "2024-1-5", "not-a-date", "", None, "2024-13-01"]
    got = [str(d) if d else None for d in values(spark, "string", texts, col.parse_day)]
    assert got == ["2024-01-05", "2024-01-05", None, None, None, None]


def test_unsafe_predicate(spark):
    results = [
        [("nsfw", 0.7)],
        [("nsfw", 0.6999), ("normal", 0.9)],
        [("normal", 0.1), ("nsfw", 0.9)],
        [],
        None,
    ]
    got = values(spark, "array<struct<label:string,score:double>>", results, col.unsafe_predicate)
    assert got == [True, False, True, False, False]


def test_blank_and_bool_masks(spark):
    assert values(spark, "array<int>", [[0, 0], [0, 1], []], col.is_blank) == [True, False, True]
    assert values(spark, "array<boolean>", [[True, False]], col.mask_from_bool) == [[255, 0]]
