"""Column expressions shared by the operators. Everything here stays in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from medialoom.functions import fixed_values as fv


def order_hash(seed: object, *keys: Column | str) -> Column:
    """Reproducible shuffle key: the same for any partitioning and on any engine."""
    cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[c.cast("string") for c in cols]))


def hash_number(text: Column, digits: int = 8) -> Column:
    """Whole number from the first hex digits of the md5 of a text."""
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("bigint")


def int_div(a: Column, b: Column | int) -> Column:
    """Whole-number division, null for a zero divisor."""
    b = F.lit(b) if isinstance(b, int) else b
    return F.call_function("div", a, F.nullif(b, F.lit(0)))


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def truthy(c: Column) -> Column:
    """Null for an empty text, so that coalesce takes the next choice."""
    return F.nullif(c, F.lit(""))


def safe_name(model_id: Column) -> Column:
    return F.replace(model_id, F.lit("/"), F.lit("_"))


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def extension(path: Column) -> Column:
    """Last dot and what follows in the last path part; a leading dot starts no extension."""
    return F.regexp_extract(base_name(path), r"^\.*[^.].*?(\.[^.]*)$", 1)


def any_contains(text: Column, words: list[str]) -> Column:
    hits = [F.contains(text, F.lit(w)) for w in words]
    out = hits[0]
    for h in hits[1:]:
        out = out | h
    return out


def any_endswith(text: Column, endings: list[str]) -> Column:
    out = F.endswith(text, F.lit(endings[0]))
    for e in endings[1:]:
        out = out | F.endswith(text, F.lit(e))
    return out


def sanitize_filename(c: Column, max_len: int = fv.MAX_NAME_CHARS) -> Column:
    """Replace characters that no file name may hold, trim, cut, never empty."""
    clean = F.trim(F.regexp_replace(c, fv.UNSAFE_NAME_CHARS, "_"), F.lit(". "))
    cut = F.when(
        F.length(clean) > max_len, F.rtrim(F.substring(clean, 1, max_len), F.lit(". "))
    ).otherwise(clean)
    return F.coalesce(truthy(cut), F.lit("untitled"))


def archive_key(mask_path: Column) -> Column:
    return F.lower(F.substring(mask_path, 1, 1))


def day_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def parse_day(text: Column) -> Column:
    """Date of a text, null where it is none; one-digit months and days are read too."""
    return F.try_to_date(text, "yyyy-M-d")


def strict_json_prompt(response: Column) -> Column:
    """Value of key prompt if the whole text is one strict JSON object, else null.

    Wrapping the text in an array makes the parser refuse anything after the
    object; a second element means that the text held more than one value.
    """
    wrapped = F.try_parse_json(F.concat(F.lit("["), response, F.lit("]")))
    more = F.try_variant_get(wrapped, "$[1]", "variant")
    return F.when(more.isNull(), F.try_variant_get(wrapped, "$[0].prompt", "string"))


def extract_prompt(response: Column) -> Column:
    """Strict JSON value, else the first embedded object, else the raw text."""
    embedded = truthy(F.regexp_extract(response, fv.EMBEDDED_PROMPT_PATTERN, 1))
    return strip(F.coalesce(strict_json_prompt(response), embedded, response))


def unsafe_predicate(
    scores: Column, threshold: float = fv.UNSAFE_THRESHOLD, label: str = fv.UNSAFE_LABEL
) -> Column:
    """True where some element has the label and at least the score."""
    return F.coalesce(
        F.exists(scores, lambda s: (s["label"] == label) & (s["score"] >= threshold)),
        F.lit(False),
    )


def frame_plan(total: Column, n: int = fv.POST_FRAMES) -> Column:
    """n frame numbers with a whole step; the last frame repeats in short videos."""
    step = F.greatest(F.lit(1), int_div(total, n).cast("int"))
    frames = F.transform(
        F.sequence(F.lit(0), F.lit(n - 1)),
        lambda i: F.least(i * step, (total - 1).cast("int")),
    )
    return F.when(total > 0, frames).otherwise(F.array().cast("array<int>"))


def frame_plan_even(total: Column, n: int = fv.GENERATED_FRAMES) -> Column:
    """Up to n frame numbers with a fractional step, none beyond the end."""
    step = F.greatest(F.lit(1.0), total.cast("double") / F.lit(float(n)))
    frames = F.transform(
        F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.floor(i * step).cast("int")
    )
    return F.filter(frames, lambda f: f < total)


def slice_task(index: Column, total: Column, tasks: int | Column) -> Column:
    """Task of a position when rows are cut into equal runs and the last takes the rest."""
    tasks = F.lit(tasks) if isinstance(tasks, int) else tasks
    per = int_div(total, tasks)
    last = (tasks - 1).cast("bigint")
    return F.when(per == 0, last).otherwise(F.least(int_div(index, per), last))


def mask_from_bool(cells: Column) -> Column:
    return F.transform(cells, lambda x: F.when(x, F.lit(255)).otherwise(F.lit(0)))


def is_blank(pixels: Column) -> Column:
    return ~F.exists(pixels, lambda x: x != 0)
