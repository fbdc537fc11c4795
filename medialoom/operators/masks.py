"""Masks: drawn parameters as SQL columns, pixel work as numpy in Arrow batches.

A mask is a row (path, height, width, data) with one byte per pixel. Every random
choice comes from a hash of the path, so a rerun draws the same.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medialoom.functions import fixed_values as fv
from medialoom.functions.columns import hash_number
from medialoom.operators.sampling import hash_sample

KERNELS = ["ellipse", "rect", "cross"]


def _draw(seed: object, name: str, key: str) -> Column:
    return hash_number(F.concat_ws("|", F.lit(str(seed)), F.lit(name), F.col(key)))


def _unit(seed: object, name: str, key: str) -> Column:
    return _draw(seed, name, key) / F.lit(2.0**32)


def _choice(options: list, number: Column) -> Column:
    listed = F.array(*[F.lit(o) for o in options])
    return F.get(listed, F.pmod(number, F.lit(len(options))).cast("int"))


def dilation_parameters(
    masks: DataFrame, profile: str = "job", seed: object = 42, key: str = "path"
) -> DataFrame:
    """Columns kernel, kernel_width, kernel_height, rounds, blur and threshold.

    ``job`` is the choice made when images are repainted, ``once`` the one made when
    masks are expanded ahead, ``preview`` the plain form of the latter.
    """
    side = F.least("height", "width")
    kernel = _choice(KERNELS, _draw(seed, "kernel", key))
    if profile == "job":
        low, high = (F.floor(side * share) for share in fv.JOB_SHARE)
        pixels = F.greatest(F.lit(fv.JOB_LEAST_PIXELS), low + F.pmod(_draw(seed, "size", key), high - low + 1))
        soft = F.pmod(_draw(seed, "soft", key), F.lit(2)) == 0
        blur = F.when(soft, _choice(fv.JOB_BLURS, _draw(seed, "blur", key))).otherwise(0)
        height_change, rounds, threshold = F.lit(0), F.lit(1), F.lit(fv.THRESHOLD)
    else:
        least, most = fv.ONCE_SHARE
        share = F.lit(least) + F.lit(most - least) * _unit(seed, "size", key)
        fewest, limit = fv.ONCE_PIXELS
        pixels = F.greatest(F.lit(fewest), F.least(F.floor(side * share), F.lit(limit)))
        blur, height_change, rounds = F.lit(0), F.lit(0), F.lit(1)
        threshold = F.lit(fv.THRESHOLD)
        if profile == "once":
            change = fv.ONCE_HEIGHT_CHANGE
            height_change = F.pmod(_draw(seed, "height", key), F.lit(2 * change + 1)) - change
            rounds = F.when(_unit(seed, "rounds", key) < fv.ONCE_SINGLE_ROUND, 1).otherwise(2)
            edge, soft_from = _unit(seed, "edge", key), fv.ONCE_SHARP + fv.ONCE_SLIGHT
            slight = (edge >= fv.ONCE_SHARP) & (edge < soft_from)
            moderate = edge >= soft_from
            number = _draw(seed, "blur", key)
            blur = (
                F.when(slight, _choice(fv.SLIGHT_BLURS, number))
                .when(moderate, _choice(fv.MODERATE_BLURS, number))
                .otherwise(0)
            )
            threshold = F.when(moderate, fv.MODERATE_THRESHOLD).otherwise(fv.THRESHOLD)
    width = pixels * 2 + 1
    return masks.withColumns(
        {
            "kernel": kernel,
            "kernel_width": width.cast("int"),
            "kernel_height": F.greatest(F.lit(3), width + height_change).cast("int"),
            "rounds": rounds.cast("int"),
            "blur": blur.cast("int"),
            "threshold": threshold.cast("int"),
        }
    )


def fixed_parameters(
    masks: DataFrame, kernel: str, pixels: int, rounds: int = 1, blur: int = 0
) -> DataFrame:
    """The same parameters for every mask."""
    side = F.lit(2 * pixels + 1)
    return masks.withColumns(
        {
            "kernel": F.lit(kernel),
            "kernel_width": side,
            "kernel_height": side,
            "rounds": F.lit(rounds),
            "blur": F.lit(blur),
            "threshold": F.lit(fv.THRESHOLD),
        }
    )


# --- pixel work on one mask -------------------------------------------------


def kernel_spans(kind: str, width: int, height: int) -> list[tuple[int, int, int]]:
    """(dy, first dx, last dx) of every kernel row around its centre."""
    cx, cy = width // 2, height // 2
    full = (-cx, width - 1 - cx)
    spans = []
    for row in range(height):
        dy = row - cy
        if kind == "rect" or (kind == "cross" and dy == 0):
            spans.append((dy, *full))
        elif kind == "cross":
            spans.append((dy, 0, 0))
        elif abs(dy) <= cy:
            reach = int(np.rint(cx * np.sqrt(max(cy * cy - dy * dy, 0)) / cy)) if cy else cx
            spans.append((dy, max(-reach, full[0]), min(reach, full[1])))
    return spans


def _shift(pixels: np.ndarray, by: int, axis: int) -> np.ndarray:
    """Pixel i takes what stood at i + by; zero beyond the border."""
    out = np.zeros_like(pixels)
    n = pixels.shape[axis]
    if abs(by) < n:
        here, there = [slice(None)] * 2, [slice(None)] * 2
        here[axis] = slice(max(-by, 0), n - max(by, 0))
        there[axis] = slice(max(by, 0), n - max(-by, 0))
        out[tuple(here)] = pixels[tuple(there)]
    return out


def _window_max(pixels: np.ndarray, first: int, last: int) -> np.ndarray:
    """Largest value at offsets first..last in each row, by doubling the window."""
    out, size, width = pixels, 1, last - first + 1
    while size < width:
        step = min(size, width - size)
        out = np.maximum(out, _shift(out, step, 1))
        size += step
    if first >= 0:
        return _shift(out, first, 1)
    # windows that begin left of the border hold what lies inside it
    padded = np.pad(pixels, ((0, 0), (-first, 0)))
    out, size = padded, 1
    while size < width:
        step = min(size, width - size)
        out = np.maximum(out, _shift(out, step, 1))
        size += step
    return out[:, : pixels.shape[1]]


def dilate(pixels: np.ndarray, kind: str, width: int, height: int) -> np.ndarray:
    """Largest value under the kernel at every pixel."""
    out, rows = np.zeros_like(pixels), {}
    for dy, first, last in kernel_spans(kind, width, height):
        if (first, last) not in rows:
            rows[first, last] = _window_max(pixels, first, last)
        np.maximum(out, _shift(rows[first, last], dy, 0), out=out)
    return out


# weights of small Gaussian windows; wider ones follow from the formula below
SMALL_WINDOWS = {
    3: [0.25, 0.5, 0.25],
    5: [0.0625, 0.25, 0.375, 0.25, 0.0625],
    7: [0.03125, 0.109375, 0.21875, 0.28125, 0.21875, 0.109375, 0.03125],
}


def blur_weights(size: int) -> np.ndarray:
    if size in SMALL_WINDOWS:
        return np.array(SMALL_WINDOWS[size])
    sigma = 0.3 * ((size - 1) * 0.5 - 1) + 0.8
    w = np.exp(-((np.arange(size) - size // 2) ** 2) / (2 * sigma**2))
    return w / w.sum()


def blur_and_cut(pixels: np.ndarray, size: int, threshold: int) -> np.ndarray:
    """Gaussian blur with mirrored borders, rounded, then 255 above the threshold."""
    weights, half = blur_weights(size), size // 2
    soft = pixels.astype(np.float64)
    for axis in (0, 1):
        mode = "reflect" if pixels.shape[axis] > half else "edge"
        pad = [(0, 0), (0, 0)]
        pad[axis] = (half, half)
        wide = np.pad(soft, pad, mode=mode)
        n = pixels.shape[axis]
        soft = sum(w * np.take(wide, range(i, i + n), axis=axis) for i, w in enumerate(weights))
    return np.where(np.floor(soft + 0.5) > threshold, 255, 0).astype(np.uint8)


def resize_nearest(pixels: np.ndarray, height: int, width: int) -> np.ndarray:
    """Nearest pixel of the centre of every target pixel."""
    h, w = pixels.shape
    rows = ((np.arange(height) + 0.5) * h / height).astype(int)
    cols = ((np.arange(width) + 0.5) * w / width).astype(int)
    return pixels[rows][:, cols]


def _grid(data: bytes, height: int, width: int) -> np.ndarray:
    return np.frombuffer(data, dtype=np.uint8).reshape(height, width)


def dilate_masks(masks: DataFrame) -> DataFrame:
    """Dilated masks, with ok and info per mask; a bad mask is reported, not fatal."""
    kept = [f for f in masks.schema.fields if f.name != "data"]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)

    def one(m) -> tuple:
        try:
            pixels = _grid(m.data, m.height, m.width)
            for _ in range(m.rounds):
                pixels = dilate(pixels, m.kernel, m.kernel_width, m.kernel_height)
            if m.blur:
                pixels = blur_and_cut(pixels, m.blur, m.threshold)
            return pixels.tobytes(), True, f"kernel={m.kernel} width={m.kernel_width} rounds={m.rounds} blur={m.blur}"
        except (ValueError, TypeError) as error:
            return None, False, str(error)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            done = [one(m) for m in frame.itertuples(index=False)]
            out = frame[[f.name for f in kept]].copy()
            out["data"], out["ok"], out["info"] = (list(c) for c in zip(*done)) if done else ([], [], [])
            yield out

    return masks.mapInPandas(run, f"{fields}, data binary, ok boolean, info string")


def fit_masks(masks: DataFrame) -> DataFrame:
    """Masks resized to image_height and image_width where the sizes differ."""
    kept = [f for f in masks.schema.fields if f.name not in ("data", "height", "width")]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = frame[[f.name for f in kept]].copy()
            out["height"], out["width"] = frame["image_height"], frame["image_width"]
            out["data"] = [
                resize_nearest(_grid(m.data, m.height, m.width), m.image_height, m.image_width).tobytes()
                for m in frame.itertuples(index=False)
            ]
            yield out

    return masks.mapInPandas(run, f"{fields}, height int, width int, data binary")


def preview_dilation(masks: DataFrame, n: int, seed: object = 42) -> DataFrame:
    """Before and after of n sampled masks with a square kernel and one pass."""
    chosen = hash_sample(masks, ["path"], n, seed)
    drawn = dilation_parameters(chosen.withColumn("before", F.col("data")), "preview", seed)
    return dilate_masks(drawn).select(
        "path", "height", "width", "before", F.col("data").alias("after")
    )


def set_pixels(masks: DataFrame) -> DataFrame:
    """One row (path, y, x) per pixel that is not zero."""

    @F.pandas_udf("array<int>")
    def places(data: pd.Series) -> pd.Series:
        return pd.Series([None if d is None else np.flatnonzero(np.frombuffer(d, np.uint8)) for d in data])

    lit = masks.select("path", "width", F.explode(places("data")).alias("i"))
    return lit.select(
        "path",
        F.call_function("div", F.col("i"), F.col("width")).cast("int").alias("y"),
        F.pmod("i", "width").alias("x"),
    )


def blank_frames(frames: DataFrame) -> DataFrame:
    """Frames with a flag that tells whether every byte is zero."""
    zeros = F.repeat(F.lit("\0"), F.octet_length("data")).cast("binary")
    return frames.withColumn("blank", F.col("data") == zeros)


def png_bytes(data: bytes, height: int, width: int) -> bytes:
    """Grey 8-bit PNG file of one mask."""
    rows = _grid(data, height, width)
    raw = b"".join(b"\x00" + r.tobytes() for r in rows)

    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    head = struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0)
    return (
        b"\x89PNG\r\n\x1a\n"
        + chunk(b"IHDR", head)
        + chunk(b"IDAT", zlib.compress(raw))
        + chunk(b"IEND", b"")
    )


def encode_png(masks: DataFrame) -> DataFrame:
    """Column ``png`` with the file content of each mask."""

    @F.pandas_udf("binary")
    def encode(data: pd.Series, height: pd.Series, width: pd.Series) -> pd.Series:
        return pd.Series([png_bytes(d, h, w) for d, h, w in zip(data, height, width)])

    return masks.withColumn("png", encode("data", "height", "width"))
