import numpy as np
import pytest
from pyspark.sql import functions as F

from medialoom.operators import masks as ops
from medialoom.operators.scoring import failures, transform_report


def kernel_grid(kind, width, height):
    grid = np.zeros((height, width), bool)
    for dy, first, last in ops.kernel_spans(kind, width, height):
        grid[dy + height // 2, first + width // 2 : last + width // 2 + 1] = True
    return grid


def brute_dilate(pixels, grid):
    h, w = pixels.shape
    out = np.zeros_like(pixels)
    cy, cx = grid.shape[0] // 2, grid.shape[1] // 2
    for y in range(h):
        for x in range(w):
            for ky, kx in zip(*np.nonzero(grid)):
                sy, sx = y + ky - cy, x + kx - cx
                if 0 <= sy < h and 0 <= sx < w:
                    out[y, x] = max(out[y, x], pixels[sy, sx])
    return out


@pytest.mark.parametrize("kind", ["ellipse", "rect", "cross"])
@pytest.mark.parametrize("size", [(3, 3), (7, 7), (11, 8), (11, 14), (5, 30)])
def test_dilate_against_brute_force(kind, size):
    random = np.random.default_rng(7)
    pixels = np.where(random.random((13, 17)) < 0.04, random.integers(1, 255, (13, 17)), 0).astype(np.uint8)
    assert np.array_equal(ops.dilate(pixels, kind, *size), brute_dilate(pixels, kernel_grid(kind, *size)))


def test_known_kernels():
    assert kernel_grid("ellipse", 5, 5).astype(int).tolist() == [
        [0, 0, 1, 0, 0], [1, 1, 1, 1, 1], [1, 1, 1, 1, 1], [1, 1, 1, 1, 1], [0, 0, 1, 0, 0]
    ]
    assert kernel_grid("cross", 3, 3).astype(int).tolist() == [[0, 1, 0], [1, 1, 1], [0, 1, 0]]


def test_blur_keeps_full_and_empty_masks_and_binary_values():
    for size in (3, 5, 7, 9):
        assert abs(ops.blur_weights(size).sum() - 1) < 1e-12
        assert ops.blur_and_cut(np.full((6, 9), 255, np.uint8), size, 127).min() == 255
        assert ops.blur_and_cut(np.zeros((6, 9), np.uint8), size, 100).max() == 0
        one = np.zeros((9, 9), np.uint8)
        one[4, 4] = 255
        assert ops.blur_and_cut(one, size, 127).max() == 0  # a single pixel melts away


def test_resize_nearest():
    pixels = np.arange(6, dtype=np.uint8).reshape(2, 3)
    assert ops.resize_nearest(pixels, 4, 6).tolist() == np.repeat(np.repeat(pixels, 2, 0), 2, 1).tolist()
    assert ops.resize_nearest(pixels, 1, 1).tolist() == [[4]]


def mask(height, width, at=()):
    pixels = np.zeros((height, width), np.uint8)
    for y, x in at:
        pixels[y, x] = 255
    return bytearray(pixels.tobytes())


@pytest.fixture
def masks(spark):
    data = [
        ("zero", 20, 20, mask(20, 20)), ("inner", 20, 20, mask(20, 20, [(10, 10)])),
        ("corner", 20, 20, mask(20, 20, [(0, 0)])), ("row", 1, 30, mask(1, 30, [(0, 5)])),
        ("small", 100, 120, mask(100, 120, [(50, 50)])), ("large", 900, 1000, mask(900, 1000, [(500, 500)])),
        ("broken", 9, 9, bytearray(b"xx")),
    ]
    return spark.createDataFrame(data, "path string, height int, width int, data binary")


def test_parameters(masks):
    job = {r.path: r for r in ops.dilation_parameters(masks, "job").collect()}
    assert job["small"].kernel_width in range(7, 18) and job["row"].kernel_width == 7
    assert job["large"].kernel_width in range(2 * 18 + 1, 2 * 72 + 2)
    once = {r.path: r for r in ops.dilation_parameters(masks, "once").collect()}
    assert once["row"].kernel_width == 11 and abs(once["row"].kernel_height - 11) <= 3
    assert 2 * 27 + 1 <= once["large"].kernel_width <= 2 * 80 + 1
    assert {r.rounds for r in once.values()} <= {1, 2}
    assert all(r.blur in (0, 3, 5, 7, 9) and r.threshold in (127, 100) for r in once.values())
    huge = masks.limit(1).withColumns({"height": F.lit(5000), "width": F.lit(5000)})
    assert ops.dilation_parameters(huge, "once").first().kernel_width == 161


@pytest.mark.parametrize("profile", ["job", "once"])
def test_jobs_report_broken_masks(masks, profile):
    done = ops.dilate_masks(ops.dilation_parameters(masks.repartition(3), profile)).cache()
    assert transform_report(done).first().asDict() == {"succeeded": 6, "failed": 1, "total": 7}
    assert [r.path for r in failures(done).collect()] == ["broken"]
    area = {r.path: sum(1 for b in r.data if b) for r in done.filter("ok").collect()}
    assert area["zero"] == 0 and area["inner"] > 1 and area["large"] > 100
    drawn = {r.path: r for r in ops.dilation_parameters(masks, profile).collect()}
    for name in ("inner", "corner"):
        p = drawn[name]
        pixels = np.frombuffer(dict(masks.select("path", "data").collect())[name], np.uint8).reshape(20, 20)
        for _ in range(p.rounds):
            pixels = brute_dilate(pixels, kernel_grid(p.kernel, p.kernel_width, p.kernel_height))
        if p.blur:
            pixels = ops.blur_and_cut(pixels, p.blur, p.threshold)
        assert area[name] == int((pixels > 0).sum())


def test_preview_leaves_the_masks_alone(masks):
    shown = ops.preview_dilation(masks.filter("path <> 'broken'"), 3).collect()
    assert len(shown) == 3
    for r in shown:
        before, after = (np.frombuffer(b, np.uint8) for b in (r.before, r.after))
        assert (after >= before).all()


def test_fit_set_and_blank(masks):
    fitted = ops.fit_masks(
        masks.filter("path in ('inner', 'zero')").withColumns({"image_height": F.lit(40), "image_width": F.lit(20)})
    )
    assert {(r.y, r.x) for r in ops.set_pixels(fitted).collect()} == {(20, 10), (21, 10)}
    blank = {r.path: r.blank for r in ops.blank_frames(masks).collect()}
    assert blank["zero"] and not blank["inner"]
