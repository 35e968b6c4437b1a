"""The flagship on frame rows, and the relational twins with logos of real size."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from framelake.operators import kernels as K
from framelake.operators import pixels as PX
from framelake.plans.logo_job import replace_logo_summary

FRAME = "video_id long, frame_no long, data binary, height int, width int, nChannels int"


def frame_rows(spark, frames):
    rows = [(v, n, img.tobytes(), img.shape[0], img.shape[1], 1 if img.ndim == 2 else img.shape[2]) for v, n, img in frames]
    return spark.createDataFrame(rows, FRAME)


def pixel_rows(spark, frames):
    parts = []
    for v, n, img in frames:
        y, x = np.indices(img.shape).reshape(2, -1)
        parts.append(pd.DataFrame({"video_id": v, "frame_no": n, "y": y, "x": x, "v": img.ravel().astype(np.int64)}))
    return spark.createDataFrame(pd.concat(parts), "video_id long, frame_no long, y int, x int, v long")


@pytest.fixture(scope="module")
def logo():
    """The published size: 90 wide and 127 high, with alpha."""
    return np.random.default_rng(1).integers(0, 256, (127, 90, 4), dtype=np.uint8)


@pytest.mark.parametrize("channels", [1, 3])
def test_summary_of_a_run_with_a_real_logo(spark, logo, channels):
    rng = np.random.default_rng(channels)
    shape = (300, 260, 3) if channels == 3 else (300, 260)
    tpl = rng.integers(0, 256, (127, 90, *shape[2:]), dtype=np.uint8)
    frames = [(v, n, rng.integers(0, 256, shape, dtype=np.uint8)) for v in (1, 2, None) for n in range(3)]
    for v, n, img in frames:
        if v != 2:                                    # video 2 shows no logo in its first frame
            img[40:167, 150:240] = tpl
    new = logo if channels == 3 else logo[:, :, [0, 3]]
    got = {r.video_id: r for r in replace_logo_summary(frame_rows(spark, frames), tpl, new, threshold=0.9).collect()}
    assert set(got) == {1, 2, None}
    for v in (1, 2, None):
        mine = [img for w, _, img in frames if w == v]
        d = K.detect(mine[0], K.TemplatePyramid(tpl), 0.9)
        out = [K.blend(img, new, d["x"], d["y"], d["w"], d["h"]) if d["detected"] else img for img in mine]
        assert d["detected"] == (v != 2)
        changed = sum(int((a != b).reshape(300, 260, -1).any(axis=2).sum()) for a, b in zip(mine, out))
        r = got[v]
        assert (r.n_frames, r.n_detected, r.confidence) == (3, 0 if v == 2 else 3, d["confidence"])
        assert r.n_changed == changed and r.mean_out == float(np.mean([o.astype(float) for o in out]))


def test_pixel_twins_take_a_logo_of_real_size(spark, logo):
    """Blending on pixel rows at 25 scales of 127 x 90: 600,000 logo pixels."""
    rng = np.random.default_rng(5)
    img = rng.integers(0, 256, (160, 120), dtype=np.uint8)
    boxes = spark.createDataFrame([(1, True, 20, 30, 90, 127)], "video_id long, detected boolean, x int, y int, w int, h int")
    grey = logo[:, :, [0, 3]].copy()
    got = PX.blend_pixels(pixel_rows(spark, [(1, 1, img)]), boxes, grey, (127, 90)).toPandas()
    out = np.zeros_like(img)
    out[got["y"], got["x"]] = got["v"]
    assert (out == K.blend(img, grey, 20, 30, 90, 127)).all()


def test_pixel_twin_detects_like_the_kernel(spark):
    rng = np.random.default_rng(6)
    tpl = rng.integers(0, 256, (9, 13), dtype=np.uint8)
    frames = [(1, n, rng.integers(0, 256, (30, 34), dtype=np.uint8)) for n in range(3)]
    frames[1][2][5:14, 11:24] = tpl
    frames.append((1, 3, rng.integers(0, 256, (10, 34), dtype=np.uint8)))       # most levels do not fit
    for group in (frames[:3], frames[3:]):
        h, w = group[0][2].shape
        got = PX.detect_pixels(pixel_rows(spark, group), tpl, F.lit(h), F.lit(w)).collect()
        for r in got:
            want = K.detect([f for _, n, f in group if n == r.frame_no][0], K.TemplatePyramid(tpl))
            assert {k: r[k] for k in want} == want


def test_load_param_image(spark):
    img = np.random.default_rng(7).integers(0, 256, (600, 500), dtype=np.uint8)      # beyond the bound of old
    assert (PX.load_param_image(pixel_rows(spark, [(1, 1, img)])) == img).all()
    with pytest.raises(ValueError, match="bound"):
        PX.load_param_image(spark.range(PX.MAX_PARAM_PIXELS + 1).selectExpr("0 AS y", "id AS x", "1 AS v"))
