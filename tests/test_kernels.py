"""Pixel kernels on plain numpy arrays (no Spark)."""

import os

import numpy as np
import pytest

from framelake.operators import kernels as K

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_scales_match_linspace_and_golden_geometry():
    assert np.array_equal(K.scales(), np.linspace(0.8, 2.0, 25))
    # template 90 wide x 127 high at scale index 16 (1.6) -> 144 x 203
    dims = {ix: (sh, sw) for ix, sh, sw in K.scaled_dims(127, 90)}
    assert dims[16] == (203, 144)


def test_resize_identity_and_formula():
    rng = np.random.default_rng(0)
    img = rng.integers(0, 256, (7, 9), dtype=np.uint8)
    assert np.array_equal(K.resize_bilinear(img, 7, 9), img)
    out = K.resize_bilinear(img, 5, 13, to_uint8=False)
    # direct evaluation of the half-pixel-centre rule for one output pixel
    oy, ox = 3, 10
    fy = (oy + 0.5) * 7 / 5 - 0.5
    fx = (ox + 0.5) * 9 / 13 - 0.5
    y0, x0 = int(np.floor(fy)), int(np.floor(fx))
    ay, ax = fy - y0, fx - x0
    p = img.astype(float)
    v = (1 - ay) * ((1 - ax) * p[y0, x0] + ax * p[y0, x0 + 1]) + ay * ((1 - ax) * p[y0 + 1, x0] + ax * p[y0 + 1, x0 + 1])
    assert out[oy, ox] == pytest.approx(v, abs=1e-12)


def test_fft_scores_equal_direct_integer_formula():
    rng = np.random.default_rng(1)
    frame = rng.integers(0, 256, (30, 41, 3), dtype=np.uint8)
    pyr = K.TemplatePyramid(frame[4:11, 6:15].copy())
    fs = K._FrameStats(frame)
    for k, lv in enumerate(pyr.levels[:6]):
        direct = K.match_scores(frame, lv[3].astype(np.uint8))
        fft = K._level_scores(fs, lv, pyr.spectrum(k, fs.ph, fs.pw))
        assert np.array_equal(direct, fft)


@pytest.mark.parametrize("scale_ix", [0, 4, 12, 20])
def test_planted_logo_found_at_known_place_and_scale(scale_ix):
    rng = np.random.default_rng(scale_ix)
    tpl = rng.integers(0, 256, (12, 16, 3), dtype=np.uint8)
    frame = rng.integers(0, 256, (90, 120, 3), dtype=np.uint8)
    sc = K.scales()
    size = lambda i: (int(12 * sc[i]), int(16 * sc[i]))
    sh, sw = size(scale_ix)
    first_ix = min(i for i in range(25) if size(i) == (sh, sw))   # equal sizes: earliest scale wins
    frame[30:30 + sh, 50:50 + sw] = K.resize_bilinear(tpl, sh, sw)
    det = K.detect(frame, K.TemplatePyramid(tpl))
    assert det["detected"] and det["confidence"] > 0.97
    assert (det["x"], det["y"], det["w"], det["h"], det["scale_ix"]) == (50, 30, sw, sh, first_ix)


def test_no_logo_and_flat_frames():
    rng = np.random.default_rng(5)
    tpl = rng.integers(0, 256, (6, 6), dtype=np.uint8)
    flat = np.full((40, 40), 77, dtype=np.uint8)
    det = K.detect(flat, K.TemplatePyramid(tpl))
    assert det["confidence"] == 0.0 and not det["detected"] and det["x"] is None
    noise = rng.integers(0, 256, (40, 40), dtype=np.uint8)
    s = K.match_scores(noise, tpl)
    assert np.all(np.isfinite(s)) and s.max() <= 1.0 + 1e-12 and s.min() >= -1.0 - 1e-12


def test_template_larger_than_frame_is_skipped():
    tpl = np.arange(100, dtype=np.uint8).reshape(10, 10)
    det = K.detect(np.zeros((6, 6), dtype=np.uint8), K.TemplatePyramid(tpl))
    assert not det["detected"]


def test_blend_alpha_rules_and_edge_crop():
    rng = np.random.default_rng(2)
    frame = rng.integers(0, 256, (20, 20, 3), dtype=np.uint8)
    opaque = np.dstack([np.full((4, 4, 3), 9, np.uint8), np.full((4, 4), 255, np.uint8)])
    clear = opaque.copy()
    clear[:, :, 3] = 0
    out = K.blend(frame, opaque, 2, 3, 4, 4)
    assert np.all(out[3:7, 2:6] == 9)                       # alpha 1 overwrites
    mask = np.ones((20, 20), bool)
    mask[3:7, 2:6] = False
    assert np.array_equal(out[mask], frame[mask])           # outside unchanged
    assert np.array_equal(K.blend(frame, clear, 2, 3, 4, 4), frame)   # alpha 0 is identity
    edge = K.blend(frame, opaque, 18, 17, 4, 4)              # crosses right/bottom edge: cropped
    assert np.all(edge[17:20, 18:20] == 9) and edge.shape == frame.shape
    half = opaque.copy()
    half[:, :, 3] = 128
    hb = K.blend(frame, half, 0, 0, 4, 4)
    a = 128 / 255.0
    assert np.array_equal(hb[0:4, 0:4], np.floor((1 - a) * frame[0:4, 0:4] + a * 9).astype(np.uint8))


def test_annotate_draws_two_pixel_outline():
    f = np.zeros((20, 20, 3), np.uint8)
    out = K.annotate(f, 5, 5, 6, 6)
    assert tuple(out[5, 5]) == (0, 255, 0) and tuple(out[6, 8]) == (0, 255, 0)
    assert tuple(out[8, 8]) == (0, 0, 0)          # interior untouched
    assert tuple(out[11, 11]) == (0, 255, 0)      # far corner (x+w, y+h) inclusive


def test_threaded_detection_equals_serial():
    rng = np.random.default_rng(9)
    frames = [rng.integers(0, 256, (40, 50, 3), dtype=np.uint8) for _ in range(3)]
    frames.append(np.full((40, 50, 3), 7, np.uint8))
    tpl = frames[0][10:16, 20:28].copy()
    frames[1][3:9, 4:12] = tpl                               # an exact copy elsewhere: a tie on score
    pyr = K.TemplatePyramid(tpl)
    assert K.detect_batch(frames, pyr, threads=4) == K.detect_batch(frames, pyr, threads=1)


def test_blend_keeps_the_frames_own_alpha():
    frame = np.full((4, 4, 4), 58, np.uint8)
    frame[:, :, 3] = 77
    logo = np.full((2, 2, 4), 255, np.uint8)
    logo[:, :, :3] = (58, 143, 63)
    out = K.blend(frame, logo, 1, 1, 2, 2)
    assert out[1, 1].tolist() == [58, 143, 63, 77] and out[0, 0].tolist() == [58, 58, 58, 77]
    grey = np.full((4, 4), 9, np.uint8)
    with pytest.raises(ValueError):
        K.blend(grey, logo, 0, 0, 2, 2)
    both = np.dstack([np.full((2, 2), 200, np.uint8), np.full((2, 2), 255, np.uint8)])
    assert K.blend(frame, both, 0, 0, 2, 2)[0, 0].tolist() == [200, 200, 200, 77]


def test_detection_drops_frame_alpha_and_refuses_other_channels():
    rng = np.random.default_rng(4)
    bgr = rng.integers(0, 256, (12, 12, 3), dtype=np.uint8)
    pyr = K.TemplatePyramid(bgr[3:8, 4:9].copy())
    want = K.detect(bgr, pyr)
    assert want["detected"] and (want["x"], want["y"]) == (4, 3)
    alpha = rng.integers(0, 256, (12, 12), dtype=np.uint8)
    assert K.detect(np.dstack([bgr, alpha]), pyr) == want
    assert K.best_in_levels(np.dstack([bgr, alpha]), pyr, [0])[0] == K.best_in_levels(bgr, pyr, [0])[0]
    with pytest.raises(ValueError):
        K.detect(bgr[:, :, 0], pyr)


@pytest.mark.parametrize("box", [(2, 3, 4, 5), (0, 0, 11, 9), (8, 7, 6, 6), (3, 3, 1, 0), (5, 5, 2, 2)])
@pytest.mark.parametrize("thickness", [1, 2, 5])
def test_annotated_pixels_are_those_near_the_box_edge(box, thickness):
    x, y, w, h = box
    f = np.zeros((10, 12, 3), np.uint8)
    yy, xx = np.mgrid[0:10, 0:12]
    inside = (xx >= x) & (xx <= x + w) & (yy >= y) & (yy <= y + h)
    border = inside & ((xx - x < thickness) | (x + w - xx < thickness)
                       | (yy - y < thickness) | (y + h - yy < thickness))
    assert np.array_equal(K.annotate(f, x, y, w, h, thickness)[:, :, 1] == 255, border)


@pytest.mark.parametrize("shape", [(41, 67), (64, 64), (90, 31)])
def test_tiles_answer_like_the_whole_frame(shape, monkeypatch):
    """Tiles far smaller than the frame: same scores, same places, same ties."""
    rng = np.random.default_rng(sum(shape))
    frame = rng.integers(0, 4, (*shape, 3), dtype=np.uint8)
    frame[-12:, -14:] = frame[2:14, 3:17]                       # the same patch twice
    tmpl = frame[4:9, 5:12].copy()
    whole = K.detect(frame, K.TemplatePyramid(tmpl))
    for tile in (12, 17, 23):
        for budget in (1 << 30, 1):                             # spectra cached, or built for each frame
            monkeypatch.setattr(K, "TILE_H", tile)
            monkeypatch.setattr(K, "TILE_W", tile + 3)
            monkeypatch.setattr(K, "SPECTRA_CACHE_BYTES", budget)
            pyr = K.TemplatePyramid(tmpl)
            assert K.detect(frame, pyr) == whole
            assert K.detect_batch([frame, frame], pyr, threads=3) == [whole, whole]
            fs = K._FrameStats(frame)
            for k, (v, y, x) in K.best_by_level(frame, pyr, range(len(pyr.levels))).items():
                scores = K._level_scores(fs, pyr.levels[k], pyr.spectrum(k, fs.ph, fs.pw))
                assert v == scores.max() and (y, x) == tuple(np.argwhere(scores == v)[0])


def test_tiles_cover_every_position_once():
    for n, template, tile in ((1080, 180, 384), (1920, 254, 512), (50, 50, 384), (700, 300, 384), (512, 9, 512)):
        size, tiles = K.tile_axis(n, template, tile)
        for h in {1, template // 2 or 1, template}:
            seen = []
            for start, step in tiles:
                valid = min(size, n - start) - h + 1
                assert valid > 0
                seen += range(start, start + min(step or valid, valid))
            assert seen == list(range(n - h + 1))


def test_a_1080p_worker_stays_below_300_mb():
    """Peak of a process with the libraries of a Python worker."""
    import subprocess
    import sys
    code = ("import re, numpy as np, pandas, pyarrow\n"
            "from framelake.operators import kernels as K\n"
            "rng = np.random.default_rng(0)\n"
            "f = [rng.integers(0, 256, (1080, 1920, 3), dtype=np.uint8) for _ in range(2)]\n"
            "K.detect_batch(f, K.TemplatePyramid(f[0][67:157, 1600:1727].copy()))\n"
            "print(int(re.search('VmHWM:\\\\s+([0-9]+)', open('/proc/self/status').read())[1]) // 1024)")
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=ROOT, check=True)
    assert int(out.stdout) < 300
