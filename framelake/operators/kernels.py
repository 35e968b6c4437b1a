"""Pure numpy pixel kernels, run inside Arrow batches (``mapInPandas``).

No Spark here: these functions are unit-testable on plain arrays and are the
per-batch work of the distributed pixel operators in
:mod:`framelake.operators.pixels`.

Conventions: images are ``uint8`` arrays ``(H, W)`` or ``(H, W, C)`` in BGR(A)
order; results that go back to uint8 are rounded half-up after resizing and
truncated after blending, exactly as the SQL twins compute them.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

# Fixed values of the multi-scale search (see functions.scalars).
SCALE_MIN, SCALE_MAX, N_SCALES = 0.8, 2.0, 25
DEFAULT_THRESHOLD = 0.3


def scales() -> np.ndarray:
    """The 25 scales, evenly spaced from 0.8 to 2.0."""
    return np.linspace(SCALE_MIN, SCALE_MAX, N_SCALES)


def scaled_dims(h: int, w: int) -> list[tuple[int, int, int]]:
    """``(scale_ix, sh, sw)`` for every distinct scaled size, first index wins."""
    out, seen = [], set()
    for i, s in enumerate(scales()):
        sw, sh = int(w * s), int(h * s)
        if (sh, sw) not in seen and sh > 0 and sw > 0:
            seen.add((sh, sw))
            out.append((i, sh, sw))
    return out


def _axis(n_in: int, n_out: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Half-pixel-centre sampling: lower index, upper index, weight of upper."""
    f = (np.arange(n_out, dtype=np.float64) + 0.5) * (float(n_in) / float(n_out)) - 0.5
    i0 = np.floor(f)
    a = f - i0
    low = i0 < 0
    i0[low], a[low] = 0, 0.0
    high = i0 >= n_in - 1
    i0[high], a[high] = n_in - 1, 0.0
    i0 = i0.astype(np.int64)
    i1 = np.minimum(i0 + 1, n_in - 1)
    return i0, i1, a


def resize_bilinear(img: np.ndarray, out_h: int, out_w: int, to_uint8: bool = True) -> np.ndarray:
    """Bilinear resize (half-pixel centres, edge clamp), any channel count.

    Separable evaluation of ``(1-ay)*((1-ax)*p00 + ax*p01) + ay*((1-ax)*p10 + ax*p11)``:
    the x-interpolation is done once per *source* row, then rows are mixed —
    the same operations in the same order as the four-neighbour formula, so
    the result is bit-identical to it (and to the SQL twin)."""
    src = img.astype(np.float64)
    y0, y1, ay = _axis(src.shape[0], out_h)
    x0, x1, ax = _axis(src.shape[1], out_w)
    tail = (1,) * (src.ndim - 2)
    axr = ax.reshape((1, -1) + tail)
    rows = (1.0 - axr) * src[:, x0] + axr * src[:, x1]          # (in_h, out_w[, C])
    ayr = ay.reshape((-1, 1) + tail)
    v = (1.0 - ayr) * rows[y0] + ayr * rows[y1]
    if not to_uint8:
        return v
    return np.clip(np.floor(v + 0.5), 0, 255).astype(np.uint8)


def _chan(img: np.ndarray) -> np.ndarray:
    return img[:, :, None] if img.ndim == 2 else img


@lru_cache(maxsize=256)
def _fft_shape(n: int) -> int:
    """Smallest 2^a 3^b 5^c >= n (fast sizes for pocketfft)."""
    best = 1 << (n - 1).bit_length()
    f5 = 1
    while f5 < 2 * n:
        f3 = f5
        while f3 < 2 * n:
            f2 = f3
            while f2 < n:
                f2 *= 2
            best = min(best, f2)
            f3 *= 3
        f5 *= 5
    return best


# A frame is scored in overlapping tiles of this size (overlap-save), so spectra
# are as large as a tile, whatever the frame: 25 levels of three channels take
# 118 MB, are built once per Python worker and serve every frame.  Templates of
# more than half a tile get larger tiles.  Spectra beyond the budget (such
# templates) are built anew for each frame.
TILE_H, TILE_W = 384, 512
SPECTRA_CACHE_BYTES = 160 * 1024 * 1024


class TemplatePyramid:
    """A template resized to every distinct scale, with its exact sums and
    (per padded frame shape) spectra — built once per Python worker."""

    def __init__(self, template: np.ndarray):
        t = _chan(template)
        self.h, self.w, self.c = t.shape
        self.levels = []
        for ix, sh, sw in scaled_dims(self.h, self.w):
            r = _chan(resize_bilinear(t, sh, sw))        # stays 8-bit: the levels live as long as the worker
            wide = r.reshape(-1, self.c).astype(np.int64)
            st = wide.sum(axis=0)
            stt = (wide * wide).sum(axis=0)
            self.levels.append((ix, sh, sw, r, st, stt))
        self._spectra: dict[tuple, list] = {}

    def spectrum(self, k: int, ph: int, pw: int) -> np.ndarray:
        """Spectrum of level ``k`` flipped (correlation as convolution)."""
        ix, sh, sw, r, st, stt = self.levels[k]
        flipped = np.ascontiguousarray(np.moveaxis(r[::-1, ::-1], 2, 0), dtype=np.float64)
        # pruned 2-D transform: the row pass only touches the template's sh
        # non-zero rows; the column pass zero-pads to ph
        rows = np.fft.rfft(flipped, n=pw, axis=2)                  # (C, sh, pw//2+1)
        return np.fft.fft(rows, n=ph, axis=1)                      # (C, ph, pw//2+1)

    def spectra(self, ph: int, pw: int) -> list | None:
        """All level spectra for a padded shape, or None if over budget."""
        key = (ph, pw)
        if key not in self._spectra:
            size = lambda h, w: len(self.levels) * h * (w // 2 + 1) * self.c * 16
            if size(ph, pw) > SPECTRA_CACHE_BYTES:
                return None
            while sum(size(*k) for k in self._spectra) + size(ph, pw) > SPECTRA_CACHE_BYTES:    # keep the most recent shapes
                self._spectra.pop(next(iter(self._spectra)))
            self._spectra[key] = [self.spectrum(k, ph, pw) for k in range(len(self.levels))]
        return self._spectra[key]


def match_scores(frame: np.ndarray, tmpl: np.ndarray) -> np.ndarray:
    """Normalized correlation coefficient of ``tmpl`` at every valid position
    (direct, exact integer sums).  Reference implementation for tests."""
    f, t = _chan(frame).astype(np.int64), _chan(tmpl).astype(np.int64)
    H, W, C = f.shape
    h, w, _ = t.shape
    n = h * w
    out = np.zeros((H - h + 1, W - w + 1))
    st = t.reshape(-1, C).sum(axis=0)
    stt = (t * t).reshape(-1, C).sum(axis=0)
    vt = int((n * stt - st * st).sum())
    for y in range(H - h + 1):
        for x in range(W - w + 1):
            win = f[y:y + h, x:x + w]
            sv = win.reshape(-1, C).sum(axis=0)
            svv = (win * win).reshape(-1, C).sum(axis=0)
            svt = (win * t).reshape(-1, C).sum(axis=0)
            num = float((n * svt - sv * st).sum())
            den = np.sqrt(float((n * svv - sv * sv).sum()) * float(vt))
            out[y, x] = 0.0 if den == 0 else num / den
    return out


def integrals(frame: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Integral images of every channel and of the squares over all channels.
    The first are unsigned 32-bit and may wrap round: the sum of a window, a
    difference, is exact while it is below 2**32 (windows of 16 million
    pixels)."""
    f = _chan(frame)
    h, w, c = f.shape
    ones = []
    for k in range(c):
        ii = np.zeros((h + 1, w + 1), np.uint32)
        np.cumsum(f[:, :, k], axis=0, dtype=np.uint32, out=ii[1:, 1:])
        np.cumsum(ii[1:, 1:], axis=1, out=ii[1:, 1:])
        ones.append(ii)
    both = np.zeros((h, w), np.uint32)
    for k in range(c):
        wide = f[:, :, k].astype(np.uint32)
        both += np.multiply(wide, wide, out=wide)
    squares = np.zeros((h + 1, w + 1))
    np.cumsum(both, axis=0, dtype=np.float64, out=squares[1:, 1:])
    np.cumsum(squares[1:, 1:], axis=1, out=squares[1:, 1:])
    return ones, squares


class _FrameStats:
    """Quantities of a frame, or of one of its tiles, shared by all scales:
    channel spectra and integral images (of a tile: views of the frame's, as
    windows are differences).  Float64 holds every sum exactly (all partial
    sums stay far below 2**53 for 8-bit images up to 4K), so the scores equal
    the integer formula."""

    def __init__(self, frame: np.ndarray, padded: tuple[int, int] | None = None, sums=None):
        f = _chan(frame)
        self.fh, self.fw, self.c = f.shape
        self.ph, self.pw = padded or (_fft_shape(self.fh), _fft_shape(self.fw))
        ff = np.ascontiguousarray(np.moveaxis(f, 2, 0), dtype=np.float64)    # (C, H, W)
        self.spec = np.fft.rfft2(ff, s=(self.ph, self.pw))                     # (C, ph, pw//2+1)
        self.ii1, self.ii2 = sums or integrals(f)

    @staticmethod
    def window(ii: np.ndarray, r0: int, r1: int, h: int, w: int, cols: int) -> np.ndarray:
        """Sums of the h x w windows at rows r0 .. r1 and the first ``cols`` columns."""
        lines = ii[r0 + h:r1 + h] - ii[r0:r1]
        return lines[:, w:w + cols] - lines[:, :cols]

    @classmethod
    def box(cls, ii: np.ndarray, h: int, w: int) -> np.ndarray:
        return cls.window(ii, 0, len(ii) - h, h, w, ii.shape[1] - w).astype(np.float64)


def _level_scores(fs: _FrameStats, level, tspec: np.ndarray) -> np.ndarray:
    """Scores of one template level at every valid position of one frame:
    ``(n*Svt - Sv*St) / sqrt((n*Svv - Sv^2) * (n*Stt - St^2))`` summed over
    channels; 0 where either variance is 0."""
    ix, sh, sw, r, st, stt = level
    n = float(sh * sw)
    # channels summed in the frequency domain: one inverse FFT per level
    acc = fs.spec[0] * tspec[0]
    for c in range(1, fs.c):
        acc += fs.spec[c] * tspec[c]
    corr = np.fft.irfft2(acc, s=(fs.ph, fs.pw))
    num = np.rint(corr[sh - 1:fs.fh, sw - 1:fs.fw])                 # exact integer sums
    num *= n
    vv = fs.box(fs.ii2, sh, sw)
    vv *= n
    for c in range(fs.c):
        sv = fs.box(fs.ii1[c], sh, sw)
        num -= sv * float(st[c])
        sv *= sv
        vv -= sv
    vt = float(int((sh * sw * stt - st * st).sum()))
    vv *= vt
    np.sqrt(vv, out=vv)
    with np.errstate(divide="ignore", invalid="ignore"):
        np.divide(num, vv, out=num, where=vv != 0)
    num[vv == 0] = 0.0
    return num


STRIP = 1 << 16    # score positions per pass: keeps the arithmetic cache-resident


def _level_best(fs: _FrameStats, level, tspec: np.ndarray, rows: int | None = None, cols: int | None = None) -> tuple[float, int, int]:
    """Best score of one level and its first position in row-major order,
    computed strip by strip (same values as :func:`_level_scores`).  Only the
    first ``rows`` and ``cols`` of the valid positions count."""
    ix, sh, sw, r, st, stt = level
    n = float(sh * sw)
    acc = fs.spec[0] * tspec[0]
    if fs.c > 1:
        part = np.empty_like(acc)
        for c in range(1, fs.c):
            acc += np.multiply(fs.spec[c], tspec[c], out=part)
    vt = float(int((sh * sw * stt - st * st).sum()))
    rows, cols = min(rows or fs.fh, fs.fh - sh + 1), min(cols or fs.fw, fs.fw - sw + 1)
    # the column pass first, then only the rows that hold positions
    np.fft.ifft(acc, axis=0, out=acc)
    corr = np.fft.irfft(acc[sh - 1:sh - 1 + rows], n=fs.pw, axis=1)
    best, by, bx = -np.inf, 0, 0
    strip = max(1, STRIP // cols)
    for r0 in range(0, rows, strip):
        r1 = min(rows, r0 + strip)
        num = np.rint(corr[r0:r1, sw - 1:sw - 1 + cols])
        num *= n
        vv = fs.window(fs.ii2, r0, r1, sh, sw, cols)
        vv *= n
        for c in range(fs.c):
            sv = fs.window(fs.ii1[c], r0, r1, sh, sw, cols).astype(np.float64)
            num -= np.multiply(sv, float(st[c]))
            sv *= sv
            vv -= sv
        vv *= vt
        np.sqrt(vv, out=vv)
        zero = vv == 0
        with np.errstate(divide="ignore", invalid="ignore"):
            np.divide(num, vv, out=num, where=~zero)
        num[zero] = 0.0
        k = int(np.argmax(num))
        v = float(num.flat[k])
        if v > best:
            best, (by, bx) = v, divmod(k, cols)
            by += r0
    return best, by, bx


def tile_axis(n: int, template: int, tile: int) -> tuple[int, list[tuple[int, int | None]]]:
    """Tiles of one axis of ``n`` pixels for templates of up to ``template``:
    the padded tile size, and of each tile its start and how many positions it
    answers for (None: all to the end)."""
    size = min(_fft_shape(n), max(tile, _fft_shape(2 * template)))
    step = size - template + 1
    starts = [0]
    while starts[-1] + size < n:
        starts.append(starts[-1] + step)
    return size, [(s, None if s == starts[-1] else step) for s in starts]


def best_by_level(frame: np.ndarray, pyramid: TemplatePyramid, ks, run=map) -> dict[int, tuple[float, int, int]]:
    """``(score, y, x)`` of the best position of each level in ``ks`` that fits
    the frame, the first in row-major order; tiles are scored through ``run``."""
    f = _chan(frame)
    fh, fw = f.shape[:2]
    ks = [k for k in ks if pyramid.levels[k][1] <= fh and pyramid.levels[k][2] <= fw]
    if not ks:
        return {}
    ph, ys = tile_axis(fh, max(pyramid.levels[k][1] for k in ks), TILE_H)
    pw, xs = tile_axis(fw, max(pyramid.levels[k][2] for k in ks), TILE_W)
    spectra = pyramid.spectra(ph, pw)

    def band_stats(y):
        """Stats of the tiles of one band; their windows come from integral
        images of the band."""
        band = f[y:y + ph]
        ones, squares = integrals(band)
        return lambda x: _FrameStats(band[:, x:x + pw], (ph, pw), ([ii[:, x:x + pw + 1] for ii in ones], squares[:, x:x + pw + 1]))

    def score(fs, tile, k, tspec):
        v, y, x = _level_best(fs, pyramid.levels[k], tspec, tile[1], tile[3])
        return k, v, tile[0] + y, tile[2] + x

    def found():
        if spectra is not None:
            for y, rows in ys:
                stats = band_stats(y)
                yield from run(lambda t: [score(fs, t, k, spectra[k]) for fs in [stats(t[2])] for k in ks], [(y, rows, x, cols) for x, cols in xs])
                del stats        # or it lives while the next band's is built
        else:                    # levels outside, so that each spectrum is built once a frame
            held = [(stats(x), (y, rows, x, cols)) for y, rows in ys for stats in [band_stats(y)] for x, cols in xs]
            for k in ks:
                tspec = pyramid.spectrum(k, ph, pw)
                yield from run(lambda h: [score(*h, k, tspec)], held)

    out: dict[int, tuple[float, int, int]] = {}
    for scores in found():
        for k, v, y, x in scores:
            if k not in out or (v, -y, -x) > (out[k][0], -out[k][1], -out[k][2]):
                out[k] = (v, y, x)
    return out


def _result(best: float, lv, loc, threshold: float) -> dict:
    found = lv is not None and best > threshold
    return {
        "detected": bool(found), "confidence": float(best),
        "scale_ix": int(lv[0]) if found else None,
        "scale": float(scales()[lv[0]]) if found else None,
        "x": int(loc[1]) if found else None, "y": int(loc[0]) if found else None,
        "w": int(lv[2]) if found else None, "h": int(lv[1]) if found else None,
    }


def detect_batch(frames: list[np.ndarray], pyramid: TemplatePyramid,
                 threshold: float = DEFAULT_THRESHOLD, timings: list | None = None,
                 threads: int = 1) -> list[dict]:
    """Multi-scale detection for a batch of frames.

    The best score starts at 0 and is replaced only by a strictly greater one,
    so non-positive scores never match and the earliest scale wins ties;
    within a scale the first maximum in row-major order wins (lowest y, then
    x).  The box is reported only above ``threshold``.  With ``threads > 1``
    the tiles of a frame are scored concurrently (numpy's FFT and ufuncs
    release the GIL); the outcome is that of the serial loop.
    """
    import time
    from concurrent.futures import ThreadPoolExecutor
    t0 = time.perf_counter()
    frames = [comparable(f, pyramid.c) for f in frames]
    pool = ThreadPoolExecutor(threads) if threads > 1 else None
    out = []
    try:
        for f in frames:
            v, k, y, x = _first_best(best_by_level(f, pyramid, range(len(pyramid.levels)), pool.map if pool else map))
            out.append(_result(v, pyramid.levels[k] if k >= 0 else None, (y, x), threshold))
    finally:
        if pool:
            pool.shutdown()
    if timings is not None:   # wall time of the batch, shared out per frame
        timings.extend([(time.perf_counter() - t0) * 1000.0 / max(len(frames), 1)] * len(frames))
    return out


def _first_best(by_level: dict[int, tuple[float, int, int]]) -> tuple:
    """``(score, level_position, y, x)``: a score above 0, ties go to the
    earliest level."""
    best = (0.0, -1, -1, -1)
    for k in sorted(by_level):
        v, y, x = by_level[k]
        if v > best[0]:
            best = (v, k, y, x)
    return best


def best_in_levels(frame: np.ndarray, pyramid: TemplatePyramid, levels: list[int]) -> tuple:
    """Best ``(score, level_position, y, x)`` of one frame over the given
    pyramid levels (the partial result of a level-split detection)."""
    return _first_best(best_by_level(comparable(frame, pyramid.c), pyramid, levels))


def detect(frame: np.ndarray, pyramid: TemplatePyramid, threshold: float = DEFAULT_THRESHOLD) -> dict:
    """Multi-scale detection in one frame (see :func:`detect_batch`)."""
    return detect_batch([frame], pyramid, threshold)[0]


def _split_alpha(img: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
    """Colour channels and alpha (the last of two or four channels, else None)."""
    img = _chan(img)
    return (img[:, :, :-1], img[:, :, -1]) if img.shape[2] in (2, 4) else (img, None)


def comparable(frame: np.ndarray, channels: int) -> np.ndarray:
    """The frame with as many channels as a template of ``channels``: its own
    alpha is left out where the template has none; any other difference is an
    error, as scores over unlike channels mean nothing."""
    f = _chan(frame)
    if f.shape[2] != channels:
        f = _split_alpha(f)[0]
    if f.shape[2] != channels:
        raise ValueError(f"a frame of {_chan(frame).shape[2]} channels does not match a template of {channels}")
    return f


def blend_patch(frame: np.ndarray, logo: np.ndarray, x: int, y: int, w: int, h: int):
    """The region that blending ``logo`` (resized to w x h) at (x, y) changes:
    ``(x, y, w, h, patch)``, or None when the box lies outside the frame.

    The box is clipped to the frame and the logo *cropped* (not squeezed); the
    last of two or four logo channels is the alpha (a/255), otherwise alpha is
    1.  Colour channels are blended and truncated into uint8; a frame's own
    alpha stays as it is.  A grey logo goes into every colour channel; a
    colour logo on a grey frame is an error."""
    fh, fw = frame.shape[:2]
    cw, ch = min(w, fw - x), min(h, fh - y)
    if cw <= 0 or ch <= 0:
        return None
    color, alpha = _split_alpha(resize_bilinear(logo, h, w)[:ch, :cw])
    roi, own = _split_alpha(frame[y:y + ch, x:x + cw])
    if color.shape[2] not in (1, roi.shape[2]):
        raise ValueError(f"a logo of {color.shape[2]} colours does not fit a frame of {roi.shape[2]}")
    a = (np.ones((ch, cw)) if alpha is None else alpha.astype(np.float64) / 255.0)[:, :, None]
    res = np.floor((1.0 - a) * roi.astype(np.float64) + a * color.astype(np.float64)).astype(np.uint8)
    if own is not None:
        res = np.dstack([res, own])
    return x, y, cw, ch, np.ascontiguousarray(res.reshape((ch, cw) + frame.shape[2:]))


def blend(frame: np.ndarray, logo: np.ndarray, x: int, y: int, w: int, h: int) -> np.ndarray:
    """The whole frame with the region of :func:`blend_patch` put in."""
    res = blend_patch(frame, logo, x, y, w, h)
    return frame.copy() if res is None else apply_patch(frame, x, y, res[4])


def apply_patch(frame: np.ndarray, x: int, y: int, patch: np.ndarray) -> np.ndarray:
    out = frame.copy()
    out[y:y + patch.shape[0], x:x + patch.shape[1]] = patch
    return out


def annotate(frame: np.ndarray, x: int, y: int, w: int, h: int, thickness: int = 2,
             color=(0, 255, 0)) -> np.ndarray:
    """Draw a box outline ``thickness`` pixels wide inside [x, x+w] x [y, y+h]."""
    out = frame.copy()
    fh, fw = frame.shape[:2]
    c = color[1] if frame.ndim == 2 else np.asarray((*color, 255)[:frame.shape[2]], dtype=np.uint8)
    rows, cols = slice(max(y, 0), min(y + h + 1, fh)), slice(max(x, 0), min(x + w + 1, fw))
    for k in range(min(thickness, h + 1)):
        for r in {y + k, y + h - k}:
            if 0 <= r < fh:
                out[r, cols] = c
    for k in range(min(thickness, w + 1)):
        for q in {x + k, x + w - k}:
            if 0 <= q < fw:
                out[rows, q] = c
    return out
