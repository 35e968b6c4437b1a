"""Pixel operators on Spark: resize, template match, multi-scale detection,
first-frame reuse or per-frame detection, alpha blend (whole frames or only
the changed patch), box annotation.

Two physical forms, one semantics (both equal the same SQL oracle):

* **Frame rows** (production): one row per frame, ``data`` = raw uint8 bytes
  ``H x W x C``.  ``mapInPandas`` runs the numpy kernels of
  :mod:`framelake.operators.kernels` on Arrow batches; the template pyramid
  and its spectra are built once per Python worker.
* **Pixel rows** (relational twin for small images): one row per pixel
  ``(video_id, frame_no, y, x, v)``; the template and the logo at every scale
  are tables that pixels join with, correlation sums a partial aggregate — all
  inside whole-stage codegen.

The template and the replacement logo are parameter images (like the logo
files the driver reads).  They are loaded once with an explicit size bound
(:data:`MAX_PARAM_PIXELS`); frames are never collected.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framelake.operators import kernels as K
from framelake.operators.joins import BROADCAST_MAX_ROWS, join_small
from framelake.session import ship_package

MAX_PARAM_PIXELS = 2048 * 2048        # of a template or logo: some 100 MB on the driver
DETECTION_FIELDS = [
    T.StructField("detected", T.BooleanType()), T.StructField("confidence", T.DoubleType()),
    T.StructField("scale_ix", T.IntegerType()), T.StructField("scale", T.DoubleType()),
    T.StructField("x", T.IntegerType()), T.StructField("y", T.IntegerType()),
    T.StructField("w", T.IntegerType()), T.StructField("h", T.IntegerType()),
]


# ------------------------------------------------------------ parameters
def load_param_image(pixels: DataFrame, y: str = "y", x: str = "x", values: tuple[str, ...] = ("v",)) -> np.ndarray:
    """Bring a small parameter image (template, logo) to the driver.

    The row count is checked *before* collecting, so an unexpectedly large
    input fails instead of flooding the driver."""
    n = pixels.count()
    if n > MAX_PARAM_PIXELS:
        raise ValueError(f"parameter image has {n} pixels; bound is {MAX_PARAM_PIXELS}")
    rows = pixels.select(y, x, *values).toPandas().to_numpy(dtype=np.int64)
    img = np.zeros((*(rows[:, :2].max(axis=0) + 1), len(values)), dtype=np.uint8)
    img[rows[:, 0], rows[:, 1]] = rows[:, 2:]
    return img[:, :, 0] if len(values) == 1 else img


# ------------------------------------------------------ frame-row helpers
def frames_from_arrays(df: DataFrame, values: str, height: int, width: int, channels: int = 1) -> DataFrame:
    """Pack an ``array<int>`` column of 0..255 values into the raw ``data``
    bytes of a frame row (a Catalyst expression, no UDF)."""
    hexed = F.transform(values, lambda v: F.lpad(F.hex(v), 2, "0"))
    return df.withColumn("data", F.unhex(F.array_join(hexed, ""))) \
             .withColumn("height", F.lit(height)).withColumn("width", F.lit(width)) \
             .withColumn("nChannels", F.lit(channels)).drop(values)


OUT_BATCH_BYTES = 16 * 1024 * 1024   # cap on one Arrow batch handed back to the JVM


def bounded_batches(pdf: pd.DataFrame, row_bytes: int) -> Iterator[pd.DataFrame]:
    """Split an output batch so no Arrow batch exceeds ``OUT_BATCH_BYTES``:
    an expanding stage (decode, upscale) must not return one giant batch."""
    step = max(1, OUT_BATCH_BYTES // max(1, row_bytes))
    for i in range(0, len(pdf), step):
        yield pdf.iloc[i:i + step]


def _img(row_data: bytes, h: int, w: int, c: int) -> np.ndarray:
    a = np.frombuffer(row_data, dtype=np.uint8)
    return a.reshape(h, w) if c == 1 else a.reshape(h, w, c)


_PYRAMIDS: dict[str, K.TemplatePyramid] = {}


def _pyramid(template: np.ndarray) -> K.TemplatePyramid:
    """Per-worker cache: the pyramid (and its spectra) survive across batches."""
    key = hashlib.sha1(template.tobytes() + str(template.shape).encode()).hexdigest()
    if key not in _PYRAMIDS:
        _PYRAMIDS[key] = K.TemplatePyramid(template)
    return _PYRAMIDS[key]


def spread_frames(frames: DataFrame, partitions: int, keys: tuple[str, ...] = ("video_id", "frame_no")) -> DataFrame:
    """Hash-spread frame rows over an explicit number of tasks before a heavy
    pixel stage.

    AQE sizes partitions by *bytes*; when frames are produced by an
    expansion (decode, upscale) the pre-expansion shuffle looks tiny and
    would be coalesced into one task.  An explicit count is kept by AQE.
    Range partitioning on the frame keys (sampled, keys only) balances the
    frames; hashing a handful of keys would stack several on one task."""
    return frames.repartitionByRange(partitions, *keys)


def ensure_parallelism(frames: DataFrame, keys: tuple[str, ...] = ("video_id", "frame_no")) -> DataFrame:
    """Spread frames only when a scan-only input has fewer partitions than
    the cluster has task slots (e.g. a few frames from one small file).

    Large inputs keep their file splits — pixel data is never shuffled just
    to rebalance it — and inputs that already pass a shuffle are sized by
    AQE.  The check runs only on exchange-free plans, where counting
    partitions needs no job."""
    plan = frames._jdf.queryExecution().executedPlan().toString()
    if "Exchange" in plan or "AdaptiveSparkPlan" in plan:
        return frames
    slots = frames.sparkSession.sparkContext.defaultParallelism
    if frames.rdd.getNumPartitions() < slots:
        return spread_frames(frames, slots, keys)
    return frames


def detect_frames(frames: DataFrame, template: np.ndarray, threshold: float = K.DEFAULT_THRESHOLD,
                  keys: tuple[str, ...] = ("video_id", "frame_no"), partitions: int | None = None,
                  with_timing: bool = False, on_error: str = "raise", threads: int = 1) -> DataFrame:
    """I4 on frame rows: multi-scale detection per frame with numpy FFT
    correlation in ``mapInPandas`` (frames spread over tasks, scales looped
    inside each Arrow batch).  ``partitions`` spreads the frames first (see
    :func:`spread_frames`).  ``with_timing`` adds ``detection_ms`` (the
    batch's detection wall time per frame, like the baseline's per-frame
    detection time).  ``threads`` scores scale levels concurrently inside a
    task — use it only when tasks are fewer than cores (first-frame mode with
    few videos); a task otherwise owns one core.  ``on_error="quarantine"`` keeps going when a frame
    cannot be decoded: the frame gets ``detected = false`` and the reason in
    an ``error`` column (split it off with ``operators.quality.split_valid``)."""
    ship_package(frames.sparkSession)
    frames = spread_frames(frames, partitions, keys) if partitions else ensure_parallelism(frames, keys)
    tpl = np.ascontiguousarray(template)
    key_fields = [frames.schema[k] for k in keys]
    if on_error not in ("raise", "quarantine"):
        raise ValueError(f"unknown error policy {on_error!r}")
    quarantine = on_error == "quarantine"
    timing = [T.StructField("detection_ms", T.DoubleType())] if with_timing else []
    errors = [T.StructField("error", T.StringType())] if quarantine else []
    schema = T.StructType(key_fields + DETECTION_FIELDS + timing + errors)

    channels = 1 if tpl.ndim == 2 else tpl.shape[2]

    def decode(d, h, w, c):
        try:
            return K.comparable(_img(d, h, w, c), channels), None
        except Exception as ex:  # noqa: BLE001  (policy: quarantine the frame)
            if not quarantine:
                raise
            return None, f"{type(ex).__name__}: {ex}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pyr = _pyramid(tpl)
        for b in batches:
            dec = [decode(d, h, w, c) for d, h, w, c in zip(b["data"], b["height"], b["width"], b["nChannels"])]
            good = [i for i, (img, _) in enumerate(dec) if img is not None]
            ms: list = []
            found = K.detect_batch([dec[i][0] for i in good], pyr, threshold, ms, threads)
            rows = [K._result(0.0, None, None, threshold) for _ in dec]
            per_ms = [0.0] * len(dec)
            for j, i in enumerate(good):
                rows[i], per_ms[i] = found[j], ms[j]
            ms = per_ms
            res = pd.DataFrame(rows)
            out = b[list(keys)].reset_index(drop=True)
            for f in DETECTION_FIELDS:
                out[f.name] = res[f.name] if len(res) else pd.Series([], dtype=object)
            for f in ("scale_ix", "x", "y", "w", "h"):
                out[f] = out[f].astype("Int32")
            if with_timing:
                out["detection_ms"] = ms
            if quarantine:
                out["error"] = [e for _, e in dec]
            yield out

    return frames.select(*keys, "data", "height", "width", "nChannels").mapInPandas(run, schema)


def detect_frames_split(frames: DataFrame, template: np.ndarray, level_groups: int = 4,
                        threshold: float = K.DEFAULT_THRESHOLD,
                        keys: tuple[str, ...] = ("video_id", "frame_no")) -> DataFrame:
    """I4/D2 for *few* frames: the frame x scale work is spread over the
    cluster.  Each frame row is fanned out to ``level_groups`` rows (a bounded
    generator), range-partitioned so every (frame, group) gets its own task,
    scored on its share of the 25 levels, and reduced per frame with
    ``max_by`` — highest score, then earliest level (the serial tie rule).
    Use it when frames are fewer than task slots; with many frames
    :func:`detect_frames` keeps each frame in one task."""
    ship_package(frames.sparkSession)
    tpl = np.ascontiguousarray(template)
    n_levels = len(K.TemplatePyramid(tpl).levels)
    groups = max(1, min(level_groups, n_levels))
    fan = frames.select(*keys, "data", "height", "width", "nChannels",
                        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("lgroup"))
    n_rows = frames.count() * groups
    slots = frames.sparkSession.sparkContext.defaultParallelism
    fan = fan.repartitionByRange(max(1, min(n_rows, 4 * slots)), *keys, "lgroup")
    part = T.StructType([frames.schema[k] for k in keys] + [
        T.StructField("_score", T.DoubleType()), T.StructField("_lvl", T.IntegerType()),
        T.StructField("_y", T.IntegerType()), T.StructField("_x", T.IntegerType())])

    def run(batches):
        pyr = _pyramid(tpl)
        for b in batches:
            rows = []
            for r in b.itertuples(index=False):
                img = _img(r.data, r.height, r.width, r.nChannels)
                lv = [k for k in range(len(pyr.levels)) if k % groups == r.lgroup]
                v, k, y, x = K.best_in_levels(img, pyr, lv)
                rows.append(tuple(getattr(r, c) for c in keys) + (v, k, y, x))
            yield pd.DataFrame(rows, columns=part.names).astype({"_lvl": "int32", "_y": "int32", "_x": "int32"})

    scored = fan.mapInPandas(run, part)
    best = scored.groupBy(*keys).agg(F.max_by(F.struct("_score", "_lvl", "_y", "_x"),
                                              F.struct("_score", -F.col("_lvl"))).alias("b"))
    pyr = K.TemplatePyramid(tpl)
    lit_arr = lambda vals, t: F.array(*[F.lit(v).cast(t) for v in vals])
    at = lambda arr: F.element_at(arr, F.col("b._lvl") + 1)
    found = F.col("b._score") > F.lit(threshold)
    keep = lambda c: F.when(found, c)
    return best.select(
        *keys, found.alias("detected"), F.greatest(F.col("b._score"), F.lit(0.0)).alias("confidence"),
        keep(at(lit_arr([lv[0] for lv in pyr.levels], "int"))).alias("scale_ix"),
        keep(at(lit_arr([float(K.scales()[lv[0]]) for lv in pyr.levels], "double"))).alias("scale"),
        keep(F.col("b._x")).alias("x"), keep(F.col("b._y")).alias("y"),
        keep(at(lit_arr([lv[2] for lv in pyr.levels], "int"))).alias("w"),
        keep(at(lit_arr([lv[1] for lv in pyr.levels], "int"))).alias("h"))


def resize_frames(frames: DataFrame, out_h: int, out_w: int) -> DataFrame:
    """I1/I8 on frame rows: bilinear resize of every frame."""
    ship_package(frames.sparkSession)
    other = [f for f in frames.schema.fields if f.name not in ("data", "height", "width")]
    schema = T.StructType(other + [T.StructField("data", T.BinaryType()),
                                   T.StructField("height", T.IntegerType()),
                                   T.StructField("width", T.IntegerType())])

    frames = ensure_parallelism(frames, tuple(k for k in ("video_id", "frame_no") if k in frames.columns))

    def run(batches):
        for b in batches:
            if not len(b):
                continue
            step = max(1, OUT_BATCH_BYTES // (out_h * out_w * int(b["nChannels"].max())))
            for i in range(0, len(b), step):      # expanding stage: bounded output batches
                part = b.iloc[i:i + step]
                out = part[[f.name for f in other]].reset_index(drop=True)
                out["data"] = [K.resize_bilinear(_img(d, h, w, c), out_h, out_w).tobytes()
                               for d, h, w, c in zip(part["data"], part["height"], part["width"],
                                                     part["nChannels"])]
                out["height"], out["width"] = np.int32(out_h), np.int32(out_w)
                yield out

    return frames.mapInPandas(run, schema)


def blend_frames(frames: DataFrame, boxes: DataFrame, logo: np.ndarray,
                 keys: tuple[str, ...] = ("video_id",)) -> DataFrame:
    """I6 on frame rows: blend ``logo`` into every frame at its video's box.

    ``boxes`` has one row per video (first-frame detection, D3); it is joined
    on the video key (AQE broadcasts it after measuring it), then each Arrow
    batch blends in numpy.  Frames without a detection pass through."""
    ship_package(frames.sparkSession)
    lg = np.ascontiguousarray(logo)
    b = boxes.select(*keys, "detected", "x", "y", "w", "h")
    j = join_small(frames, b, list(keys), "left")
    schema = frames.schema

    def run(batches):
        for p in batches:
            data = []
            for row in p.itertuples(index=False):
                img = _img(row.data, row.height, row.width, row.nChannels)
                if row.detected is True or row.detected == 1:
                    img = K.blend(img, lg, int(row.x), int(row.y), int(row.w), int(row.h))
                data.append(img.tobytes())
            out = p[[f.name for f in schema.fields]].copy()
            out["data"] = data
            yield out

    return j.mapInPandas(run, schema)


def replace_frames(frames: DataFrame, template: np.ndarray, logo: np.ndarray,
                   threshold: float = K.DEFAULT_THRESHOLD,
                   keys: tuple[str, ...] = ("video_id", "frame_no")) -> DataFrame:
    """I4 ``per_frame`` mode + I6: detect in every frame and blend the logo at
    that frame's own box, in one ``mapInPandas`` pass — per-frame boxes never
    have to be joined back onto the frames.  Output: the frame row with the
    new ``data`` plus the detection columns."""
    ship_package(frames.sparkSession)
    frames = ensure_parallelism(frames, keys)
    tpl, lg = np.ascontiguousarray(template), np.ascontiguousarray(logo)
    base = [f for f in frames.schema.fields]
    schema = T.StructType(base + [f for f in DETECTION_FIELDS if f.name not in frames.columns])

    def run(batches):
        pyr = _pyramid(tpl)
        for b in batches:
            imgs = [_img(d, h, w, c) for d, h, w, c in zip(b["data"], b["height"], b["width"], b["nChannels"])]
            dets = K.detect_batch(imgs, pyr, threshold)
            out = b.reset_index(drop=True).copy()
            out["data"] = [K.blend(img, lg, d["x"], d["y"], d["w"], d["h"]).tobytes() if d["detected"]
                           else img.tobytes() for img, d in zip(imgs, dets)]
            res = pd.DataFrame(dets)
            for f in DETECTION_FIELDS:
                out[f.name] = res[f.name] if len(res) else pd.Series([], dtype=object)
            for f in ("scale_ix", "x", "y", "w", "h"):
                out[f] = out[f].astype("Int32")
            yield out

    return frames.mapInPandas(run, schema)


def annotate_frames(frames: DataFrame, boxes: DataFrame, keys: tuple[str, ...] = ("video_id",),
                    thickness: int = 2) -> DataFrame:
    """I7 on frame rows: draw each video's detected box (green outline,
    ``thickness`` px) into its frames; frames without a detection pass through."""
    ship_package(frames.sparkSession)
    b = boxes.select(*keys, "detected", "x", "y", "w", "h")
    j = join_small(frames, b, list(keys), "left")
    schema = frames.schema

    def run(batches):
        for p in batches:
            data = []
            for row in p.itertuples(index=False):
                img = _img(row.data, row.height, row.width, row.nChannels)
                if row.detected is True or row.detected == 1:
                    img = K.annotate(img, int(row.x), int(row.y), int(row.w), int(row.h), thickness)
                data.append(img.tobytes())
            out = p[[f.name for f in schema.fields]].copy()
            out["data"] = data
            yield out

    return j.mapInPandas(run, schema)


PATCH_FIELDS = [T.StructField("px", T.IntegerType()), T.StructField("py", T.IntegerType()),
                T.StructField("pw", T.IntegerType()), T.StructField("ph", T.IntegerType()),
                T.StructField("patch", T.BinaryType())]


def blend_patches(frames: DataFrame, boxes: DataFrame, logo: np.ndarray,
                  keys: tuple[str, ...] = ("video_id", "frame_no"), video_key: str = "video_id") -> DataFrame:
    """I6, patch form: per frame only the blended region ``(px, py, pw, ph,
    patch)`` — at 1080p about 88 KB instead of a 6.2 MB frame — so the job
    writes a small fraction of the data; frames without a detection yield no
    row.  :func:`apply_patches` rebuilds full frames where a sink needs them."""
    ship_package(frames.sparkSession)
    lg = np.ascontiguousarray(logo)
    b = boxes.where(F.col("detected")).select(video_key, "x", "y", "w", "h")
    j = join_small(frames, b, video_key)
    schema = T.StructType([frames.schema[k] for k in keys] + PATCH_FIELDS)

    def run(batches):
        for p in batches:
            rows = []
            for r in p.itertuples(index=False):
                img = _img(r.data, r.height, r.width, r.nChannels)
                res = K.blend_patch(img, lg, int(r.x), int(r.y), int(r.w), int(r.h))
                if res is not None:
                    px, py, pw, ph, patch = res
                    rows.append(tuple(getattr(r, k) for k in keys) + (px, py, pw, ph, patch.tobytes()))
            out = pd.DataFrame(rows, columns=list(keys) + [f.name for f in PATCH_FIELDS])
            for f in ("px", "py", "pw", "ph"):
                out[f] = out[f].astype("int32")
            yield out

    return j.select(*keys, "data", "height", "width", "nChannels", "x", "y", "w", "h").mapInPandas(run, schema)


def blend_stats(frames: DataFrame, boxes: DataFrame, logo: np.ndarray, video_key: str = "video_id") -> DataFrame:
    """E4 per frame, without the pixels: ``n_pixels`` and ``n_values`` (pixels
    times channels) of the frame, ``n_changed`` pixels that the blend changes
    and ``sum_out``, the sum of all values after it.  A frame without a
    detection is counted as it is."""
    ship_package(frames.sparkSession)
    lg = np.ascontiguousarray(logo)
    b = boxes.select(video_key, "detected", "x", "y", "w", "h")
    j = join_small(frames, b, video_key, "left", null_keys=True)
    names = ["n_pixels", "n_values", "n_changed", "sum_out"]
    schema = T.StructType([frames.schema[video_key]] + [T.StructField(n, T.LongType()) for n in names])

    def run(batches):
        for p in batches:
            rows = []
            for r in p.itertuples(index=False):
                img = _img(r.data, r.height, r.width, r.nChannels)
                total, changed = int(img.sum(dtype=np.int64)), 0
                res = K.blend_patch(img, lg, int(r.x), int(r.y), int(r.w), int(r.h)) if r.detected is True or r.detected == 1 else None
                if res is not None:
                    px, py, pw, ph, patch = res
                    before = img[py:py + ph, px:px + pw]
                    off = patch != before
                    changed = int((off if off.ndim == 2 else off.any(axis=2)).sum())
                    total += int(patch.sum(dtype=np.int64)) - int(before.sum(dtype=np.int64))
                rows.append((img.shape[0] * img.shape[1], img.size, changed, total))
            out = p[[video_key]].reset_index(drop=True)
            for k, name in enumerate(names):
                out[name] = np.array([row[k] for row in rows], np.int64)
            yield out

    return j.select(video_key, "data", "height", "width", "nChannels", "detected", "x", "y", "w", "h").mapInPandas(run, schema)


def apply_patches(frames: DataFrame, patches: DataFrame,
                  keys: tuple[str, ...] = ("video_id", "frame_no")) -> DataFrame:
    """Full frames from frames + patches (left join on the frame key: frames
    without a patch pass through unchanged)."""
    ship_package(frames.sparkSession)
    j = frames.join(patches, list(keys), "left")
    schema = frames.schema

    def run(batches):
        for p in batches:
            data = []
            for r in p.itertuples(index=False):
                if r.patch is None or (isinstance(r.patch, float) and np.isnan(r.patch)):
                    data.append(r.data)
                    continue
                img = _img(r.data, r.height, r.width, r.nChannels)
                shape = (int(r.ph), int(r.pw)) + (() if r.nChannels == 1 else (int(r.nChannels),))
                patch = np.frombuffer(r.patch, dtype=np.uint8).reshape(shape)
                data.append(K.apply_patch(img, int(r.px), int(r.py), patch).tobytes())
            out = p[[f.name for f in schema.fields]].copy()
            out["data"] = data
            yield out

    return j.mapInPandas(run, schema)


# ---------------------------------------------------- pixel-row (relational)
def _axis_cols(o: Column, n_in: int | Column, n_out: int | Column):
    """Half-pixel-centre sampling for output coordinate ``o``: (i0, i1, a)."""
    n_in_c = n_in if isinstance(n_in, Column) else F.lit(n_in)
    n_out_c = n_out if isinstance(n_out, Column) else F.lit(n_out)
    f = (o.cast("double") + F.lit(0.5)) * (n_in_c.cast("double") / n_out_c.cast("double")) - F.lit(0.5)
    i0 = F.floor(f)
    a = f - i0
    low, high = i0 < 0, i0 >= n_in_c - 1
    i0c = F.when(low, F.lit(0)).when(high, n_in_c - 1).otherwise(i0).cast("int")
    ac = F.when(low | high, F.lit(0.0)).otherwise(a)
    return i0c, F.least(i0c + 1, n_in_c - 1).cast("int"), ac


def bilinear_value(p00: Column, p01: Column, p10: Column, p11: Column, ay: Column, ax: Column) -> Column:
    one = F.lit(1.0)
    return (one - ay) * ((one - ax) * p00 + ax * p01) + ay * ((one - ax) * p10 + ax * p11)


def to_uint8(v: Column) -> Column:
    """Round half up and clamp to 0..255 (result of a uint8 resize)."""
    return F.least(F.lit(255), F.greatest(F.lit(0), F.floor(v + F.lit(0.5)))).cast("bigint")


def resize_pixels(frames: DataFrame, values: str, in_h: int, in_w: int, out_h: int, out_w: int,
                  keys: tuple[str, ...] = ("video_id", "frame_no")) -> DataFrame:
    """I1 on frames whose pixels are an array column (row-major, one channel):
    one row per output pixel, its four neighbours picked by position.  Narrow:
    no join, no shuffle."""
    g = frames.select(*keys, F.col(values).alias("_v"),
                      F.explode(F.sequence(F.lit(0), F.lit(out_h * out_w - 1))).alias("_i"))
    oy, ox = (F.col("_i") / out_w).cast("int"), (F.col("_i") % out_w).cast("int")
    y0, y1, ay = _axis_cols(oy, in_h, out_h)
    x0, x1, ax = _axis_cols(ox, in_w, out_w)
    at = lambda y, x: F.get("_v", y * in_w + x).cast("double")
    v = bilinear_value(at(y0, x0), at(y0, x1), at(y1, x0), at(y1, x1), ay, ax)
    return g.select(*keys, oy.alias("y"), ox.alias("x"), to_uint8(v).alias("v"))


def _param_table(spark: SparkSession, levels: list[tuple[tuple[int, ...], np.ndarray]], ids: str, values: str) -> DataFrame:
    """Levels of a parameter image as a table: the level's ``ids``, row, column
    and ``values`` of every pixel.  It grows with the image alone; up to
    :data:`joins.BROADCAST_MAX_ROWS` rows it is sent to every executor, beyond
    that the join shuffles it."""
    parts = []
    for of, img in levels:
        h, w = img.shape[:2]
        at = np.indices((h, w)).reshape(2, -1)
        parts.append(np.concatenate([np.broadcast_to(np.array(of)[:, None], (len(of), h * w)), at, img.reshape(h * w, -1).T]))
    rows = np.concatenate(parts, axis=1)
    names = f"{ids} {values}".split()
    table = spark.createDataFrame(pd.DataFrame(dict(zip(names, rows.astype(np.int64)))), ", ".join(f"{n} bigint" for n in names))
    return F.broadcast(table) if rows.shape[1] <= BROADCAST_MAX_ROWS else table


def _level_const(pyr: K.TemplatePyramid, lvl: Column, what: int, dtype: str) -> Column:
    vals = [lv[what] if what < 3 else int(lv[what][0]) for lv in pyr.levels]
    return F.element_at(F.array(*[F.lit(v) for v in vals]), lvl + 1).cast(dtype)


def match_sums(pixels: DataFrame, pyr: K.TemplatePyramid, frame_h: Column, frame_w: Column,
               keys: tuple[str, ...] = ("video_id", "frame_no")) -> DataFrame:
    """Correlation sums per (frame, level, position): each pixel is dealt over
    the levels and the template rows that a valid window puts on it, joins
    that row of the template table, and ``count / sum(v) / sum(v^2) /
    sum(v*t)`` are partially aggregated before the shuffle.  (Window sums come
    out of the same aggregate: summed-area tables would add two sorts to a
    plan that meets every pair of pixel and template anyway.)"""
    spark = pixels.sparkSession
    tpl = _param_table(spark, [((li,), lv[3][:, :, :1]) for li, lv in enumerate(pyr.levels)], "_lvl", "_ty _tx _t")
    sizes = F.array(*[F.struct(F.lit(li).cast("bigint").alias("lvl"), F.lit(lv[1]).alias("sh"), F.lit(lv[2]).alias("sw")) for li, lv in enumerate(pyr.levels)])
    e = pixels.select(*keys, "y", "x", "v", frame_h.alias("_fh"), frame_w.alias("_fw"), F.explode(sizes).alias("_s"))
    low = F.greatest(F.lit(0), F.col("y") - (F.col("_fh") - F.col("_s.sh")))       # rows of valid windows
    high = F.least(F.col("_s.sh") - 1, F.col("y"))
    e = e.select("*", F.explode(F.when((high >= low) & (F.col("_s.sh") <= F.col("_fh")), F.sequence(low, high))).alias("_row"))
    j = e.join(tpl, (F.col("_s.lvl") == F.col("_lvl")) & (F.col("_row").cast("bigint") == F.col("_ty")))
    py, px = F.col("y") - F.col("_row"), (F.col("x") - F.col("_tx")).cast("int")
    j = j.select(*keys, F.col("_lvl").cast("int").alias("lvl"), py.alias("py"), px.alias("px"), "v", F.col("_t").alias("t"),
                 ((px >= 0) & (px <= F.col("_fw") - F.col("_s.sw"))).alias("_ok")).where("_ok")
    return j.groupBy(*keys, "lvl", "py", "px").agg(
        F.count(F.lit(1)).alias("n"), F.sum("v").alias("sv"), F.sum(F.col("v") * F.col("v")).alias("svv"),
        F.sum(F.col("v") * F.col("t")).alias("svt"))


def ncc_score(n: Column, sv: Column, svv: Column, svt: Column, st: Column, stt: Column) -> Column:
    """Normalized correlation coefficient from exact integer sums; 0 when a
    variance is 0 (written with sums, so a flat window cannot divide by 0)."""
    num = (n * svt - sv * st).cast("double")
    den = F.sqrt((n * svv - sv * sv).cast("double") * (n * stt - st * st).cast("double"))
    return F.when(den == 0, F.lit(0.0)).otherwise(num / den)


def detect_pixels(pixels: DataFrame, template: np.ndarray, frame_h: Column, frame_w: Column,
                  threshold: float = K.DEFAULT_THRESHOLD,
                  keys: tuple[str, ...] = ("video_id", "frame_no"), single_scale: bool = False) -> DataFrame:
    """I2-I4/E3/C3 on pixel rows: best normalized correlation per frame over
    all scales (or at scale 1 only); ties -> lowest scale, then y, then x."""
    pyr = K.TemplatePyramid(template)
    if single_scale:
        pyr.levels = [lv for lv in pyr.levels if (lv[1], lv[2]) == (pyr.h, pyr.w)][:1]
    s = match_sums(pixels, pyr, frame_h, frame_w, keys)
    lvl = F.col("lvl")
    scored = s.select(*keys, _level_const(pyr, lvl, 0, "int").alias("scale_ix"),
                      _level_const(pyr, lvl, 1, "int").alias("h"), _level_const(pyr, lvl, 2, "int").alias("w"),
                      F.col("py").cast("int").alias("y"), F.col("px").cast("int").alias("x"),
                      ncc_score(F.col("n"), F.col("sv"), F.col("svv"), F.col("svt"),
                                _level_const(pyr, lvl, 4, "bigint"), _level_const(pyr, lvl, 5, "bigint"))
                      .alias("score"))
    best = scored.groupBy(*keys).agg(F.max_by(
        F.struct("score", "scale_ix", "x", "y", "w", "h"),
        F.struct("score", -F.col("scale_ix"), -F.col("y"), -F.col("x"))).alias("b"))
    found = F.col("b.score") > F.lit(threshold)
    keep = lambda c: F.when(found, c)
    return best.select(
        *keys, found.alias("detected"), F.greatest(F.col("b.score"), F.lit(0.0)).alias("confidence"),
        keep(F.col("b.scale_ix")).alias("scale_ix"),
        keep(F.element_at(F.array(*[F.lit(float(v)) for v in K.scales()]), F.col("b.scale_ix") + 1))
        .alias("scale"),
        keep(F.col("b.x")).alias("x"), keep(F.col("b.y")).alias("y"),
        keep(F.col("b.w")).alias("w"), keep(F.col("b.h")).alias("h"))


def first_frame_detection(frames: DataFrame, detect_fn, key: str = "video_id",
                          frame_col: str = "frame_no") -> DataFrame:
    """D3: run ``detect_fn`` only on the first frame of each video, giving one
    detection row per video.  The per-video minimum comes from the key
    columns alone (pixels are pruned from that branch) and selects the frames
    through a checked broadcast semi join, so no frame is shuffled.

    Frames with a ``chunk_id`` are joined on it too, and those of a frame store
    on ``chunk_slot``: it is a partition column, so only the folders of first
    chunks are read."""
    parts = [c for c in ("chunk_id", "chunk_slot") if c in frames.columns]
    first = (frames.where(F.col(frame_col).isNotNull()).groupBy(key)
                   .agg(F.min(F.struct(frame_col, *parts)).alias("_f")).select(key, "_f.*"))
    # the partition column is compared plainly: that is what Spark prunes by
    return detect_fn(join_small(frames, first, [key, *parts, frame_col], "left_semi", prune=frame_col, null_keys=[key]))


def reuse_detection(frame_keys: DataFrame, det: DataFrame, key: str = "video_id") -> DataFrame:
    """D3: attach the per-video detection to every frame (one row per video
    on the small side; AQE broadcasts it)."""
    d = det.drop("frame_no") if "frame_no" in det.columns else det
    return join_small(frame_keys, d, key, "left", null_keys=True)


def blend_pixels(pixels: DataFrame, boxes: DataFrame, logo: np.ndarray, template_shape: tuple[int, int],
                 key: str | list[str] = "video_id", keep_original: bool = False) -> DataFrame:
    """I5/I6 on pixel rows: inside the (clipped) box the logo, resized to the
    box size, is blended ``(1 - a) * p + a * l`` and truncated; elsewhere the
    pixel is unchanged.  The logo at every possible box size is a table that
    pixels join with on size and place."""
    th, tw = template_shape
    lg = logo if logo.ndim == 3 else logo[:, :, None]

    def level(sh, sw):
        img = K.resize_bilinear(lg, sh, sw)
        alpha = img[:, :, -1] if img.shape[2] in (2, 4) else np.full((sh, sw), 255, np.uint8)
        return (sh, sw), np.dstack([img[:, :, 0], alpha])
    table = _param_table(pixels.sparkSession, [level(sh, sw) for _, sh, sw in K.scaled_dims(th, tw)], "_lh _lw", "_ly _lx _l _a")
    keys = [key] if isinstance(key, str) else list(key)
    b = boxes.select(*keys, F.col("detected").alias("_d"), F.col("x").alias("_bx"), F.col("y").alias("_by"),
                     F.col("w").alias("_bw"), F.col("h").alias("_bh"))
    j = join_small(pixels, b, keys, "left")
    at = lambda c: F.when(F.coalesce(F.col("_d"), F.lit(False)), c).cast("bigint")  # noqa: E731  NULL meets no logo pixel
    j = j.withColumns({"_py": at(F.col("y") - F.col("_by")), "_px": at(F.col("x") - F.col("_bx"))})
    j = j.join(table, (F.col("_bh").cast("bigint") == F.col("_lh")) & (F.col("_bw").cast("bigint") == F.col("_lw"))
               & (F.col("_py") == F.col("_ly")) & (F.col("_px") == F.col("_lx")), "left")
    inside = F.col("_l").isNotNull()
    a = F.col("_a").cast("double") / F.lit(255.0)
    blended = F.floor((F.lit(1.0) - a) * F.col("v").cast("double") + a * F.col("_l").cast("double")).cast("bigint")
    out = F.when(inside, blended).otherwise(F.col("v"))
    cols = [c for c in pixels.columns if c != "v"]
    extra = [F.col("v").alias("v0")] if keep_original else []
    return j.select(*cols, *extra, out.alias("v"))


def annotate_pixels(pixels: DataFrame, boxes: DataFrame, key: str = "video_id", thickness: int = 2,
                    value: int = 255) -> DataFrame:
    """I7 on pixel rows: a ``thickness``-pixel outline of the box
    ``[x, x+w] x [y, y+h]`` set to ``value`` (the green channel)."""
    b = boxes.select(key, F.col("detected").alias("_d"), F.col("x").alias("_bx"), F.col("y").alias("_by"),
                     F.col("w").alias("_bw"), F.col("h").alias("_bh"))
    j = join_small(pixels, b, key, "left")
    x, y, bx, by, bw, bh = (F.col(c) for c in ("x", "y", "_bx", "_by", "_bw", "_bh"))
    inside = (x >= bx) & (x <= bx + bw) & (y >= by) & (y <= by + bh)
    border = inside & ((x - bx < thickness) | (bx + bw - x < thickness)
                       | (y - by < thickness) | (by + bh - y < thickness))
    hit = F.coalesce(F.col("_d") & border, F.lit(False))
    cols = [c for c in pixels.columns if c != "v"]
    return j.select(*cols, F.when(hit, F.lit(value).cast("bigint")).otherwise(F.col("v")).alias("v"))


def frame_stats(pixels: DataFrame, keys: tuple[str, ...] = ("video_id", "frame_no"), channels: int = 1) -> DataFrame:
    """Dimensions, channels, size and value statistics per frame."""
    return (pixels.groupBy(*keys)
                  .agg((F.max("y") + 1).alias("height"), (F.max("x") + 1).alias("width"),
                       F.count(F.lit(1)).alias("n_pixels"), F.min("v").alias("min_v"),
                       F.max("v").alias("max_v"), F.avg("v").alias("mean_v"))
                  .withColumn("nChannels", F.lit(channels))
                  .withColumn("size_kb", F.col("n_pixels") * channels / F.lit(1024.0)))


