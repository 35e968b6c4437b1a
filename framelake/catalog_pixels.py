"""Registered pixel queries (resize, match, detect, reuse, blend, annotate)
and their DuckDB oracles.  Imported by :mod:`framelake.catalog`."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framelake.catalog import ORACLES, register
from framelake.operators import kernels as K
from framelake.operators import pixels as PX
from framelake.oracle import with_fx
from framelake.sources import testdata as TD

SIDE = TD.FRAME_SIDE
RESIZE_TO = (6, 12)              # (out_h, out_w): downscale rows, upscale columns
THRESHOLD = K.DEFAULT_THRESHOLD
STRICT_THRESHOLD = 0.5           # C3 query: a second, stricter cut


# ------------------------------------------------------------- SQL builders
def _sql_sampling(name: str, levels: str, dims: str) -> tuple[str, str]:
    """Output pixels of every level with their four source coordinates and
    weights (half-pixel centres, edge clamp) — twin of ``kernels._axis``."""
    def axis(o, n_in, n_out, p):
        f = f"((CAST({o} AS DOUBLE) + 0.5::DOUBLE) * (CAST({n_in} AS DOUBLE) / CAST({n_out} AS DOUBLE)) - 0.5::DOUBLE)"
        bad = f"(floor({f}) < 0 OR floor({f}) >= {n_in} - 1)"
        i0 = (f"CAST(CASE WHEN floor({f}) < 0 THEN 0 WHEN floor({f}) >= {n_in} - 1 THEN {n_in} - 1 "
              f"ELSE floor({f}) END AS INTEGER)")
        return (f"{i0} AS {p}0, least({i0} + 1, {n_in} - 1) AS {p}1, "
                f"CASE WHEN {bad} THEN 0.0::DOUBLE ELSE {f} - floor({f}) END AS a{p}")
    return (name, f"""
        SELECT scale_ix, sh, sw, oy, ox, {axis('oy', 'ih', 'sh', 'y')}, {axis('ox', 'iw', 'sw', 'x')}
        FROM (SELECT scale_ix, sh, sw, ih, iw, oy, unnest(range(sw)) AS ox
              FROM (SELECT scale_ix, sh, sw, ih, iw, unnest(range(sh)) AS oy FROM {levels}, {dims}) a) b""")


def _bilinear(p: str, q: str, r: str, s: str) -> str:
    return (f"((1.0::DOUBLE - ay) * ((1.0::DOUBLE - ax) * {p} + ax * {q}) "
            f"+ ay * ((1.0::DOUBLE - ax) * {r} + ax * {s}))")


def _u8(v: str) -> str:
    return f"CAST(least(255, greatest(0, floor({v} + 0.5::DOUBLE))) AS BIGINT)"


def _sql_resized(name: str, samp: str, src: str, yk: str, xk: str, col: str, extra: str = "") -> tuple[str, str]:
    joins = " ".join(
        f"JOIN {src} {al} ON {al}.{yk} = s.y{yy} AND {al}.{xk} = s.x{xx}"
        for al, yy, xx in (("a", 0, 0), ("b", 0, 1), ("c", 1, 0), ("d", 1, 1)))
    more = ""
    if extra:
        more = f", {_u8(_bilinear(f'a.{extra}', f'b.{extra}', f'c.{extra}', f'd.{extra}'))} AS {extra}"
    return (name, f"""
        SELECT s.scale_ix, s.sh, s.sw, s.oy, s.ox,
               {_u8(_bilinear(f'a.{col}', f'b.{col}', f'c.{col}', f'd.{col}'))} AS {col}{more}
        FROM {samp} s {joins}""")


_LEVELS = [
    ("scl", """SELECT CAST(i AS INTEGER) AS scale_ix,
                CASE WHEN i = 24 THEN 2.0::DOUBLE
                     ELSE 0.8::DOUBLE + CAST(i AS DOUBLE) * ((2.0::DOUBLE - 0.8::DOUBLE) / 24.0::DOUBLE) END AS scale
               FROM range(25) r(i)"""),
    ("tdim", "SELECT max(ty) + 1 AS ih, max(tx) + 1 AS iw FROM fx_template"),
    ("lv", """SELECT min(scale_ix) AS scale_ix, sh, sw FROM (
                SELECT scale_ix, CAST(floor(CAST(ih AS DOUBLE) * scale) AS INTEGER) AS sh,
                       CAST(floor(CAST(iw AS DOUBLE) * scale) AS INTEGER) AS sw FROM scl, tdim) z
               WHERE sh > 0 AND sw > 0 GROUP BY sh, sw"""),
    _sql_sampling("tsamp", "lv", "tdim"),
    _sql_resized("tr", "tsamp", "fx_template", "ty", "tx", "t"),
    ("tsum", "SELECT scale_ix, sum(t) AS st, sum(t * t) AS stt FROM tr GROUP BY 1"),
]


def _sql_detect(src: str, prefix: str, threshold: float) -> list[tuple[str, str]]:
    """Best multi-scale match per frame of pixel table ``src``."""
    return [
        (f"{prefix}m", f"""
            SELECT p.video_id, p.frame_no, tr.scale_ix, tr.sh, tr.sw, p.y - tr.oy AS py, p.x - tr.ox AS px,
                   count(*) AS n, sum(p.v) AS sv, sum(p.v * p.v) AS svv, sum(p.v * tr.t) AS svt
            FROM {src} p JOIN tr ON p.y - tr.oy BETWEEN 0 AND {SIDE} - tr.sh AND p.x - tr.ox BETWEEN 0 AND {SIDE} - tr.sw
            GROUP BY ALL"""),
        (f"{prefix}s", f"""
            SELECT video_id, frame_no, scale_ix, sh, sw, py, px,
                   CASE WHEN den = 0 THEN 0.0::DOUBLE ELSE num / den END AS score
            FROM (SELECT m.*, CAST(n * svt - sv * st AS DOUBLE) AS num,
                         sqrt(CAST(n * svv - sv * sv AS DOUBLE) * CAST(n * stt - st * st AS DOUBLE)) AS den
                  FROM {prefix}m m JOIN tsum USING (scale_ix)) q"""),
        (f"{prefix}b", f"""
            SELECT video_id, frame_no, score > {threshold}::DOUBLE AS detected,
                   greatest(score, 0.0::DOUBLE) AS confidence,
                   CASE WHEN score > {threshold}::DOUBLE THEN scale_ix END AS scale_ix,
                   CASE WHEN score > {threshold}::DOUBLE THEN
                        (SELECT scale FROM scl WHERE scl.scale_ix = r.scale_ix) END AS scale,
                   CASE WHEN score > {threshold}::DOUBLE THEN CAST(px AS INTEGER) END AS x,
                   CASE WHEN score > {threshold}::DOUBLE THEN CAST(py AS INTEGER) END AS y,
                   CASE WHEN score > {threshold}::DOUBLE THEN sw END AS w,
                   CASE WHEN score > {threshold}::DOUBLE THEN sh END AS h
            FROM (SELECT *, row_number() OVER (PARTITION BY video_id, frame_no
                                               ORDER BY score DESC, scale_ix, py, px) AS rn FROM {prefix}s) r
            WHERE rn = 1"""),
    ]


_FIRST = [("firstpx", """SELECT * FROM fx_pixels p WHERE frame_no =
             (SELECT min(frame_no) FROM fx_pixels q WHERE q.video_id = p.video_id)""")]
_REUSE = _LEVELS + _FIRST + _sql_detect("firstpx", "f", THRESHOLD) + [
    ("frames", "SELECT DISTINCT video_id, frame_no FROM fx_pixels"),
    ("reuse", """SELECT fr.video_id, fr.frame_no, fb.detected, fb.confidence, fb.x, fb.y, fb.w, fb.h
                 FROM frames fr LEFT JOIN fb USING (video_id)"""),
]
_LOGO = [("ldim", "SELECT max(ly) + 1 AS ih, max(lx) + 1 AS iw FROM fx_logo"),
         _sql_sampling("lsamp", "lv", "ldim"),
         _sql_resized("lr", "lsamp", "fx_logo", "ly", "lx", "l", extra="a")]
_BLEND = _REUSE + _LOGO + [("blend", """
    SELECT p.video_id, p.frame_no, p.y, p.x, p.v AS v0,
           CASE WHEN lr.l IS NULL THEN p.v ELSE CAST(floor(
                (1.0::DOUBLE - CAST(lr.a AS DOUBLE) / 255.0::DOUBLE) * CAST(p.v AS DOUBLE)
                + (CAST(lr.a AS DOUBLE) / 255.0::DOUBLE) * CAST(lr.l AS DOUBLE)) AS BIGINT) END AS v
    FROM fx_pixels p LEFT JOIN fb ON fb.video_id = p.video_id AND fb.detected
    LEFT JOIN lr ON lr.sh = fb.h AND lr.sw = fb.w AND lr.oy = p.y - fb.y AND lr.ox = p.x - fb.x""")]


# ------------------------------------------------------------ Spark helpers
_PARAMS: dict[tuple, np.ndarray] = {}


def _param(spark, d, which: str) -> np.ndarray:
    """Template / logo image, loaded once per application and data folder."""
    key = (spark.sparkContext.applicationId, d, which)
    if key not in _PARAMS:
        if which == "template":
            _PARAMS[key] = PX.load_param_image(TD.template(spark, d), "ty", "tx", ("t",))
        else:
            _PARAMS[key] = PX.load_param_image(TD.logo(spark, d), "ly", "lx", ("l", "a"))
    return _PARAMS[key]


def _template(spark, d) -> np.ndarray:
    return _param(spark, d, "template")


def _logo(spark, d) -> np.ndarray:
    return _param(spark, d, "logo")


def _detect_px(spark, d, px: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    return PX.detect_pixels(px, _template(spark, d), F.lit(SIDE), F.lit(SIDE), threshold)


def _reuse(spark, d) -> DataFrame:
    px = TD.pixels(spark, d).select("video_id", "frame_no", "y", "x", "v")
    det = PX.first_frame_detection(px, lambda f: _detect_px(spark, d, f))
    keys = px.select("video_id", "frame_no").distinct()
    return PX.reuse_detection(keys, det).select("video_id", "frame_no", "detected", "confidence",
                                                "x", "y", "w", "h")


def _first_boxes(spark, d) -> DataFrame:
    px = TD.pixels(spark, d).select("video_id", "frame_no", "y", "x", "v")
    return PX.first_frame_detection(px, lambda f: _detect_px(spark, d, f))


PIXEL_ROW = T.StructType([T.StructField("video_id", T.IntegerType()), T.StructField("frame_no", T.LongType()),
                          T.StructField("y", T.IntegerType()), T.StructField("x", T.IntegerType()),
                          T.StructField("v", T.LongType())])


def frames_to_pixels(frames: DataFrame) -> DataFrame:
    """Frame rows -> pixel rows (single channel), for checks and reports."""
    from framelake.session import ship_package
    ship_package(frames.sparkSession)
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            parts = []
            for vid, fno, data, h, w in zip(b["video_id"], b["frame_no"], b["data"], b["height"], b["width"]):
                a = np.frombuffer(data, dtype=np.uint8).reshape(h, w)
                yy, xx = np.mgrid[0:h, 0:w]
                parts.append(pd.DataFrame({"video_id": np.int32(vid), "frame_no": np.int64(fno),
                                           "y": yy.ravel().astype(np.int32), "x": xx.ravel().astype(np.int32),
                                           "v": a.ravel().astype(np.int64)}))
            yield pd.concat(parts, ignore_index=True) if parts else pd.DataFrame(columns=PIXEL_ROW.names)
    return frames.select("video_id", "frame_no", "data", "height", "width").mapInPandas(run, PIXEL_ROW)


# ------------------------------------------------------------------ queries
_RESIZE_SQL = [
    ("rlv", f"SELECT 0 AS scale_ix, {RESIZE_TO[0]} AS sh, {RESIZE_TO[1]} AS sw"),
    ("rdim", f"SELECT {SIDE} AS ih, {SIDE} AS iw"),
    _sql_sampling("rsamp", "rlv", "rdim"),
]
_AT = "vals[s.y{0} * 8 + s.x{1} + 1]"
_RESIZE_BODY = f"""
    SELECT video_id, frame_no, CAST(s.oy AS INTEGER) AS y, CAST(s.ox AS INTEGER) AS x,
           {_u8(_bilinear(_AT.format(0, 0), _AT.format(0, 1), _AT.format(1, 0), _AT.format(1, 1)))} AS v
    FROM fx_arrays, rsamp s"""


@register("resize_pixels", with_fx(_RESIZE_BODY, "fx_arrays", ctes=_RESIZE_SQL))
def q_resize_pixels(spark, d):
    return PX.resize_pixels(TD.pixel_arrays(spark, d), "vals", SIDE, SIDE, *RESIZE_TO)


@register("rescale_frames", with_fx(_RESIZE_BODY, "fx_arrays", ctes=_RESIZE_SQL))
def q_rescale_frames(spark, d):
    """I8 on the production path: numpy bilinear resize per frame row."""
    return frames_to_pixels(PX.resize_frames(TD.pixel_frames(spark, d), *RESIZE_TO))


@register("scale_sweep", with_fx("""
    SELECT l.video_id, l.frame_no, s.scale_ix, s.scale, CAST(floor(CAST(l.w AS DOUBLE) * s.scale) AS INTEGER) AS sw,
           CAST(floor(CAST(l.h AS DOUBLE) * s.scale) AS INTEGER) AS sh
    FROM (SELECT video_id, frame_no, CAST(max(x) + 1 AS INTEGER) AS w, CAST(max(y) + 1 AS INTEGER) AS h
          FROM fx_pixels GROUP BY 1, 2) l, scl s""", "fx_pixels", ctes=[_LEVELS[0]]))
def q_scale_sweep(spark, d):
    """The 25 scaled sizes of every frame (as a template candidate)."""
    from framelake.functions.scalars import N_SCALES, scale_at, scaled_size
    dims = TD.pixels(spark, d).groupBy("video_id", "frame_no").agg(
        (F.max("x") + 1).cast("int").alias("w"), (F.max("y") + 1).cast("int").alias("h"))
    s = dims.select("*", F.explode(F.sequence(F.lit(0), F.lit(N_SCALES - 1))).alias("scale_ix"))
    s = s.withColumn("scale", scale_at(F.col("scale_ix")))
    return s.select("video_id", "frame_no", "scale_ix", "scale",
                    scaled_size(F.col("w"), F.col("scale")).alias("sw"),
                    scaled_size(F.col("h"), F.col("scale")).alias("sh"))


@register("template_match", with_fx("""
    SELECT video_id, frame_no, score, CAST(px AS INTEGER) AS x, CAST(py AS INTEGER) AS y FROM (
      SELECT *, row_number() OVER (PARTITION BY video_id, frame_no ORDER BY score DESC, py, px) AS rn FROM s) r
    WHERE rn = 1""", "fx_template", "fx_pixels", ctes=[
    ("m", f"""SELECT p.video_id, p.frame_no, p.y - t.ty AS py, p.x - t.tx AS px, count(*) AS n, sum(p.v) AS sv,
                    sum(p.v * p.v) AS svv, sum(p.v * t.t) AS svt
             FROM fx_pixels p JOIN fx_template t
               ON p.y - t.ty BETWEEN 0 AND {SIDE - 3} AND p.x - t.tx BETWEEN 0 AND {SIDE - 3}
             GROUP BY ALL"""),
    ("ts", "SELECT sum(t) AS st, sum(t * t) AS stt FROM fx_template"),
    ("s", """SELECT video_id, frame_no, py, px, CASE WHEN den = 0 THEN 0.0::DOUBLE ELSE num / den END AS score
             FROM (SELECT m.*, CAST(n * svt - sv * st AS DOUBLE) AS num,
                          sqrt(CAST(n * svv - sv * sv AS DOUBLE) * CAST(n * stt - st * st AS DOUBLE)) AS den
                   FROM m, ts) q""")]))
def q_template_match(spark, d):
    """Best single-scale normalized correlation per frame."""
    tpl = _template(spark, d)
    pyr = K.TemplatePyramid(tpl)
    pyr.levels = [lv for lv in pyr.levels if (lv[1], lv[2]) == tpl.shape][:1]
    s = PX.match_sums(TD.pixels(spark, d), pyr, F.lit(SIDE), F.lit(SIDE))
    st, stt = int(pyr.levels[0][4][0]), int(pyr.levels[0][5][0])
    sc = s.withColumn("score", PX.ncc_score(F.col("n"), F.col("sv"), F.col("svv"), F.col("svt"),
                                            F.lit(st).cast("bigint"), F.lit(stt).cast("bigint")))
    b = sc.groupBy("video_id", "frame_no").agg(F.max_by(F.struct("score", "px", "py"),
                                                        F.struct("score", -F.col("py"), -F.col("px"))).alias("b"))
    return b.select("video_id", "frame_no", F.col("b.score").alias("score"),
                    F.col("b.px").cast("int").alias("x"), F.col("b.py").cast("int").alias("y"))


_DETECT_ALL = _LEVELS + _sql_detect("fx_pixels", "all_", THRESHOLD)


@register("detect_logo", with_fx("SELECT * FROM all_b", "fx_template", "fx_pixels", ctes=_DETECT_ALL))
def q_detect_logo(spark, d):
    """I4/D2/E3 (per-frame mode): multi-scale detection in every frame."""
    return _detect_px(spark, d, TD.pixels(spark, d).select("video_id", "frame_no", "y", "x", "v"))


@register("detect_frames", with_fx("SELECT * FROM all_b", "fx_template", "fx_pixels", ctes=_DETECT_ALL))
def q_detect_frames(spark, d):
    """I4 on the production path: numpy FFT correlation in mapInPandas."""
    return PX.detect_frames(TD.pixel_frames(spark, d), _template(spark, d), THRESHOLD)


@register("quarantine_detect", with_fx("""
    SELECT video_id, frame_no, frame_no % 10 = 3 AS quarantined, CASE WHEN frame_no % 10 = 3 THEN NULL ELSE detected END AS detected,
           CASE WHEN frame_no % 10 = 3 THEN NULL ELSE confidence END AS confidence,
           CASE WHEN frame_no % 10 = 3 THEN 64 - 1 - frame_no % 7 END AS n_bytes
    FROM all_b""", "fx_template", "fx_pixels", ctes=_DETECT_ALL))
def q_quarantine_detect(spark, d):
    """C6 on frames: every tenth frame is cut short; detection goes on, and the
    frames it could not decode leave it as rows with the reason."""
    from framelake.operators.quality import split_valid
    frames = TD.pixel_frames(spark, d)
    short = F.col("frame_no") % 10 == 3
    cut = F.when(short, F.substring("data", F.lit(1), (63 - F.col("frame_no") % 7).cast("int"))).otherwise(F.col("data"))
    found = PX.detect_frames(frames.withColumn("data", cut), _template(spark, d), THRESHOLD, on_error="quarantine")
    good, bad = split_valid(found, F.col("error"))
    n_bytes = F.regexp_extract("error", r"size (\d+)", 1).cast("bigint")          # of the decoder's message
    return (good.select("video_id", "frame_no", F.lit(False).alias("quarantined"), "detected", "confidence", F.lit(None).cast("bigint").alias("n_bytes"))
                .unionByName(bad.select("video_id", "frame_no", F.lit(True).alias("quarantined"), F.lit(None).cast("boolean").alias("detected"),
                                        F.lit(None).cast("double").alias("confidence"), n_bytes.alias("n_bytes"))))


@register("detect_frames_split", with_fx("SELECT * FROM all_b", "fx_template", "fx_pixels", ctes=_DETECT_ALL))
def q_detect_frames_split(spark, d):
    """I4/D2 with the frame x scale work spread over tasks (few-frames form)."""
    return PX.detect_frames_split(TD.pixel_frames(spark, d), _template(spark, d), 4, THRESHOLD)


@register("detect_threshold", with_fx(f"""
    SELECT video_id, frame_no, confidence, x, y FROM all_b WHERE confidence > {STRICT_THRESHOLD}::DOUBLE""",
    "fx_template", "fx_pixels", ctes=_DETECT_ALL))
def q_detect_threshold(spark, d):
    """Detections strictly above a confidence cut."""
    det = q_detect_logo(spark, d)
    return det.where(F.col("confidence") > F.lit(STRICT_THRESHOLD)).select(
        "video_id", "frame_no", "confidence", "x", "y")


@register("first_frame_reuse", with_fx("SELECT * FROM reuse", "fx_template", "fx_logo", "fx_pixels",
                                       ctes=_REUSE))
def q_first_frame_reuse(spark, d):
    """D3: detect once per video (first frame), reuse for every frame."""
    return _reuse(spark, d)


@register("blend_logo", with_fx("SELECT video_id, frame_no, y, x, v FROM blend",
                                "fx_template", "fx_logo", "fx_pixels", ctes=_BLEND))
def q_blend_logo(spark, d):
    """Alpha-blend the new logo at each video's first-frame box."""
    px = TD.pixels(spark, d).select("video_id", "frame_no", "y", "x", "v")
    return PX.blend_pixels(px, _first_boxes(spark, d), _logo(spark, d), _template(spark, d).shape)


@register("blend_frames", with_fx("SELECT video_id, frame_no, y, x, v FROM blend",
                                  "fx_template", "fx_logo", "fx_pixels", ctes=_BLEND))
def q_blend_frames(spark, d):
    """I6 on the production path: numpy blend per frame row, box per video
    from a numpy first-frame detection."""
    frames = TD.pixel_frames(spark, d)
    tpl = _template(spark, d)
    det = PX.first_frame_detection(frames, lambda f: PX.detect_frames(f, tpl, THRESHOLD))
    return frames_to_pixels(PX.blend_frames(frames, det.drop("frame_no"), _logo(spark, d)))


@register("blend_patches", with_fx("""
    SELECT b.video_id, b.frame_no, fb.x AS px, fb.y AS py,
           CAST(least(fb.w, 8 - fb.x) AS INTEGER) AS pw, CAST(least(fb.h, 8 - fb.y) AS INTEGER) AS ph,
           string_agg(printf('%02X', b.v), '' ORDER BY b.y, b.x) AS patch_hex
    FROM blend b JOIN fb ON fb.video_id = b.video_id AND fb.detected
    WHERE b.x >= fb.x AND b.x < fb.x + fb.w AND b.y >= fb.y AND b.y < fb.y + fb.h
    GROUP BY b.video_id, b.frame_no, fb.x, fb.y, fb.w, fb.h""",
    "fx_template", "fx_logo", "fx_pixels", ctes=_BLEND))
def q_blend_patches(spark, d):
    """I6, patch form: only the blended region of each frame is emitted."""
    frames = TD.pixel_frames(spark, d)
    tpl = _template(spark, d)
    det = PX.first_frame_detection(frames, lambda f: PX.detect_frames(f, tpl, THRESHOLD))
    p = PX.blend_patches(frames, det.drop("frame_no"), _logo(spark, d))
    return p.select("video_id", "frame_no", "px", "py", "pw", "ph", F.hex("patch").alias("patch_hex"))


_PER_FRAME = _LEVELS + _sql_detect("fx_pixels", "all_", THRESHOLD) + _LOGO + [("pblend", """
    SELECT p.video_id, p.frame_no, p.y, p.x, p.v AS v0,
           CASE WHEN lr.l IS NULL THEN p.v ELSE CAST(floor(
                (1.0::DOUBLE - CAST(lr.a AS DOUBLE) / 255.0::DOUBLE) * CAST(p.v AS DOUBLE)
                + (CAST(lr.a AS DOUBLE) / 255.0::DOUBLE) * CAST(lr.l AS DOUBLE)) AS BIGINT) END AS v
    FROM fx_pixels p LEFT JOIN all_b d ON d.video_id = p.video_id AND d.frame_no = p.frame_no AND d.detected
    LEFT JOIN lr ON lr.sh = d.h AND lr.sw = d.w AND lr.oy = p.y - d.y AND lr.ox = p.x - d.x""")]


@register("replace_per_frame", with_fx("SELECT video_id, frame_no, y, x, v FROM pblend",
                                       "fx_template", "fx_logo", "fx_pixels", ctes=_PER_FRAME))
def q_replace_per_frame(spark, d):
    """I4 per_frame + I6 on frame rows: detect and blend in one pass."""
    out = PX.replace_frames(TD.pixel_frames(spark, d), _template(spark, d), _logo(spark, d), THRESHOLD)
    return frames_to_pixels(out)


@register("per_frame_summary", with_fx("""
    SELECT d.video_id, count(*) AS n_processed, count(*) FILTER (WHERE d.detected) AS n_detected,
           100.0::DOUBLE * CAST(count(*) FILTER (WHERE d.detected) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS detect_pct,
           min(d.confidence) AS min_confidence, max(d.confidence) AS max_confidence,
           CAST(sum(c.n_changed) AS BIGINT) AS n_changed_pixels
    FROM all_b d JOIN (SELECT video_id, frame_no, count(*) FILTER (WHERE v <> v0) AS n_changed
                       FROM pblend GROUP BY 1, 2) c USING (video_id, frame_no)
    GROUP BY 1""", "fx_template", "fx_logo", "fx_pixels", ctes=_PER_FRAME))
def q_per_frame_summary(spark, d):
    """E4 in per_frame mode (relational twin): processed / detected / changed
    per video, detection in every frame and the blend at each frame's box."""
    px = TD.pixels(spark, d).select("video_id", "frame_no", "y", "x", "v")
    det = _detect_px(spark, d, px)
    blended = PX.blend_pixels(px, det, _logo(spark, d), _template(spark, d).shape, key=["video_id", "frame_no"],
                              keep_original=True)
    changed = blended.groupBy("video_id", "frame_no").agg(F.count_if(F.col("v") != F.col("v0")).alias("n_changed"))
    j = det.join(changed, ["video_id", "frame_no"])
    return j.groupBy("video_id").agg(
        F.count(F.lit(1)).alias("n_processed"), F.count_if("detected").alias("n_detected"),
        (F.lit(100.0) * F.count_if("detected").cast("double") / F.count(F.lit(1)).cast("double")).alias("detect_pct"),
        F.min("confidence").alias("min_confidence"), F.max("confidence").alias("max_confidence"),
        F.sum("n_changed").cast("bigint").alias("n_changed_pixels"))


@register("annotate_box", with_fx("""
    SELECT p.video_id, p.frame_no, p.y, p.x,
           CASE WHEN fb.detected AND p.x >= fb.x AND p.x <= fb.x + fb.w AND p.y >= fb.y AND p.y <= fb.y + fb.h
                     AND (p.x - fb.x < 2 OR fb.x + fb.w - p.x < 2 OR p.y - fb.y < 2 OR fb.y + fb.h - p.y < 2)
                THEN CAST(255 AS BIGINT) ELSE p.v END AS v
    FROM fx_pixels p LEFT JOIN fb USING (video_id)""", "fx_template", "fx_logo", "fx_pixels", ctes=_REUSE))
def q_annotate_box(spark, d):
    """Draw the detected box (2 px) on every frame of its video."""
    px = TD.pixels(spark, d).select("video_id", "frame_no", "y", "x", "v")
    return PX.annotate_pixels(px, _first_boxes(spark, d))


@register("annotate_frames", ORACLES["annotate_box"])
def q_annotate_frames(spark, d):
    """I7 on the production path: numpy outline per frame row."""
    frames = TD.pixel_frames(spark, d)
    tpl = _template(spark, d)
    det = PX.first_frame_detection(frames, lambda f: PX.detect_frames(f, tpl, THRESHOLD))
    return frames_to_pixels(PX.annotate_frames(frames, det.drop("frame_no")))


@register("bbox_clip", with_fx(f"""
    SELECT video_id, frame_no, x, y, least(w, {SIDE} - x) AS w, least(h, {SIDE} - y) AS h FROM (
      SELECT DISTINCT video_id, frame_no, CAST(frame_no % 8 AS INTEGER) AS x,
             CAST((frame_no // 8) % 8 AS INTEGER) AS y, CAST(3 + frame_no % 4 AS INTEGER) AS w,
             CAST(3 + frame_no % 3 AS INTEGER) AS h FROM fx_pixels) b""", "fx_pixels"))
def q_bbox_clip(spark, d):
    """Boxes placed by frame number, clipped to the 8x8 frame."""
    from framelake.functions.scalars import clip_extent
    f = TD.pixels(spark, d).select("video_id", "frame_no").distinct()
    b = f.select("video_id", "frame_no", (F.col("frame_no") % 8).cast("int").alias("x"),
                 ((F.col("frame_no") / 8).cast("bigint") % 8).cast("int").alias("y"),
                 (F.lit(3) + F.col("frame_no") % 4).cast("int").alias("w"),
                 (F.lit(3) + F.col("frame_no") % 3).cast("int").alias("h"))
    return b.select("video_id", "frame_no", "x", "y",
                    clip_extent(F.col("x"), F.col("w"), F.lit(SIDE)).alias("w"),
                    clip_extent(F.col("y"), F.col("h"), F.lit(SIDE)).alias("h"))


@register("image_stats", with_fx("""
    SELECT video_id, frame_no, CAST(max(y) + 1 AS INTEGER) AS height, CAST(max(x) + 1 AS INTEGER) AS width,
           count(*) AS n_pixels, min(v) AS min_v, max(v) AS max_v, avg(v) AS mean_v, 1 AS nChannels,
           CAST(count(*) AS DOUBLE) / 1024.0::DOUBLE AS size_kb
    FROM fx_pixels GROUP BY 1, 2""", "fx_pixels"))
def q_image_stats(spark, d):
    """Frame dimensions, channels, size and value range."""
    return PX.frame_stats(TD.pixels(spark, d))


@register("run_summary", with_fx("""
    SELECT r.video_id, r.n_frames, r.n_detected, 100.0::DOUBLE * CAST(r.n_detected AS DOUBLE) / CAST(r.n_frames AS DOUBLE)
             AS detect_pct, r.confidence, c.n_changed, c.mean_out
    FROM (SELECT video_id, count(*) AS n_frames, count(*) FILTER (WHERE detected) AS n_detected,
                 max(confidence) AS confidence FROM reuse GROUP BY 1) r
    JOIN (SELECT video_id, count(*) FILTER (WHERE v <> v0) AS n_changed, avg(v) AS mean_out
          FROM blend GROUP BY 1) c USING (video_id)""",
    "fx_template", "fx_logo", "fx_pixels", ctes=_BLEND))
def q_run_summary(spark, d):
    """E4 + flagship: detect once per video, reuse, blend, summarise."""
    from framelake.plans.logo_job import replace_logo_summary
    return replace_logo_summary(TD.pixel_frames(spark, d), _template(spark, d), _logo(spark, d), THRESHOLD)


# -------------------------------------------------- three channels and alpha
def _sql_resized_c(name: str, samp: str, src: str, value: str) -> tuple[str, str]:
    """Every channel of ``src(y, x, c, <value>)`` at every size of ``samp``."""
    joins = " ".join(f"JOIN {src} {al} ON {al}.c = k.c AND {al}.y = s.y{yy} AND {al}.x = s.x{xx}"
                     for al, yy, xx in (("a", 0, 0), ("b", 0, 1), ("d", 1, 0), ("e", 1, 1)))
    mixed = _u8(_bilinear(f"a.{value}", f"b.{value}", f"d.{value}", f"e.{value}"))
    return (name, f"""
        SELECT s.scale_ix, s.sh, s.sw, s.oy, s.ox, k.c, {mixed} AS {value}
        FROM {samp} s CROSS JOIN (SELECT DISTINCT c FROM {src}) k {joins}""")


def _sql_detect_c(src: str) -> list[tuple[str, str]]:
    """Best match per frame of ``src``, the sums of the channels added up."""
    hit = f"score > {THRESHOLD}::DOUBLE"
    return [
        ("cm", f"""
            SELECT p.video_id, p.frame_no, t.scale_ix, t.sh, t.sw, p.y - t.oy AS py, p.x - t.ox AS px, p.c,
                   count(*) AS n, sum(p.v) AS sv, sum(p.v * p.v) AS svv, sum(p.v * t.v) AS svt
            FROM {src} p JOIN ctr t ON t.c = p.c AND p.y - t.oy BETWEEN 0 AND {SIDE} - t.sh
                                   AND p.x - t.ox BETWEEN 0 AND {SIDE} - t.sw
            GROUP BY ALL"""),
        ("cs", """
            SELECT video_id, frame_no, scale_ix, sh, sw, py, px,
                   CASE WHEN den = 0 THEN 0.0::DOUBLE ELSE num / den END AS score
            FROM (SELECT video_id, frame_no, scale_ix, sh, sw, py, px,
                         CAST(sum(n * svt - sv * st) AS DOUBLE) AS num,
                         sqrt(CAST(sum(n * svv - sv * sv) AS DOUBLE) * CAST(sum(n * stt - st * st) AS DOUBLE)) AS den
                  FROM cm JOIN ctsum USING (scale_ix, c) GROUP BY ALL) q"""),
        ("cb", f"""
            SELECT video_id, frame_no, {hit} AS detected, greatest(score, 0.0::DOUBLE) AS confidence,
                   CASE WHEN {hit} THEN scale_ix END AS scale_ix,
                   CASE WHEN {hit} THEN (SELECT scale FROM scl WHERE scl.scale_ix = r.scale_ix) END AS scale,
                   CASE WHEN {hit} THEN CAST(px AS INTEGER) END AS x,
                   CASE WHEN {hit} THEN CAST(py AS INTEGER) END AS y,
                   CASE WHEN {hit} THEN sw END AS w, CASE WHEN {hit} THEN sh END AS h
            FROM (SELECT *, row_number() OVER (PARTITION BY video_id, frame_no
                                               ORDER BY score DESC, scale_ix, py, px) AS rn FROM cs) r
            WHERE rn = 1"""),
    ]


_BGR_LEVELS = [
    _LEVELS[0],
    ("tdim", "SELECT 3 AS ih, 3 AS iw"),
    _LEVELS[2],
    ("ctpl", """SELECT y - 2 AS y, x - 2 AS x, c, v FROM fx_bgr
                WHERE frame_no = 0 AND y BETWEEN 2 AND 4 AND x BETWEEN 2 AND 4"""),
    _sql_sampling("tsamp", "lv", "tdim"),
    _sql_resized_c("ctr", "tsamp", "ctpl", "v"),
    ("ctsum", "SELECT scale_ix, c, sum(v) AS st, sum(v * v) AS stt FROM ctr GROUP BY 1, 2"),
]
#: the logo's channels 0 to 2 are colours, channel 3 its alpha
_BGR_BLEND = _BGR_LEVELS + [
    ("cfirst", """SELECT * FROM fx_bgr p WHERE frame_no =
                  (SELECT min(frame_no) FROM fx_bgr q WHERE q.video_id = p.video_id)"""),
    *_sql_detect_c("cfirst"),
    ("clogo", """SELECT y, x, c, v FROM fx_bgr WHERE frame_no = 1 AND y < 3 AND x < 3
                 UNION ALL
                 SELECT y, x, 3 AS c, CAST(CASE x WHEN 0 THEN 0 WHEN 1 THEN 128 ELSE 255 END AS BIGINT) AS v
                 FROM fx_bgr WHERE frame_no = 1 AND y < 3 AND x < 3 AND c = 0"""),
    _sql_resized_c("clr", "tsamp", "clogo", "v"),
    ("cblend", """
        SELECT p.video_id, p.frame_no, p.y, p.x, p.c,
               CASE WHEN l.v IS NULL THEN p.v ELSE CAST(floor(
                    (1.0::DOUBLE - CAST(a.v AS DOUBLE) / 255.0::DOUBLE) * CAST(p.v AS DOUBLE)
                    + (CAST(a.v AS DOUBLE) / 255.0::DOUBLE) * CAST(l.v AS DOUBLE)) AS BIGINT) END AS v
        FROM fx_bgr p LEFT JOIN cb ON cb.video_id = p.video_id AND cb.detected
        LEFT JOIN clr l ON l.c = p.c AND l.sh = cb.h AND l.sw = cb.w AND l.oy = p.y - cb.y AND l.ox = p.x - cb.x
        LEFT JOIN clr a ON a.c = 3 AND a.sh = l.sh AND a.sw = l.sw AND a.oy = l.oy AND a.ox = l.ox"""),
]


def _bgr_image(frames: DataFrame, frame_no: int, y0: int, x0: int) -> np.ndarray:
    """A 3x3 crop of one frame, as a parameter image."""
    data = frames.where(F.col("frame_no") == frame_no).first()["data"]
    return np.frombuffer(bytes(data), np.uint8).reshape(SIDE, SIDE, 3)[y0:y0 + 3, x0:x0 + 3].copy()


def _bgr_template(frames: DataFrame) -> np.ndarray:
    return _bgr_image(frames, TD.TEMPLATE_FRAME, TD.TEMPLATE_Y0, TD.TEMPLATE_X0)


@register("detect_frames_bgr", with_fx("SELECT * FROM cb", "fx_bgr", ctes=_BGR_LEVELS + _sql_detect_c("fx_bgr")))
def q_detect_frames_bgr(spark, d):
    """I4 on frames of three channels."""
    frames = TD.bgr_frames(spark, d)
    return PX.detect_frames(frames, _bgr_template(frames))


@register("blend_frames_bgr", with_fx("""
    SELECT video_id, frame_no, string_agg(printf('%02X', v), '' ORDER BY y, x, c) AS data_hex
    FROM cblend GROUP BY 1, 2""", "fx_bgr", ctes=_BGR_BLEND))
def q_blend_frames_bgr(spark, d):
    """I6 on frames of three channels with a logo of four: first-frame boxes."""
    frames = TD.bgr_frames(spark, d)
    template = _bgr_template(frames)
    alpha = np.tile(np.array(TD.LOGO_ALPHA_BY_COLUMN, np.uint8), (TD.LOGO_SIDE, 1))
    logo = np.dstack([_bgr_image(frames, TD.LOGO_FRAME, 0, 0), alpha])
    boxes = PX.first_frame_detection(frames, lambda f: PX.detect_frames(f, template)).drop("frame_no")
    return PX.blend_frames(frames, boxes, logo).select("video_id", "frame_no", F.hex("data").alias("data_hex"))
