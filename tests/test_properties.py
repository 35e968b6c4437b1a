"""Operators against plain-Python reference implementations on random inputs."""

import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from framelake.operators import kernels as K
from framelake.operators import media as MD
from framelake.operators import pixels as PX
from framelake.plans import chunking as CH

SETTINGS = settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))


def _frames(seed, n=400):
    rnd = random.Random(seed)
    rows, used = [], set()
    for fid in range(n):
        vid = 0 if rnd.random() < 0.4 else rnd.randint(1, 3)           # a hot video
        pts = rnd.randint(0, 10_000_000)
        while (vid, pts) in used:
            pts += 1
        used.add((vid, pts))
        rows.append((vid, fid, pts, "I" if rnd.random() < 0.15 else "P"))
    return rows


def _segments_reference(rows, n):
    out = {}
    for vid in {r[0] for r in rows}:
        fr = sorted((r for r in rows if r[0] == vid), key=lambda r: (r[2], r[1]))
        dur = max(r[2] for r in fr) + 1
        seg, counts = 0, {}
        for _, fid, pts, pt in fr:
            if pt == "I":
                seg = max(seg, min(n - 1, pts * n // dur))
            counts[seg] = counts.get(seg, 0) + 1
        off = 0
        for i, s in enumerate(sorted(counts)):
            out[(vid, i)] = (s, counts[s], off)
            off += counts[s]
    return out


@SETTINGS
@given(seed=st.integers(0, 10_000), n=st.integers(2, 12), block=st.sampled_from([10_000, 250_000, 5_000_000]))
def test_keyframe_segments_match_reference(spark, seed, n, block):
    rows = _frames(seed)
    df = spark.createDataFrame(rows, "video_id long, frame_id long, pts_us long, pict_type string")
    got = {(r.video_id, r.chunk_id): (r.nominal_chunk, r.frame_count, r.frame_offset)
           for r in CH.keyframe_segments(df, n, block_us=block).collect()}
    assert got == _segments_reference(rows, n)


def _resample_reference(rows, num, den):
    out = {}
    for vid in {r[0] for r in rows}:
        slots = {}
        for _, fid, pts, _ in sorted((r for r in rows if r[0] == vid), key=lambda r: (r[2], r[1])):
            slots[(2 * pts * num + den * 1_000_000) // (2 * den * 1_000_000)] = fid
        last = None
        for k in range(min(slots), max(slots) + 1):
            last = slots.get(k, last)
            out[(vid, k)] = (last, k not in slots)
    return out


@SETTINGS
@given(seed=st.integers(0, 10_000), fps=st.sampled_from([(1, 1), (25, 1), (30000, 1001), (1, 3)]),
       block=st.sampled_from([7, 64, 4096]))
def test_fps_resample_matches_reference(spark, seed, fps, block):
    rows = _frames(seed, 200)
    df = spark.createDataFrame(rows, "video_id long, frame_id long, pts_us long, pict_type string")
    got = {(r.video_id, r.slot): (r.frame_id, r.is_dup)
           for r in MD.fps_resample(df.select("video_id", "frame_id", "pts_us"), *fps, block_slots=block).collect()}
    assert got == _resample_reference(rows, *fps)


@SETTINGS
@given(seed=st.integers(0, 10_000), th=st.integers(2, 4), tw=st.integers(2, 4))
def test_relational_detection_equals_kernel(spark, seed, th, tw):
    rng = np.random.default_rng(seed)
    frames = [rng.integers(0, 256, (9, 10), dtype=np.uint8) for _ in range(3)]
    frames.append(np.full((9, 10), 50, dtype=np.uint8))                     # flat frame
    tpl = frames[0][2:2 + th, 3:3 + tw].copy()
    rows = [(0, i, y, x, int(f[y, x])) for i, f in enumerate(frames) for y in range(9) for x in range(10)]
    px = spark.createDataFrame(rows, "video_id long, frame_no long, y int, x int, v long")
    got = {r.frame_no: r for r in PX.detect_pixels(px, tpl, F.lit(9), F.lit(10)).collect()}
    pyr = K.TemplatePyramid(tpl)
    for i, f in enumerate(frames):
        want = K.detect(f, pyr)
        g = got[i]
        assert (g.detected, g.x, g.y, g.w, g.h, g.scale_ix) == (
            want["detected"], want["x"], want["y"], want["w"], want["h"], want["scale_ix"])
        assert g.confidence == pytest.approx(want["confidence"], abs=1e-12)


def test_plans_cover_duration_without_overlap(spark):
    v = spark.createDataFrame([(1, 61.5), (2, 3600.0)], "video_id long, duration_s double")
    for r in CH.chunk_sweep(v, 2, 10).groupBy("video_id", "num_chunks").agg(
            F.sum("chunk_len_s").alias("total"), F.max("start_s").alias("last_start"),
            F.first("chunk_len_s").alias("len"), F.count(F.lit(1)).alias("n")).collect():
        dur = 61.5 if r.video_id == 1 else 3600.0
        assert r.n == r.num_chunks and r.total == pytest.approx(dur)
        assert r.last_start + r.len == pytest.approx(dur)
    f = spark.createDataFrame([(0, i, i * 37) for i in range(1000)], "video_id long, frame_id long, pts_us long")
    plan = CH.micro_plan(f, 7).orderBy("chunk_id").collect()
    assert plan[0].start_us == 0 and all(a.end_us == b.start_us for a, b in zip(plan, plan[1:]))
    assert CH.range_join_chunks(f, CH.micro_plan(f, 7), 1000).count() == 1000


def test_keyframe_segments_with_probe_duration(spark):
    rows = [(0, i, i * 1000, "I" if i % 5 == 0 else "P") for i in range(100)]
    df = spark.createDataFrame(rows, "video_id long, frame_id long, pts_us long, pict_type string")
    ext = spark.createDataFrame([(0, 200_000)], "video_id long, dur_us long")     # twice the frames' span
    segs = CH.keyframe_segments(df, 4, block_us=10_000, extent=ext).orderBy("chunk_id").collect()
    # nominal chunks of 50 ms: frames (0..99 ms) fill chunks 0 and 1 only
    assert [(r.nominal_chunk, r.frame_count, r.frame_offset) for r in segs] == [(0, 50, 0), (1, 50, 50)]


def test_keyframe_segments_frames_and_reset_timestamps(spark):
    rows = _frames(3, 300)
    df = spark.createDataFrame(rows, "video_id long, frame_id long, pts_us long, pict_type string")
    segs = {(r.video_id, r.chunk_id): r for r in CH.keyframe_segments(df, 6, block_us=250_000).collect()}
    fr = CH.keyframe_segments(df, 6, block_us=250_000, with_frames=True).collect()
    assert len(fr) == len(rows)
    for f in fr:
        s = segs[(f.video_id, f.chunk_id)]
        assert s.first_pts_us <= f.pts_us <= s.last_pts_us
        assert f.pts_in_chunk_us == f.pts_us - s.first_pts_us          # timestamps restart per chunk
    counts = {}
    for f in fr:
        counts[(f.video_id, f.chunk_id)] = counts.get((f.video_id, f.chunk_id), 0) + 1
    assert counts == {k: s.frame_count for k, s in segs.items()}
