"""Planted-logo PNG frames through the image source, production detection
and blending (A3 + B5 + I4 + I6 on frame rows)."""

import numpy as np
from pyspark.sql import functions as F

from framelake.functions.scalars import basename
from framelake.operators import kernels as K
from framelake.operators import pixels as PX
from framelake.sources.files import read_images
from tests.test_sources import _png


def test_planted_logo_png_frames(spark, tmp_dir):
    rng = np.random.default_rng(11)
    tpl = rng.integers(0, 256, (10, 14, 3), dtype=np.uint8)            # BGR template
    ix = 12                                                             # planted at scale index 12
    s = K.scales()[ix]
    sh, sw = int(10 * s), int(14 * s)
    first_ix = min(i for i in range(25) if (int(10 * K.scales()[i]), int(14 * K.scales()[i])) == (sh, sw))
    frames = []
    for n in range(1, 4):
        f = rng.integers(0, 256, (48, 64, 3), dtype=np.uint8)
        f[20:20 + sh, 30:30 + sw] = K.resize_bilinear(tpl, sh, sw)
        frames.append(f)
        rgb = f[:, :, ::-1]                                             # PNG stores RGB
        _png(f"{tmp_dir}/frame{n:06d}.png", [list(row.ravel()) for row in rgb], 2)
    imgs = read_images(spark, tmp_dir)
    fr = imgs.select(F.lit(0).cast("long").alias("video_id"),
                     F.regexp_extract(basename(F.col("origin")), r"frame(\d+)\.png", 1).cast("long").alias("frame_no"),
                     "height", "width", "nChannels", "data")
    det = {r.frame_no: r for r in PX.detect_frames(fr, tpl).collect()}
    assert sorted(det) == [1, 2, 3]
    for r in det.values():
        assert r.detected and r.confidence > 0.97
        assert (r.x, r.y, r.w, r.h, r.scale_ix) == (30, 20, sw, sh, first_ix)
    logo = np.dstack([np.full((10, 14, 3), 200, np.uint8), np.full((10, 14), 255, np.uint8)])
    boxes = PX.first_frame_detection(fr, lambda f: PX.detect_frames(f, tpl)).drop("frame_no")
    out = {r.frame_no: np.frombuffer(r.data, np.uint8).reshape(48, 64, 3)
           for r in PX.blend_frames(fr, boxes, logo).collect()}
    for n, f in enumerate(frames, start=1):
        assert np.all(out[n][20:20 + sh, 30:30 + sw] == 200)
        mask = np.ones((48, 64), bool)
        mask[20:20 + sh, 30:30 + sw] = False
        assert np.array_equal(out[n][mask], f[mask])


def test_patches_rebuild_blended_frames(spark):
    from tests.conftest import SF_SMALL
    from framelake.sources import testdata as TD
    frames = TD.pixel_frames(spark, SF_SMALL)
    tpl = PX.load_param_image(TD.template(spark, SF_SMALL), "ty", "tx", ("t",))
    logo = PX.load_param_image(TD.logo(spark, SF_SMALL), "ly", "lx", ("l", "a"))
    det = PX.first_frame_detection(frames, lambda f: PX.detect_frames(f, tpl)).drop("frame_no")
    full = {(r.video_id, r.frame_no): bytes(r.data) for r in PX.blend_frames(frames, det, logo).collect()}
    rebuilt = {(r.video_id, r.frame_no): bytes(r.data)
               for r in PX.apply_patches(frames, PX.blend_patches(frames, det, logo)).collect()}
    assert full == rebuilt and len(full) == frames.count()


def test_svd_topk_equals_numpy(spark):
    from tests.conftest import SF_SMALL
    from framelake.operators.linalg import svd_topk
    emb = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    got = [r.sigma for r in svd_topk(spark, emb, "embedding", 6).orderBy("k").collect()]
    x = np.stack([np.asarray(r.embedding, dtype=np.float64) for r in emb.select("embedding").collect()])
    assert np.allclose(got, np.linalg.svd(x, compute_uv=False)[:6], rtol=1e-9)
