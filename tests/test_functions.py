"""Column functions (names, estimates, KPIs, scales, clipping, timestamps)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from framelake.functions import scalars as S


def test_names(spark):
    df = spark.createDataFrame([(7, 42), (1234, 1234567)], "c long, f long")
    got = df.select(S.chunk_name(F.col("c")).alias("a"), S.frame_name(F.col("f")).alias("b"),
                    S.frame_name_underscore(F.col("f")).alias("u")).collect()
    assert [tuple(r) for r in got] == [("chunk_007.mp4", "frame000042.png", "frame_000042.png"),
                                       ("chunk_1234.mp4", "frame1234567.png", "frame_1234567.png")]
    p = spark.createDataFrame([("`/a/b/chunk_001.mp4'",)], "p string")
    r = p.select(S.basename(S.strip_quotes(F.col("p"))).alias("b"),
                 S.strip_extension(S.basename(S.strip_quotes(F.col("p")))).alias("s")).first()
    assert (r.b, r.s) == ("chunk_001.mp4", "chunk_001")


def test_frame_count_estimates_round_half_even(spark):
    df = spark.createDataFrame([(2.5, 1.0), (3.5, 1.0), (10.0, 29.97)], "d double, fps double")
    got = [tuple(r) for r in df.select(S.frame_count_round(F.col("d"), F.col("fps")),
                                       S.frame_count_floor(F.col("d"), F.col("fps"))).collect()]
    assert got == [(round(2.5), 2), (round(3.5), 3), (round(10.0 * 29.97), int(29.97 * 10.0))]
    z = spark.createDataFrame([(100, 0.0)], "n long, fps double")
    assert z.select(S.duration_from_count(F.col("n"), F.col("fps"))).first()[0] is None


def test_frame_pts_and_ratios(spark):
    df = spark.createDataFrame([(1,), (2,), (30001,)], "n long")
    pts = [r[0] for r in df.select(S.frame_pts_us(F.col("n"), F.lit(30000), F.lit(1001))).collect()]
    assert pts == [0, 1000000 * 1001 // 30000, 30000 * 1000000 * 1001 // 30000]
    r = spark.createDataFrame([(5, 0), (1, 4)], "a long, b long").select(S.safe_ratio(F.col("a"), F.col("b")))
    assert [x[0] for x in r.collect()] == [0.0, 0.25]


def test_scales_and_clip(spark):
    ix = spark.range(25).select(S.scale_at(F.col("id")).alias("s"))
    assert np.array_equal(np.array([r.s for r in ix.collect()]), np.linspace(0.8, 2.0, 25))
    b = spark.createDataFrame([(6, 4, 8)], "x int, w int, frame_w int")
    assert b.select(S.clip_extent(F.col("x"), F.col("w"), F.col("frame_w"))).first()[0] == 2
    sz = spark.createDataFrame([(90, 1.6)], "d int, s double").select(S.scaled_size(F.col("d"), F.col("s")))
    assert sz.first()[0] == 144
    with pytest.raises(ValueError):
        S.parse_fps("x", "other")
