"""NULL video and chunk keys are keys like any other: no operator loses their rows."""

import pytest
from pyspark.sql import functions as F

from framelake.operators import frames as FR
from framelake.operators import media as MD
from framelake.operators.joins import by_keys
from framelake.plans import chunking as CH
from framelake.sources.sinks import sweep_rows


@pytest.fixture
def media(spark):
    """Two videos of the same frames, one of them without a name."""
    rows = [(v, 10 * v0 + i, 7 * i, "I" if i % 3 == 0 else "P", 100) for v0, v in enumerate((1, None)) for i in range(9)]
    return spark.createDataFrame(rows, "video_id long, frame_id long, pts_us long, pict_type string, size_bytes long")


@pytest.fixture
def parts(spark):
    rows = [(v, c, i, bytes([65 + i])) for v in (1, None) for c in (0, None) for i in range(1, 6)]
    return spark.createDataFrame(rows, "video_id long, chunk_id long, frame_no long, data binary")


def both_alike(df, key="video_id"):
    """The rows of the named and of the nameless video, without key and ids."""
    rest = [c for c in df.columns if c not in (key, "frame_id", "packet_id")]
    rows = df.select(key, *rest).collect()
    named, nameless = ([tuple(r)[1:] for r in rows if (r[0] is None) == none] for none in (False, True))
    return named and sorted(named, key=repr) == sorted(nameless, key=repr)


def test_by_keys_joins_nulls(spark):
    a = spark.createDataFrame([(1, None, "a"), (None, None, "b"), (2, 2, "c")], "x int, y int, v string")
    b = spark.createDataFrame([(1, None, 10), (None, None, 20)], "x int, y int, w int")
    assert sorted(map(tuple, by_keys(a, b, ["x", "y"]).select("v", "w").collect())) == [("a", 10), ("b", 20)]
    left = by_keys(a, b, ["x", "y"], "left")
    assert left.columns == ["x", "y", "v", "w"] and left.where("w is null").count() == 1


@pytest.mark.parametrize("policy", ["strict", "skip", "fill_previous"])
def test_reassembly_keeps_nameless_chunks(parts, policy):
    out = FR.reassemble(parts, policy, frames_per_part=2).collect()
    assert len(out) == 12 and sum(r.n_frames for r in out) == 20
    assert {bytes(r.payload) for r in out} == {b"BC", b"DE", b"F"}


def test_strict_reassembly_fails_on_a_gap_of_a_nameless_chunk(parts):
    holes = parts.where("NOT (video_id IS NULL AND chunk_id IS NULL AND frame_no = 3)")
    with pytest.raises(Exception, match="gap in frames"):
        FR.reassemble(holes, "strict", frames_per_part=2).collect()
    filled = FR.reassemble(holes, "fill_previous", frames_per_part=8).where("video_id IS NULL AND chunk_id IS NULL").first()
    assert bytes(filled.payload) == b"BCCEF"


def test_numbering_keeps_nameless_chunks(parts):
    local = parts.withColumnRenamed("frame_no", "local_no")
    counts = local.groupBy("video_id", "chunk_id").agg(F.count(F.lit(1)).alias("frame_count"))
    out = FR.number_frames(local, FR.chunk_offsets(counts))
    for v in ("video_id = 1", "video_id IS NULL"):
        assert sorted(r.frame_no for r in out.where(v).collect()) == list(range(1, 11))


def test_batches_and_resampling_keep_nameless_videos(media):
    assert both_alike(FR.batch_plan(media, 1, F.floor(F.col("pts_us") / 10), ["pts_us", "frame_id"]))
    out = MD.fps_resample(media, 100_000, 1, block_slots=4)
    assert both_alike(out) and out.where("frame_id IS NULL").count() == 0
    packets = media.withColumnRenamed("frame_id", "packet_id").withColumn("media_type", F.lit("audio"))
    assert both_alike(MD.remux(packets, 10))


def test_chunks_keep_nameless_videos(media):
    assert both_alike(CH.assign_equal_chunks(media, 3))
    assert both_alike(CH.range_join_chunks(media, CH.micro_plan(media, 3), 10))
    for with_frames in (False, True):
        assert both_alike(CH.keyframe_segments(media, 4, block_us=10, with_frames=with_frames))
    assert both_alike(CH.keyframe_chunks(media, 3))
    assert both_alike(CH.force_keyframes(media, 3))
    assert sweep_rows(media, 2, 4).agg(F.sum("chunk_bytes")).first()[0] == 18 * 100 * 3


def test_each_chunk_has_a_task_of_its_own(spark):
    """Also where chunk sizes differ widely and keys are NULL."""
    rows = [(v, c, i) for v in (None, 0, 7) for c in (*range(20), None) for i in range(500 if (v, c) == (7, 3) else 2)]
    df = spark.createDataFrame(rows, "video_id long, chunk_id long, i long").repartition(5)
    ranks = CH.chunk_ranks(df, per_task=10)
    keys = sorted({(v, c) for v, c, _ in rows}, key=lambda k: tuple((x is not None, x or 0) for x in k))
    assert [(r.video_id, r.chunk_id) for r in ranks.orderBy("rank").collect()] == keys
    assert [r["rank"] for r in ranks.orderBy("rank").collect()] == list(range(63))
    out = CH.one_task_per_chunk(df)
    assert out.rdd.getNumPartitions() == 63
    per_task = out.groupBy(F.spark_partition_id().alias("t")).agg(F.count_distinct(F.struct("video_id", "chunk_id")).alias("n"), F.min("task_no").alias("no")).collect()
    assert len(per_task) == 63 and all(r.n == 1 and r.no == r.t for r in per_task)
