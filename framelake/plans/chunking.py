"""Chunk planning: equal-time plans, sweeps, key-frame aligned segmentation,
key-frame-only chunks, forced key frames, time -> chunk assignment.

Plans are metadata: one row per (video, chunk).  Frame-level work
(assignment, segmentation) never uses a window over a whole video; see
:mod:`framelake.operators.scan`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framelake.functions.scalars import chunk_name, idiv
from framelake.operators import scan
from framelake.operators.joins import by_keys

# Default block width for ordered scans over frame metadata: frames of one
# video have distinct timestamps, so a block holds at most block_us * fps rows.
DEFAULT_BLOCK_US = 60 * 1000000


def video_extent(frames: DataFrame, key: str = "video_id", pts: str = "pts_us") -> DataFrame:
    """Per video: ``dur_us`` = last pts + 1 (every frame lies in [0, dur_us))."""
    return frames.groupBy(key).agg((F.max(pts) + F.lit(1)).alias("dur_us"))


def equal_time_plan(videos: DataFrame, n_chunks: int | Column, duration: str = "duration_s") -> DataFrame:
    """``n`` chunks of equal length per video: ``(i, i * len, len)``."""
    n = n_chunks if isinstance(n_chunks, Column) else F.lit(int(n_chunks))
    length = F.col(duration) / n.cast("double")
    return (videos.select("*", n.alias("num_chunks"), length.alias("chunk_len_s"),
                          F.explode(F.sequence(F.lit(0), n - 1)).alias("chunk_id"))
                  .select("video_id", "num_chunks", F.col("chunk_id").cast("int").alias("chunk_id"),
                          (F.col("chunk_id").cast("double") * F.col("chunk_len_s")).alias("start_s"),
                          "chunk_len_s",
                          chunk_name(F.col("chunk_id")).alias("chunk_file")))


def chunk_sweep(videos: DataFrame, n_min: int = 2, n_max: int = 10, duration: str = "duration_s") -> DataFrame:
    """P5: the equal-time plan for every chunk count in ``[n_min, n_max]``.

    The sweep is a generator (explode), not a join with a settings table."""
    v = videos.select("video_id", duration,
                      F.explode(F.sequence(F.lit(n_min), F.lit(n_max))).alias("_n"))
    return equal_time_plan(v, F.col("_n"), duration)


def nominal_chunk(pts_us: Column, dur_us: Column, n_chunks: int) -> Column:
    """Equal-width chunk of a timestamp: ``least(n-1, pts * n div dur)``."""
    return F.least(F.lit(n_chunks - 1).cast("bigint"), idiv(pts_us * F.lit(n_chunks), dur_us))


def assign_equal_chunks(frames: DataFrame, n_chunks: int) -> DataFrame:
    """D5 (equal-width plan): chunk of each frame by arithmetic, no join with
    the plan beyond the per-video extent (one row per video)."""
    ext = video_extent(frames)
    return (by_keys(frames, ext, ["video_id"])
                  .withColumn("chunk_id", nominal_chunk(F.col("pts_us"), F.col("dur_us"), n_chunks)
                              .cast("int"))
                  .drop("dur_us"))


def range_join_chunks(frames: DataFrame, plan: DataFrame, bin_us: int) -> DataFrame:
    """D5 (general plan): each frame to the chunk whose ``[start_us, end_us)``
    contains its pts.

    Binned range join: every plan row is replicated onto the fixed-width time
    bins it overlaps and frames join on ``(video_id, bin)`` with the range as
    a residual filter.  The equi-key is fine-grained, so a long video spreads
    over many tasks, and a frame meets only the plan rows of its own bin.
    """
    p = plan.select("video_id", "chunk_id", "start_us", "end_us",
                    F.explode(F.sequence(idiv(F.col("start_us"), F.lit(bin_us)),
                                         idiv(F.col("end_us") - 1, F.lit(bin_us)))).alias("_bin"))
    f = frames.withColumn("_bin", idiv(F.col("pts_us"), F.lit(bin_us)))
    return (by_keys(f, p, ["video_id", "_bin"])
             .where((F.col("pts_us") >= F.col("start_us")) & (F.col("pts_us") < F.col("end_us")))
             .drop("_bin", "start_us", "end_us"))


def micro_plan(frames: DataFrame, n_chunks: int) -> DataFrame:
    """Equal-time plan in integer microseconds over each video's extent."""
    ext = video_extent(frames)
    return (ext.select("video_id", "dur_us",
                       F.explode(F.sequence(F.lit(0), F.lit(n_chunks - 1))).alias("chunk_id"))
               .select("video_id", F.col("chunk_id").cast("int").alias("chunk_id"),
                       idiv(F.col("chunk_id") * F.col("dur_us"), F.lit(n_chunks)).alias("start_us"),
                       idiv((F.col("chunk_id") + 1) * F.col("dur_us"), F.lit(n_chunks)).alias("end_us")))


def keyframe_segments(frames: DataFrame, n_chunks: int, block_us: int = DEFAULT_BLOCK_US,
                      with_frames: bool = False, extent: DataFrame | None = None) -> DataFrame:
    """Key-frame aligned segmentation (stream copy cuts only at key frames).

    Rule: nominal chunk = ``least(n-1, pts*n div dur)``; a frame belongs to the
    nominal chunk of the last key frame at or before it (0 before any key
    frame); the distinct segments are renumbered densely from 0.  Returns one
    row per segment with its frame count and exclusive frame offset, or the
    frames with their ``chunk_id`` when ``with_frames``.  ``extent`` supplies
    ``(video_id, dur_us)`` (e.g. from probe metadata); by default it is the
    last pts + 1 of each video.
    """
    ext = extent.select("video_id", "dur_us") if extent is not None else video_extent(frames)
    f = (by_keys(frames, ext, ["video_id"])
               .withColumn("_nom", nominal_chunk(F.col("pts_us"), F.col("dur_us"), n_chunks)))
    seg = scan.running_max(f, ["video_id"], ["pts_us", "frame_id"],
                           idiv(F.col("pts_us"), F.lit(block_us)),
                           F.when(F.col("pict_type") == "I", F.col("_nom")), "_seg")
    seg = seg.withColumn("_seg", F.coalesce(F.col("_seg"), F.lit(0).cast("bigint")))
    segs = (seg.groupBy("video_id", "_seg")
               .agg(F.count(F.lit(1)).alias("frame_count"),
                    F.min("pts_us").alias("first_pts_us"), F.max("pts_us").alias("last_pts_us")))
    w = Window.partitionBy("video_id").orderBy("_seg")   # one row per segment: small
    segs = segs.select(
        "video_id",
        (F.row_number().over(w) - 1).cast("int").alias("chunk_id"),
        F.col("_seg").alias("nominal_chunk"), "frame_count", "first_pts_us", "last_pts_us",
        F.coalesce(F.sum("frame_count").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
         .cast("bigint").alias("frame_offset"))
    if not with_frames:
        return segs
    # pts restart per chunk (reset timestamps)
    return (by_keys(seg, segs.select("video_id", F.col("nominal_chunk").alias("_seg"), "chunk_id",
                                     "first_pts_us"), ["video_id", "_seg"])
               .withColumn("pts_in_chunk_us", F.col("pts_us") - F.col("first_pts_us"))
               .drop("_seg", "_nom", "dur_us", "first_pts_us"))


def segment_report(segments: DataFrame, requested: int) -> DataFrame:
    """Per video how many chunks were asked for and how many the key
    frames allowed, and how uneven they are; ``matches`` is false where the
    split could not give what was asked for."""
    return (segments.groupBy("video_id")
                    .agg(F.count(F.lit(1)).alias("created"), F.min("frame_count").alias("least_frames"),
                         F.max("frame_count").alias("most_frames"), F.sum("frame_count").alias("n_frames"))
                    .select("video_id", F.lit(requested).cast("bigint").alias("requested"), "created",
                            (F.col("created") == requested).alias("matches"), "least_frames", "most_frames", "n_frames"))


def keyframe_chunks(frames: DataFrame, n_chunks: int) -> DataFrame:
    """Key frames only, each with its equal-time chunk."""
    keys = frames.where(F.col("pict_type") == "I")
    ext = video_extent(frames)
    return (by_keys(keys, ext, ["video_id"])
                .select("video_id", nominal_chunk(F.col("pts_us"), F.col("dur_us"), n_chunks)
                        .cast("int").alias("chunk_id"), "frame_id", "pts_us"))


def force_keyframes(frames: DataFrame, n_chunks: int) -> DataFrame:
    """Re-encode with a key frame forced at each chunk start: the first
    frame with ``pts >= start`` of every chunk becomes a key frame.

    The first frame of each chunk comes from a map-side-combined ``min``
    aggregate (one row per chunk) joined back, not a per-chunk window."""
    f = assign_equal_chunks(frames, n_chunks)
    firsts = (f.groupBy("video_id", "chunk_id")
               .agg(F.min(F.struct("pts_us", "frame_id")).alias("_first"))
               .select("video_id", "chunk_id", F.col("_first.frame_id").alias("_ffid")))
    return (by_keys(f, firsts, ["video_id", "chunk_id"])
             .select("video_id", "chunk_id", "frame_id", "pts_us",
                     (F.col("pict_type") == "I").alias("was_key"),
                     ((F.col("pict_type") == "I") | F.col("frame_id").eqNullSafe(F.col("_ffid"))).alias("is_key")))


def chunk_ranks(chunks: DataFrame, keys: tuple[str, ...] = ("video_id", "chunk_id"), per_task: int = 100_000) -> DataFrame:
    """The distinct keys of ``chunks`` with a dense ``rank`` from 0 in key
    order (NULLs first), without a task that sees all of them: the keys are
    sorted by range and written, each range is numbered by itself, and the
    counts of the ranges before it (one row per range) are added."""
    from framelake.session import scratch_path
    spark = chunks.sparkSession
    d = chunks.select(*keys).distinct()
    path = scratch_path(spark, "chunk-ranks")       # written: a range keeps its rows when a task is run again
    (d.repartitionByRange(max(1, -(-d.count() // per_task)), *keys).withColumn("_range", F.spark_partition_id()).write.parquet(path))
    d = spark.read.parquet(path)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = d.groupBy("_range").agg(F.count(F.lit(1)).alias("_n")).select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    local = Window.partitionBy("_range").orderBy(*keys)
    return (d.withColumn("_l", F.row_number().over(local)).join(offsets, "_range")
             .select(*keys, (F.col("_before") + F.col("_l") - 1).cast("bigint").alias("rank")))


def one_task_per_chunk(frames: DataFrame, n_chunks: int | None = None,
                       keys: tuple[str, ...] = ("video_id", "chunk_id")) -> DataFrame:
    """Every chunk's rows in a task of their own, as many tasks as chunks.

    Each chunk has a dense rank, which *is* its partition, so no two chunks
    ever share a task (hashing the key, or sampling its range bounds, can put
    two into one).  The column ``task_no`` holds the rank.  A known ``n_chunks``
    saves counting them."""
    ranks = chunk_ranks(frames, keys)
    n = n_chunks or ranks.count()
    ranked = by_keys(frames, ranks, keys).withColumn("task_no", F.col("rank").cast("int")).drop("rank")
    return ranked.repartitionById(max(n, 1), "task_no")
