"""Frame table operators: payload explode, chunk offsets and global numbering,
manifests, gaps, batches, progress marks, first frame, reassembly, set
differences and empty-result guards.

Rule followed throughout: binary frame data never enters a shuffle, sort or
window unless the operator's output *is* that data (reassembly); numbering and
checks run on metadata and are joined back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framelake.functions.scalars import idiv
from framelake.operators import scan
from framelake.operators.joins import by_keys, join_small


def frame_count(n_bytes: Column, frame_bytes: int) -> Column:
    """Frames in ``n_bytes`` bytes, a partial tail included."""
    return idiv(n_bytes + F.lit(frame_bytes - 1), F.lit(frame_bytes)).cast("bigint")


def explode_frames(chunks: DataFrame, frame_bytes: int, payload: str = "payload") -> DataFrame:
    """A4: one chunk row (raw fixed-size frames back to back) -> one row per
    frame, ``local_no`` 1-based.  A partial tail is a row of its own, shorter
    than ``frame_bytes``; empty and NULL payloads give no rows.

    ``sequence`` + ``substring`` is a narrow generator inside codegen; no UDF,
    no shuffle."""
    n = frame_count(F.length(payload), frame_bytes)
    keep = [c for c in chunks.columns if c != payload]
    return (chunks.select(*keep, payload,
                          F.explode(F.when(n > 0, F.sequence(F.lit(0).cast("bigint"), n - 1))).alias("_i"))
                  .select(*keep, (F.col("_i") + 1).alias("local_no"),
                          F.substring(payload, F.col("_i") * frame_bytes + 1, frame_bytes)
                           .alias("data")))


def chunk_frame_counts_from_payload(chunks: DataFrame, frame_bytes: int, payload: str = "payload") -> DataFrame:
    """E1 on payloads: frames per chunk without materialising the frames."""
    return chunks.select("video_id", "chunk_id",
                         F.coalesce(frame_count(F.length(payload), frame_bytes), F.lit(0).cast("bigint"))
                          .alias("frame_count"))


def chunk_offsets(counts: DataFrame, count_col: str = "frame_count") -> DataFrame:
    """exclusive running sum of frame counts over chunks of a video.

    Input is one row per chunk (metadata), so a per-video window is small."""
    w = Window.partitionBy("video_id").orderBy("chunk_id").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("frame_offset", F.coalesce(F.sum(count_col).over(w), F.lit(0)).cast("bigint"))


def number_frames(frames: DataFrame, offsets: DataFrame) -> DataFrame:
    """Global 1-based ``frame_no = frame_offset + local_no``.

    No global sort: the chunk offsets (one row per chunk) are joined onto the
    frames with a size-checked broadcast, so frame bytes are not shuffled."""
    o = offsets.select("video_id", "chunk_id", "frame_offset")
    return (join_small(frames, o, ["video_id", "chunk_id"], null_keys=True)
                  .withColumn("frame_no", (F.col("frame_offset") + F.col("local_no")).cast("bigint"))
                  .drop("frame_offset"))


def manifest(frames: DataFrame, block_frames: int = 4096) -> DataFrame:
    """Per chunk the runs of consecutive frame numbers, one row each:
    ``run_no`` (1-based), first and last number, and count.  A chunk without
    holes is one row, however long it is; repeated numbers count once.

    Frames minus their position is constant within a run; positions come from
    the blocked ordered index, so no task holds a whole chunk."""
    keys = ["video_id", "chunk_id"]
    block = lambda c: idiv(F.col(c), F.lit(block_frames))
    ix = scan.ordered_index(frames.select(*keys, "frame_no").distinct(), keys, ["frame_no"], block("frame_no"))
    runs = (ix.groupBy(*keys, (F.col("frame_no") - F.col("ix")).alias("_run"))
              .agg(F.min("frame_no").alias("first_no"), F.max("frame_no").alias("last_no"),
                   F.count(F.lit(1)).alias("n_frames")))
    numbered = scan.ordered_index(runs, keys, ["first_no"], block("first_no"), "run_no")
    return numbered.select(*keys, "run_no", "first_no", "last_no", "n_frames")


def frame_gaps(frames: DataFrame, keys: Sequence[str], frame_col: str, block: Column) -> DataFrame:
    """places where the next frame number jumps by more than one
    (``lead(frame) - frame > 1``), with the number of missing frames."""
    nxt = scan.next_value(frames.select(*keys, frame_col), keys, [frame_col], block,
                          F.col(frame_col), "next_no")
    return (nxt.where(F.col("next_no") - F.col(frame_col) > 1)
               .select(*keys, F.col(frame_col).alias("frame_no"), "next_no",
                       (F.col("next_no") - F.col(frame_col) - 1).alias("missing")))


def batch_plan(frames: DataFrame, cores: int, block: Column, order: Sequence[str]) -> DataFrame:
    """consecutive batches of ``max(n // (cores * 4), 1)`` frames per video."""
    counts = frames.groupBy("video_id").agg(F.count(F.lit(1)).alias("_n"))
    ix = scan.ordered_index(frames, ["video_id"], order, block)
    size = F.greatest(idiv(F.col("_n"), F.lit(cores * 4)), F.lit(1))
    return (by_keys(ix, counts, ["video_id"])
              .withColumn("batch_size", size.cast("bigint"))
              .withColumn("batch_id", idiv(F.col("ix") - 1, F.col("batch_size")))
              .drop("_n"))


def progress_marks(frames: DataFrame, step: int, block: Column, order: Sequence[str]) -> DataFrame:
    """the frames at which a progress report fires (every ``step`` frames)."""
    ix = scan.ordered_index(frames, ["video_id"], order, block)
    return ix.where(F.col("ix") % step == 0)


def first_frame(frames: DataFrame, key: str = "video_id",
                order: Sequence[str] = ("frame_no",)) -> DataFrame:
    """The first frame per video in ``order`` (end it with a unique column
    where the first may tie) as a partial (map-side) aggregate."""
    other = [c for c in frames.columns if c != key]
    return (frames.groupBy(key).agg(F.min_by(F.struct(*other), F.struct(*order)).alias("_f"))
                  .select(key, "_f.*"))


def reassemble(frames: DataFrame, policy: str = "strict", data: str = "data",
               frames_per_part: int = 16) -> DataFrame:
    """Ordered reassembly of a chunk's frames.

    A chunk of any length becomes rows ``(video_id, chunk_id, part_no,
    first_no, last_no, n_frames, payload)``, to be written one after the other
    in ``part_no`` order: the frames of one part are those whose number lies
    in one range of ``frames_per_part``, so no row or task grows with the
    chunk.  Within a part frames are ordered by integer ``frame_no``.

    Policies for holes in a chunk's numbering: ``strict`` raises, ``skip``
    concatenates what exists, ``fill_previous`` repeats the previous frame for
    every missing number.  A number that occurs twice raises under ``strict``
    and is concatenated twice under ``skip``; under ``fill_previous`` the
    copies follow its last occurrence (by bytes).
    """
    if policy not in ("strict", "skip", "fill_previous"):
        raise ValueError(f"unknown reassembly policy {policy!r}")
    keys = ["video_id", "chunk_id"]
    f = frames.select(*keys, "frame_no", F.col(data).alias("_data"))
    if policy == "fill_previous":
        # the copies are rows of their own, so a long hole spreads over parts
        holes = frame_gaps(frames, keys, "frame_no", idiv(F.col("frame_no"), F.lit(4096)))
        last = (by_keys(f, holes.select(*keys, "frame_no", "next_no"), [*keys, "frame_no"])
                 .groupBy(*keys, "frame_no", "next_no").agg(F.max("_data").alias("_data")))
        f = f.unionByName(last.select(
            *keys, F.explode(F.sequence(F.col("frame_no") + 1, F.col("next_no") - 1)).alias("frame_no"), "_data"))
    part = idiv(F.col("frame_no") - 1, F.lit(frames_per_part)).cast("bigint")
    g = (f.groupBy(*keys, part.alias("part_no"))
          .agg(F.array_sort(F.collect_list(F.struct("frame_no", "_data"))).alias("_fr"),
               F.min("frame_no").alias("first_no"), F.max("frame_no").alias("last_no"),
               F.count(F.lit(1)).alias("n_frames")))
    payload = F.aggregate("_fr", F.lit(b""), lambda acc, x: F.concat(acc, x["_data"]))
    out = g.select(*keys, "part_no", "first_no", "last_no", "n_frames", payload.alias("payload"))
    return _require_dense(out, keys) if policy == "strict" else out


def _require_dense(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fails where the frame numbers of a chunk have a hole or a repeat: inside
    a part, or between a part and the one before it (a window over part rows,
    whose bytes stay out of it)."""
    meta = parts.select(*keys, "part_no", "first_no", "last_no", "n_frames")
    prev = scan.previous_value(meta, keys, ["part_no"], idiv(F.col("part_no"), F.lit(4096)),
                               F.col("last_no"), "_prev")
    bad = ((F.col("last_no") - F.col("first_no") + 1 != F.col("n_frames"))
           | (F.col("first_no") != F.col("_prev") + 1))
    checked = prev.groupBy(*keys).agg(F.max(F.coalesce(bad, F.lit(False))).alias("_bad"))
    ok = F.when(~F.col("_bad"), F.col("n_frames")).otherwise(
        F.raise_error(F.format_string("gap in frames of video %s chunk %s", *[F.col(k).cast("string") for k in keys])).cast("bigint"))
    return by_keys(parts, checked, keys).withColumn("n_frames", ok).drop("_bad")


def unprocessed(extracted: DataFrame, processed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Frames extracted but never processed (anti join on the keys)."""
    return extracted.join(processed.select(*keys), list(keys), "left_anti")


def require_frames(counts: DataFrame, count_col: str,
                   keys: Sequence[str] = ("video_id", "chunk_id")) -> DataFrame:
    """Fail the job when a unit (a chunk) produced no frames."""
    unit = F.concat_ws("/", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys])
    return counts.withColumn(count_col, F.when(F.col(count_col) > 0, F.col(count_col)).otherwise(
        F.raise_error(F.concat(F.lit("no frames extracted for "), unit)).cast("bigint")))
