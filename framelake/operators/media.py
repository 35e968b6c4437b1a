"""Media-level operators on frame/packet metadata: stream selection, audio
presence, constant-rate resampling, audio re-mux (interleave), before/after
metadata deltas."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelake.functions.scalars import idiv
from framelake.operators import scan
from framelake.operators.joins import by_keys


def select_media(packets: DataFrame, media_type: str | None) -> DataFrame:
    """C4: ``v:0``/``-vn``/``-map 0`` style selection (None keeps all)."""
    return packets if media_type is None else packets.where(F.col("media_type") == media_type)


def audio_report(packets: DataFrame) -> DataFrame:
    """C4: per video whether an audio track exists, its packet count and
    bytes; a video without audio gets ``found = false`` and zeros.  One pass:
    a conditional aggregate over all packets."""
    audio = F.col("media_type") == "audio"
    return (packets.groupBy("video_id")
                   .agg(F.count_if(audio).alias("n_packets"),
                        F.coalesce(F.sum(F.when(audio, F.length("payload"))), F.lit(0)).cast("bigint")
                         .alias("audio_bytes"))
                   .select("video_id", (F.col("n_packets") > 0).alias("found"), "n_packets", "audio_bytes"))


def resample_slot(pts_us, fps_num: int, fps_den: int):
    """Output slot of a timestamp on a ``num/den`` fps grid:
    ``floor(pts * fps + 0.5)`` in exact integer arithmetic."""
    return idiv(pts_us * F.lit(2 * fps_num) + F.lit(fps_den * 1000000), F.lit(2 * fps_den * 1000000))


def fps_resample(frames: DataFrame, fps_num: int, fps_den: int, block_slots: int = 4096) -> DataFrame:
    """Resample to a constant frame rate (what an ``fps=`` filter does).

    Output slot k shows the last input frame whose slot is <= k: duplicates
    fill holes, extra frames within one slot are dropped.  The grid between
    each video's first and last slot is generated per block of slots (spread
    over tasks), joined with the per-slot winners, and holes are filled by a
    blocked forward fill — no window ever spans a whole video.
    """
    f = frames.withColumn("slot", resample_slot(F.col("pts_us"), fps_num, fps_den))
    winners = (f.groupBy("video_id", "slot")
                .agg(F.max_by(F.struct("frame_id", "pts_us"), F.struct("pts_us", "frame_id")).alias("w")))
    rng = winners.groupBy("video_id").agg(F.min("slot").alias("lo"), F.max("slot").alias("hi"))
    blocks = rng.select("video_id", "lo", "hi",
                        F.explode(F.sequence(idiv(F.col("lo"), F.lit(block_slots)),
                                             idiv(F.col("hi"), F.lit(block_slots)))).alias("b"))
    grid = (blocks.repartition("video_id", "b")
                  .select("video_id", F.explode(F.sequence(
                      F.greatest(F.col("lo"), F.col("b") * block_slots),
                      F.least(F.col("hi"), F.col("b") * block_slots + block_slots - 1))).alias("slot")))
    g = by_keys(grid, winners, ["video_id", "slot"], "left")
    filled = scan.fill_forward(g, ["video_id"], ["slot"], idiv(F.col("slot"), F.lit(block_slots)),
                               F.col("w"), "src")
    return filled.select(
        "video_id", "slot",
        idiv(F.col("slot") * F.lit(1000000 * fps_den), F.lit(fps_num)).alias("out_pts_us"),
        F.col("src.frame_id").alias("frame_id"), F.col("src.pts_us").alias("src_pts_us"),
        F.col("w").isNull().alias("is_dup"))


def remux(packets: DataFrame, block_us: int) -> DataFrame:
    """Interleave the packets of all tracks by (pts, media type, id)
    with a per-video sequence number; a video without audio still gets its
    other packets (``has_audio = false``)."""
    seq = scan.ordered_index(packets, ["video_id"], ["pts_us", "media_type", "packet_id"],
                             idiv(F.col("pts_us"), F.lit(block_us)), "seq")
    has = (packets.groupBy("video_id")
                  .agg(F.coalesce(F.bool_or(F.col("media_type") == "audio"), F.lit(False)).alias("has_audio")))
    return by_keys(seq, has, ["video_id"], "left")


def before_after(stats: DataFrame, key: str, side_col: str, before: str, after: str,
                 measures: list[str]) -> DataFrame:
    """Compare per-key metadata before and after a transform, with the
    delta of every measure.

    Written as one conditional aggregation over ``(key, side)`` rows instead
    of a self-join: one shuffle, map-side combined, and a key missing on one
    side simply yields NULL there (full-outer semantics)."""
    aggs = []
    for m in measures:
        for side, tag in ((before, "before"), (after, "after")):
            aggs.append(F.max(F.when(F.col(side_col) == side, F.col(m))).alias(f"{m}_{tag}"))
    present = [F.max(F.col(side_col) == s).alias(f"_has_{t}") for s, t in ((before, "b"), (after, "a"))]
    g = stats.where(F.col(side_col).isin(before, after)).groupBy(key).agg(*aggs, *present)
    out = [key]
    for m in measures:
        out += [f"{m}_before", f"{m}_after",
                (F.coalesce(F.col(f"{m}_after"), F.lit(0)) - F.coalesce(F.col(f"{m}_before"), F.lit(0)))
                .alias(f"{m}_delta")]
    return g.select(*out)
