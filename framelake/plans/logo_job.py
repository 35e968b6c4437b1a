"""The logo-replacement job as one DataFrame plan (the flagship query).

frames --(first frame per video)--> detect --(one row per video)--> reuse on
every frame --> blend --> per-video summary.

Detection runs once per video instead of once per frame (the dominant cost
of a per-frame run); the per-video detection is the small side of a join.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelake.operators import kernels as K
from framelake.operators import pixels as PX
from framelake.operators.joins import by_keys
from framelake.session import shared_dir


def replace_logo_summary(frames: DataFrame, template: np.ndarray, logo: np.ndarray,
                         threshold: float = K.DEFAULT_THRESHOLD, threads: int = 1) -> DataFrame:
    """Per video: frames, frames with a (reused) detection, detection rate,
    detection confidence, pixels changed by the blend, mean output value.

    ``frames`` are frame rows of any size.  Each frame is read once, blended
    in its own task and leaves it as four numbers; frames are counted as rows
    and their pixels never meet a shuffle."""
    det = PX.first_frame_detection(frames, lambda f: PX.detect_frames(f, template, threshold, threads=threads))
    # the detection (one row per video) is the expensive, reusable result:
    # cut its lineage in the shared checkpoint folder so a lost executor in
    # the blend stage never re-runs detection
    shared_dir(frames.sparkSession)
    det = det.drop("frame_no").checkpoint(eager=True)
    totals = (PX.blend_stats(frames, det, logo).groupBy("video_id")
                .agg(F.count(F.lit(1)).alias("n_frames"), F.sum("n_changed").alias("n_changed"),
                     F.sum("sum_out").alias("_sum"), F.sum("n_values").alias("_n")))
    per_video = by_keys(totals, det.select("video_id", "detected", "confidence"), ["video_id"], "left")
    n_detected = F.when(F.col("detected"), F.col("n_frames")).otherwise(F.lit(0)).cast("bigint")
    return per_video.select(
        "video_id", "n_frames", n_detected.alias("n_detected"),
        (F.lit(100.0) * n_detected.cast("double") / F.col("n_frames").cast("double")).alias("detect_pct"),
        "confidence", "n_changed", F.try_divide(F.col("_sum").cast("double"), F.col("_n").cast("double")).alias("mean_out"))
