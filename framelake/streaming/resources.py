"""Windowed resource profiles, batch and streaming (same operator)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def resource_windows(samples: DataFrame, width: str = "1 hour") -> DataFrame:
    """Tumbling-window average and peak of CPU/RAM per run.

    Works unchanged on a batch DataFrame and on a streaming one (after
    ``withWatermark``): it is a plain ``groupBy(window)`` aggregate."""
    g = samples.groupBy("run_id", F.window("ts", width).alias("w")).agg(
        F.count(F.lit(1)).alias("n_samples"),
        F.avg("cpu_percent").alias("avg_cpu"), F.max("cpu_percent").alias("peak_cpu"),
        F.avg("ram_percent").alias("avg_ram"), F.max("ram_percent").alias("peak_ram"))
    return g.select("run_id", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "n_samples", "avg_cpu", "peak_cpu", "avg_ram", "peak_ram")


def stream_resource_windows(samples_stream: DataFrame, width: str = "1 hour",
                            watermark: str = "2 hours") -> DataFrame:
    """Streaming form.  Event time must be TIMESTAMP for the watermark; a
    TIMESTAMP_NTZ column is mapped to the instant with the same wall time in
    UTC (and the windows mapped back), so no session time zone can shift the
    window boundaries."""
    epoch = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
    s = (samples_stream.withColumn("ts", F.expr(f"timestamp_micros(timestampdiff(MICROSECOND, {epoch}, ts))"))
                       .withWatermark("ts", watermark))
    out = resource_windows(s, width)
    back = lambda c: F.expr(f"timestampadd(MICROSECOND, unix_micros({c}), {epoch})")
    return (out.withColumn("window_start", back("window_start"))
               .withColumn("window_end", back("window_end")))
