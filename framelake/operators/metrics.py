"""Aggregates and derived KPIs: totals, size statistics, detection summaries,
run KPIs, resource profiles, phase durations, before/after deltas.

All are plain ``groupBy().agg()`` with partial (map-side) aggregation; the
only windows run over per-phase record tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelake.functions.scalars import bytes_to_kb, bytes_to_mb


def size_stats(frames: DataFrame, size_col: str, key: str = "video_id") -> DataFrame:
    """Count, total and mean frame size per video, in bytes, MB and KB."""
    return (frames.groupBy(key)
                  .agg(F.count(F.lit(1)).alias("n_frames"),
                       F.sum(size_col).cast("bigint").alias("total_bytes"),
                       F.avg(size_col).alias("avg_bytes"))
                  .withColumn("total_mb", bytes_to_mb(F.col("total_bytes").cast("double")))
                  .withColumn("avg_kb", bytes_to_kb(F.col("avg_bytes"))))


def latest_per(df: DataFrame, keys: list[str], order: list[str], cols: list[str], prefix: str = "") -> DataFrame:
    """Last record per key ("last write wins") as a partial
    aggregate: ``max_by(struct(cols), struct(order))``."""
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_records"),
                              F.max_by(F.struct(*cols), F.struct(*order)).alias("_l"))
    return g.select(*keys, "n_records", *[F.col(f"_l.{c}").alias(prefix + c) for c in cols])


def run_kpis(items: DataFrame, key: str = "run_id") -> DataFrame:
    """Success rate, compression ratio, size overhead, throughput and
    seconds per item, each with a zero guard."""
    from framelake.functions.scalars import safe_ratio
    g = items.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_items"), F.count_if("ok").alias("n_ok"),
        F.sum("in_bytes").alias("in_bytes"), F.sum("out_bytes").alias("out_bytes"),
        F.expr("timestampdiff(SECOND, min(ts), max(ts))").alias("duration_s"))
    return g.select(
        key, "n_items", "n_ok",
        (F.lit(100.0) * safe_ratio(F.col("n_ok"), F.col("n_items"))).alias("success_pct"),
        safe_ratio(F.col("in_bytes"), F.col("out_bytes")).alias("compression_ratio"),
        (F.lit(100.0) * safe_ratio(F.col("out_bytes") - F.col("in_bytes"), F.col("in_bytes"))).alias("overhead_pct"),
        "duration_s",
        safe_ratio(F.col("n_items"), F.col("duration_s")).alias("items_per_s"),
        safe_ratio(F.col("duration_s"), F.col("n_items")).alias("s_per_item"))


def phase_durations(records: DataFrame, key: str, phase: str, order: list[str], block) -> DataFrame:
    """Time between consecutive records of a run (``ts - lag(ts)``,
    computed per block with a carried-in previous timestamp), then
    sum/avg/max per phase."""
    from framelake.operators import scan
    prev = scan.previous_value(records, [key], order, block, F.col("ts"), "prev_ts")
    d = prev.where(F.col("prev_ts").isNotNull()).withColumn(
        "dur_s", F.expr("timestampdiff(SECOND, prev_ts, ts)"))
    return d.groupBy(phase).agg(F.count(F.lit(1)).alias("n"), F.sum("dur_s").alias("total_s"),
                                F.avg("dur_s").alias("avg_s"), F.max("dur_s").alias("max_s"))


def resource_profile(samples: DataFrame, phases: DataFrame, bin_us: int) -> DataFrame:
    """Average and true peak CPU/RAM per run and phase.  Samples are
    assigned to phases by a binned range join against the phase plan
    ``(phase, start_ts, end_ts)``; those outside every phase form the phase
    ``unassigned``.  Spark broadcasts the plan where its size allows."""
    from framelake.functions.scalars import idiv
    epoch = "TIMESTAMP_NTZ'2000-01-01 00:00:00'"
    us = lambda c: F.expr(f"timestampdiff(MICROSECOND, {epoch}, {c})")
    p = phases.select("phase", "start_ts", "end_ts",
                      F.explode(F.sequence(idiv(us("start_ts"), F.lit(bin_us)),
                                           idiv(us("end_ts") - 1, F.lit(bin_us)))).alias("_bin"))
    s = samples.withColumn("_bin", idiv(us("ts"), F.lit(bin_us)))
    j = s.join(p, (s["_bin"] == p["_bin"]) & (s["ts"] >= p["start_ts"]) & (s["ts"] < p["end_ts"]), "left")
    return j.groupBy("run_id", F.coalesce("phase", F.lit("unassigned")).alias("phase")).agg(
        F.count(F.lit(1)).alias("n_samples"),
        F.avg("cpu_percent").alias("avg_cpu"), F.max("cpu_percent").alias("peak_cpu"),
        F.avg("ram_percent").alias("avg_ram"), F.max("ram_percent").alias("peak_ram"))
