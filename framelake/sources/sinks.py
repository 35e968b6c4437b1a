"""A7/A8/A11 sinks: sweep CSV, nested metrics JSON, run report; and the
sweep rows (E6) they are written from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.operators.joins import by_keys
from framelake.plans.chunking import video_extent


def sweep_rows(frames: DataFrame, n_min: int, n_max: int) -> DataFrame:
    """Per chunk count ``n`` in [n_min, n_max] and chunk: the bytes the chunk
    holds (the work a chunk of that sweep setting carries)."""
    f = (by_keys(frames, video_extent(frames), ["video_id"])
               .select("pts_us", "dur_us", "size_bytes",
                       F.explode(F.sequence(F.lit(n_min), F.lit(n_max))).alias("num_chunks")))
    chunk = F.least(F.col("num_chunks").cast("bigint") - 1,
                    F.call_function("div", F.col("pts_us") * F.col("num_chunks"), F.col("dur_us")))
    return (f.groupBy("num_chunks", chunk.cast("int").alias("chunk_no"))
             .agg(F.sum("size_bytes").cast("bigint").alias("chunk_bytes")))


def sweep_rows_by_video(frames: DataFrame, n_min: int, n_max: int) -> DataFrame:
    """:func:`sweep_rows` of each video by itself, with its length: a video's
    chunk of setting ``n`` lasts ``dur_us / n``."""
    f = (by_keys(frames, video_extent(frames), ["video_id"])
               .select("video_id", "pts_us", "dur_us", "size_bytes",
                       F.explode(F.sequence(F.lit(n_min), F.lit(n_max))).alias("num_chunks")))
    chunk = F.least(F.col("num_chunks").cast("bigint") - 1,
                    F.call_function("div", F.col("pts_us") * F.col("num_chunks"), F.col("dur_us")))
    return (f.groupBy("video_id", "num_chunks", chunk.cast("int").alias("chunk_no"), "dur_us")
             .agg(F.sum("size_bytes").cast("bigint").alias("chunk_bytes")))


def sweep_summary(rows: DataFrame) -> DataFrame:
    """Total and mean chunk time per sweep setting (bytes / 1e6 as the
    time proxy), plus the slowest chunk."""
    g = rows.groupBy("num_chunks").agg(F.count(F.lit(1)).alias("n_chunks"),
                                       F.sum("chunk_bytes").alias("_b"), F.max("chunk_bytes").alias("_m"))
    total = F.col("_b").cast("double") / F.lit(1000000.0)
    return g.select("num_chunks", "n_chunks", total.alias("total_s"),
                    (total / F.col("n_chunks").cast("double")).alias("mean_s"),
                    (F.col("_m").cast("double") / F.lit(1000000.0)).alias("max_s"))


def write_sweep_csv(rows: DataFrame, path: str) -> None:
    """CSV with a header row, values formatted with two decimals (exact
    half-even rounding of bytes / 1e6, see ``functions.two_decimals``)."""
    from framelake.functions.scalars import two_decimals
    proc = two_decimals(F.col("chunk_bytes"), 1000000).alias("proc_s")
    if "dur_us" not in rows.columns:
        out, order = rows.select("num_chunks", "chunk_no", proc), ["num_chunks", "chunk_no"]
    else:                       # of each video, with the length of its chunks
        length = two_decimals(F.col("dur_us"), F.col("num_chunks").cast("bigint") * 1000000).alias("chunk_len_s")
        out, order = rows.select("video_id", "num_chunks", "chunk_no", length, proc), ["video_id", "num_chunks", "chunk_no"]
    (out.orderBy(*order)
         .write.mode("overwrite").option("header", True).csv(path))


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, every column as text (no schema inference)."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path)


def metrics_tree(runs: DataFrame) -> DataFrame:
    """The nested metrics record of every run."""
    g = runs.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("n_items"), F.count_if("ok").alias("n_ok"),
        F.sum("in_bytes").alias("in_bytes"), F.sum("out_bytes").alias("out_bytes"),
        F.min("ts").alias("start"), F.max("ts").alias("end"))
    return g.select("run_id",
                    F.struct("n_items", "n_ok").alias("processing"),
                    F.struct((F.col("in_bytes") / 1048576.0).alias("input_mb"),
                             (F.col("out_bytes") / 1048576.0).alias("output_mb")).alias("sizes"),
                    F.struct(F.col("start").cast("string").alias("start"),
                             F.col("end").cast("string").alias("end")).alias("time"))


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def run_report(runs: DataFrame) -> DataFrame:
    """One report row per run with a formatted summary line."""
    g = runs.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("n_items"), F.count_if("ok").alias("n_ok"),
        F.floor(F.sum("in_bytes") / F.lit(1024.0)).cast("bigint").alias("in_kb"),
        F.floor(F.sum("out_bytes") / F.lit(1024.0)).cast("bigint").alias("out_kb"))
    g = g.withColumn("n_failed", F.col("n_items") - F.col("n_ok"))
    return g.select("run_id", "n_items", "n_ok", "n_failed", "in_kb", "out_kb",
                    F.format_string("run %d: %d items, %d ok, %d failed, in=%d KB, out=%d KB",
                                    "run_id", "n_items", "n_ok", "n_failed", "in_kb", "out_kb").alias("report"))


def append_events(events: DataFrame, path: str, partition_by: str | None = "run_id") -> None:
    """Append-only run-event / checkpoint log.  Records are only ever
    appended (one file set per job commit); readers take the latest record
    per key with :func:`framelake.operators.metrics.latest_per`."""
    w = events.write.mode("append")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)


def append_commit(events: DataFrame, log: str, commit: str | None = None) -> str:
    """One commit of a run-event log with several writers: its records go to a
    folder of their own, so writers at work at the same time never touch each
    other's files.  A commit that is made again under its own name replaces
    itself.  Returns the name."""
    import uuid
    commit = commit or uuid.uuid4().hex
    events.write.mode("overwrite").parquet(f"{log.rstrip('/')}/commit={commit}")
    return commit


def read_log(spark: SparkSession, log: str) -> DataFrame:
    """All records of a log, with the ``commit`` they came in; what a writer
    hasn't committed yet is not seen."""
    return spark.read.option("mergeSchema", "true").parquet(log)
