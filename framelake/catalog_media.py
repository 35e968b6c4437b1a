"""Registered media, metrics, streaming and linear-algebra queries and their
DuckDB oracles.  Imported by :mod:`framelake.catalog`."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from framelake.catalog import DAY_US, HOUR_US, ORACLES, register
from framelake.functions import scalars as S
from framelake.operators import media as MD
from framelake.operators import metrics as MT
from framelake.oracle import with_fx
from framelake.sources import testdata as TD

RESAMPLE_FPS = (1, 600)             # one output frame per 10 minutes of the event clock
WINDOW = "1 hour"
# The phase plan of the resource profile (start inclusive, end exclusive).
PHASES = [("probe", "2024-01-01 00:00:00", "2024-01-02 00:00:00"),
          ("extract", "2024-01-02 00:00:00", "2024-01-10 00:00:00"),
          ("detect", "2024-01-10 00:00:00", "2024-01-25 00:00:00"),
          ("compile", "2024-01-25 00:00:00", "2024-02-01 00:00:00")]


# --------------------------------------------------------------- media (C/D)
@register("extract_audio", with_fx("""
    SELECT v.video_id, a.n IS NOT NULL AS found, coalesce(a.n, 0) AS n_packets,
           CAST(coalesce(a.b, 0) AS BIGINT) AS audio_bytes
    FROM (SELECT DISTINCT video_id FROM fx_packets) v
    LEFT JOIN (SELECT video_id, count(*) AS n, sum(octet_length(payload)) AS b FROM fx_packets
               WHERE media_type = 'audio' GROUP BY 1) a USING (video_id)""", "fx_packets"))
def q_extract_audio(spark, d):
    return MD.audio_report(TD.packets(spark, d))


@register("fps_resample", with_fx(f"""
    SELECT video_id, slot, (slot * {1000000 * RESAMPLE_FPS[1]}) // {RESAMPLE_FPS[0]} AS out_pts_us,
           last_value(frame_id IGNORE NULLS) OVER w AS frame_id, last_value(pts_us IGNORE NULLS) OVER w AS src_pts_us,
           frame_id IS NULL AS is_dup
    FROM (SELECT g.video_id, g.slot, s.frame_id, s.pts_us
          FROM (SELECT video_id, unnest(range(lo, hi + 1)) AS slot
                FROM (SELECT video_id, min(slot) AS lo, max(slot) AS hi FROM s GROUP BY 1) r) g
          LEFT JOIN s USING (video_id, slot)) j
    WINDOW w AS (PARTITION BY video_id ORDER BY slot ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "fx_frames", ctes=[("s", f"""
    SELECT video_id, slot, frame_id, pts_us FROM (
      SELECT video_id, frame_id, pts_us,
             (pts_us * {2 * RESAMPLE_FPS[0]} + {RESAMPLE_FPS[1] * 1000000}) // {2 * RESAMPLE_FPS[1] * 1000000} AS slot,
             row_number() OVER (PARTITION BY video_id,
               (pts_us * {2 * RESAMPLE_FPS[0]} + {RESAMPLE_FPS[1] * 1000000}) // {2 * RESAMPLE_FPS[1] * 1000000}
               ORDER BY pts_us DESC, frame_id DESC) AS rn
      FROM fx_frames) z WHERE rn = 1""")]))
def q_fps_resample(spark, d):
    f = TD.frames(spark, d).select("video_id", "frame_id", "pts_us")
    return MD.fps_resample(f, *RESAMPLE_FPS, block_slots=256)


@register("remux_audio", with_fx("""
    SELECT p.video_id, p.media_type, p.pts_us, p.packet_id,
           row_number() OVER (PARTITION BY p.video_id ORDER BY p.pts_us, p.media_type, p.packet_id) AS seq,
           coalesce(h.has_audio, false) AS has_audio
    FROM fx_packets p LEFT JOIN (SELECT DISTINCT video_id, true AS has_audio FROM fx_packets
                                 WHERE media_type = 'audio') h USING (video_id)""", "fx_packets"))
def q_remux_audio(spark, d):
    pk = TD.packets(spark, d).select("video_id", "media_type", "pts_us", "packet_id")
    return MD.remux(pk, DAY_US)


@register("metadata_delta", with_fx("""
    SELECT coalesce(b.run_id, a.run_id) AS run_id, b.n_items AS n_items_before, a.n_items AS n_items_after,
           coalesce(a.n_items, 0) - coalesce(b.n_items, 0) AS n_items_delta,
           b.out_bytes AS out_bytes_before, a.out_bytes AS out_bytes_after,
           coalesce(a.out_bytes, 0) - coalesce(b.out_bytes, 0) AS out_bytes_delta
    FROM (SELECT * FROM st WHERE phase_flag = 'O') b FULL JOIN (SELECT * FROM st WHERE phase_flag = 'F') a
      ON a.run_id = b.run_id""", "fx_runs", ctes=[("st", """
    SELECT run_id, phase_flag, count(*) AS n_items, sum(out_bytes) AS out_bytes FROM fx_runs GROUP BY 1, 2""")]))
def q_metadata_delta(spark, d):
    st = (TD.runs(spark, d).groupBy("run_id", "phase_flag")
          .agg(F.count(F.lit(1)).alias("n_items"), F.sum("out_bytes").alias("out_bytes")))
    return MD.before_after(st, "run_id", "phase_flag", "O", "F", ["n_items", "out_bytes"])


# ------------------------------------------------------------- metrics (A/B/E)
@register("run_kpis", with_fx("""
    SELECT run_id, n_items, n_ok, 100.0::DOUBLE * CASE WHEN n_items = 0 THEN 0.0::DOUBLE ELSE CAST(n_ok AS DOUBLE) / CAST(n_items AS DOUBLE) END AS success_pct,
           CASE WHEN out_bytes = 0 THEN 0.0::DOUBLE ELSE in_bytes / out_bytes END AS compression_ratio,
           100.0::DOUBLE * CASE WHEN in_bytes = 0 THEN 0.0::DOUBLE ELSE (out_bytes - in_bytes) / in_bytes END AS overhead_pct,
           duration_s,
           CASE WHEN duration_s = 0 THEN 0.0::DOUBLE ELSE CAST(n_items AS DOUBLE) / CAST(duration_s AS DOUBLE) END AS items_per_s,
           CASE WHEN n_items = 0 THEN 0.0::DOUBLE ELSE CAST(duration_s AS DOUBLE) / CAST(n_items AS DOUBLE) END AS s_per_item
    FROM (SELECT run_id, count(*) AS n_items, count(*) FILTER (WHERE ok) AS n_ok, sum(in_bytes) AS in_bytes,
                 sum(out_bytes) AS out_bytes, CAST(epoch(max(ts)) - epoch(min(ts)) AS BIGINT) AS duration_s
          FROM fx_runs GROUP BY 1) g""", "fx_runs"))
def q_run_kpis(spark, d):
    return MT.run_kpis(TD.runs(spark, d))


@register("run_events_latest", with_fx("""
    SELECT run_id, n_records, ts AS last_ts, item_id AS last_item_id, item_no AS last_item_no, ok AS last_ok FROM (
      SELECT *, count(*) OVER (PARTITION BY run_id) AS n_records,
             row_number() OVER (PARTITION BY run_id ORDER BY ts DESC, item_id DESC, item_no DESC) AS rn
      FROM fx_runs) z WHERE rn = 1""", "fx_runs"))
def q_run_events_latest(spark, d):
    return MT.latest_per(TD.runs(spark, d), ["run_id"], ["ts", "item_id", "item_no"],
                         ["ts", "item_id", "item_no", "ok"], prefix="last_")


@register("latest_checkpoint", with_fx("""
    SELECT run_id, phase_flag AS phase, n_records, ts, item_id AS frame_number, in_bytes, out_bytes FROM (
      SELECT *, count(*) OVER (PARTITION BY run_id, phase_flag) AS n_records,
             row_number() OVER (PARTITION BY run_id, phase_flag ORDER BY ts DESC, item_id DESC, item_no DESC) AS rn
      FROM fx_runs) z WHERE rn = 1""", "fx_runs"))
def q_latest_checkpoint(spark, d):
    r = TD.runs(spark, d).withColumnRenamed("phase_flag", "phase").withColumnRenamed("item_id", "frame_number")
    return MT.latest_per(r, ["run_id", "phase"], ["ts", "frame_number", "item_no"],
                         ["ts", "frame_number", "in_bytes", "out_bytes"])


@register("run_report", with_fx("""
    SELECT run_id, n_items, n_ok, n_items - n_ok AS n_failed, in_kb, out_kb,
           printf('run %d: %d items, %d ok, %d failed, in=%d KB, out=%d KB', run_id, n_items, n_ok, n_items - n_ok,
                  in_kb, out_kb) AS report
    FROM (SELECT run_id, count(*) AS n_items, count(*) FILTER (WHERE ok) AS n_ok,
                 CAST(floor(sum(in_bytes) / 1024.0::DOUBLE) AS BIGINT) AS in_kb,
                 CAST(floor(sum(out_bytes) / 1024.0::DOUBLE) AS BIGINT) AS out_kb FROM fx_runs GROUP BY 1) g""",
    "fx_runs"))
def q_run_report(spark, d):
    from framelake.sources.sinks import run_report
    return run_report(TD.runs(spark, d))


_SWEEP_CTES = [("ext", "SELECT video_id, max(pts_us) + 1 AS dur_us FROM fx_frames GROUP BY video_id"),
               ("sw", """SELECT n AS num_chunks, CAST(least(n - 1, (pts_us * n) // dur_us) AS INTEGER) AS chunk_no,
                                size_bytes
                         FROM (SELECT f.*, e.dur_us, unnest(range(2, 11)) AS n FROM fx_frames f JOIN ext e USING (video_id)) z"""),
               ("pc", """SELECT CAST(num_chunks AS INTEGER) AS num_chunks, chunk_no, CAST(sum(size_bytes) AS BIGINT) AS chunk_bytes
                         FROM sw GROUP BY 1, 2""")]


@register("sweep_summary", with_fx("""
    SELECT num_chunks, count(*) AS n_chunks, CAST(sum(chunk_bytes) AS DOUBLE) / 1000000.0::DOUBLE AS total_s,
           CAST(sum(chunk_bytes) AS DOUBLE) / 1000000.0::DOUBLE / CAST(count(*) AS DOUBLE) AS mean_s,
           CAST(max(chunk_bytes) AS DOUBLE) / 1000000.0::DOUBLE AS max_s
    FROM pc GROUP BY 1""", "fx_frames", ctes=_SWEEP_CTES))
def q_sweep_summary(spark, d):
    from framelake.sources.sinks import sweep_rows, sweep_summary
    return sweep_summary(sweep_rows(TD.frames(spark, d), 2, 10))


def _sql_two_decimals(v: str, per_one: int) -> str:
    step = per_one // 100
    c = (f"({v} // {step} + CASE WHEN ({v} % {step}) * 2 > {step} OR (({v} % {step}) * 2 = {step} "
         f"AND ({v} // {step}) % 2 = 1) THEN 1 ELSE 0 END)")
    return f"(CAST({c} // 100 AS VARCHAR) || '.' || lpad(CAST({c} % 100 AS VARCHAR), 2, '0'))"


@register("sweep_csv", with_fx(f"""
    SELECT CAST(num_chunks AS VARCHAR) AS num_chunks, CAST(chunk_no AS VARCHAR) AS chunk_no,
           {_sql_two_decimals('chunk_bytes', 1000000)} AS proc_s
    FROM pc""", "fx_frames", ctes=_SWEEP_CTES))
def q_sweep_csv(spark, d):
    """Sweep rows written as CSV with a header and 2-decimal values, read back."""
    from framelake.session import scratch_path
    from framelake.sources.sinks import read_csv, sweep_rows, write_sweep_csv
    path = scratch_path(spark, "sweep-csv")
    write_sweep_csv(sweep_rows(TD.frames(spark, d), 2, 10), path)
    return read_csv(spark, path)


@register("sweep_lengths_csv", with_fx(f"""
    SELECT CAST(video_id AS VARCHAR) AS video_id, CAST(n AS VARCHAR) AS num_chunks, CAST(chunk_no AS VARCHAR) AS chunk_no,
           {_sql_two_decimals('dur_us', 1000000).replace('10000', '(n * 10000)')} AS chunk_len_s,
           {_sql_two_decimals('chunk_bytes', 1000000)} AS proc_s
    FROM (SELECT video_id, n, CAST(least(n - 1, (pts_us * n) // dur_us) AS INTEGER) AS chunk_no, dur_us,
                 CAST(sum(size_bytes) AS BIGINT) AS chunk_bytes
          FROM (SELECT f.*, e.dur_us, unnest(range(2, 11)) AS n FROM fx_frames f JOIN ext e USING (video_id)) z
          GROUP BY ALL) y""", "fx_frames", ctes=_SWEEP_CTES[:1]))
def q_sweep_lengths_csv(spark, d):
    """A7 of each video, with the length of its chunks."""
    from framelake.session import scratch_path
    from framelake.sources.sinks import read_csv, sweep_rows_by_video, write_sweep_csv
    path = scratch_path(spark, "sweep-lengths-csv")
    write_sweep_csv(sweep_rows_by_video(TD.frames(spark, d), 2, 10), path)
    return read_csv(spark, path)


@register("event_log", ORACLES["run_events_latest"])
def q_event_log(spark, d):
    """A9 whole: two writers commit their records at the same time, the first
    one commits again (as after a retry), and records come late; the last
    record of every run is read back."""
    from concurrent.futures import ThreadPoolExecutor

    from framelake.session import scratch_path
    from framelake.sources.sinks import append_commit, read_log
    log, events = scratch_path(spark, "event-log"), TD.runs(spark, d)
    odd, late = F.col("item_no") % 2 == 1, F.col("item_id") % 5 == 0
    parts = [events.where(odd & ~late), events.where(~odd & ~late)]
    with ThreadPoolExecutor(2) as writers:
        names = list(writers.map(lambda e: append_commit(e, log), parts))
    append_commit(parts[0], log, names[0])
    append_commit(events.where(late), log)
    return MT.latest_per(read_log(spark, log), ["run_id"], ["ts", "item_id", "item_no"],
                         ["ts", "item_id", "item_no", "ok"], prefix="last_")


@register("metrics_json", with_fx("""
    SELECT run_id, count(*) AS n_items, count(*) FILTER (WHERE ok) AS n_ok,
           sum(in_bytes) / 1048576.0::DOUBLE AS input_mb, sum(out_bytes) / 1048576.0::DOUBLE AS output_mb,
           CAST(min(ts) AS VARCHAR) AS start_ts, CAST(max(ts) AS VARCHAR) AS end_ts
    FROM fx_runs GROUP BY 1""", "fx_runs"))
def q_metrics_json(spark, d):
    """Nested per-run metrics written as JSON lines, read back (and
    flattened for the check)."""
    from framelake.session import scratch_path
    from framelake.sources.sinks import metrics_tree, write_json
    path = scratch_path(spark, "metrics-json")
    write_json(metrics_tree(TD.runs(spark, d)), path)
    j = spark.read.json(path)
    return j.select("run_id", F.col("processing.n_items").alias("n_items"), F.col("processing.n_ok").alias("n_ok"),
                    F.col("sizes.input_mb").alias("input_mb"), F.col("sizes.output_mb").alias("output_mb"),
                    F.col("time.start").alias("start_ts"), F.col("time.end").alias("end_ts"))


_PHASE_SQL = ("phases", " UNION ALL ".join(
    f"SELECT '{p}' AS phase, TIMESTAMP '{a}' AS start_ts, TIMESTAMP '{b}' AS end_ts" for p, a, b in PHASES))


@register("resource_profile", with_fx("""
    SELECT r.run_id, coalesce(p.phase, 'unassigned') AS phase, count(*) AS n_samples, avg(cpu_percent) AS avg_cpu, max(cpu_percent) AS peak_cpu,
           avg(ram_percent) AS avg_ram, max(ram_percent) AS peak_ram
    FROM fx_resources r LEFT JOIN phases p ON r.ts >= p.start_ts AND r.ts < p.end_ts GROUP BY 1, 2""",
    "fx_resources", ctes=[_PHASE_SQL]))
def q_resource_profile(spark, d):
    plan = spark.createDataFrame(PHASES, "phase string, start_ts string, end_ts string").select(
        "phase", F.col("start_ts").cast("timestamp_ntz").alias("start_ts"),
        F.col("end_ts").cast("timestamp_ntz").alias("end_ts"))
    return MT.resource_profile(TD.resources(spark, d), plan, DAY_US)


@register("phase_durations", with_fx("""
    SELECT phase_flag, count(*) AS n, CAST(sum(dur_s) AS BIGINT) AS total_s, avg(dur_s) AS avg_s, max(dur_s) AS max_s
    FROM (SELECT phase_flag, CAST(epoch(ts) - epoch(lag(ts) OVER (PARTITION BY run_id ORDER BY ts, item_id, item_no)) AS BIGINT)
                 AS dur_s FROM fx_runs) z
    WHERE dur_s IS NOT NULL GROUP BY 1""", "fx_runs"))
def q_phase_durations(spark, d):
    r = TD.runs(spark, d)
    block = S.idiv(F.expr("timestampdiff(DAY, TIMESTAMP_NTZ'1990-01-01 00:00:00', ts)"), F.lit(90))
    return MT.phase_durations(r, "run_id", "phase_flag", ["ts", "item_id", "item_no"], block)


# ------------------------------------------------------------- streaming (S)
@register("resource_windows", with_fx(f"""
    SELECT run_id, make_timestamp(w) AS window_start, make_timestamp(w + {HOUR_US}) AS window_end,
           count(*) AS n_samples, avg(cpu_percent) AS avg_cpu, max(cpu_percent) AS peak_cpu,
           avg(ram_percent) AS avg_ram, max(ram_percent) AS peak_ram
    FROM (SELECT *, (epoch_us(ts) // {HOUR_US}) * {HOUR_US} AS w FROM fx_resources) z GROUP BY run_id, w""",
    "fx_resources"))
def q_resource_windows(spark, d):
    from framelake.streaming.resources import resource_windows
    return resource_windows(TD.resources(spark, d), WINDOW)


@register("stream_resource_windows", with_fx(f"""
    SELECT run_id, make_timestamp(w) AS window_start, make_timestamp(w + {HOUR_US}) AS window_end,
           count(*) AS n_samples, avg(cpu_percent) AS avg_cpu, max(cpu_percent) AS peak_cpu,
           avg(ram_percent) AS avg_ram, max(ram_percent) AS peak_ram
    FROM (SELECT *, (epoch_us(ts) // {HOUR_US}) * {HOUR_US} AS w FROM fx_resources) z GROUP BY run_id, w""",
    "fx_resources"))
def q_stream_resource_windows(spark, d):
    """S1 as a stream: resource samples arrive through a file stream, are
    watermarked and windowed; each micro-batch writes the windows it changed
    under its own number (a replayed batch replaces its folder), and the last
    state of every window is read back.  State beyond the watermark is freed."""
    from framelake.session import scratch_path
    from framelake.streaming.resources import stream_resource_windows
    schema = TD.table(spark, d, "events").schema
    src = spark.readStream.schema(schema).option("pathGlobFilter", "events*.parquet").parquet(d)
    samples = src.select((F.col("user_id") % TD.N_VIDEOS).alias("run_id"), "ts",
                         (F.floor(F.col("value") * 0.8) / 4.0).alias("cpu_percent"),
                         F.get_json_object("props", "$.k").cast("double").alias("ram_percent"))
    out = scratch_path(spark, "resource-windows")
    q = (stream_resource_windows(samples, WINDOW, "2 hours").writeStream.outputMode("update")
         .foreachBatch(lambda b, i: b.write.mode("overwrite").parquet(f"{out}/batch_id={i}"))
         .option("checkpointLocation", scratch_path(spark, "res-ckpt"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return MT.latest_per(spark.read.parquet(out), ["run_id", "window_start", "window_end"], ["batch_id"],
                         ["n_samples", "avg_cpu", "peak_cpu", "avg_ram", "peak_ram"]).drop("n_records")


@register("stream_frames", with_fx("""
    SELECT video_id, chunk_id, i + 1 AS local_no, substring(hex(payload), 128 * i + 1, 128) AS data_hex
    FROM (SELECT video_id, chunk_id, payload, unnest(range((octet_length(payload) + 63) // 64)) AS i FROM fx_payload) p""",
    "fx_payload"))
def q_stream_frames(spark, d):
    """Chunk payloads ingested by a streaming file source into the frame store."""
    from framelake.session import scratch_path
    from framelake.streaming.ingest import ingest_chunks
    store, ckpt = scratch_path(spark, "stream-store"), scratch_path(spark, "stream-ckpt")
    ingest_chunks(spark, _arriving(spark, d), lambda b: b, TD.PAYLOAD_FRAME_BYTES, store, ckpt)
    back = spark.read.parquet(store)
    return back.select(F.col("video_id").cast("bigint").alias("video_id"),
                       F.col("chunk_id").cast("bigint").alias("chunk_id"), "local_no",
                       F.hex("data").alias("data_hex"))


# Chunks arrive in files of about so many chunks, twelve at least.
FILE_CHUNKS, LEAST_FILES = 100_000, 12
PROGRESS_BATCHES = 10


def _arriving(spark, d):
    """fx_payload written as the files of a stream: file ``k`` of ``n`` holds
    the chunks whose number leaves ``k``.  One file is one micro-batch."""
    from framelake.session import scratch_path
    chunks, path = TD.payload(spark, d), scratch_path(spark, "arriving")
    n = max(LEAST_FILES, -(-chunks.count() // FILE_CHUNKS))
    part = F.pmod(F.col("chunk_id"), F.lit(n)).cast("int")
    chunks.withColumn("part_no", part).repartitionById(n, "part_no").write.parquet(path)
    return spark.readStream.schema("video_id long, chunk_id long, payload binary, part_no int").option("maxFilesPerTrigger", 1).parquet(path)


_ARRIVING_SQL = f"(SELECT greatest({LEAST_FILES}, (count(*) + {FILE_CHUNKS - 1}) // {FILE_CHUNKS}) AS n FROM fx_payload)"


@register("stream_resume", with_fx("""
    SELECT video_id, chunk_id, CAST((octet_length(payload) + 63) // 64 AS BIGINT) AS n_frames,
           CAST(octet_length(payload) AS BIGINT) AS n_bytes, CAST(1 AS BIGINT) AS n_batches, CAST(2 AS BIGINT) AS n_runs
    FROM fx_payload WHERE octet_length(payload) > 0""", "fx_payload"))
def q_stream_resume(spark, d):
    """S3: an ingestion is stopped when its third micro-batch is written but
    not committed, and started again from its checkpoint; every frame is in
    the store once."""
    from framelake.session import scratch_path
    from framelake.streaming.ingest import Stopped, ingest_chunks
    stream = _arriving(spark, d)
    store, ckpt, runs = scratch_path(spark, "resume-store"), scratch_path(spark, "resume-ckpt"), 1
    try:
        ingest_chunks(spark, stream, lambda b: b, TD.PAYLOAD_FRAME_BYTES, store, ckpt, stop_after=3)
    except Stopped:
        runs += 1
        ingest_chunks(spark, stream, lambda b: b, TD.PAYLOAD_FRAME_BYTES, store, ckpt)
    frames = spark.read.parquet(store)
    return (frames.groupBy(F.col("video_id").cast("bigint").alias("video_id"), "chunk_id")
                  .agg(F.count(F.lit(1)).alias("n_frames"), F.sum(F.length("data")).cast("bigint").alias("n_bytes"),
                       F.count_distinct("batch_id").alias("n_batches"))
                  .withColumn("n_runs", F.lit(runs).cast("bigint")))


@register("batch_progress", with_fx(f"""
    SELECT part_no, n_frames, n_failed, CAST(sum(n_frames) OVER () AS BIGINT) AS frames_done,
           CAST(sum(n_failed) OVER () AS BIGINT) AS failed_done, count(*) OVER () AS n_records, count(*) OVER () // {PROGRESS_BATCHES} AS n_marks,
           CAST(sum(n_frames - n_failed) OVER () AS DOUBLE) / CAST(sum(n_frames) OVER () AS DOUBLE) AS success_rate
    FROM (SELECT CAST(chunk_id % n AS INTEGER) AS part_no, CAST(sum((octet_length(payload) + 63) // 64) AS BIGINT) AS n_frames,
                 count(*) FILTER (WHERE octet_length(payload) % 64 > 0) AS n_failed
          FROM fx_payload, {_ARRIVING_SQL} a GROUP BY 1) p""", "fx_payload"))
def q_batch_progress(spark, d):
    """F4/C5/E4 per micro-batch: frames and failures observed while a batch is
    written, and a checkpoint record after each; the last record and the marks
    of every tenth batch are read back."""
    from framelake.session import scratch_path
    from framelake.streaming.ingest import ingest_chunks, read_progress
    log = scratch_path(spark, "progress-log")
    ingest_chunks(spark, _arriving(spark, d), lambda b: b, TD.PAYLOAD_FRAME_BYTES, scratch_path(spark, "progress-store"),
                  scratch_path(spark, "progress-ckpt"), log=log, every=PROGRESS_BATCHES, observe={"part_no": F.max("part_no")})
    records = read_progress(spark, log)
    run = Window.partitionBy()                      # one row per micro-batch
    last = F.max(F.struct("batch_id", "frames_done", "failed_done")).over(run)
    rows = records.select(F.col("part_no").cast("int").alias("part_no"), "n_frames", "n_failed", last.alias("l"),
                          F.count(F.lit(1)).over(run).alias("n_records"), F.count_if("is_mark").over(run).alias("n_marks"))
    rate = (F.col("l.frames_done") - F.col("l.failed_done")).cast("double") / F.col("l.frames_done").cast("double")
    return rows.select("part_no", "n_frames", "n_failed", "l.frames_done", "l.failed_done", "n_records", "n_marks", rate.alias("success_rate"))


# ---------------------------------------------------------- linear algebra (L)
@register("matmul_coo", with_fx("""
    SELECT a.i, b.j, sum(a.v * b.v) AS v FROM fx_coo a JOIN fx_coo b ON a.j = b.i GROUP BY 1, 2""", "fx_coo"))
def q_matmul_coo(spark, d):
    from framelake.operators.linalg import matmul_coo
    a = TD.coo(spark, d)
    return matmul_coo(a, a)


@register("gram_matrix", with_fx("""
    SELECT CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j,
           CAST(sum(vals[i + 1] * vals[j + 1]) AS DOUBLE) AS g
    FROM fx_arrays, (SELECT unnest(range(64)) AS i) a, (SELECT unnest(range(64)) AS j) b GROUP BY 1, 2""", "fx_arrays"))
def q_gram_matrix(spark, d):
    """L2's distributed half over whole pixel values, whose sums are exact."""
    from framelake.operators.linalg import gram_matrix
    return gram_matrix(TD.pixel_arrays(spark, d), "vals")


@register("svd_topk")
def q_svd_topk(spark, d):
    from framelake.operators.linalg import svd_topk
    return svd_topk(spark, TD.table(spark, d, "embeddings"), "embedding", 5)


def _svd_sql(k: int = 5, squarings: int = 16) -> str:
    """Singular pairs from the Gram matrix alone: its power ``2^squarings`` has
    the leading vector in every column (taken where the diagonal is largest);
    the pair is then taken out of the Gram and the next one follows."""
    ctes = [("x", "SELECT vec_id, CAST(embedding[i + 1] AS DOUBLE) AS v, i FROM embeddings, (SELECT unnest(range(64)) AS i) r"),
            ("g0", "SELECT a.i, b.i AS j, sum(a.v * b.v) AS g FROM x a JOIN x b USING (vec_id) GROUP BY 1, 2")]
    for n in range(k):
        ctes.append((f"p{n}_0", f"SELECT i, j, g / (SELECT max(abs(g)) FROM g{n}) AS g FROM g{n}"))
        for m in range(squarings):
            ctes.append((f"q{n}_{m}", f"SELECT a.i, b.j, sum(a.g * b.g) AS g FROM p{n}_{m} a JOIN p{n}_{m} b ON a.j = b.i GROUP BY 1, 2"))
            ctes.append((f"p{n}_{m + 1}", f"SELECT i, j, g / (SELECT max(abs(g)) FROM q{n}_{m}) AS g FROM q{n}_{m}"))
        power = f"p{n}_{squarings}"
        ctes.append((f"c{n}", f"SELECT i, g FROM {power} WHERE j = (SELECT i FROM {power} WHERE i = j ORDER BY g DESC, i LIMIT 1)"))
        ctes.append((f"v{n}", f"SELECT i, g / (SELECT sqrt(sum(g * g)) FROM c{n}) AS v FROM c{n}"))
        ctes.append((f"w{n}", f"SELECT g.i, sum(g.g * v.v) AS w FROM g0 g JOIN v{n} v ON g.j = v.i GROUP BY 1"))
        ctes.append((f"l{n}", f"SELECT sum(w.w * v.v) AS l FROM w{n} w JOIN v{n} v USING (i)"))
        ctes.append((f"g{n + 1}", f"SELECT g.i, g.j, g.g - l.l * a.v * b.v AS g FROM g{n} g JOIN v{n} a ON g.i = a.i JOIN v{n} b ON g.j = b.i, l{n} l"))
        ctes.append((f"r{n}", f"SELECT sqrt(sum((w.w - l.l * v.v) * (w.w - l.l * v.v))) / (SELECT l FROM l0) AS r FROM w{n} w JOIN v{n} v USING (i), l{n} l"))
    rows = " UNION ALL ".join(f"SELECT CAST({n} AS INTEGER) AS k, round(sqrt(l), 4) AS sigma, round(r, 6) AS residual FROM l{n}, r{n}" for n in range(k))
    return "WITH " + ", ".join(f"{name} AS MATERIALIZED ({sql})" for name, sql in ctes) + " " + rows


@register("svd_pairs", _svd_sql())
def q_svd_pairs(spark, d):
    """L2 whole: pairs from the tree of triangular factors, checked against a
    Gram matrix that is formed anew."""
    from framelake.operators.linalg import gram_matrix, pair_residuals, singular_pairs
    x = TD.table(spark, d, "embeddings")
    out = pair_residuals(singular_pairs(x, "embedding", 5), gram_matrix(x, "embedding"))
    return out.select("k", F.round("sigma", 4).alias("sigma"), F.round("residual", 6).alias("residual"))
