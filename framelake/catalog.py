"""Registered queries (Spark) and their DuckDB oracles.

Each entry runs one operator of the inventory over the driver's tables
through a fixture adapter (:mod:`framelake.sources.testdata`).  The oracle is
independent SQL over the same base tables (:mod:`framelake.oracle`).  Column
names and types agree on both sides, and so do doubles, bit for bit
(``tools/oracle_check.py --exact``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.functions import scalars as S
from framelake.operators import frames as FR
from framelake.oracle import with_fx
from framelake.plans import chunking as CH
from framelake.sources import probe as PR
from framelake.sources import testdata as TD

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


# ---------------------------------------------------------------- parameters
N_CHUNKS = 10                       # chunks per recording (the original cluster runs used 10)
HOUR_US = 3600 * 1000000            # scan block for the events-based frame fixture
DAY_US = 24 * HOUR_US
PAYLOAD_FPS = (30000, 1001)         # constant frame rate used at reassembly
BATCH_CORES = 8
PART_FRAMES = 16                    # frames per part of a reassembled chunk
PROGRESS_STEP = 100
SLICE_START_US, SLICE_LEN_US = 3 * DAY_US, DAY_US


def _sql_fps(t: str) -> str:
    """Lenient fps parse in DuckDB (twin of ``scalars.parse_fps``)."""
    rx = r"'^(\d+)/(\d+)'"
    num = f"TRY_CAST(regexp_extract({t}, {rx}, 1) AS DOUBLE)"
    den = f"TRY_CAST(regexp_extract({t}, {rx}, 2) AS DOUBLE)"
    return (f"(CASE WHEN regexp_matches({t}, {rx}) THEN "
            f"(CASE WHEN {den} = 0 THEN 0.0::DOUBLE ELSE {num} / {den} END) "
            f"ELSE coalesce(TRY_CAST({t} AS DOUBLE), 0.0::DOUBLE) END)")


def _sql_fps_error(t: str) -> str:
    strict = r"'^\s*[+-]?\d+\s*/\s*\d+\s*$'"
    den = rf"TRY_CAST(regexp_extract({t}, '/\s*(\d+)\s*$', 1) AS DOUBLE)"
    return (f"(CASE WHEN {t} IS NULL THEN 'missing' "
            f"WHEN regexp_matches({t}, {strict}) AND {den} = 0 THEN 'zero denominator' "
            f"WHEN NOT regexp_matches({t}, {strict}) AND TRY_CAST({t} AS DOUBLE) IS NULL "
            f"THEN 'not a number' END)")


_META_SQL = ("meta", f"""
    SELECT video_id, fps_text, st.width AS width, st.height AS height,
           st.avg_frame_rate AS avg_frame_rate, {_sql_fps('st.avg_frame_rate')} AS fps,
           coalesce(TRY_CAST(st.nb_frames AS BIGINT), 0) AS frame_count,
           TRY_CAST(f.duration AS DOUBLE) AS duration_s, TRY_CAST(f.size AS BIGINT) AS file_size,
           TRY_CAST(f.size AS DOUBLE) / (1024.0::DOUBLE * 1024.0::DOUBLE) AS file_size_mb,
           TRY_CAST(f.bit_rate AS BIGINT) AS bit_rate
    FROM (SELECT video_id, fps_text,
                 list_filter(p.streams, lambda x: x.width IS NOT NULL)[1] AS st, p.format AS f
          FROM (SELECT video_id, fps_text, from_json(probe_json,
                 '{{"streams":[{{"index":"INTEGER","codec_type":"VARCHAR","width":"INTEGER",
                    "height":"INTEGER","avg_frame_rate":"VARCHAR","nb_frames":"VARCHAR"}}],
                   "format":{{"duration":"VARCHAR","size":"VARCHAR","bit_rate":"VARCHAR"}}}}') AS p
                FROM fx_probe) j) s""")


def _meta(spark: SparkSession, d: str) -> DataFrame:
    return PR.parse_probe(TD.probe(spark, d))


# ------------------------------------------------------------ sources (A*)
@register("probe_metadata", with_fx("SELECT * FROM meta", "fx_probe", ctes=[_META_SQL]))
def q_probe_metadata(spark, d):
    return _meta(spark, d)


@register("list_chunks")
def q_list_chunks(spark, d):
    """A1: the table files of the data directory, name-sorted; only file
    metadata is read (the ``content`` column is pruned)."""
    from framelake.sources.files import list_files
    return list_files(spark, d, "*.parquet")


# ----------------------------------------------------- scalar functions (B*)
@register("fps_parse", with_fx(f"""
    SELECT video_id, fps_text, {_sql_fps('fps_text')} AS fps, {_sql_fps_error('fps_text')} AS fps_error
    FROM fx_probe""", "fx_probe"))
def q_fps_parse(spark, d):
    p = TD.probe(spark, d)
    return p.select("video_id", "fps_text", S.parse_fps("fps_text").alias("fps"),
                    S.fps_error("fps_text").alias("fps_error"))


@register("frame_count_estimates", with_fx("""
    SELECT video_id, frame_count, CAST(round_even(duration_s * fps, 0) AS BIGINT) AS est_round,
           CAST(floor(fps * duration_s) AS BIGINT) AS est_floor,
           CASE WHEN fps = 0 THEN NULL ELSE frame_count / fps END AS duration_from_count
    FROM meta""", "fx_probe", ctes=[_META_SQL]))
def q_frame_count_estimates(spark, d):
    m = _meta(spark, d)
    return m.select("video_id", "frame_count",
                    S.frame_count_round(F.col("duration_s"), F.col("fps")).alias("est_round"),
                    S.frame_count_floor(F.col("duration_s"), F.col("fps")).alias("est_floor"),
                    S.duration_from_count(F.col("frame_count"), F.col("fps")).alias("duration_from_count"))


# ---------------------------------------------------------- planning (P*)
@register("chunk_plan", with_fx("""
    SELECT video_id, 10 AS num_chunks, CAST(i AS INTEGER) AS chunk_id,
           CAST(i AS DOUBLE) * (duration_s / 10.0::DOUBLE) AS start_s,
           duration_s / 10.0::DOUBLE AS chunk_len_s, printf('chunk_%03d.mp4', i) AS chunk_file
    FROM (SELECT video_id, duration_s, unnest(range(10)) AS i FROM meta) m""",
    "fx_probe", ctes=[_META_SQL]))
def q_chunk_plan(spark, d):
    return CH.equal_time_plan(_meta(spark, d), N_CHUNKS)


@register("chunk_sweep", with_fx("""
    SELECT video_id, CAST(n AS INTEGER) AS num_chunks, CAST(i AS INTEGER) AS chunk_id,
           CAST(i AS DOUBLE) * (duration_s / CAST(n AS DOUBLE)) AS start_s,
           duration_s / CAST(n AS DOUBLE) AS chunk_len_s, printf('chunk_%03d.mp4', i) AS chunk_file
    FROM (SELECT video_id, duration_s, n, unnest(range(n)) AS i
          FROM (SELECT video_id, duration_s, unnest(range(2, 11)) AS n FROM meta) a) b""",
    "fx_probe", ctes=[_META_SQL]))
def q_chunk_sweep(spark, d):
    return CH.chunk_sweep(_meta(spark, d), 2, 10)


_EXT_SQL = ("ext", "SELECT video_id, max(pts_us) + 1 AS dur_us FROM fx_frames GROUP BY video_id")
_NOM = "least(9, (pts_us * 10) // dur_us)"


_SEG_CTES = [
    _EXT_SQL,
    ("g", f"SELECT f.*, {_NOM} AS nominal FROM fx_frames f JOIN ext USING (video_id)"),
    ("s", """SELECT video_id, pts_us,
                 coalesce(max(CASE WHEN pict_type = 'I' THEN nominal END) OVER (
                   PARTITION BY video_id ORDER BY pts_us, frame_id
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS seg FROM g"""),
    ("a", """SELECT video_id, seg, count(*) AS frame_count, min(pts_us) AS first_pts_us,
                 max(pts_us) AS last_pts_us FROM s GROUP BY 1, 2"""),
]


@register("keyframe_segments", with_fx("""
    SELECT video_id, CAST(row_number() OVER (PARTITION BY video_id ORDER BY seg) - 1 AS INTEGER) AS chunk_id,
           seg AS nominal_chunk, frame_count, first_pts_us, last_pts_us,
           CAST(coalesce(sum(frame_count) OVER (PARTITION BY video_id ORDER BY seg
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS frame_offset
    FROM a""", "fx_frames", ctes=_SEG_CTES))
def q_keyframe_segments(spark, d):
    return CH.keyframe_segments(TD.frames(spark, d), N_CHUNKS, block_us=HOUR_US)


SHORT_CHUNKS = 400                  # more chunks than some videos have key frames for


@register("segment_report", with_fx("""
    SELECT video_id, CAST(400 AS BIGINT) AS requested, count(*) AS created, count(*) = 400 AS matches,
           min(frame_count) AS least_frames, max(frame_count) AS most_frames, CAST(sum(frame_count) AS BIGINT) AS n_frames
    FROM a GROUP BY 1""", "fx_frames", ctes=[(n, q.replace("least(9, (pts_us * 10)", "least(399, (pts_us * 400)")) for n, q in _SEG_CTES]))
def q_segment_report(spark, d):
    """Requested against created chunks."""
    return CH.segment_report(CH.keyframe_segments(TD.frames(spark, d), SHORT_CHUNKS, block_us=HOUR_US), SHORT_CHUNKS)


@register("keyframe_select", with_fx(
    "SELECT video_id, frame_id, pts_us, size_bytes FROM fx_frames WHERE pict_type = 'I'", "fx_frames"))
def q_keyframe_select(spark, d):
    return TD.frames(spark, d, only="I").select("video_id", "frame_id", "pts_us", "size_bytes")


@register("time_slice", with_fx(f"""
    SELECT video_id, frame_id, pts_us, pict_type FROM fx_frames
    WHERE pts_us >= {SLICE_START_US} AND pts_us < {SLICE_START_US + SLICE_LEN_US}""", "fx_frames"))
def q_time_slice(spark, d):
    f = TD.frames(spark, d, between=(SLICE_START_US, SLICE_START_US + SLICE_LEN_US))
    return f.select("video_id", "frame_id", "pts_us", "pict_type")


@register("keyframe_chunks", with_fx(f"""
    SELECT video_id, CAST({_NOM} AS INTEGER) AS chunk_id, frame_id, pts_us
    FROM fx_frames JOIN ext USING (video_id) WHERE pict_type = 'I'""", "fx_frames", ctes=[_EXT_SQL]))
def q_keyframe_chunks(spark, d):
    return CH.keyframe_chunks(TD.frames(spark, d), N_CHUNKS)


_CHUNKED_CTES = [_EXT_SQL, ("c", f"""
    SELECT video_id, frame_id, pts_us, pict_type, CAST({_NOM} AS INTEGER) AS chunk_id
    FROM fx_frames JOIN ext USING (video_id)""")]


@register("force_keyframes", with_fx("""
    SELECT video_id, chunk_id, frame_id, pts_us, pict_type = 'I' AS was_key,
           pict_type = 'I' OR row_number() OVER (PARTITION BY video_id, chunk_id ORDER BY pts_us, frame_id) = 1
             AS is_key
    FROM c""", "fx_frames", ctes=_CHUNKED_CTES))
def q_force_keyframes(spark, d):
    return CH.force_keyframes(TD.frames(spark, d), N_CHUNKS)


@register("chunk_range_join", with_fx("""
    SELECT f.video_id, f.frame_id, f.pts_us, p.chunk_id
    FROM fx_frames f JOIN plan p ON f.video_id = p.video_id AND f.pts_us >= p.start_us AND f.pts_us < p.end_us
    """, "fx_frames", ctes=[_EXT_SQL, ("plan", """
    SELECT video_id, CAST(i AS INTEGER) AS chunk_id, (i * dur_us) // 10 AS start_us, ((i + 1) * dur_us) // 10 AS end_us
    FROM (SELECT video_id, dur_us, unnest(range(10)) AS i FROM ext) e""")]))
def q_chunk_range_join(spark, d):
    f = TD.frames(spark, d).select("video_id", "frame_id", "pts_us")
    plan = CH.micro_plan(f, N_CHUNKS)
    return CH.range_join_chunks(f, plan, DAY_US)


@register("chunk_frame_counts", with_fx("""
    SELECT video_id, chunk_id, count(*) AS frame_count, min(pts_us) AS first_pts_us, max(pts_us) AS last_pts_us,
           CASE WHEN max(pts_us) - min(pts_us) = 0 THEN 0.0::DOUBLE
                ELSE CAST((count(*) - 1) * 1000000 AS DOUBLE) / CAST(max(pts_us) - min(pts_us) AS DOUBLE) END AS fps_est
    FROM c GROUP BY 1, 2""", "fx_frames", ctes=_CHUNKED_CTES))
def q_chunk_frame_counts(spark, d):
    f = CH.assign_equal_chunks(TD.frames(spark, d), N_CHUNKS)
    g = f.groupBy("video_id", "chunk_id").agg(F.count(F.lit(1)).alias("frame_count"),
                                              F.min("pts_us").alias("first_pts_us"),
                                              F.max("pts_us").alias("last_pts_us"))
    return g.withColumn("fps_est", S.safe_ratio((F.col("frame_count") - 1) * 1000000,
                                                F.col("last_pts_us") - F.col("first_pts_us")))


@register("task_per_chunk", with_fx("""
    SELECT CAST(dense_rank() OVER (ORDER BY video_id, chunk_id) - 1 AS INTEGER) AS task_no, CAST(1 AS BIGINT) AS n_chunks, video_id, chunk_id, n_frames
    FROM (SELECT video_id, chunk_id, count(*) AS n_frames FROM c GROUP BY 1, 2) g""", "fx_frames", ctes=_CHUNKED_CTES))
def q_task_per_chunk(spark, d):
    """What each task of the per-chunk stage holds."""
    f = CH.one_task_per_chunk(CH.assign_equal_chunks(TD.frames(spark, d), N_CHUNKS))
    return (f.groupBy(F.spark_partition_id().alias("task_no"))
             .agg(F.count_distinct("video_id", "chunk_id").alias("n_chunks"), F.min("video_id").alias("video_id"),
                  F.min("chunk_id").alias("chunk_id"), F.count(F.lit(1)).alias("n_frames")))


# --------------------------------------------- frame store & numbering (A/F/G)
def _payload_frames(spark, d):
    return FR.explode_frames(TD.payload(spark, d), TD.PAYLOAD_FRAME_BYTES)


def _numbered(spark, d):
    chunks = TD.payload(spark, d)
    counts = FR.chunk_frame_counts_from_payload(chunks, TD.PAYLOAD_FRAME_BYTES)
    return FR.number_frames(FR.explode_frames(chunks, TD.PAYLOAD_FRAME_BYTES), FR.chunk_offsets(counts))


_EXPLODED_SQL = ("ex", """
    SELECT video_id, chunk_id, i + 1 AS local_no, substring(hex(payload), 128 * i + 1, 128) AS data_hex
    FROM (SELECT video_id, chunk_id, payload, unnest(range((octet_length(payload) + 63) // 64)) AS i FROM fx_payload) p""")
_OFFSETS_SQL = ("offs", """
    SELECT video_id, chunk_id, (octet_length(payload) + 63) // 64 AS frame_count,
           CAST(coalesce(sum((octet_length(payload) + 63) // 64) OVER (PARTITION BY video_id ORDER BY chunk_id
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS frame_offset
    FROM fx_payload""")
_NUMBERED_SQL = ("numbered", """
    SELECT ex.video_id, ex.chunk_id, local_no, frame_offset + local_no AS frame_no, data_hex
    FROM ex JOIN offs USING (video_id, chunk_id)""")
_PAYLOAD_CTES = [_EXPLODED_SQL, _OFFSETS_SQL, _NUMBERED_SQL]


@register("explode_frames", with_fx("SELECT * FROM ex", "fx_payload", ctes=[_EXPLODED_SQL]))
def q_explode_frames(spark, d):
    f = _payload_frames(spark, d)
    return f.select("video_id", "chunk_id", "local_no", F.hex("data").alias("data_hex"))


@register("chunk_offsets", with_fx("SELECT * FROM offs", "fx_payload", ctes=[_OFFSETS_SQL]))
def q_chunk_offsets(spark, d):
    counts = FR.chunk_frame_counts_from_payload(TD.payload(spark, d), TD.PAYLOAD_FRAME_BYTES)
    return FR.chunk_offsets(counts)


@register("global_frame_no", with_fx(
    "SELECT video_id, chunk_id, local_no, frame_no FROM numbered", "fx_payload", ctes=_PAYLOAD_CTES))
def q_global_frame_no(spark, d):
    return _numbered(spark, d).select("video_id", "chunk_id", "local_no", "frame_no")


@register("frame_store_roundtrip", with_fx(
    "SELECT video_id, chunk_id, frame_no, data_hex FROM numbered", "fx_payload", ctes=_PAYLOAD_CTES))
def q_frame_store_roundtrip(spark, d):
    from framelake.session import scratch_path
    from framelake.sources.frame_store import read_frame_store, write_frame_store
    path = scratch_path(spark, "frame-store")
    write_frame_store(_numbered(spark, d).drop("local_no"), path)
    back = read_frame_store(spark, path)
    return back.select(F.col("video_id").cast("bigint").alias("video_id"),
                       F.col("chunk_id").cast("bigint").alias("chunk_id"), "frame_no",
                       F.hex("data").alias("data_hex"))


@register("chunk_manifest", with_fx("""
    SELECT video_id, chunk_id, row_number() OVER (PARTITION BY video_id, chunk_id ORDER BY first_no) AS run_no,
           first_no, last_no, n_frames
    FROM (SELECT video_id, chunk_id, min(frame_no) AS first_no, max(frame_no) AS last_no, count(*) AS n_frames
          FROM (SELECT video_id, chunk_id, frame_no,
                       frame_no - row_number() OVER (PARTITION BY video_id, chunk_id ORDER BY frame_no) AS run
                FROM numbered) n GROUP BY video_id, chunk_id, run) r""", "fx_payload", ctes=_PAYLOAD_CTES))
def q_chunk_manifest(spark, d):
    return FR.manifest(_numbered(spark, d))


@register("frame_names", with_fx("""
    SELECT video_id, chunk_id, frame_no, printf('chunk_%03d.mp4', chunk_id) AS chunk_file,
           printf('frame%06d.png', frame_no) AS frame_file, printf('frame_%06d.png', frame_no) AS frame_file_u,
           printf('frame%06d', frame_no) AS frame_stem,
           printf('chunk_%03d.mp4', chunk_id) AS chunk_base
    FROM numbered""", "fx_payload", ctes=_PAYLOAD_CTES))
def q_frame_names(spark, d):
    n = _numbered(spark, d)
    path = F.concat(F.lit("'/videos/v"), F.col("video_id").cast("string"), F.lit("/"),
                    S.chunk_name(F.col("chunk_id")), F.lit("`"))
    return n.select("video_id", "chunk_id", "frame_no",
                    S.chunk_name(F.col("chunk_id")).alias("chunk_file"),
                    S.frame_name(F.col("frame_no")).alias("frame_file"),
                    S.frame_name_underscore(F.col("frame_no")).alias("frame_file_u"),
                    S.strip_extension(S.frame_name(F.col("frame_no"))).alias("frame_stem"),
                    S.basename(S.strip_quotes(path)).alias("chunk_base"))


@register("frame_timestamps", with_fx(f"""
    SELECT video_id, frame_no, ((frame_no - 1) * 1000000 * {PAYLOAD_FPS[1]}) // {PAYLOAD_FPS[0]} AS pts_us
    FROM numbered""", "fx_payload", ctes=_PAYLOAD_CTES))
def q_frame_timestamps(spark, d):
    n = _numbered(spark, d)
    return n.select("video_id", "frame_no",
                    S.frame_pts_us(F.col("frame_no"), F.lit(PAYLOAD_FPS[0]), F.lit(PAYLOAD_FPS[1]))
                     .alias("pts_us"))


@register("reassemble", with_fx(f"""
    SELECT video_id, chunk_id, (frame_no - 1) // {PART_FRAMES} AS part_no, min(frame_no) AS first_no,
           max(frame_no) AS last_no, count(*) AS n_frames, string_agg(data_hex, '' ORDER BY frame_no) AS payload_hex,
           CAST(sum(length(data_hex)) // 2 AS BIGINT) AS n_bytes
    FROM numbered GROUP BY 1, 2, 3""", "fx_payload", ctes=_PAYLOAD_CTES))
def q_reassemble(spark, d):
    r = FR.reassemble(_numbered(spark, d), "strict", frames_per_part=PART_FRAMES)
    return r.select("video_id", "chunk_id", "part_no", "first_no", "last_no", "n_frames",
                    F.hex("payload").alias("payload_hex"), F.length("payload").cast("bigint").alias("n_bytes"))


@register("require_frames", with_fx("""
    SELECT video_id, chunk_id, CAST((octet_length(payload) + 63) // 64 AS BIGINT) AS n_frames
    FROM fx_payload""", "fx_payload"))
def q_require_frames(spark, d):
    counts = FR.chunk_frame_counts_from_payload(TD.payload(spark, d), TD.PAYLOAD_FRAME_BYTES)
    return FR.require_frames(counts.withColumnRenamed("frame_count", "n_frames"), "n_frames")


# ------------------------------------------------ ordered frame scans (F*)
_IX_SQL = ("ixf", """
    SELECT video_id, frame_id, pts_us,
           row_number() OVER (PARTITION BY video_id ORDER BY pts_us, frame_id) AS ix,
           count(*) OVER (PARTITION BY video_id) AS n
    FROM fx_frames""")


@register("batch_plan", with_fx(f"""
    SELECT video_id, frame_id, pts_us, ix, greatest(n // {BATCH_CORES * 4}, 1) AS batch_size,
           (ix - 1) // greatest(n // {BATCH_CORES * 4}, 1) AS batch_id
    FROM ixf""", "fx_frames", ctes=[_IX_SQL]))
def q_batch_plan(spark, d):
    f = TD.frames(spark, d).select("video_id", "frame_id", "pts_us")
    return FR.batch_plan(f, BATCH_CORES, S.idiv(F.col("pts_us"), F.lit(HOUR_US)), ["pts_us", "frame_id"])


@register("progress_marks", with_fx(f"""
    SELECT video_id, frame_id, pts_us, ix FROM ixf WHERE ix % {PROGRESS_STEP} = 0""",
    "fx_frames", ctes=[_IX_SQL]))
def q_progress_marks(spark, d):
    f = TD.frames(spark, d).select("video_id", "frame_id", "pts_us")
    return FR.progress_marks(f, PROGRESS_STEP, S.idiv(F.col("pts_us"), F.lit(HOUR_US)), ["pts_us", "frame_id"])


@register("frame_gaps", with_fx("""
    SELECT video_id, frame_no, next_no, next_no - frame_no - 1 AS missing FROM (
      SELECT video_id, frame_id AS frame_no, lead(frame_id) OVER (PARTITION BY video_id ORDER BY frame_id) AS next_no
      FROM fx_frames) g
    WHERE next_no - frame_no > 1""", "fx_frames"))
def q_frame_gaps(spark, d):
    f = TD.frames(spark, d)
    return FR.frame_gaps(f, ["video_id"], "frame_id", S.idiv(F.col("frame_id"), F.lit(1000)))


@register("first_frame", with_fx("""
    SELECT video_id, frame_id, pts_us, pict_type, size_bytes FROM (
      SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY pts_us, frame_id) AS rn FROM fx_frames) f
    WHERE rn = 1""", "fx_frames"))
def q_first_frame(spark, d):
    return FR.first_frame(TD.frames(spark, d), order=("pts_us", "frame_id"))


@register("unprocessed_frames", with_fx("""
    SELECT video_id, frame_id, pts_us FROM fx_frames f
    WHERE NOT EXISTS (SELECT 1 FROM fx_packets p WHERE p.media_type = 'video'
                      AND p.video_id = f.video_id AND p.packet_id = f.frame_id)""", "fx_frames", "fx_packets"))
def q_unprocessed_frames(spark, d):
    f = TD.frames(spark, d).select("video_id", "frame_id", "pts_us")
    done = (TD.packets(spark, d).where(F.col("media_type") == "video")
              .select("video_id", F.col("packet_id").alias("frame_id")))
    return FR.unprocessed(f, done, ["video_id", "frame_id"])


@register("quarantine_frames", with_fx(f"""
    SELECT video_id, fps_text, {_sql_fps_error('fps_text')} AS error FROM fx_probe
    WHERE {_sql_fps_error('fps_text')} IS NOT NULL""", "fx_probe"))
def q_quarantine_frames(spark, d):
    from framelake.operators.quality import split_valid
    _, bad = split_valid(TD.probe(spark, d).select("video_id", "fps_text"), S.fps_error("fps_text"))
    return bad


@register("frame_size_stats", with_fx("""
    SELECT video_id, count(*) AS n_frames, CAST(sum(size_bytes) AS BIGINT) AS total_bytes,
           avg(size_bytes) AS avg_bytes, CAST(sum(size_bytes) AS DOUBLE) / (1024.0::DOUBLE * 1024.0::DOUBLE) AS total_mb,
           avg(size_bytes) / 1024.0::DOUBLE AS avg_kb
    FROM fx_frames GROUP BY 1""", "fx_frames"))
def q_frame_size_stats(spark, d):
    from framelake.operators.metrics import size_stats
    return size_stats(TD.frames(spark, d), "size_bytes")


# The other query groups register themselves into QUERIES / ORACLES on import.
import framelake.catalog_pixels  # noqa: E402,F401  (pixel queries)
import framelake.catalog_media  # noqa: E402,F401  (media, metrics, streaming, linear algebra)
