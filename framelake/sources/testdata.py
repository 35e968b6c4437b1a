"""Adapters from the driver's tables to framelake's data model.

The driver ships relational tables, not media, so each adapter gives a table
one of the roles the engine works on (frame metadata, pixel grids, chunk
payloads, packets, probe output, resource samples, run metrics, a sparse
matrix).  Every adapter is a narrow projection of one table (plus, for
``coo``, one aggregate), so it scales with its input.  The DuckDB twins of
these definitions live in :mod:`framelake.oracle`; the two must stay equal.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the fixtures (documented in FIXTURES.md §3).
N_VIDEOS = 4                 # video_id = user_id % 4 for the events-based fixtures
FRAME_SIDE = 8               # embeddings (64 values) form 8x8 one-channel frames
PAYLOAD_FRAME_BYTES = 64     # documents' UTF-8 bytes are cut into 64-byte frames
EPOCH = "2024-01-01 00:00:00"
TEMPLATE_FRAME, TEMPLATE_Y0, TEMPLATE_X0, TEMPLATE_SIDE = 0, 2, 2, 3
LOGO_FRAME, LOGO_SIDE = 1, 3
LOGO_ALPHA_BY_COLUMN = (0, 128, 255)
CHANNEL_SHIFT = 21
BAD_FPS_TEXT = {0: "0/0", 1: "abc", 2: "25"}   # keyed by p_partkey % 100


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def pts_us(ts_name: str) -> Column:
    """Microseconds since EPOCH from a TIMESTAMP_NTZ column, independent of session zone."""
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'{EPOCH}', {ts_name})")


def _instant(us: int) -> Column:
    """The TIMESTAMP_NTZ literal ``us`` microseconds after EPOCH."""
    at = datetime.fromisoformat(EPOCH) + timedelta(microseconds=us)
    return F.lit(at.isoformat(sep=" ", timespec="microseconds")).cast("timestamp_ntz")


def frames(spark: SparkSession, sf_dir: str, only: str | None = None,
           between: tuple[int, int] | None = None) -> DataFrame:
    """fx_frames: frame metadata (key frames are the signup events).

    ``only`` keeps one picture type and ``between`` one half-open range of
    ``pts_us``; both are put as filters on the stored columns, which reach the
    Parquet scan, where filters on the computed ones would not."""
    ev = table(spark, sf_dir, "events")
    if only is not None:
        kind = F.col("event_type")
        stored = {"I": kind == "signup", "B": kind == "error",
                  "P": kind.isNull() | ~kind.isin("signup", "error")}
        ev = ev.where(stored[only])
    if between is not None:
        start, end = (_instant(us) for us in between)
        ev = ev.where((F.col("ts") >= start) & (F.col("ts") < end))
    return ev.select(
        (F.col("user_id") % N_VIDEOS).alias("video_id"),
        F.col("event_id").alias("frame_id"),
        pts_us("ts").alias("pts_us"),
        F.when(F.col("event_type") == "signup", "I")
         .when(F.col("event_type") == "error", "B").otherwise("P").alias("pict_type"),
        F.floor(F.col("value") * 1000).cast("bigint").alias("size_bytes"),
    )


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fx_pixels: one row per pixel of an 8x8 one-channel frame.

    ``v`` is the uint8 value, ``e`` the raw float.
    """
    emb = table(spark, sf_dir, "embeddings")
    p = emb.select(F.col("label").alias("video_id"), F.col("vec_id").alias("frame_no"),
                   F.posexplode("embedding").alias("i", "e"))
    e = F.col("e").cast("double")
    return p.select(
        "video_id", "frame_no",
        (F.col("i") / FRAME_SIDE).cast("int").alias("y"),
        (F.col("i") % FRAME_SIDE).cast("int").alias("x"),
        F.floor(F.least(F.lit(255.0), F.greatest(F.lit(0.0), F.lit(128.0) + F.lit(256.0) * e)))
         .cast("bigint").alias("v"),
        e.alias("e"),
    )


def template(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fx_template: a 3x3 crop of frame 0 at rows/cols 2..4 (the old logo)."""
    px = pixels(spark, sf_dir)
    return (px.where((F.col("frame_no") == TEMPLATE_FRAME)
                     & F.col("y").between(TEMPLATE_Y0, TEMPLATE_Y0 + TEMPLATE_SIDE - 1)
                     & F.col("x").between(TEMPLATE_X0, TEMPLATE_X0 + TEMPLATE_SIDE - 1))
              .select((F.col("y") - TEMPLATE_Y0).alias("ty"), (F.col("x") - TEMPLATE_X0).alias("tx"),
                      F.col("v").alias("t")))


def logo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fx_logo: a 3x3 crop of frame 1 with an alpha ramp 0/128/255 by column."""
    px = pixels(spark, sf_dir)
    a0, a1, a2 = LOGO_ALPHA_BY_COLUMN
    return (px.where((F.col("frame_no") == LOGO_FRAME) & (F.col("y") < LOGO_SIDE) & (F.col("x") < LOGO_SIDE))
              .select(F.col("y").alias("ly"), F.col("x").alias("lx"), F.col("v").alias("l"),
                      F.when(F.col("x") == 0, F.lit(a0)).when(F.col("x") == 1, F.lit(a1))
                       .otherwise(F.lit(a2)).cast("bigint").alias("a")))


def payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fx_payload: each document is a raw chunk; its UTF-8 bytes are the payload."""
    docs = table(spark, sf_dir, "documents")
    return docs.select((F.col("doc_id") % N_VIDEOS).alias("video_id"),
                       (F.col("doc_id") / N_VIDEOS).cast("bigint").alias("chunk_id"),
                       F.encode("text", "UTF-8").alias("payload"))


def packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fx_packets: purchases are audio packets, views/clicks video packets and
    signups subtitles; all others are data, and so are the purchases of video
    3, which has no audio track."""
    ev = table(spark, sf_dir, "events")
    silent = F.col("user_id") % N_VIDEOS == N_VIDEOS - 1
    media = (F.when((F.col("event_type") == "purchase") & ~silent, "audio")
              .when(F.col("event_type").isin("view", "click"), "video")
              .when(F.col("event_type") == "signup", "subtitle").otherwise("data"))
    return ev.select((F.col("user_id") % N_VIDEOS).alias("video_id"), media.alias("media_type"),
                     pts_us("ts").alias("pts_us"),
                     F.col("event_id").alias("packet_id"),
                     F.encode("props", "UTF-8").alias("payload"))


def fps_text_col() -> Column:
    key = F.col("p_partkey") % 100
    good = F.concat((F.col("p_size") * 1000).cast("string"), F.lit("/1001"))
    c = F.when(key == 0, F.lit(BAD_FPS_TEXT[0])).when(key == 1, F.lit(BAD_FPS_TEXT[1])) \
         .when(key == 2, F.lit(BAD_FPS_TEXT[2]))
    return c.otherwise(good)


def probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fx_probe: one probe JSON document per part (audio stream first, then video)."""
    part = table(spark, sf_dir, "part")
    s = lambda c: c.cast("string")
    side = F.col("p_size") + 40
    dur = s(F.col("p_retailprice"))
    js = F.concat(
        F.lit('{"streams":[{"index":0,"codec_type":"audio","sample_rate":"48000"},'
              '{"index":1,"codec_type":"video","width":'), s(side * 16),
        F.lit(',"height":'), s(side * 9),
        F.lit(',"avg_frame_rate":"'), F.col("fps_text"),
        F.lit('","nb_frames":"'), s(F.col("p_size") * 300 + F.col("p_partkey") % 7),
        F.lit('","duration":"'), dur,
        F.lit('"}],"format":{"duration":"'), dur,
        F.lit('","size":"'), s(F.col("p_partkey") * 1000 + 5000000),
        F.lit('","bit_rate":"'), s(F.col("p_size") * 100000),
        F.lit('"}}'))
    return (part.select(F.col("p_partkey").alias("video_id"), "p_partkey", F.col("p_retailprice"),
                        F.col("p_size"), fps_text_col().alias("fps_text"))
                .select("video_id", "fps_text", js.alias("probe_json")))


def resources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fx_resources: resource samples of four runs.  CPU percent is
    ``value / 5`` quantised to quarter points (exact in binary, so sums and
    averages do not depend on summation order)."""
    ev = table(spark, sf_dir, "events")
    return ev.select((F.col("user_id") % N_VIDEOS).alias("run_id"), "ts",
                     (F.floor(F.col("value") * 0.8) / 4.0).alias("cpu_percent"),
                     F.get_json_object("props", "$.k").cast("double").alias("ram_percent"))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fx_runs: one processed item per line item; a run is a supplier.  Byte
    counts are whole numbers (exact sums in any order)."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_suppkey").alias("run_id"),
                     F.col("l_orderkey").alias("item_id"),
                     F.col("l_linenumber").alias("item_no"),
                     F.floor("l_extendedprice").cast("double").alias("in_bytes"),
                     (F.col("l_quantity") * 1000).alias("out_bytes"),
                     (F.col("l_returnflag") != "R").alias("ok"),
                     F.col("l_shipdate").alias("ts"),
                     F.col("l_linestatus").alias("phase_flag"))


def coo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fx_coo: a 50x50 sparse matrix in coordinate form."""
    li = table(spark, sf_dir, "lineitem")
    return (li.groupBy((F.col("l_orderkey") % 50).alias("i"), (F.col("l_partkey") % 50).alias("j"))
              .agg(F.sum("l_quantity").alias("v")))


def pixel_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fx_pixels with one row per frame: its values as the array ``vals``."""
    emb = table(spark, sf_dir, "embeddings")
    vals = F.transform("embedding", lambda e: F.floor(F.least(F.lit(255.0), F.greatest(
        F.lit(0.0), F.lit(128.0) + F.lit(256.0) * e.cast("double")))).cast("int"))
    return emb.select(F.col("label").alias("video_id"), F.col("vec_id").alias("frame_no"), vals.alias("vals"))


def pixel_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fx_pixels as frame rows: one row per frame, raw uint8 bytes in ``data``."""
    from framelake.operators.pixels import frames_from_arrays
    return frames_from_arrays(pixel_arrays(spark, sf_dir), "vals", FRAME_SIDE, FRAME_SIDE, 1)


def bgr_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fx_bgr as frame rows: 8x8 frames of three channels; channel ``c`` shows
    the same values, begun ``CHANNEL_SHIFT * c`` places later."""
    from framelake.operators.pixels import frames_from_arrays
    n = FRAME_SIDE * FRAME_SIDE
    vals = F.transform(F.sequence(F.lit(0), F.lit(3 * n - 1)), lambda k: F.get(
        "vals", (F.floor(k / 3) + CHANNEL_SHIFT * (k % 3)).cast("int") % n))
    f = pixel_arrays(spark, sf_dir).select("video_id", "frame_no", vals.alias("vals"))
    return frames_from_arrays(f, "vals", FRAME_SIDE, FRAME_SIDE, 3)
