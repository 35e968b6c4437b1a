"""A2: video metadata from probe JSON text (``streams[]`` + ``format{}``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framelake.functions.scalars import bytes_to_mb, parse_fps

STREAM = T.StructType([
    T.StructField("index", T.IntegerType()),
    T.StructField("codec_type", T.StringType()),
    T.StructField("width", T.IntegerType()),
    T.StructField("height", T.IntegerType()),
    T.StructField("avg_frame_rate", T.StringType()),
    T.StructField("r_frame_rate", T.StringType()),
    T.StructField("nb_frames", T.StringType()),
    T.StructField("nb_read_frames", T.StringType()),
    T.StructField("duration", T.StringType()),
])
PROBE = T.StructType([
    T.StructField("streams", T.ArrayType(STREAM)),
    T.StructField("format", T.StructType([
        T.StructField("duration", T.StringType()),
        T.StructField("size", T.StringType()),
        T.StructField("bit_rate", T.StringType()),
    ])),
])


def parse_probe(df: DataFrame, json_col: str = "probe_json", fps_mode: str = "lenient") -> DataFrame:
    """Video metadata: the first stream that has a ``width`` (the video
    stream), joined with the container's duration, size and bit rate.

    Numbers arrive as strings; ``nb_frames`` defaults to 0 when absent."""
    p = F.from_json(F.col(json_col), PROBE)
    keep = [c for c in df.columns if c != json_col]
    v = df.select(*keep, p.alias("_p")).select(
        *keep, F.get(F.filter("_p.streams", lambda s: s["width"].isNotNull()), 0).alias("_s"),
        F.col("_p.format").alias("_f"))
    return v.select(
        *keep,
        F.col("_s.width").alias("width"), F.col("_s.height").alias("height"),
        F.col("_s.avg_frame_rate").alias("avg_frame_rate"),
        parse_fps(F.col("_s.avg_frame_rate"), fps_mode).alias("fps"),
        F.coalesce(F.col("_s.nb_frames").try_cast("bigint"), F.lit(0).cast("bigint")).alias("frame_count"),
        F.col("_f.duration").try_cast("double").alias("duration_s"),
        F.col("_f.size").try_cast("bigint").alias("file_size"),
        bytes_to_mb(F.col("_f.size").try_cast("double")).alias("file_size_mb"),
        F.col("_f.bit_rate").try_cast("bigint").alias("bit_rate"),
    )
