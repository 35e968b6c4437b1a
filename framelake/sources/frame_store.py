"""The frame store — Parquet partitioned by (video_id, chunk_slot).

A video has at most ``SLOTS`` folders, whatever its number of chunks: up to
``SLOTS`` consecutive chunks have one each, further chunks share them.  Files
are sorted by chunk and frame number, so filters on them skip row groups.

Exactly-once per chunk: a re-run (task retry, restarted job) replaces only
the chunks it rewrites.  It writes the slots of these anew (dynamic partition
overwrite), with the other chunks that they hold, and the commit protocol
publishes files only from successful tasks — no executor-side side-effect
writes.  Two jobs must not rewrite chunks of one slot at the same time.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framelake.operators.joins import join_small

# Small row groups: a raw 1080p BGR frame is 6,220,800 bytes.  The vectorized
# reader fills a batch from one row group, so 64 MB row groups keep a read
# batch near 10 frames instead of columnarReaderBatchSize (4096) frames.
FRAME_STORE_OPTIONS = {"compression": "zstd", "parquet.block.size": str(64 * 1024 * 1024)}

SLOTS = 32


def chunk_slot(frames: DataFrame) -> Column:
    """The folder of a chunk below its video."""
    whole = isinstance(frames.schema["chunk_id"].dataType, T.IntegralType)
    return F.pmod(F.col("chunk_id") if whole else F.xxhash64("chunk_id"), F.lit(SLOTS)).cast("int")


def write_frame_store(frames: DataFrame, path: str, mode: str = "overwrite", regroup: bool = False) -> None:
    """Write frames sorted by integer number within each chunk.

    Frames produced by :func:`~framelake.operators.frames.explode_frames`
    already sit in the task of their chunk, so by default the pixel bytes are
    only sorted locally, never shuffled.  ``regroup=True`` hash-groups frames
    by slot first (one file per slot) for inputs that are not chunk-aligned."""
    src = frames.withColumn("chunk_slot", chunk_slot(frames))
    if mode == "overwrite" and (stored := _stored(src, path)) is not None:
        src = src.unionByName(_kept(stored, src), allowMissingColumns=True)
    if regroup:
        src = src.repartition("video_id", "chunk_slot")
    # dynamic overwrite as a per-write option: no session state is touched
    (src.sortWithinPartitions("video_id", "chunk_slot", "chunk_id", "frame_no")
        .write.mode(mode).option("partitionOverwriteMode", "dynamic").options(**FRAME_STORE_OPTIONS)
        .partitionBy("video_id", "chunk_slot").parquet(path))


def _stored(src: DataFrame, path: str) -> DataFrame | None:
    """The store at ``path``, if there is one, with video ids of the type that
    ``src`` has (a plain read takes folders 01 and 1 for the same number)."""
    try:
        schema = src.sparkSession.read.parquet(path).schema
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    if "chunk_slot" not in schema.names:
        raise ValueError(f"{path} has a folder per chunk: write the store to a new path")
    typed = [src.schema[f.name] if f.name in ("video_id", "chunk_slot") else f for f in schema]
    return src.sparkSession.read.schema(T.StructType(typed)).parquet(path)


def _kept(stored: DataFrame, src: DataFrame) -> DataFrame:
    """Stored frames of the slots that ``src`` rewrites, but of other chunks."""
    # a folder cannot tell an empty id from NULL
    video = F.nullif(F.col("video_id").cast("string"), F.lit("")).alias("_video")
    chunks = src.select(video, "chunk_slot", "chunk_id").distinct()
    touched = join_small(stored.withColumn("_video", video), chunks.select("_video", "chunk_slot").distinct(),
                         ["_video", "chunk_slot"], "left_semi", null_keys=True)
    return join_small(touched, chunks, ["_video", "chunk_slot", "chunk_id"], "left_anti", null_keys=True).drop("_video")


def read_frame_store(spark: SparkSession, path: str) -> DataFrame:
    """Read the store back; filters on video_id/chunk_slot prune partitions and
    filters on chunk_id / frame_no / pts_us are pushed into the Parquet scan."""
    return spark.read.parquet(path)
