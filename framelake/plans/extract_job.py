"""Chunk files -> numbered frames -> frame store, as one Spark job.

1. list the chunk files (``binaryFile``; ``length`` comes from the listing,
   so counting frames reads no content),
2. per chunk: its frame count and the exclusive running offset (a window over
   the one-row-per-chunk table),
3. plan byte ranges of a few frames each from the file lengths and spread them
   over the tasks (metadata only),
4. each task opens its ranges and emits one row per frame, numbered
   ``offset + local_no``,
5. write the partitioned frame store (a re-run replaces its own chunks).

A file of any length is read in parallel and no row holds more than one frame.

The video id is the chunk file's parent folder and the chunk id the number
in its name (``chunk_%03d``); ordering is by that integer, never by text.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.functions.scalars import basename, strip_extension
from framelake.operators import frames as FR
from framelake.sources.frame_store import write_frame_store


def _raw(spark: SparkSession, root: str, glob: str) -> DataFrame:
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob)
                 .option("recursiveFileLookup", "true").load(root))


def chunk_keys() -> list:
    stem = strip_extension(basename(F.col("path")))
    return [F.regexp_extract(F.col("path"), r"/([^/]+)/[^/]+$", 1).alias("video_id"),
            F.coalesce(F.regexp_extract(stem, r"(\d+)$", 1).try_cast("bigint"),
                       F.lit(0).cast("bigint")).alias("chunk_id")]


def chunk_files(spark: SparkSession, root: str, glob: str = "*.mp4") -> DataFrame:
    """Chunk files under ``root/<video>/``: path, length, video, chunk number
    (``content`` is pruned: the listing reads no file bytes)."""
    return _raw(spark, root, glob).select("path", "length", *chunk_keys())


def _ranges(batches, frame_bytes: int):
    """Reads ``n_bytes`` from ``start`` of ``path``, one frame at a time.  Paths
    are opened through Arrow's filesystems (local, HDFS, S3 and others)."""
    from pyarrow.fs import FileSystem
    for b in batches:
        for r in b.itertuples(index=False):
            fs, inner = FileSystem.from_uri(re.sub(r"^file:/(?=[^/])", "file:///", r.path))
            with fs.open_input_file(inner) as f:
                for at in range(0, r.n_bytes, frame_bytes):
                    data = f.read_at(min(frame_bytes, r.n_bytes - at), r.start + at)
                    yield pd.DataFrame({
                        "video_id": [r.video_id], "chunk_id": [r.chunk_id],
                        "local_no": [(r.start + at) // frame_bytes + 1],
                        "frame_no": [r.frame_offset + (r.start + at) // frame_bytes + 1], "data": [data]})


def read_ranges(files: DataFrame, frame_bytes: int, frames_per_read: int = 16) -> DataFrame:
    """Frames of the files of a listing (path, length, video_id, chunk_id,
    frame_offset), read by byte ranges of a few frames; no file content passes
    the listing, so a file of any length will do."""
    step = frame_bytes * frames_per_read
    ranges = (files.where(F.col("length") > 0)
                   .withColumn("start", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1,
                                                             F.lit(step).cast("bigint"))))
                   .select("path", "video_id", "chunk_id", "frame_offset", "start",
                           F.least(F.lit(step), F.col("length") - F.col("start")).alias("n_bytes")))
    # a task's ranges are neighbours in one chunk, so the store gets few files per chunk
    return (ranges.repartitionByRange("video_id", "chunk_id", "start")
                  .mapInPandas(lambda bs: _ranges(bs, frame_bytes),
                               "video_id string, chunk_id bigint, local_no bigint, frame_no bigint, data binary"))


def extract_frames(spark: SparkSession, root: str, frame_bytes: int, glob: str = "*.mp4",
                   geometry: tuple[int, int, int] | None = None, frames_per_read: int = 16) -> DataFrame:
    """Numbered frames of every chunk file (steps 1-4); each byte is read once.
    ``geometry = (height, width, channels)`` adds the frame-row columns the
    pixel operators read.

    A partial frame at a file's end is a shorter row of its own; with a
    ``geometry`` it fails the job, as it is no picture."""
    from framelake.session import ship_package

    if geometry is not None and geometry[0] * geometry[1] * geometry[2] != frame_bytes:
        raise ValueError("geometry does not match frame_bytes")
    ship_package(spark)
    files = chunk_files(spark, root, glob)
    if geometry is not None:
        whole = F.col("length") % frame_bytes == 0
        files = files.withColumn("length", F.when(whole, F.col("length")).otherwise(F.raise_error(
            F.concat(F.lit("partial frame at the end of "), F.col("path"))).cast("bigint")))
    counts = files.withColumn("frame_count", FR.frame_count(F.col("length"), frame_bytes))
    frames = read_ranges(FR.chunk_offsets(counts), frame_bytes, frames_per_read)
    if geometry is not None:
        h, w, c = geometry
        frames = frames.select("*", F.lit(h).alias("height"), F.lit(w).alias("width"), F.lit(c).alias("nChannels"))
    return frames


def extract_to_store(spark: SparkSession, root: str, frame_bytes: int, store_path: str,
                     glob: str = "*.mp4", geometry: tuple[int, int, int] | None = None) -> None:
    """The whole job (steps 1-5)."""
    write_frame_store(extract_frames(spark, root, frame_bytes, glob, geometry), store_path)
