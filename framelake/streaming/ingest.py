"""Incremental chunk ingestion into the frame store, resumable.

New chunk files are picked up by a streaming file source; every micro-batch
explodes its chunks into frames and writes them with dynamic partition
overwrite keyed on ``(batch_id, video_id)``.  A replayed batch (after a crash
between write and commit) rewrites its own partitions, so the store never
holds duplicates, and rows of one chunk that arrive in two batches are all
kept.  There are as many directories as batches and videos, not chunks;
``chunk_id`` is a sorted column, so filters on it skip row groups.  The
checkpoint makes a restart continue where it stopped.

With a log, every micro-batch also leaves one checkpoint record: what it
wrote, how many of its frames failed and how far the run has come.  The counts
are observed while the batch is written, so the data is read once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from framelake.operators.frames import explode_frames

RECORD = "batch_id long, n_frames long, n_failed long, frames_done long, failed_done long, is_mark boolean"


class Stopped(RuntimeError):
    """The run was asked to end before its last micro-batch was committed."""


def _record(spark: SparkSession, log: str, batch_id: int, counted: dict, every: int) -> None:
    """The checkpoint record of a micro-batch, in a folder of its own: a
    replayed batch replaces its record.  Only the record before it is read."""
    done = failed = 0
    if batch_id:
        before = spark.read.schema(RECORD).parquet(f"{log}/batch={batch_id - 1}").first()
        done, failed = before.frames_done, before.failed_done
    n, bad = counted["n_frames"], counted["n_failed"]
    row = (batch_id, n, bad, done + n, failed + bad, (batch_id + 1) % every == 0)
    spark.createDataFrame([row + tuple(v for k, v in counted.items() if k not in ("n_frames", "n_failed"))],
                          RECORD + "".join(f", {k} long" for k in counted if k not in ("n_frames", "n_failed"))
                          ).coalesce(1).write.mode("overwrite").parquet(f"{log}/batch={batch_id}")


def read_progress(spark: SparkSession, log: str) -> DataFrame:
    """All checkpoint records of a log."""
    return spark.read.option("mergeSchema", "true").parquet(log).drop("batch")


def ingest_chunks(spark: SparkSession, stream: DataFrame, to_chunks: Callable[[DataFrame], DataFrame],
                  frame_bytes: int, store_path: str, checkpoint: str, log: str | None = None, every: int = 10,
                  observe: dict[str, Column] | None = None, stop_after: int | None = None) -> None:
    """Run the ingestion until the source is drained (``availableNow``).

    ``log`` is the folder of checkpoint records (:data:`RECORD`); a frame
    shorter than ``frame_bytes`` counts as failed, every ``every``-th
    micro-batch is a progress mark, and ``observe`` adds whole-number metrics
    of the frames to the records.  ``stop_after`` ends the run with
    :class:`Stopped` once so many micro-batches are written.  The last one is
    then not committed, as after a crash at that point; the next run with the
    same ``checkpoint`` does it again and goes on.
    """
    written = 0

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        nonlocal written
        frames = explode_frames(to_chunks(batch), frame_bytes).withColumn("batch_id", F.lit(epoch_id))
        counted = Observation(f"batch-{epoch_id}")
        if log is not None:
            failed = F.count_if(F.length("data") < frame_bytes)
            more = [c.cast("bigint").alias(k) for k, c in (observe or {}).items()]
            frames = frames.observe(counted, F.count(F.lit(1)).alias("n_frames"), failed.alias("n_failed"), *more)
        (frames.sortWithinPartitions("video_id", "chunk_id", "local_no")
               .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
               .partitionBy("batch_id", "video_id").parquet(store_path))
        if log is not None:
            _record(batch.sparkSession, log, epoch_id, counted.get, every)
        written += 1
        if written == stop_after:
            raise Stopped(f"after {written} micro-batches")

    q = (stream.writeStream.foreachBatch(write_batch)
               .option("checkpointLocation", checkpoint)
               .trigger(availableNow=True).start())
    try:
        q.awaitTermination()
    except StreamingQueryException:
        if written != stop_after:
            raise
        raise Stopped(f"after {written} micro-batches") from None


def ingest_chunk_files(spark: SparkSession, root: str, frame_bytes: int, store_path: str, checkpoint: str,
                       glob: str = "*.raw", files_per_batch: int = 1000, frames_per_read: int = 16) -> None:
    """Ingestion of chunk *files* of any length, until the source is drained.

    The stream carries listings only (path and length; the content is pruned,
    so no row holds a file); every micro-batch plans byte ranges from them and
    reads those spread over its tasks, as the batch job does.  Video and chunk
    come from folder and file name; frames are numbered within their chunk."""
    from framelake.plans.extract_job import chunk_keys, read_ranges
    from framelake.session import ship_package
    ship_package(spark)
    listing = (spark.readStream.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
                    .option("maxFilesPerTrigger", files_per_batch)
                    .schema("path string, modificationTime timestamp, length long, content binary").load(root)
                    .select("path", "length"))

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        files = batch.select("path", "length", *chunk_keys(), F.lit(0).cast("bigint").alias("frame_offset"))
        frames = read_ranges(files, frame_bytes, frames_per_read).drop("frame_no").withColumn("batch_id", F.lit(epoch_id))
        (frames.sortWithinPartitions("video_id", "chunk_id", "local_no")
               .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
               .partitionBy("batch_id", "video_id").parquet(store_path))

    q = (listing.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
                .trigger(availableNow=True).start())
    q.awaitTermination()
