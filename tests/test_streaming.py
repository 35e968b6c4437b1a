"""Streaming forms equal their batch twins; ingestion resumes without duplicates."""


import pytest
from pyspark.sql import functions as F

from framelake.sources import testdata as TD
from framelake.streaming.ingest import Stopped, ingest_chunk_files, ingest_chunks, read_progress
from framelake.streaming.resources import resource_windows, stream_resource_windows
from tests.conftest import SF_SMALL


def test_stream_windows_equal_batch(spark, tmp_dir):
    batch = resource_windows(TD.resources(spark, SF_SMALL), "1 hour")
    schema = TD.table(spark, SF_SMALL, "events").schema
    src = (spark.readStream.schema(schema).option("pathGlobFilter", "events*.parquet").parquet(SF_SMALL))
    samples = src.select((F.col("user_id") % 4).alias("run_id"), "ts",
                         (F.floor(F.col("value") * 0.8) / 4.0).alias("cpu_percent"),
                         F.get_json_object("props", "$.k").cast("double").alias("ram_percent"))
    q = (stream_resource_windows(samples, "1 hour", "0 seconds").writeStream.outputMode("complete")
         .format("memory").queryName("res_windows").trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.table("res_windows")
    cols = ["run_id", "window_start", "n_samples", "peak_cpu"]
    assert sorted(got.select(*cols).collect()) == sorted(batch.select(*cols).collect())


def test_ingest_resumes_without_duplicates(spark, tmp_dir):
    src = f"{tmp_dir}/in"
    docs = TD.table(spark, SF_SMALL, "documents")
    docs.where(F.col("doc_id") < 100).write.parquet(f"{src}/part1")
    schema = docs.schema
    to_chunks = lambda b: b.select((F.col("doc_id") % 4).alias("video_id"),
                                   (F.col("doc_id") / 4).cast("bigint").alias("chunk_id"),
                                   F.encode("text", "UTF-8").alias("payload"))

    def run():
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(src)
        ingest_chunks(spark, stream, to_chunks, 64, f"{tmp_dir}/store", f"{tmp_dir}/ckpt")

    run()
    first = spark.read.parquet(f"{tmp_dir}/store").count()
    run()                                                     # restart: nothing new
    assert spark.read.parquet(f"{tmp_dir}/store").count() == first
    docs.where(F.col("doc_id") >= 100).write.parquet(f"{src}/part2")
    run()                                                     # new chunks only
    total = spark.read.parquet(f"{tmp_dir}/store")
    expect = docs.select((F.ceil(F.length(F.encode("text", "UTF-8")) / 64)).cast("bigint").alias("n")) \
                 .agg(F.sum("n")).first()[0]
    assert total.count() == expect
    assert total.groupBy("video_id", "chunk_id", "local_no").count().where("count > 1").count() == 0


def test_ingest_raw_chunk_files_with_binaryfile_stream(spark, tmp_dir):
    import os
    from pyspark.sql import types as T
    from framelake.functions.scalars import basename, strip_extension
    src = f"{tmp_dir}/raw"
    os.makedirs(f"{src}/cam1")
    with open(f"{src}/cam1/chunk_000.raw", "wb") as f:
        f.write(bytes(range(48)))
    schema = T.StructType([T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()),
                           T.StructField("length", T.LongType()), T.StructField("content", T.BinaryType())])
    to_chunks = lambda b: b.select(
        F.regexp_extract("path", r"/([^/]+)/[^/]+$", 1).alias("video_id"),
        F.regexp_extract(strip_extension(basename(F.col("path"))), r"(\d+)$", 1).cast("bigint").alias("chunk_id"),
        F.col("content").alias("payload"))

    def run():
        stream = (spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", "*.raw")
                  .option("recursiveFileLookup", "true").load(src))
        ingest_chunks(spark, stream, to_chunks, 16, f"{tmp_dir}/store", f"{tmp_dir}/ckpt")

    run()
    assert spark.read.parquet(f"{tmp_dir}/store").count() == 3
    with open(f"{src}/cam1/chunk_001.raw", "wb") as f:
        f.write(bytes(range(100, 132)))
    run()                                                         # picks up only the new file
    got = sorted((r.chunk_id, r.local_no, bytes(r.data)) for r in spark.read.parquet(f"{tmp_dir}/store").collect())
    assert [(c, n) for c, n, _ in got] == [(0, 1), (0, 2), (0, 3), (1, 1), (1, 2)]
    assert got[3][2] == bytes(range(100, 116))


def test_a_chunk_in_two_batches_keeps_all_its_rows(spark, tmp_dir):
    src = f"{tmp_dir}/in"
    schema = "video_id long, chunk_id long, payload binary"

    def run():
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(src)
        ingest_chunks(spark, stream, lambda b: b, 2, f"{tmp_dir}/store", f"{tmp_dir}/ckpt")

    for i, payload in enumerate((b"abcd", b"efg")):
        spark.createDataFrame([(0, 5, payload)], schema).write.parquet(f"{src}/part{i}")
        run()
    rows = spark.read.parquet(f"{tmp_dir}/store").orderBy("batch_id", "local_no").collect()
    assert b"".join(bytes(r.data) for r in rows) == b"abcdefg"


def arriving(spark, path, parts=5):
    """Files of a stream: file k holds one chunk of 3 * (k + 1) + 1 bytes."""
    for k in range(parts):
        row = [(k % 2, k, bytes([65 + k]) * (3 * (k + 1) + 1))]
        spark.createDataFrame(row, "video_id long, chunk_id long, payload binary").coalesce(1).write.parquet(f"{path}/part{k}")
    return (spark.readStream.schema("video_id long, chunk_id long, payload binary")
            .option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(path))


@pytest.mark.parametrize("stop_after", [1, 3, 5])
def test_a_stopped_run_goes_on_from_its_checkpoint(spark, tmp_dir, stop_after):
    stream = arriving(spark, f"{tmp_dir}/in")
    args = (spark, stream, lambda b: b, 3, f"{tmp_dir}/store", f"{tmp_dir}/ckpt", f"{tmp_dir}/log")
    with pytest.raises(Stopped):
        ingest_chunks(*args, every=2, stop_after=stop_after)
    assert read_progress(spark, f"{tmp_dir}/log").count() == stop_after
    ingest_chunks(*args, every=2)
    store = spark.read.parquet(f"{tmp_dir}/store")
    per_chunk = {r.chunk_id: (r.n, r.b) for r in store.groupBy("chunk_id").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("batch_id").alias("b")).collect()}
    assert per_chunk == {k: (k + 2, 1) for k in range(5)}
    log = read_progress(spark, f"{tmp_dir}/log").orderBy("batch_id").collect()
    assert [r.batch_id for r in log] == list(range(5))
    assert [r.n_frames for r in log] == [2, 3, 4, 5, 6] and [r.frames_done for r in log] == [2, 5, 9, 14, 20]
    assert [r.failed_done for r in log] == [1, 2, 3, 4, 5] and [r.is_mark for r in log] == [False, True, False, True, False]


def test_a_real_failure_is_not_taken_for_a_stop(spark, tmp_dir):
    stream = arriving(spark, f"{tmp_dir}/in", 2)
    with pytest.raises(Exception, match="no_such_column"):
        ingest_chunks(spark, stream, lambda b: b.select("no_such_column"), 3, f"{tmp_dir}/store", f"{tmp_dir}/ckpt", stop_after=1)


def test_records_hold_observed_metrics(spark, tmp_dir):
    stream = arriving(spark, f"{tmp_dir}/in", 3)
    ingest_chunks(spark, stream, lambda b: b, 3, f"{tmp_dir}/store", f"{tmp_dir}/ckpt", f"{tmp_dir}/log",
                  observe={"last_chunk": F.max("chunk_id"), "n_bytes": F.sum(F.length("data"))})
    log = read_progress(spark, f"{tmp_dir}/log").orderBy("batch_id").collect()
    assert [(r.last_chunk, r.n_bytes) for r in log] == [(0, 4), (1, 7), (2, 10)]


def test_chunk_files_beyond_the_row_limit_are_streamed(spark, tmp_dir):
    """The stream holds listings: a file above the limit of ``binaryFile`` (here
    16 bytes) is read by ranges; a later file comes with a later run."""
    import os
    src, limit = f"{tmp_dir}/raw/cam1", "spark.sql.sources.binaryFile.maxLength"
    os.makedirs(src)
    content = {0: bytes(range(50)), 1: b"", 2: bytes(range(100, 109))}

    def put(c):
        with open(f"{src}/chunk_{c:03d}.raw", "wb") as f:
            f.write(content[c])

    def run():
        ingest_chunk_files(spark, f"{tmp_dir}/raw", 4, f"{tmp_dir}/store", f"{tmp_dir}/ckpt", files_per_batch=1, frames_per_read=3)
        rows = spark.read.parquet(f"{tmp_dir}/store").orderBy("chunk_id", "local_no").collect()
        return {c: [bytes(r.data) for r in rows if r.chunk_id == c] for c in {r.chunk_id for r in rows}}, rows

    before = spark.conf.get(limit)
    spark.conf.set(limit, "16")
    try:
        put(0)
        put(1)
        with pytest.raises(Exception, match="exceeds the max length"):
            spark.read.format("binaryFile").load(f"{src}/chunk_000.raw").collect()
        got, rows = run()
        assert got == {0: [content[0][k:k + 4] for k in range(0, 50, 4)]}
        assert [r.local_no for r in rows] == list(range(1, 14)) and rows[0].video_id == "cam1"
        put(2)
        got, _ = run()
        assert got[2] == [content[2][:4], content[2][4:8], content[2][8:]] and len(got[0]) == 13
    finally:
        spark.conf.set(limit, before)
