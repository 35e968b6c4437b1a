"""Size-checked broadcast joins and the pixel-stage parallelism guard."""

from pyspark.sql import functions as F

from framelake.operators.joins import join_small
from framelake.operators.pixels import ensure_parallelism


def test_join_small_broadcasts_below_bound_and_falls_back_above(spark):
    big = spark.range(2000).select((F.col("id") % 50).alias("k"), F.col("id").alias("v"))
    small = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    a = join_small(big, small, "k")
    b = join_small(big, small, "k", max_rows=10)                 # over the bound: shuffle join
    assert "BroadcastHashJoin" in a._jdf.queryExecution().executedPlan().toString()
    want = sorted((r.k, r.v, r.k * 10) for r in big.collect())
    for df in (a, b):
        assert sorted((r.k, r.v, r.w) for r in df.collect()) == want


def test_ensure_parallelism_only_spreads_small_scan_inputs(spark, tmp_dir):
    path = tmp_dir + "/one"
    spark.range(40).select(F.col("id").alias("video_id"), F.col("id").alias("frame_no")) \
         .coalesce(1).write.parquet(path)
    one = spark.read.parquet(path)
    spread = ensure_parallelism(one)
    assert spread.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    shuffled = one.groupBy("video_id").agg(F.max("frame_no").alias("frame_no"))
    assert ensure_parallelism(shuffled) is shuffled                 # after a shuffle AQE sizes it
    many = spark.range(0, 40, 1, 16).select(F.col("id").alias("video_id"), F.col("id").alias("frame_no"))
    assert ensure_parallelism(many) is many                         # enough splits: untouched


def test_first_frames_read_first_chunks_only(spark, tmp_dir):
    from framelake.operators.pixels import first_frame_detection
    from framelake.sources.frame_store import read_frame_store, write_frame_store
    rows = [(v, c, 10 * c + n, bytes([v, c, n])) for v in (1, 2) for c in range(v - 1, 4) for n in (1, 2, 3)]
    write_frame_store(spark.createDataFrame(rows, "video_id int, chunk_id int, frame_no long, data binary"),
                      f"{tmp_dir}/store")
    got = first_frame_detection(read_frame_store(spark, f"{tmp_dir}/store"), lambda f: f)
    assert sorted((r.video_id, r.frame_no, bytes(r.data)) for r in got.collect()) == [
        (1, 1, bytes([1, 0, 1])), (2, 11, bytes([2, 1, 1]))]
    plan = got._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    filters = scan.split("PartitionFilters")[1]
    assert "dynamicpruning" in filters and "chunk_id" in filters
