"""Event logs of several writers, sweep rows with lengths, chunk reports."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from framelake.functions.scalars import two_decimals
from framelake.operators.metrics import latest_per
from framelake.plans import chunking as CH
from framelake.sources.sinks import append_commit, read_csv, read_log, sweep_rows_by_video, write_sweep_csv


def test_writers_at_the_same_time_lose_nothing(spark, tmp_dir):
    log = f"{tmp_dir}/log"
    parts = [spark.createDataFrame([(k % 3, 10 * k + i, f"w{k}") for i in range(5)], "run_id int, ts int, who string") for k in range(6)]
    with ThreadPoolExecutor(6) as pool:
        names = list(pool.map(lambda p: append_commit(p, log), parts))
    assert len(set(names)) == 6 and read_log(spark, log).count() == 30
    append_commit(parts[2], log, names[2])                                  # a retried commit replaces itself
    append_commit(spark.createDataFrame([(0, 1, "late")], "run_id int, ts int, who string"), log)
    assert read_log(spark, log).count() == 31
    last = {r.run_id: (r.ts, r.who) for r in latest_per(read_log(spark, log), ["run_id"], ["ts"], ["ts", "who"]).collect()}
    assert last == {0: (34, "w3"), 1: (44, "w4"), 2: (54, "w5")}


def test_a_commit_that_fails_is_not_read(spark, tmp_dir):
    log = f"{tmp_dir}/log"
    good = spark.createDataFrame([(1, 1)], "run_id int, ts int")
    append_commit(good, log)
    with pytest.raises(Exception, match="no luck"):
        append_commit(good.withColumn("ts", F.raise_error(F.lit("no luck")).cast("int")), log)
    assert read_log(spark, log).count() == 1


def test_sweep_rows_hold_the_length_of_their_video(spark, tmp_dir):
    frames = spark.createDataFrame([(1, 0, 10), (1, 2_999_999, 20), (2, 9_999_999, 30), (None, 999_999, 40)], "video_id int, pts_us long, size_bytes long")
    rows = sweep_rows_by_video(frames, 2, 3)
    write_sweep_csv(rows, f"{tmp_dir}/csv")
    got = {(r.video_id, r.num_chunks, r.chunk_no): (r.chunk_len_s, r.proc_s) for r in read_csv(spark, f"{tmp_dir}/csv").collect()}
    assert got[("1", "2", "0")][0] == "1.50" and got[("1", "3", "2")][0] == "1.00"
    assert got[("2", "2", "1")][0] == "5.00" and got[("2", "3", "2")][0] == "3.33" and got[(None, "3", "2")][0] == "0.33"
    assert rows.agg(F.sum("chunk_bytes")).first()[0] == 200


def test_two_decimals_by_a_column(spark):
    df = spark.createDataFrame([(5, 1000), (15, 1000), (25, 1000), (1234567, 300)], "n long, per long")
    assert [r[0] for r in df.select(two_decimals(F.col("n"), F.col("per"))).collect()] == ["0.00", "0.02", "0.02", "4115.22"]


def test_segment_report_tells_what_was_created(spark):
    rows = [(v, i, 10 * i, "I" if (i in (0, 5) or v == 2) else "P") for v in (1, 2) for i in range(10)]
    frames = spark.createDataFrame(rows, "video_id int, frame_id long, pts_us long, pict_type string")
    got = {r.video_id: r for r in CH.segment_report(CH.keyframe_segments(frames, 5, block_us=20), 5).collect()}
    assert (got[1].created, got[1].matches, got[2].created, got[2].matches) == (2, False, 5, True)
    assert (got[1].requested, got[1].n_frames, got[1].least_frames, got[1].most_frames) == (5, 10, 5, 5)
