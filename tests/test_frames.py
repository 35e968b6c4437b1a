"""Frame store, numbering, gaps and reassembly."""

import pytest
from pyspark.sql import functions as F

from framelake.operators import frames as FR
from framelake.sources.frame_store import read_frame_store, write_frame_store


def _chunks(spark):
    rows = [(0, c, bytes((c * 7 + i) % 256 for i in range(16 * n + 5))) for c, n in ((0, 3), (1, 0), (2, 4))]
    rows.append((1, 0, bytes(range(32))))
    return spark.createDataFrame(rows, "video_id long, chunk_id long, payload binary")


def _numbered(spark):
    ch = _chunks(spark)
    counts = FR.chunk_frame_counts_from_payload(ch, 16)
    return FR.number_frames(FR.explode_frames(ch, 16), FR.chunk_offsets(counts))


def test_numbers_dense_from_one(spark):
    n = _numbered(spark)
    per = {v: sorted(r.frame_no for r in n.where(F.col("video_id") == v).collect()) for v in (0, 1)}
    assert per[0] == list(range(1, 11)) and per[1] == [1, 2]     # tails are frames too


def _payloads(parts):
    got = {}
    for r in sorted(parts.collect(), key=lambda r: r.part_no):
        key = (r.video_id, r.chunk_id)
        got[key] = got.get(key, b"") + bytes(r.payload)
    return got


@pytest.mark.parametrize("per_part", [1, 2, 16])
def test_explode_then_reassemble_is_identity(spark, per_part):
    parts = FR.reassemble(_numbered(spark), "strict", frames_per_part=per_part)
    assert _payloads(parts) == {(r.video_id, r.chunk_id): bytes(r.payload) for r in _chunks(spark).collect()}
    assert all(r.n_frames <= per_part for r in parts.collect())
    if per_part == 1:
        assert parts.where("video_id = 0 and chunk_id = 2").count() == 5      # one chunk, several parts


def test_empty_and_null_payloads_give_no_frames(spark):
    ch = spark.createDataFrame([(0, 0, b""), (0, 1, None), (None, 2, b"abc")],
                               "video_id long, chunk_id long, payload binary")
    assert [(r.video_id, r.chunk_id, r.local_no, bytes(r.data)) for r in FR.explode_frames(ch, 2).collect()] == [
        (None, 2, 1, b"ab"), (None, 2, 2, b"c")]
    counts = {r.chunk_id: r.frame_count for r in FR.chunk_frame_counts_from_payload(ch, 2).collect()}
    assert counts == {0: 0, 1: 0, 2: 2}


@pytest.mark.parametrize("per_part", [2, 16])
def test_reassembly_policies_on_gap(spark, per_part):
    rows = [(0, 0, 1, b"a"), (0, 0, 2, b"b"), (0, 0, 5, b"e")]
    df = spark.createDataFrame(rows, "video_id long, chunk_id long, frame_no long, data binary")
    with pytest.raises(Exception):
        FR.reassemble(df, "strict", frames_per_part=per_part).collect()
    with pytest.raises(Exception):                                   # a repeat is no dense numbering either
        FR.reassemble(df.where("frame_no < 3").unionAll(df.where("frame_no = 2")), "strict").collect()
    assert _payloads(FR.reassemble(df, "skip", frames_per_part=per_part)) == {(0, 0): b"abe"}
    assert _payloads(FR.reassemble(df, "fill_previous", frames_per_part=per_part)) == {(0, 0): b"abbbe"}
    gaps = FR.frame_gaps(df, ["video_id"], "frame_no", F.lit(0)).collect()
    assert [(g.frame_no, g.next_no, g.missing) for g in gaps] == [(2, 5, 2)]
    assert [tuple(r) for r in FR.manifest(df.unionAll(df), block_frames=2).orderBy("run_no").collect()] == [
        (0, 0, 1, 1, 2, 2), (0, 0, 2, 5, 5, 1)]


def test_first_frame_breaks_ties(spark):
    rows = [(0, 7, 100), (0, 3, 100), (0, 1, 200), (1, 9, None)]
    df = spark.createDataFrame(rows, "video_id long, frame_id long, pts_us long")
    got = {r.video_id: r.frame_id for r in FR.first_frame(df, order=("pts_us", "frame_id")).collect()}
    assert got == {0: 3, 1: 9}


def test_integer_order_beyond_text_order(spark):
    rows = [(0, 0, n, bytes([n % 256])) for n in (999999, 1000000, 1000001, 999998)]
    df = spark.createDataFrame(rows, "video_id long, chunk_id long, frame_no long, data binary")
    got = _payloads(FR.reassemble(df, "strict"))
    assert got == {(0, 0): bytes([999998 % 256, 999999 % 256, 1000000 % 256, 1000001 % 256])}


def test_frame_store_roundtrip_and_idempotent_rerun(spark, tmp_dir):
    n = _numbered(spark).drop("local_no")
    path = tmp_dir + "/store"
    write_frame_store(n, path)
    write_frame_store(n.where(F.col("chunk_id") == 2), path)     # re-run one chunk
    back = read_frame_store(spark, path)
    assert back.count() == n.count()
    a = sorted((r.video_id, r.chunk_id, r.frame_no, bytes(r.data)) for r in back.collect())
    b = sorted((r.video_id, r.chunk_id, r.frame_no, bytes(r.data)) for r in n.collect())
    assert a == b
    plan = back.where(F.col("frame_no") > 3)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "frame_no" in plan


def test_require_frames_raises(spark):
    df = spark.createDataFrame([(0, 0, 3), (0, 1, 0)], "video_id long, chunk_id long, n long")
    assert FR.require_frames(df.where("chunk_id = 0"), "n").count() == 1
    with pytest.raises(Exception, match="0/1"):
        FR.require_frames(df, "n").collect()


def test_one_task_per_chunk(spark):
    from framelake.plans.chunking import one_task_per_chunk
    ch = spark.createDataFrame([(0, c, b"x") for c in range(10)], "video_id long, chunk_id long, payload binary")
    parts = one_task_per_chunk(ch, 10).rdd.glom().map(len).collect()
    assert sorted(parts) == [1] * 10


def test_detect_frames_quarantines_undecodable_frames(spark):
    import numpy as np
    from framelake.operators.pixels import detect_frames
    from framelake.operators.quality import split_valid
    rng = np.random.default_rng(3)
    img = rng.integers(0, 256, (12, 12), dtype=np.uint8)
    rows = [(0, 1, img.tobytes(), 12, 12, 1), (0, 2, b"short", 12, 12, 1)]
    df = spark.createDataFrame(rows, "video_id long, frame_no long, data binary, height int, width int, nChannels int")
    out = detect_frames(df, img[3:8, 4:9].copy(), on_error="quarantine")
    good, bad = split_valid(out, F.col("error"))
    g = good.first()
    assert g.detected and (g.x, g.y) == (4, 3)
    assert [r.frame_no for r in bad.collect()] == [2]
    with pytest.raises(Exception):
        detect_frames(df, img[3:8, 4:9].copy()).collect()


def test_extract_job_from_chunk_files(spark, tmp_dir):
    import os
    from framelake.plans.extract_job import chunk_files, extract_frames, extract_to_store
    src = {("vidA", 0): bytes(range(40)), ("vidA", 2): bytes(range(100, 133)), ("vidA", 10): bytes(8),
           ("vidB", 1): bytes(range(50, 74))}
    for (v, c), payload in src.items():
        os.makedirs(f"{tmp_dir}/chunks/{v}", exist_ok=True)
        with open(f"{tmp_dir}/chunks/{v}/chunk_{c:03d}.mp4", "wb") as f:
            f.write(payload)
    plan = chunk_files(spark, f"{tmp_dir}/chunks")._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1].split("\n")[0]      # listing reads no bytes
    fr = extract_frames(spark, f"{tmp_dir}/chunks", 8, frames_per_read=2).collect()
    got = sorted((r.video_id, r.chunk_id, r.frame_no, bytes(r.data)) for r in fr)
    want, no = [], {"vidA": 0, "vidB": 0}
    for (v, c) in sorted(src, key=lambda k: (k[0], k[1])):      # integer chunk order: 0, 2, 10
        p = src[(v, c)]
        for i in range(-(-len(p) // 8)):
            no[v] += 1
            want.append((v, c, no[v], p[i * 8:(i + 1) * 8]))
    assert got == sorted(want)
    extract_to_store(spark, f"{tmp_dir}/chunks", 8, f"{tmp_dir}/store")
    assert spark.read.parquet(f"{tmp_dir}/store").count() == len(want)
    with pytest.raises(Exception, match="vidA"):                 # 33 bytes are no whole 2x2x2 frames
        extract_frames(spark, f"{tmp_dir}/chunks", 8, geometry=(2, 2, 2)).collect()


def test_append_only_log_last_write_wins(spark, tmp_dir):
    from framelake.operators.metrics import latest_per
    from framelake.sources.sinks import append_events
    path = tmp_dir + "/events"
    first = spark.createDataFrame([(1, "extract", 10, 100), (1, "detect", 20, 5)],
                                  "run_id int, phase string, ts long, frame_number long")
    append_events(first, path)
    append_events(spark.createDataFrame([(1, "extract", 30, 250)], "run_id int, phase string, ts long, frame_number long"),
                  path)
    log = spark.read.parquet(path)
    assert log.count() == 3                                        # nothing overwritten
    got = {r.phase: (r.n_records, r.frame_number) for r in
           latest_per(log, ["run_id", "phase"], ["ts"], ["frame_number"]).collect()}
    assert got == {"extract": (2, 250), "detect": (1, 5)}


def test_frame_store_folders_do_not_grow_with_chunks(spark, tmp_dir):
    """Many chunks share the folders of a video; a re-run of some, with fewer
    frames, keeps the others; videos 1 and 01, and NULL keys, stay apart."""
    import os

    from framelake.sources.frame_store import SLOTS
    schema = "video_id string, chunk_id long, frame_no long, data binary"
    rows = [(v, c, 10 * c + k, bytes([c % 256, k])) for v in ("1", "01", None) for c in range(5 * SLOTS + 3) for k in (1, 2)]
    rows += [("1", None, 1, b"n"), (None, None, 2, b"m")]
    path = tmp_dir + "/store"
    write_frame_store(spark.createDataFrame(rows, schema), path)
    folders = [d for d, _, files in os.walk(path) if any(f.endswith(".parquet") for f in files)]
    assert len(folders) <= 3 * (SLOTS + 1)
    redone = [("1", 2, 21, b"new"), ("1", 2 + SLOTS, 5, b"new"), (None, None, 2, b"new"), ("2", 2, 1, b"new")]
    write_frame_store(spark.createDataFrame(redone, schema), path)
    want = [r for r in rows if r[:2] not in {x[:2] for x in redone}] + redone
    got = spark.read.schema(schema + ", chunk_slot int").parquet(path)
    order = lambda rs: sorted(((r[0] or "", r[0] is None, -1 if r[1] is None else r[1], r[2], bytes(r[3])) for r in rs))
    assert order(got.select("video_id", "chunk_id", "frame_no", "data").collect()) == order(want)


def test_first_frames_of_a_store_read_the_slots_of_first_chunks(spark, tmp_dir):
    from framelake.operators.pixels import first_frame_detection
    from framelake.sources.frame_store import SLOTS
    rows = [(v, c, 10 * c + k, bytes([v, k])) for v in (1, 2) for c in range(v, 2 * SLOTS) for k in (1, 2)]
    write_frame_store(spark.createDataFrame(rows, "video_id int, chunk_id int, frame_no long, data binary"), f"{tmp_dir}/store")
    got = first_frame_detection(read_frame_store(spark, f"{tmp_dir}/store"), lambda f: f)
    assert sorted((r.video_id, r.frame_no, bytes(r.data)) for r in got.collect()) == [(1, 11, bytes([1, 1])), (2, 21, bytes([2, 1]))]
    scan = next(x for x in got._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in x)
    filters = scan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "dynamicpruning" in filters and "chunk_slot" in filters
