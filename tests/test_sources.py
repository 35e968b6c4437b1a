"""Sources: image files, file listing, probe JSON, fps parsing."""

import struct
import zlib

import pytest
from pyspark.sql import functions as F

from framelake.functions.scalars import fps_error, parse_fps
from framelake.sources.files import list_files, read_images, require_images
from framelake.sources.probe import parse_probe


def _png(path, rows, color_type):
    def chunk(tag, data):
        return struct.pack(">I", len(data)) + tag + data + struct.pack(">I", zlib.crc32(tag + data) & 0xFFFFFFFF)
    h, w = len(rows), len(rows[0]) // (3 if color_type == 2 else 4)
    raw = b"".join(b"\x00" + bytes(r) for r in rows)
    data = (b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, color_type, 0, 0, 0))
            + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))
    with open(path, "wb") as f:
        f.write(data)


def test_image_source_bgr_and_bgra(spark, tmp_dir):
    _png(f"{tmp_dir}/rgb.png", [[10, 20, 30, 40, 50, 60]], 2)          # 2x1 RGB
    _png(f"{tmp_dir}/rgba.png", [[10, 20, 30, 255]], 6)                # 1x1 RGBA
    with open(f"{tmp_dir}/broken.png", "wb") as f:
        f.write(b"abc")
    imgs = {r.origin.rsplit("/", 1)[-1]: r for r in read_images(spark, tmp_dir, on_error="drop").collect()}
    assert set(imgs) == {"rgb.png", "rgba.png"}                        # undecodable file dropped
    assert imgs["rgb.png"].mode == 16 and bytes(imgs["rgb.png"].data)[:3] == bytes([30, 20, 10])
    assert imgs["rgba.png"].mode == 24 and bytes(imgs["rgba.png"].data) == bytes([30, 20, 10, 255])
    kept = read_images(spark, tmp_dir, on_error="keep")
    assert kept.count() == 3
    with pytest.raises(Exception):
        require_images(kept).collect()
    with pytest.raises(Exception):                                     # the default
        read_images(spark, tmp_dir).collect()


def test_list_files_name_sorted(spark):
    names = [r.name for r in list_files(spark, "/root/testdata/sf0.001", "*.parquet").collect()]
    assert names == sorted(names) and "events.parquet" in names


def test_fps_dialects(spark):
    df = spark.createDataFrame([("30000/1001",), ("0/0",), ("abc",), ("25",), ("24/1x",)], "t string")
    got = {r.t: (r.f, r.e) for r in df.select("t", parse_fps("t").alias("f"), fps_error("t").alias("e")).collect()}
    assert got["30000/1001"][0] == pytest.approx(30000 / 1001)
    assert got["0/0"] == (0.0, "zero denominator")
    assert got["abc"] == (0.0, "not a number")
    assert got["25"] == (25.0, None)
    assert got["24/1x"][0] == 24.0          # leading rational is enough for the lenient parse
    with pytest.raises(Exception):
        df.where(F.col("t") == "0/0").select(parse_fps("t", "strict")).collect()
    ok = df.where(F.col("t") == "30000/1001").select(parse_fps("t", "strict").alias("f")).first()
    assert ok.f == pytest.approx(30000 / 1001)


def test_probe_picks_first_stream_with_width(spark):
    js = ('{"streams":[{"codec_type":"audio"},{"codec_type":"video","width":1920,"height":1080,'
          '"avg_frame_rate":"30000/1001","nb_frames":"1800"}],"format":{"duration":"60.06","size":"1048576"}}')
    m = parse_probe(spark.createDataFrame([(1, js)], "video_id int, probe_json string")).first()
    assert (m.width, m.height, m.frame_count, m.file_size_mb) == (1920, 1080, 1800, 1.0)
    assert m.fps == pytest.approx(29.97002997)
