"""A1/A3: file listings and image scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.functions.scalars import basename


def list_files(spark: SparkSession, directory: str, glob: str = "*.mp4") -> DataFrame:
    """A1: files of a directory matching ``glob``, ordered by name.

    Only ``path``/``length``/``modificationTime`` are selected, so the
    ``binaryFile`` source never reads file contents."""
    df = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
               .option("recursiveFileLookup", "false").load(directory))
    return (df.select("path", "length", "modificationTime")
              .withColumn("name", basename(F.col("path")))
              .orderBy("name"))


def read_images(spark: SparkSession, path: str, on_error: str = "raise") -> DataFrame:
    """A3: decode image files with Spark's ``image`` source.

    Rows carry ``origin, height, width, nChannels, mode, data`` (BGR/BGRA
    byte order).  An undecodable file fails the job; ``on_error="drop"`` leaves
    it out and ``"keep"`` keeps it as a row with ``nChannels = -1``."""
    if on_error not in ("raise", "drop", "keep"):
        raise ValueError(f"unknown error policy {on_error!r}")
    df = spark.read.format("image").option("dropInvalid", on_error == "drop").load(path)
    images = df.select("image.origin", "image.height", "image.width", "image.nChannels",
                       "image.mode", "image.data")
    return require_images(images) if on_error == "raise" else images


def require_images(images: DataFrame) -> DataFrame:
    """Fail on unreadable images: an unreadable frame is an error, not an empty frame."""
    bad = F.col("height") <= 0
    return images.withColumn("height", F.when(~bad, F.col("height")).otherwise(
        F.raise_error(F.concat(F.lit("unreadable image: "), F.col("origin"))).cast("int")))
