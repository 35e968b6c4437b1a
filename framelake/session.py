"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "framelake", driver_memory: str | None = None) -> SparkSession:
    """Session with the settings the operators are designed for.

    AQE stays on: it coalesces tiny shuffles, splits skewed join partitions and
    turns a sort-merge join into a broadcast join only after measuring the real
    size of the small side at runtime.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    b = (b.config("spark.ui.enabled", "false")
          .config("spark.ui.showConsoleProgress", "false")
          .config("spark.sql.adaptive.enabled", "true")
          .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
          .config("spark.sql.adaptive.skewJoin.enabled", "true")
          .config("spark.sql.execution.arrow.pyspark.enabled", "true")
          # pixel stages: cap Arrow batches by bytes (a 1080p BGR frame is
          # 6.2 MB; 32 MB = about five), not by record count, so tiny and huge
          # frames both batch well
          .config("spark.sql.execution.arrow.maxBytesPerBatch", str(32 * 1024 * 1024))
          .config("spark.sql.session.timeZone", "UTC"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:   # local mode: the driver JVM is the executor
        b = b.config("spark.driver.memory", driver_memory)
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Root of the shared folder used for lineage cuts and written tables.

    Uses the cluster's ``spark.checkpoint.dir``.  Where that is unset, a local
    master gets a folder below the warehouse directory; on a cluster this is
    an error, as each machine would write to a disk of its own.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d and not (sc.master == "local" or sc.master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not d:
        wh = spark.conf.get("spark.sql.warehouse.dir", "spark-warehouse")
        d = wh.rstrip("/") + "/framelake-checkpoints"
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique table path inside the shared folder."""
    root = shared_dir(spark)
    if root.startswith("file:"):
        root = root[len("file:"):]
    return os.path.join(root, f"{name}-{uuid.uuid4().hex[:12]}")


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``framelake`` importable in every Python worker (once per app).

    Functions handed to ``mapInPandas`` are pickled by reference to their
    module, so executors need the package: it is zipped in memory, written
    into the shared folder (through Hadoop's FileSystem API when that folder
    is not local) and distributed with ``addPyFile``."""
    import io
    import zipfile

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    root = shared_dir(spark)
    name = f"framelake-{uuid.uuid4().hex[:8]}.zip"
    if "://" in root and not root.startswith("file:"):
        jvm = spark.sparkContext._jvm
        jpath = jvm.org.apache.hadoop.fs.Path(root.rstrip("/") + "/" + name)
        fs = jpath.getFileSystem(sc._jsc.hadoopConfiguration())
        out = fs.create(jpath, True)
        out.write(bytearray(buf.getvalue()))
        out.close()
        dest = jpath.toString()
    else:
        local = root[len("file:"):] if root.startswith("file:") else root
        os.makedirs(local, exist_ok=True)
        dest = os.path.join(local, name)
        with open(dest, "wb") as fh:
            fh.write(buf.getvalue())
    sc.addPyFile(dest)
    _SHIPPED.add(sc.applicationId)
