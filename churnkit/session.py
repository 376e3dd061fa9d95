"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "churnkit", shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Session with the settings the operators are tuned for.

    AQE stays on so shuffle partitions are coalesced/split at run time and
    skewed join partitions are divided; the UI stays off (no server).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    Reads ``spark.checkpoint.dir`` (or the context's checkpoint dir).  Only a
    local-mode session without one (tests) gets a scratch folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = os.path.join("/tmp", f"churnkit-ckpt-{uuid.uuid4().hex[:8]}")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint root for written tables."""
    root = ensure_checkpoint_dir(spark)
    return f"{root.rstrip('/')}/churnkit-{name}-{uuid.uuid4().hex[:12]}"


def stored(spark: SparkSession, df, name: str):
    """Write a table to the shared folder and read it back: its lineage ends there,
    and what is computed from it twice is computed once."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def release(spark: SparkSession, *tables) -> None:
    """Delete stored tables that nothing reads any more, and let Spark's cleaner drop
    the shuffle files of finished, unreachable jobs."""
    import gc
    import time

    for t in tables:
        path = spark._jvm.org.apache.hadoop.fs.Path(t.scratch)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    for _ in range(2):  # plans become unreachable in the first collection, their shuffles in the second
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.3)  # the cleaner works beside the driver's main thread


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``churnkit`` importable in the Python workers (pandas UDFs pickle
    package functions by reference): zip the package once per application and
    hand it to ``addPyFile``, which distributes it to every executor."""
    import tempfile
    import zipfile

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    fd, path = tempfile.mkstemp(prefix="churnkit-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(path)
    _SHIPPED.add(app)
