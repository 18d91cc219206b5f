"""Session settings the operators rely on, and the shared scratch location."""

from __future__ import annotations

import atexit
import contextlib
import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings (safe to set on an existing session). Feed timestamps are
# wall-clock values, so the session zone is pinned to UTC to keep to_date/datediff
# free of daylight-saving shifts.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the library assumes; returns the same session.

    Dated bronze folders are many; listing them is a Spark job with one task per
    folder by default, so the listing job is sized to the cluster's cores instead.
    """
    conf = dict(RUNTIME_CONF)
    conf["spark.sql.sources.parallelPartitionDiscovery.parallelism"] = str(
        max(8, spark.sparkContext.defaultParallelism))
    for k, v in conf.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "ticketflow", driver_memory: str = "16g") -> SparkSession:
    """A local session for tests and benchmarks (the UI stays off)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for k, v in RUNTIME_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_root(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    Read from the session; only a session whose executors are threads of the driver gets a
    temporary folder of its own (tests). A cluster session without it is an error: a
    machine-local folder would not survive a lost executor.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder for this cluster")
        root = tempfile.mkdtemp(prefix="ticketflow-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared root for one run's staged tables. It is
    deleted when the session's Python process ends, or by ``clear_scratch``."""
    if not _SCRATCH:
        atexit.register(_clear_at_exit)
    path = os.path.join(shared_root(spark), "ticketflow", f"{name}-{uuid.uuid4().hex[:12]}")
    _SCRATCH.append((spark, path))
    return path


_SCRATCH: list[tuple[SparkSession, str]] = []


def clear_scratch(spark: SparkSession) -> int:
    """Delete the scratch folders this process made in ``spark``'s application; returns how
    many. Results that read them can't be computed any more."""
    mine = [x for x in _SCRATCH if x[0].sparkContext is spark.sparkContext]
    jvm = spark.sparkContext._jvm
    for entry in mine:
        p = jvm.org.apache.hadoop.fs.Path(entry[1])
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        _SCRATCH.remove(entry)
    return len(mine)


def _clear_at_exit() -> None:
    for spark in {id(s.sparkContext): s for s, _ in _SCRATCH}.values():
        with contextlib.suppress(Exception):  # the session may have ended before
            if not spark.sparkContext._jsc.sc().isStopped():
                clear_scratch(spark)
