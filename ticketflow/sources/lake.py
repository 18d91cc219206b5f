"""Lakehouse tables on a shared filesystem: dated partitions, full-table overwrites
and versioned publishes. Paths are plain Hadoop paths (local, HDFS, object store)."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def partition_path(root: str, source: str, run_date: str, column: str = "dt") -> str:
    """Deterministic folder of one dated partition, e.g. ``root/feed/dt=2026-06-16``."""
    return f"{root.rstrip('/')}/{source}/{column}={run_date}"


def write_partitions(df: DataFrame, path: str, column: str = "dt",
                     after: Callable[[DataFrame], DataFrame] | None = None) -> Observation:
    """Replace exactly the ``column`` partitions present in ``df``; others stay.

    Dynamic partition overwrite makes a re-run of a date idempotent and lets an
    empty input land no partition at all. ``rebalance`` lets AQE split a hot
    partition value over several tasks (and files) instead of one task per value.
    ``after``, a projection that keeps ``column``, is done past the exchange and the sort by
    ``column``: what it makes wider isn't moved. Returns an Observation holding the written row
    count (no second job).
    """
    obs = Observation(f"written_{uuid.uuid4().hex[:8]}")
    # observed after the exchange: a task of the writing stage counts once, however often it ran
    dealt = df.hint("rebalance", column).observe(obs, F.count(F.lit(1)).alias("rows"))
    writer = (after(dealt.sortWithinPartitions(column)) if after else dealt).write.partitionBy(column)
    if path_exists(df.sparkSession, path):
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    else:  # a new table: no partition can be replaced, so skip the staged rename
        writer.mode("errorifexists").parquet(path)
    return obs


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a (Hadoop) path exists, asked of its own filesystem."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def write_table(df: DataFrame, path: str, partition_by: str | None = None) -> Observation:
    """Full overwrite of one table, in the partitioning and order the plan already has: a
    narrow result is written without a shuffle, files being as many as its tasks (adaptive
    execution has coalesced small ones after any shuffle). ``partition_by`` lays the table
    out by a column that later reads prune on."""
    obs = Observation(f"written_{uuid.uuid4().hex[:8]}")
    writer = (df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
              .option("partitionOverwriteMode", "static"))  # all of it, also partitions without rows
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return obs


def drop_partitions(spark: SparkSession, path: str, column: str, gone) -> None:
    """Delete the partitions whose value ``gone`` (a function of its text) says so."""
    jvm = spark.sparkContext._jvm
    for name in names_in(spark, path):
        if name.startswith(f"{column}=") and gone(name.partition("=")[2]):
            p = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{name}")
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def delete_path(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def scan_partitioned(spark: SparkSession, path: str, column: str = "dt",
                     start=None, end=None) -> DataFrame:
    """All partitions as one table; a ``[start, end)`` range prunes partitions."""
    df = spark.read.parquet(path)
    if start is not None:
        df = df.where(F.col(column) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(F.col(column) < F.lit(end).cast("date"))
    return df


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file of its own, complete once it is there: written aside, then renamed."""
    jvm = spark.sparkContext._jvm
    aside, target = (jvm.org.apache.hadoop.fs.Path(p) for p in (f"{path}.{uuid.uuid4().hex[:8]}.tmp", path))
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(aside, True)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()
    if not fs.rename(aside, target):
        raise FileExistsError(path)


def read_text(spark: SparkSession, path: str) -> str:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    stream = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


# --- versioned publish -------------------------------------------------------------
#
# A publish writes every table of a run under ``root/runs/<run_id>/`` and, only when
# all are written and validated, points ``root/_current`` at the run. Readers resolve
# the pointer, so they never see half of a multi-table publish.

def run_path(root: str, run_id: str, table: str) -> str:
    return f"{root.rstrip('/')}/runs/{run_id}/{table}"


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in a folder, none if it is not there."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [f.getPath().getName() for f in fs.listStatus(path)] if fs.exists(path) else []


def _create(spark: SparkSession, path: str) -> bool:
    """Create an empty file unless it exists; whether this call created it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).createNewFile(p)


class Outrun(RuntimeError):
    """Another publisher has published since this one read what it builds on."""


def set_current(spark: SparkSession, root: str, run_id: str, onto: str | None = None) -> None:
    """Point ``root`` at a run. The pointer is the name of an empty file, led by a version
    that the publisher has claimed by creating its claim file first: two publishers never
    share one, and no clocks are compared. Nothing is deleted, so a crash while publishing
    leaves the previous pointer in force. With ``onto``, the run this one was derived from
    ('' for none), the publish is refused with ``Outrun`` unless that is still current."""
    folder = f"{root.rstrip('/')}/_current"
    while True:
        version = max(map(int, names_in(spark, f"{folder}/claims")), default=0) + 1
        if onto is not None and onto != _pointed(spark, root):
            raise Outrun(f"{root} is not at {onto or 'nothing'} any more")
        if _create(spark, f"{folder}/claims/{version:012d}"):
            if onto is not None and onto != _pointed(spark, root):
                continue  # published between the look and the claim; the next look will tell
            _create(spark, f"{folder}/runs/{version:012d}-{run_id}")
            return


def _pointed(spark: SparkSession, root: str) -> str:
    return max(names_in(spark, f"{root.rstrip('/')}/_current/runs"), default="").partition("-")[2]


def current_run(spark: SparkSession, root: str) -> str:
    """The run of the highest version: one folder listing, no job."""
    run = _pointed(spark, root)
    if not run:
        raise FileNotFoundError(f"nothing published under {root}")
    return run


def read_published(spark: SparkSession, root: str, table: str) -> DataFrame:
    return spark.read.parquet(run_path(root, current_run(spark, root), table))
