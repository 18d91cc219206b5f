"""Fewer, fuller files in dated tables.

A day that is landed in many small loads, or by many tasks, ends up in many small files, and scans pay for
each. The compaction lists the partitions' files, packs each partition's bytes into files of about
``target_bytes``, and rewrites only partitions that have more files than that takes, all in one job and each
swapped whole (dynamic overwrite). A second run finds nothing to do. Rows, columns and other partitions stay.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketflow.sources.lake import names_in

TARGET_BYTES = 128 << 20


def partition_files(spark: SparkSession, path: str, column: str = "dt") -> dict[str, list[int]]:
    """Sizes of the data files of each partition, from folder listings alone."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = {}
    for name in names_in(spark, path):
        if name.startswith(f"{column}="):
            files = fs.listStatus(jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{name}"))
            out[name.partition("=")[2]] = [f.getLen() for f in files if f.isFile() and not f.getPath().getName().startswith(("_", "."))]
    return out


def files_needed(sizes: list[int], target_bytes: int = TARGET_BYTES) -> int:
    return max(1, ceil(sum(sizes) / target_bytes))


def compact_partitions(spark: SparkSession, path: str, column: str = "dt", target_bytes: int = TARGET_BYTES) -> dict[str, tuple[int, int]]:
    """Rewrite the partitions that have too many files; returns (files before, files aimed at) of each."""
    todo = {v: (len(s), files_needed(s, target_bytes)) for v, s in partition_files(spark, path, column).items()
            if len(s) > files_needed(s, target_bytes)}
    if not todo:
        return {}
    schema = spark.read.parquet(path).schema
    rows = spark.read.schema(schema).parquet(path).where(F.col(column).cast("string").isin(list(todo)))
    # the files of a partition are bins that its rows are dealt out to; small partitions have one
    large = {v: n for v, (_, n) in todo.items() if n > 1}
    bins = F.lit(1)
    if large:
        known = F.create_map(*(F.lit(x) for item in large.items() for x in item))
        bins = F.coalesce(F.try_element_at(known, F.col(column).cast("string")), bins)
    dealt = rows.withColumn("_bin", F.floor(F.rand(7) * bins).cast("int"))
    tasks = min(sum(n for _, n in todo.values()), 4 * spark.sparkContext.defaultParallelism)
    (dealt.repartition(tasks, column, "_bin").drop("_bin").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path))
    return todo


def compacted(spark: SparkSession, path: str, column: str = "dt", target_bytes: int = TARGET_BYTES) -> DataFrame:
    compact_partitions(spark, path, column, target_bytes)
    return spark.read.parquet(path)
