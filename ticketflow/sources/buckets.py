"""Current state laid out by hash bucket of its key, so that an upsert rewrites only what it touches.

The bucket is a partition column (``bucket=17``), computed from the key; how many there are, and of which
columns, is kept in ``_layout.json`` beside them. An upsert finds the buckets of the changed keys, reads
those alone (partition pruning), and replaces them in one job; files of other buckets stay as they are.
It can be repeated after a failure: merging the same changes once more gives the same state.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketflow.operators.silver import dedup_latest
from ticketflow.sources.lake import read_text, write_text

BUCKET = "bucket"


def bucket_of(keys: Iterable[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _layout(spark: SparkSession, path: str) -> tuple[list[str], int]:
    found = json.loads(read_text(spark, f"{path.rstrip('/')}/_layout.json"))
    return found["keys"], found["buckets"]


def write_buckets(state: DataFrame, path: str, key: str | Iterable[str] = "ticket_id", buckets: int = 64) -> None:
    """Lay out ``state`` (one row per key) anew."""
    keys = [key] if isinstance(key, str) else list(key)
    (state.withColumn(BUCKET, bucket_of(keys, buckets)).hint("rebalance", BUCKET)
     .write.mode("errorifexists").partitionBy(BUCKET).parquet(path))
    write_text(state.sparkSession, f"{path.rstrip('/')}/_layout.json", json.dumps({"keys": keys, "buckets": buckets}))


def read_buckets(spark: SparkSession, path: str, only: Iterable[int] | None = None) -> DataFrame:
    """The state, with its bucket; of some buckets only those are read."""
    state = spark.read.parquet(path)
    return state if only is None else state.where(F.col(BUCKET).isin(list(only)))


def upsert_buckets(spark: SparkSession, path: str, changes: DataFrame, order: str = "last_activity",
                   tie_breakers: Iterable[str] = ()) -> list[int]:
    """Latest version per key of the state at ``path`` and ``changes``, in place; returns the buckets that
    were rewritten. No more rows reach the driver than there are buckets."""
    keys, buckets = _layout(spark, path)
    changes = changes.withColumn(BUCKET, bucket_of(keys, buckets))
    touched = sorted(r[BUCKET] for r in changes.select(BUCKET).distinct().collect())
    if not touched:
        return []
    state = read_buckets(spark, path, touched)
    # the key's bucket is part of the key, so rows of a bucket meet in the exchange that the merge needs
    merged = dedup_latest(state.unionByName(changes, allowMissingColumns=True).select(*state.columns),
                          [*keys, BUCKET], order, tuple(tie_breakers))
    (merged.hint("rebalance", BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(BUCKET).parquet(path))
    return touched
