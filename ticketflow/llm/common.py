"""Helpers shared by the operators: tables, staged results, splits, components."""

from __future__ import annotations

import pickle

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketflow.session import scratch_path

#: Words are runs of anything but ASCII white space.
WHITE = r"[\x20\x09-\x0D]+"

#: Rows of an Arrow batch. Texts may be long, so batches stay small.
ARROW_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``sf_dir/name.parquet``, read through Spark only (the path may be in a remote store)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, name: str, **layout) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: cuts the lineage, so that
    a lost executor costs a reread and not the work above."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.mode("overwrite")
    if layout.get("by"):
        writer = writer.partitionBy(*layout["by"])
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Bound the rows of the batches that go to Python, whose texts may be very long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


class Shared:
    """A value for the tasks, broadcast as bytes that need no code of this package to be read."""

    def __init__(self, spark: SparkSession, value):
        self._bytes = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    def value(self):
        return pickle.loads(self._bytes.value)


def remainder(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text modulo ``parts``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


def held_out(doc_id: Column, parts: int) -> Column:
    return remainder(doc_id, parts) == 1


def row_key(doc_id: Column, text: Column) -> Column:
    """A key for a row by content: rows with the same id and text share it. Never null."""
    return F.md5(F.concat(
        F.coalesce(doc_id.cast("string"), F.lit("-")),
        F.when(text.isNull(), F.lit("~")).otherwise(F.lit(":")),
        F.coalesce(text, F.lit(""))).cast("binary"))


def broadcast_if_small(df: DataFrame, most_rows: int) -> DataFrame:
    """Hint a broadcast only where a count shows ``df`` (a staged or small table) to be within
    ``most_rows``; otherwise the planner shuffles. The result is the same."""
    return F.broadcast(df) if df.limit(most_rows + 1).count() <= most_rows else df


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the smallest node reachable.

    Alternates large-star and small-star rounds (each: a combined min per node and a join),
    with every round's edges written to the shared folder. No group is ever gathered; a hub
    is a skewed join key, which adaptive execution splits. Self links and repeats are fine.
    """
    cur = staged(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a <> b").distinct(), "cc")
    print_of = None
    for _ in range(most_rounds):
        both = cur.unionByName(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (both.join(low, "a").where("b > a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())
        # small star: every node's smaller neighbours go to the smallest of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a")
                 .select(F.explode(F.array(
                     F.struct(F.col("a"), F.col("m").alias("b")),
                     F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
                 .select("e.a", "e.b").where("a <> b").distinct())
        cur = staged(small, "cc")
        seen = cur.agg(F.count("*").alias("n"),
                       F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if seen == print_of:
            return cur.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                cur.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        print_of = seen
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
