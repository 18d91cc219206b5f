"""Distinct keys of a dated table without reading it again: a sketch per partition.

Beside a table of ``dt`` partitions lies one of sketches (HLL, one row per partition), written from the rows
of a load as it lands them and replaced with their partitions. The distinct keys of any set
of partitions are the estimate of their merged sketches, so the row-count check of a publish needs no scan of
bronze. With ``lg_k`` of 14 the standard error is about 0.8 % (1.04 / sqrt(2 ** lg_k)); the check
widens its band by ``ERRORS`` of them, so that an estimate never fails a publish that the exact count passes,
but for one in some ten thousand. The exact count stays the default where no sketches are kept.
"""

from __future__ import annotations

from math import sqrt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketflow.sources.lake import write_partitions

LG_K = 14
#: Standard errors by which the band of the check is wider.
ERRORS = 4


def relative_error(lg_k: int = LG_K) -> float:
    """One standard error of an estimate."""
    return 1.04 / sqrt(1 << lg_k)


def partition_sketches(rows: DataFrame, key: str = "ticket_id", column: str = "dt", lg_k: int = LG_K) -> DataFrame:
    """(column, rows, has_null, sketch) per partition. Built on the map side, so a hot day ships a sketch
    per task. A null key is one key and is kept apart, as the sketch takes none."""
    return rows.groupBy(column).agg(
        F.count(F.lit(1)).alias("rows"), F.max(F.col(key).isNull()).alias("has_null"),
        F.hll_sketch_agg(F.col(key).cast("string"), F.lit(lg_k)).alias("sketch"))


def refresh_sketches(rows: DataFrame, path: str, key: str = "ticket_id", column: str = "dt", lg_k: int = LG_K) -> None:
    """Replace the sketches of the partitions present in ``rows`` (all rows of these partitions)."""
    write_partitions(partition_sketches(rows, key, column, lg_k), path, column)


def distinct_estimate(sketches: DataFrame) -> DataFrame:
    """One row (distinct_keys) of the merged ``sketches``."""
    merged = sketches.agg(F.hll_union_agg("sketch").alias("s"), F.max("has_null").alias("has_null"))
    return merged.select((F.coalesce(F.hll_sketch_estimate("s"), F.lit(0)) + F.coalesce(F.col("has_null").cast("int"), F.lit(0)))
                         .cast("long").alias("distinct_keys"))


def read_sketches(spark: SparkSession, path: str, start=None, end=None, column: str = "dt") -> DataFrame:
    """The sketches of the partitions in ``[start, end)``."""
    df = spark.read.parquet(path)
    if start is not None:
        df = df.where(F.col(column) >= F.lit(start).cast("date"))
    return df if end is None else df.where(F.col(column) < F.lit(end).cast("date"))


def check_rowcount_delta_estimated(df: DataFrame, sketches: DataFrame, min_ratio: float = 0.5,
                                   lg_k: int = LG_K) -> DataFrame:
    """The row-count check of ``operators.quality`` against the estimate: (name, passed, detail)."""
    slack = ERRORS * relative_error(lg_k)
    base: Column = distinct_estimate(sketches).scalar()
    m = df.agg(F.count(F.lit(1)).alias("n")).withColumn("b", base)
    inside = (F.col("b") > 0) & (F.col("n") <= F.col("b") * (1 + slack)) & (F.col("n") >= F.col("b") * (min_ratio * (1 - slack)))
    return m.select(F.lit("rowcount_delta").alias("name"), F.coalesce(inside, F.lit(False)).alias("passed"),
                    F.format_string(f"silver=%d vs bronze_distinct~%d (min_ratio={min_ratio}, within {slack:.3f})", "n", "b")
                    .alias("detail"))
