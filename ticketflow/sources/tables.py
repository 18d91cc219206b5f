"""Parquet table access with explicit projection, so the scan's ReadSchema only
carries the columns a plan uses."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, root: str, name: str, columns=None) -> DataFrame:
    """``root/name.parquet`` (a file or a folder of parts), optionally projected."""
    path = os.path.join(root, f"{name}.parquet")
    if not os.path.exists(path) and os.path.isdir(os.path.join(root, name)):
        path = os.path.join(root, name)
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df
