"""Dated tables whose columns grow: a log of schemas beside the data.

Partitions landed at different times need not have the same columns. Each table keeps, in the folder
``_schemas`` below it, a file for every schema that brought something new. A load is compared with what
the log knows before anything is written: new columns (also inside structs) widen the table, whole and
binary numbers may grow (``int`` to ``long``, ``float`` to ``double``), and any other change of a type is
drift, which is refused with the column and the partitions named. Readers take the columns from the log, so
no column of any partition is lost, and one that a partition lacks is null there. No file is
opened to find a schema.

The table's schema is the merge of all files of the log, in the order of their names. Merging does not
depend on that order, so of two loads that widen a table at once neither loses its columns.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketflow.sources.lake import names_in, read_text, write_partitions, write_text

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_BINARY = (T.FloatType, T.DoubleType)
#: Partitions that an error names.
_NAMED = 10


class SchemaDrift(ValueError):
    """A load whose types do not fit the table's. ``problems`` are (column, type there, type here)."""

    def __init__(self, path: str, problems: list[tuple[str, str, str]], partitions: list[str]):
        self.path, self.problems, self.partitions = path, problems, partitions
        what = "; ".join(f"{c}: {have} there, {got} here" for c, have, got in problems)
        super().__init__(f"{path}, partitions {', '.join(partitions)}: {what}")


def merged_type(have: T.DataType, got: T.DataType, name: str, problems: list) -> T.DataType:
    for family in (_WHOLE, _BINARY):
        if isinstance(have, family) and isinstance(got, family):
            return max(have, got, key=lambda t: family.index(type(t)))
    if isinstance(have, T.StructType) and isinstance(got, T.StructType):
        return merged_schema(have, got, problems, f"{name}.")
    if isinstance(have, T.ArrayType) and isinstance(got, T.ArrayType):
        return T.ArrayType(merged_type(have.elementType, got.elementType, f"{name}[]", problems))
    if isinstance(have, T.MapType) and isinstance(got, T.MapType):
        return T.MapType(merged_type(have.keyType, got.keyType, f"{name} keys", problems),
                         merged_type(have.valueType, got.valueType, f"{name} values", problems))
    if have != got:
        problems.append((name, have.simpleString(), got.simpleString()))
    return have


def merged_schema(have: T.StructType, got: T.StructType, problems: list, prefix: str = "") -> T.StructType:
    """Columns of ``have``, widened by ``got``, then the new ones; all may be null. What does not fit goes
    to ``problems``, also names that differ in case alone."""
    fields = {f.name: f.dataType for f in have}
    spelt = {n.lower(): n for n in fields}
    for f in got:
        known = spelt.setdefault(f.name.lower(), f.name)
        if known != f.name:
            problems.append((prefix + f.name, f"named {known}", f.dataType.simpleString()))
        elif f.name in fields:
            fields[f.name] = merged_type(fields[f.name], f.dataType, prefix + f.name, problems)
        else:
            fields[f.name] = merged_type(f.dataType, f.dataType, prefix + f.name, problems)  # all may be null
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


def table_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """What the log of the table at ``path`` says; None if there is no log."""
    folder, out, problems = f"{path.rstrip('/')}/_schemas", None, []
    for name in sorted(n for n in names_in(spark, folder) if n.endswith(".json")):
        schema = T.StructType.fromJson(json.loads(read_text(spark, f"{folder}/{name}")))
        out = schema if out is None else merged_schema(out, schema, problems)
    if problems:  # two loads at once gave a column different types
        raise SchemaDrift(path, problems, ["of its log"])
    return out


def _fitted(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with all columns of ``schema``, in its order and types."""
    have = set(df.columns)
    return df.select(*((F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema))


def _partitions(df: DataFrame, column: str) -> list[str]:
    days = df.select(F.col(column).cast("string").alias("d")).distinct().orderBy("d").limit(_NAMED + 1).collect()
    names = [f"{column}={r['d']}" for r in days]
    return [*names[:_NAMED], "and more"] if len(names) > _NAMED else names


def land_evolving(df: DataFrame, path: str, column: str = "dt") -> int:
    """Replace the ``column`` partitions present in ``df``, widening the table by its new columns; returns
    the rows written. Raises ``SchemaDrift``, and writes nothing, if types do not fit."""
    spark, problems = df.sparkSession, []
    known = table_schema(spark, path)
    schema = merged_schema(known or T.StructType(), df.schema, problems)
    if problems:
        raise SchemaDrift(path, problems, _partitions(df, column))
    if schema != known:  # first the log: until rows come, the new columns are null everywhere
        version = len(names_in(spark, f"{path.rstrip('/')}/_schemas"))
        write_text(spark, f"{path.rstrip('/')}/_schemas/{version:06d}-{uuid.uuid4().hex[:8]}.json", schema.json())
    return int(write_partitions(_fitted(df, schema), path, column).get["rows"])


def read_evolving(spark: SparkSession, path: str, column: str = "dt", start=None, end=None) -> DataFrame:
    """All partitions with all columns that any of them has; a ``[start, end)`` range prunes partitions."""
    schema = table_schema(spark, path)
    if schema is None:
        raise FileNotFoundError(f"no schema log at {path}")
    df = spark.read.schema(schema).parquet(path).select(*schema.names)
    if start is not None:
        df = df.where(F.col(column) >= F.lit(start).cast(schema[column].dataType))
    if end is not None:
        df = df.where(F.col(column) < F.lit(end).cast(schema[column].dataType))
    return df
