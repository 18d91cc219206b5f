"""Shard placement by a permutation-filled lookup table.

Every shard has a permutation of the slots of a prime-sized table, given by an offset and a
step. In turns, each shard claims the next slot of its permutation that is still free, until
the table is full; so shards hold equal parts to within one slot, and adding or removing a
shard moves few other slots. Placing a row is one hash and one lookup in the broadcast table.

Defined results: a null doc_id is placed as the empty text; repeated rows share a shard; columns
``slot`` and ``shard`` of the input are replaced.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHARDS = 16
SLOTS_PER_SHARD = 100
_HEX = 15  # hex digits of an md5 that fit a positive long


def table_size(shards: int) -> int:
    """The smallest prime of at least ``SLOTS_PER_SHARD`` slots a shard."""
    n = max(2, shards * SLOTS_PER_SHARD)
    while any(n % k == 0 for k in range(2, int(n**0.5) + 1)):
        n += 1
    return n


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:_HEX], 16)


def lookup_table(names: list[str], size: int) -> list[int]:
    """The shard number of every slot. Its size follows from the number of shards alone."""
    if not names or len(set(names)) < len(names):
        raise ValueError("shard names must be distinct, and one at least")
    if size < len(names):
        raise ValueError("the table needs a slot for every shard")
    at = [_number(f"{n}:offset") % size for n in names]
    step = [_number(f"{n}:step") % (size - 1) + 1 for n in names]
    slots, left = [-1] * size, size
    while left:
        for k in range(len(names)):
            while slots[at[k]] >= 0:
                at[k] = (at[k] + step[k]) % size
            slots[at[k]] = k
            left -= 1
            if not left:
                break
    return slots


def slot_of(key: Column, size: int) -> Column:
    text = F.coalesce(key.cast("string"), F.lit(""))
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, _HEX), 16, 10).cast("long")
            % size).cast("int")


def placement(spark: SparkSession, names: list[str]) -> DataFrame:
    """(slot, shard): a row for each slot, so bounded by the configured shards."""
    size = table_size(len(names))
    slots = lookup_table(names, size)
    return spark.range(size).select(
        F.col("id").cast("int").alias("slot"),
        F.element_at(F.lit(slots), F.col("id").cast("int") + 1).alias("shard"))


def place(docs: DataFrame, shards: int = SHARDS, key: str = "doc_id") -> DataFrame:
    """``docs`` with ``slot`` and ``shard``; no shuffle."""
    names = [f"shard-{k:05d}" for k in range(shards)]
    size = table_size(shards)
    docs = docs.drop("slot", "shard") if key not in ("slot", "shard") else docs
    return (docs.withColumn("slot", slot_of(F.col(key), size))
            .join(F.broadcast(placement(docs.sparkSession, names)), "slot")
            .select(*docs.columns, "slot", "shard"))


def oracle_sql(shards: int = SHARDS) -> str:
    """The placement in SQL: the table is filled turn by turn in a recursive query."""
    size = table_size(shards)
    num = lambda t: f"('0x' || substr(md5({t}), 1, {_HEX}))::BIGINT"
    return f"""
WITH RECURSIVE s AS (
  SELECT k::BIGINT AS k, 'shard-' || lpad(k::VARCHAR, 5, '0') AS name FROM range({shards}) t(k)),
p AS (SELECT k, {num("name || ':offset'")} % {size} AS o,
             {num("name || ':step'")} % {size - 1} + 1 AS d FROM s),
pref AS (SELECT k, list((o + j * d) % {size} ORDER BY j) AS want
         FROM p, range({size}) t(j) GROUP BY k),
fill(turn, taken, slot, shard) AS (
  SELECT 0::BIGINT, []::BIGINT[], -1::BIGINT, -1::BIGINT
  UNION ALL
  SELECT turn + 1, list_append(taken, got), got, k FROM (
    SELECT f.turn, f.taken, pref.k,
           list_filter(pref.want, lambda x: NOT list_contains(f.taken, x))[1] AS got
    FROM fill f JOIN pref ON pref.k = f.turn % {shards} WHERE f.turn < {size})),
h AS (SELECT doc_id, {num("coalesce(doc_id::VARCHAR, '')")} % {size} AS slot FROM documents)
SELECT h.doc_id, h.slot, f.shard FROM h JOIN fill f ON h.slot = f.slot"""
