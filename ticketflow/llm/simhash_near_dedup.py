"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Fingerprints within 3 bits of each other meet on a common variant: each emits the variants
within half the distance of it. Half of an odd distance is a whole number on one side only,
so the two sides are told apart by parity. Two fingerprints at distance 3 differ in parity;
the even one emits its radius-1 ball, the odd one its radius-1 ball and those radius-2 variants
whose two flipped bits lie in the same half of the word (of any three differing bits, two do).
Hence every pair within 3 bits meets, and of those that meet on a variant

* all within radius 1 of it are within 2 bits of each other,
* an odd one at radius 2 is within 3 bits of every even one there,

so one hub per variant carries all its links: no group is expanded into pairs.

Defined results: a null text counts as empty; no words give fingerprint zero, which links like
any other; repeated rows and copies share a fingerprint and so a component; a null doc_id takes
part in links but never names a component unless all its documents are null.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketflow.llm.common import connected_components, row_key, small_batches, staged

MAX_BITS = 3
SHINGLE_WORDS = 3
HASH_SEED = 42
_CHUNK = 1 << 16
_LANES = np.uint64(0x0101010101010101)


def _bit_counts(h: np.ndarray) -> np.ndarray:
    """How many of the 64-bit values have each bit set (bit 0 first)."""
    total = np.zeros(64, np.int64)
    for at in range(0, len(h), 255):  # a byte lane holds 255 at most
        part = h[at:at + 255]
        for k in range(8):
            lanes = np.add.reduce((part >> np.uint64(k)) & _LANES)
            total[k::8] += np.frombuffer(np.uint64(lanes).tobytes(), np.uint8)
    return total


def _bit_counts_fast(h: np.ndarray) -> np.ndarray:
    """As ``_bit_counts``, with all blocks of 255 values reduced at once."""
    if len(h) <= 255:
        return _bit_counts(h)
    starts = np.arange(0, len(h), 255)
    total = np.zeros(64, np.int64)
    for k in range(8):
        lanes = np.add.reduceat((h >> np.uint64(k)) & _LANES, starts)
        total[k::8] += lanes.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return total


def fingerprint(text: bytes | None, words: int = SHINGLE_WORDS, seed: int = HASH_SEED) -> int:
    """Unsigned fingerprint of a whole UTF-8 text: majority bits of its shingles' XXH64."""
    w = (text or b"").lower().split()  # bytes: lowers A-Z only, splits at ASCII white space
    if not w:
        return 0
    digest = partial(xxhash.xxh64_intdigest, seed=seed)
    n = max(1, len(w) - words + 1)
    shingles = map(b" ".join, zip(*(islice(w, k, None) for k in range(words)), strict=False)) \
        if len(w) >= words else iter([b" ".join(w)])
    hashes = map(digest, shingles)
    total = np.zeros(64, np.int64)
    for at in range(0, n, _CHUNK):
        total += _bit_counts_fast(np.fromiter(islice(hashes, _CHUNK), np.uint64, min(_CHUNK, n - at)))
    return int(sum(1 << k for k in np.flatnonzero(total * 2 > n).tolist()))


def with_fingerprints(docs: DataFrame, *keep: Column, words: int = SHINGLE_WORDS,
                      seed: int = HASH_SEED) -> DataFrame:
    """``keep`` columns of each row and ``fp``, the fingerprint as a signed long."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(*keep, F.col("text").cast("binary").alias("__text"))
    schema = docs.select(*keep).withColumn("fp", F.lit(0).cast("long")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            last = b.num_columns - 1
            fps = np.fromiter((fingerprint(t.as_py(), words, seed) for t in b.column(last)),
                              np.uint64, b.num_rows).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns[:last], pa.array(fps)],
                                             [*b.schema.names[:last], "fp"])

    return rows.mapInArrow(run, schema)


def _variants() -> tuple[list[int], list[int]]:
    """Flips for every fingerprint (none, one bit), and for odd ones (two bits of one half)."""
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    near = [0, *(signed(1 << k) for k in range(64))]
    far = [signed((1 << i) | (1 << j)) for half in (range(32), range(32, 64))
           for i, j in combinations(half, 2)]
    return near, far


def _crowded(fps: DataFrame, blocks: int = 6) -> DataFrame:
    """Drop fingerprints that cannot have a partner: two within 3 bits agree on at least
    ``blocks`` - 3 of their blocks of bits, so one that shares no such combination has none."""
    edges = [round(64 * k / blocks) for k in range(blocks + 1)]
    keys = []
    for n, combo in enumerate(combinations(range(blocks), blocks - MAX_BITS)):
        mask = sum(((1 << edges[b + 1]) - (1 << edges[b])) for b in combo)
        mask = mask - (1 << 64) if mask >> 63 else mask
        keys.append(F.struct(F.lit(n).cast("byte").alias("c"),
                             F.col("fp").bitwiseAND(F.lit(mask)).alias("k")))
    rows = fps.select("fp", F.explode(F.array(*keys)).alias("e")).select("fp", "e.c", "e.k")
    shared = rows.groupBy("c", "k").agg(F.count("*").alias("n")).where("n > 1").select("c", "k")
    return rows.join(shared, ["c", "k"], "left_semi").select("fp").distinct()


def links(fps: DataFrame) -> DataFrame:
    """Links (a, b) that connect distinct fingerprints ``fp`` exactly as all pairs within
    3 bits do: per variant, its hub with every other fingerprint that is linked to it there."""
    near, far = _variants()
    odd = F.bit_count("fp") % 2 == 1
    balls = fps.select("fp", F.explode(F.lit(near)).alias("flip")).unionByName(
        fps.where(odd).select("fp", F.explode(F.lit(far)).alias("flip")))
    # distinct fingerprints within the ball of one variant: 65 + 992 at most
    met = (balls.select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("v"))
           .groupBy("v").agg(F.collect_list("fp").alias("all")).where(F.size("all") > 1))
    even = F.filter("all", lambda x: F.bit_count(x) % 2 == 0)
    ring1 = F.filter("all", lambda x: F.bit_count(x.bitwiseXOR(F.col("v"))) <= 1)
    hubs = met.select("all", even.alias("even"), ring1.alias("ring1"))
    star = hubs.select(
        F.when(F.size("even") > 0, F.array_min("even")).otherwise(F.array_min("ring1")).alias("a"),
        F.explode(F.when(F.size("even") > 0, F.col("all")).otherwise(F.col("ring1"))).alias("b"))
    return (star.where((F.col("a") != F.col("b"))
                       & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_BITS))
            .distinct())


def components(fingerprints: DataFrame) -> DataFrame:
    """(fp, root) for those of the ``fp`` column that have a partner within 3 bits."""
    distinct = staged(_crowded(fingerprints.select("fp").distinct()), "fps")
    return staged(connected_components(links(distinct))
                  .select(F.col("node").alias("fp"), "root"), "fp_roots")


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """Per document: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id
    that can be reached over links, itself included)."""
    rows = staged(with_fingerprints(docs, F.col("doc_id"), words=words), "fingerprints")
    firsts = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = components(rows)
    linked = firsts.join(roots, "fp")
    named = linked.groupBy("root").agg(F.min("first").alias("named"))
    by_fp = staged(firsts.join(roots, "fp", "left").join(named, "root", "left")
                   .select("fp", F.coalesce("named", "first").alias("component_id")), "fp_names")
    return rows.join(by_fp, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def deduplicate(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """The rows of ``docs`` that stay: one for each component, that with the smallest doc_id
    (null last), then the smallest row key; of repeated rows, one. Columns as in ``docs``."""
    key = row_key(F.col("doc_id"), F.col("text"))
    rows = staged(with_fingerprints(docs, F.col("doc_id"), key.alias("__key"), words=words),
                  "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "__key"))
    firsts = rows.groupBy("fp").agg(first.alias("first"))
    group = firsts.join(components(rows), "fp", "left").select(
        F.coalesce("root", "fp").alias("root"), "first")
    kept = staged(group.groupBy("root").agg(F.min("first").alias("first"))
                  .select(F.col("first.__key").alias("__key")).distinct(), "kept_rows")
    return (docs.withColumn("__key", key).join(kept, "__key", "left_semi")
            .dropDuplicates(["__key"]).drop("__key"))
