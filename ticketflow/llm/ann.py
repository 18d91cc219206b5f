"""Nearest neighbours by inner product with multi-index hashing.

Vectors get binary codes from rotations learned on a bounded sample (iterative quantisation of
the vectors lifted to equal length, so that the angle follows the inner product). Codes are
split into substrings, each with an index of its own. A query probes every substring index
within its part of the Hamming radius; by the pigeonhole principle that finds every code within
the radius, and those are ranked by the inner products of the original vectors in double
precision. Queries that find fewer than ``k`` in all blocks together go round again with a wider radius.

The radius is learned: a sample of queries is compared with all rows exactly, and the radius is
the ``RADIUS_SHARE`` quantile of their true neighbours' code distances. The more rows there are, the
nearer these are, so the radius shrinks as the table grows, and with it the share of rows probed; how far
depends on how well the vectors cluster.

The index is sharded by a hash of the id into blocks of about ``BLOCK_ROWS`` rows. A block's rows
come first, sorted, and its index is built once; the queries stream past it in batches, so a task holds
a block and a batch of queries.

Defined results: vectors that are null, empty, zero, of another length than most, or hold a null,
NaN or infinite component, and rows without vec_id, take no part; rows that share a vec_id count
once, with the smallest vector; ties go to the smaller vec_id; with k candidates or fewer, all
are returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import ceil, comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticketflow.llm.common import Shared, small_batches, staged

K = 20
BITS = 128
SUBSTRING_BITS = 16
SAMPLE_ROWS = 8_192
SAMPLE_VALUES = 1 << 21
SAMPLE_QUERIES = 64
RADIUS_SHARE = 0.985
BLOCK_ROWS = 16_384
#: Rows of an Arrow batch: queries are answered a batch at a time.
BATCH_ROWS = 4_096
#: Bits by which the radius widens from round to round.
WIDER = 16
ROTATION_ROUNDS = 30


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): one double vector per id, all of the most frequent length."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    good = (F.col("vec_id").isNotNull() & F.col("v").isNotNull()
            & F.forall("v", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
            & F.exists("v", lambda x: x != 0))
    rows = staged(vectors.select(F.col("vec_id").cast("long"), v.alias("v")).where(good)
                  .groupBy("vec_id").agg(F.min("v").alias("v")), "vectors")
    top = (rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect())
    return rows.where(F.size("v") == (top[0]["n"] if top else -1))


class Codes:
    """Binary codes: signs of the lifted vectors under learned rotations."""

    def __init__(self, sample: np.ndarray, longest: float, bits: int = BITS, seed: int = 5):
        self.longest = longest or 1.0
        rng = np.random.default_rng(seed)
        x = self._lift(sample)
        axes = np.linalg.eigh(x.T @ x)[1].T[::-1]  # the leading directions first
        parts = []
        while (left := bits - sum(p.shape[1] for p in parts)) > 0:
            base = axes[:left].T  # the leading directions, or all of them
            y = x @ base
            turn = np.linalg.qr(rng.normal(size=(base.shape[1],) * 2))[0]
            for _ in range(ROTATION_ROUNDS):
                u, _, w = np.linalg.svd(y.T @ np.where(y @ turn > 0, 1.0, -1.0))
                turn = u @ w
            parts.append(base @ turn)
        self.turn = np.hstack(parts)

    def _lift(self, x: np.ndarray) -> np.ndarray:
        x = x / self.longest
        return np.hstack([x, np.sqrt(np.maximum(0, 1 - (x * x).sum(1, keepdims=True)))])

    def rows(self, x: np.ndarray) -> np.ndarray:
        return self._pack(self._lift(x))

    def queries(self, x: np.ndarray) -> np.ndarray:
        return self._pack(np.hstack([x, np.zeros((len(x), 1))]))

    def _pack(self, x: np.ndarray) -> np.ndarray:
        """Substrings of ``SUBSTRING_BITS`` bits, one column each."""
        return np.packbits(x @ self.turn > 0, axis=1).view(">u2").astype(np.uint16)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64)


def _ball(radius: int) -> np.ndarray:
    """All substrings within ``radius`` bits of zero."""
    return np.array([sum(1 << k for k in c) for r in range(radius + 1)
                     for c in combinations(range(SUBSTRING_BITS), r)], np.uint16)


class MultiIndex:
    """Substring indexes over one block of codes."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.tables = []
        for part in codes.T:
            order = np.argsort(part, kind="stable")
            values, starts = np.unique(part[order], return_index=True)
            self.tables.append((order, values, np.append(starts, len(order))))
        self.balls: dict[int, np.ndarray] = {}

    def within(self, query: np.ndarray, radius: int) -> np.ndarray:
        """Rows whose code is within ``radius`` bits of the query's."""
        parts = len(self.tables)
        small, more = divmod(radius, parts)  # some substring differs in no more bits than its share
        found = np.zeros(len(self.codes), bool)
        for j, (order, values, starts) in enumerate(self.tables):
            share = small if j <= more else small - 1
            if share < 0:
                continue
            if sum(comb(SUBSTRING_BITS, r) for r in range(share + 1)) < len(values):
                if share not in self.balls:
                    self.balls[share] = _ball(share)
                probes = self.balls[share] ^ query[j]
                at = np.searchsorted(values, probes)
                at = at[(at < len(values)) & (values[np.minimum(at, len(values) - 1)] == probes)]
            else:  # the ball is larger than the directory: go through the directory
                at = np.flatnonzero(np.bitwise_count(values ^ query[j]) <= share)
            first, n = starts[at], starts[at + 1] - starts[at]
            ends = np.cumsum(n)
            spots = np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - ends + n, n)
            found[order[spots]] = True
        rows = np.flatnonzero(found)
        return rows[distances(self.codes[rows], query) <= radius]


def nearest_in_block(ids: np.ndarray, x: np.ndarray, index: MultiIndex, query_id: int, q: np.ndarray,
                     code: np.ndarray, radius: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Up to ``k`` (ids, scores) of a block within the radius of one query, nearest first."""
    rows = index.within(code, radius)
    rows = rows[ids[rows] != query_id]
    scores = x[rows] @ q
    best = np.lexsort((ids[rows], -scores))[:k]
    return ids[rows[best]], scores[best]


def learn_codes(rows: DataFrame) -> Codes | None:
    """Codes from a bounded sample of ``rows``, chosen by a hash of the id."""
    stat = rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("dim"), F.max(F.aggregate(
        "v", F.lit(0.0), lambda s, x: s + x * x)).alias("longest")).first()
    if not stat["n"]:
        return None
    keep = min(1.0, min(SAMPLE_ROWS, max(256, SAMPLE_VALUES // stat["dim"])) / stat["n"])
    sample = (rows.where(F.pmod(F.xxhash64(F.lit("codes"), "vec_id"), F.lit(1 << 30)) < ceil(keep * (1 << 30)))
              .orderBy("vec_id").collect())
    if not sample:
        sample = rows.limit(256).collect()
    return Codes(np.array([r["v"] for r in sample]), float(stat["longest"]) ** 0.5)


def learn_radius(rows: DataFrame, queries: DataFrame, codes: Codes, k: int = K) -> int:
    """The radius that holds ``RADIUS_SHARE`` of the true neighbours of a sample of queries."""
    spark = rows.sparkSession
    sample = queries.orderBy(F.xxhash64(F.lit("radius"), "vec_id"), "vec_id").limit(SAMPLE_QUERIES).collect()
    if not sample:
        return 0
    shared = Shared(spark, (np.array([r["vec_id"] for r in sample]),
                                           np.array([r["v"] for r in sample]), codes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        qid, q, codes = shared.value()
        qc = codes.queries(q)
        best: list[list[tuple]] = [[] for _ in qid]
        for b in batches:
            ids = b.column(0).to_numpy()
            x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
            c, s = codes.rows(x), q @ x.T
            for n in range(len(qid)):
                top = np.argpartition(-s[n], min(k, len(ids) - 1))[:k + 1]
                mine = [(-s[n, i], int(ids[i]), int(distances(c[i], qc[n]))) for i in top if ids[i] != qid[n]]
                best[n] = sorted(best[n] + mine)[:k]
        flat = [(int(qid[n]), -s, i, d) for n, mine in enumerate(best) for s, i, d in mine]
        cols = list(zip(*flat, strict=True)) if flat else [[], [], [], []]
        kinds = (pa.int64(), pa.float64(), pa.int64(), pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                                         ["query_id", "score", "vec_id", "bits"])

    near = rows.select("vec_id", "v").mapInArrow(run, "query_id long, score double, vec_id long, bits int")
    top = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    bits = [r["bits"] for r in near.withColumn("r", F.row_number().over(top)).where(F.col("r") <= k)
            .select("bits").collect()]  # SAMPLE_QUERIES * k rows
    return int(np.ceil(np.quantile(bits, RADIUS_SHARE))) if bits else BITS


def _answers(rows: DataFrame, queries: DataFrame, codes: Codes, radius: int, k: int) -> DataFrame:
    """(query_id, vec_id, score): of every block up to ``k`` neighbours of each query within the radius."""
    shared = Shared(rows.sparkSession, (codes, radius))
    blocks = max(1, ceil(rows.count() / BLOCK_ROWS))
    own = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")
    left = rows.select(own.alias("block"), F.lit(False).alias("asks"), "vec_id", "v")
    right = queries.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(True).alias("asks"), "vec_id", "v")
    dealt = left.unionByName(right).repartition(blocks, "block").sortWithinPartitions("block", "asks", "vec_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, radius = shared.value()
        at, ids, x, index = None, [], [], None  # the block, its rows, and its index once queries come
        for b in batches:
            if not b.num_rows:
                continue
            block, asks, vec_ids = (b.column(c).to_numpy(zero_copy_only=False) for c in range(3))
            v = b.column(3).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            cuts = np.flatnonzero((block[1:] != block[:-1]) | (asks[1:] != asks[:-1])) + 1
            for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), b.num_rows], strict=True):
                if block[i] != at:
                    at, ids, x, index = block[i], [], [], None
                if not asks[i]:
                    ids.append(vec_ids[i:j])
                    x.append(v[i:j])
                    continue
                if index is None:
                    if not ids:  # a block without rows
                        continue
                    all_ids, all_x = np.concatenate(ids), np.concatenate(x)
                    ids, x, index = [all_ids], [all_x], MultiIndex(codes.rows(all_x))
                found = [nearest_in_block(ids[0], x[0], index, q, v[i + n], code, radius, k)
                         for n, (q, code) in enumerate(zip(vec_ids[i:j], codes.queries(v[i:j]), strict=True))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(vec_ids[i:j], [len(f[0]) for f in found])), pa.array(np.concatenate([f[0] for f in found])),
                     pa.array(np.concatenate([f[1] for f in found]))], ["query_id", "vec_id", "score"])

    return dealt.mapInArrow(run, "query_id long, vec_id long, score double")


def search(rows: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score) for the ``usable`` rows ``queries`` against all ``rows``."""
    spark = rows.sparkSession
    small_batches(spark, BATCH_ROWS)
    codes = learn_codes(rows)
    if codes is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    radius, total, asked, done = learn_radius(rows, queries, codes, k), rows.count(), queries, None
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    while True:
        found = staged(_answers(rows, asked, codes, radius, k).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k),
                       "neighbours")
        # all other rows are candidates; a query need not be among the rows
        enough = F.least(F.lit(k), F.lit(total) - F.coalesce(F.col("inside"), F.lit(0)))
        counts = found.groupBy(F.col("query_id").alias("vec_id")).agg(F.count("*").alias("n"))
        inside = rows.select("vec_id", F.lit(1).alias("inside"))
        short = staged(asked.join(counts, "vec_id", "left").join(inside, "vec_id", "left")
                       .where(F.coalesce("n", F.lit(0)) < enough).select("vec_id", "v"), "short_queries")
        last = radius >= BITS or short.isEmpty()
        if not last:
            found = found.join(short.select(F.col("vec_id").alias("query_id")), "query_id", "left_anti")
        done = found if done is None else done.unionByName(found)
        if last:
            return done.select("query_id", "rank", "vec_id", "score")
        asked, radius = short, min(BITS, radius + WIDER)
