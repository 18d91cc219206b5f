"""Text quality: logistic regression on hashed word n-grams, trained with
follow-the-regularised-leader updates and scored as sparse dot products.

Training takes a bounded sample of the labelled rows (``SAMPLE_ROWS`` documents expected,
chosen by a hash of the id, so the bound holds at any size); shards of it train apart and
their weights are averaged. Scoring is one pass over the documents without a shuffle.

Defined results: a null text counts as empty and gets the score of the bias alone; labels that
are null, repeated or contradictory: null ones are left out, of the others the smallest counts;
without any label every score is 0.5 and every prediction 1 (nothing is rejected).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketflow.llm.common import Shared, broadcast_if_small, held_out, small_batches

DIM_BITS = 18
SAMPLE_ROWS = 6_000
SHARDS = 6
EPOCHS = 4
HELD_OUT_PARTS = 3
#: FTRL-proximal: learning rate, its smoothing, L1, L2.
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.02, 0.1

_TOKEN = re.compile(rb"[0-9A-Za-z_\x80-\xff]+|[^\s0-9A-Za-z_\x80-\xff]+")
_REPEAT, _REPEAT_2 = 1, 2  # features of a token equal to the one before it, or the one before that
_CHUNK = 1 << 20


def features(text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashed uni- and bigrams of the whole text: sorted slots, and values of unit length."""
    mask = (1 << DIM_BITS) - 1
    counts = np.zeros(0, np.int64)
    h = np.fromiter(map(crc32, _TOKEN.findall(text or b"")), np.uint32)
    if not len(h):
        return counts, np.zeros(0, np.float32)
    h = h.astype(np.uint64)
    pairs = (h[:-1] * np.uint64(0x9E3779B1) + h[1:] * np.uint64(0x85EBCA77)) >> np.uint64(7)
    slots = np.concatenate([h, pairs, np.full(int((h[1:] == h[:-1]).sum()), _REPEAT, np.uint64),
                            np.full(int((h[2:] == h[:-2]).sum()), _REPEAT_2, np.uint64)])
    at, n = np.unique((slots & np.uint64(mask)).astype(np.int64), return_counts=True)
    x = np.sqrt(n)
    return at, (x / np.sqrt((x * x).sum())).astype(np.float32)


class Ftrl:
    """FTRL-proximal state over ``2**DIM_BITS`` slots; the last is the bias."""

    def __init__(self) -> None:
        self.z = np.zeros((1 << DIM_BITS) + 1)
        self.n = np.zeros((1 << DIM_BITS) + 1)

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) <= L1, 0.0, w)

    def learn(self, at: np.ndarray, x: np.ndarray, y: float, weight: float) -> None:
        w = self.weights(at)
        p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
        g = weight * (p - y) * x
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g


def _train_shard(pdf: pd.DataFrame) -> np.ndarray:
    model, bias = Ftrl(), 1 << DIM_BITS
    pdf = pdf.sort_values(["order", "text"])
    rows = [(np.append(at, bias), np.append(x, np.float32(1)), float(y))
            for (at, x), y in zip(map(features, pdf["text"]), pdf["quality"], strict=True)]
    ones = sum(y for *_, y in rows)
    share = {1.0: len(rows) / (2 * ones) if ones else 1, 0.0: len(rows) / (2 * (len(rows) - ones))
             if ones < len(rows) else 1}  # both labels weigh the same
    for _ in range(EPOCHS):
        for at, x, y in rows:
            model.learn(at, x, y, share[y])
    return model.weights()


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> np.ndarray:
    """Weights learned from a bounded sample of the labelled rows outside the held-out third."""
    spark = docs.sparkSession
    marked = (labels.select("doc_id", "quality").where("doc_id is not null and quality is not null")
              .where(~held_out(F.col("doc_id"), HELD_OUT_PARTS))
              .groupBy("doc_id").agg(F.min("quality").alias("quality")))
    total = marked.count()
    order = F.xxhash64(F.lit("quality"), F.col("doc_id"))
    keep = min(1.0, sample_rows / max(1, total))
    sample = marked.withColumn("order", order).where(
        F.pmod("order", F.lit(1 << 30)) < int(keep * (1 << 30)))
    sample = broadcast_if_small(sample, 2 * sample_rows)
    rows = (docs.select("doc_id", F.col("text").cast("binary").alias("text")).where("doc_id is not null")
            .join(sample, "doc_id")
            .select(F.pmod(F.shiftright("order", 32), F.lit(SHARDS)).alias("shard"), "order",
                    F.coalesce("text", F.lit(b"")).alias("text"), F.col("quality").cast("double")))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        w = _train_shard(pdf)
        return pd.DataFrame({"rows": [len(pdf)], "w": [w.astype(np.float32).tobytes()]})

    small_batches(spark)
    parts = rows.groupBy("shard").applyInPandas(fit, "rows long, w binary").collect()  # SHARDS rows
    if not parts:
        return np.zeros((1 << DIM_BITS) + 1, np.float32)
    n = np.array([p["rows"] for p in parts], float)
    w = np.stack([np.frombuffer(p["w"], np.float32) for p in parts])
    return (n @ w / n.sum()).astype(np.float32)


def with_scores(docs: DataFrame, weights: np.ndarray, name: str = "score") -> DataFrame:
    """All columns of ``docs`` and ``name``, the probability of quality 1; an input column of
    that name is replaced."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.drop(name)
    shared = Shared(spark, weights)
    schema = docs.withColumn(name, F.lit(0.0)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value().astype(np.float64)
        for b in batches:
            texts = b.column(b.schema.names.index("text"))
            z = np.empty(b.num_rows)
            for k, t in enumerate(texts):
                at, x = features(None if not t.is_valid else t.as_buffer().to_pybytes())
                z[k] = w[at] @ x + w[-1]
            score = 1 / (1 + np.exp(-np.clip(z, -35, 35)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(score)], [*b.schema.names, name])

    return docs.mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted (1 if score >= 0.5)."""
    scored = with_scores(docs.select("doc_id", "text"), train(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id"), HELD_OUT_PARTS).alias("held_out"),
                         "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are predicted to be of quality 1. Columns as in ``docs``."""
    return (with_scores(docs, train(docs, labels), "__score").where("__score >= 0.5")
            .drop("__score"))
