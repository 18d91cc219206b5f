"""Language identification by a convolutional network over bytes.

Filters of several widths slide over the bytes of a window, each filter keeps its largest
response in the window, and a softmax over those gives the languages. The network is trained in
numpy on windows of a bounded sample of labelled documents (``TRAIN_DOCS`` expected, with the same quota
for each language, so that a rare one is learned however large the corpus; chosen by a hash of the
id). Every window of a whole text is scored, those of many texts together, and a text's probabilities
are averaged; one pass over the documents, no shuffle.

Defined results: null texts and texts without a letter are ``und`` with score 0; rows with a null
lang are not learned from; without any labelled document all are ``und``; ties go to the
language that sorts first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketflow.llm.common import Shared, held_out, small_batches

WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 16
TRAIN_DOCS = 2_400
TRAIN_WINDOWS = 4
TRAIN_EPOCHS = 8
BATCH = 64
RATE = 0.01
HELD_OUT_PARTS = 3
UNDETERMINED = "und"
_PAD = max(WIDTHS) - 1
_CHUNK = 64
_TEXT_CHUNK = 4096


def windows(text: bytes) -> np.ndarray:
    """All windows of a text, (n, WINDOW + _PAD) bytes: each runs into the next by ``_PAD`` bytes,
    the last is filled with zeros."""
    raw = np.frombuffer(text, np.uint8)
    n = max(1, -(-len(raw) // WINDOW))
    filled = np.zeros(n * WINDOW + _PAD, np.uint8)
    filled[:len(raw)] = raw
    return np.lib.stride_tricks.sliding_window_view(filled, WINDOW + _PAD)[::WINDOW]


class ByteNet:
    """Filters are tables: a filter of width w holds a weight for each byte at each of w places."""

    def __init__(self, classes: int, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.tables = [[rng.normal(0, 0.3 / np.sqrt(w), (256, FILTERS)).astype(np.float32) for _ in range(w)]
                       for w in WIDTHS]
        for table in self.tables:
            for place in table:
                place[0] = 0  # padding
        self.out = rng.normal(0, 0.1, (FILTERS * len(WIDTHS), classes)).astype(np.float32)
        self.bias = np.zeros(classes, np.float32)

    def pooled(self, x: np.ndarray, where: bool = False):
        """Largest response of each filter in each window, and where it is."""
        tops, places = [], []
        for table in self.tables:
            r = table[0][x[:, :WINDOW]]
            for k in range(1, len(table)):
                r += table[k][x[:, k:k + WINDOW]]
            if where:
                at = r.argmax(axis=1)
                places.append(at)
                tops.append(np.take_along_axis(r, at[:, None, :], 1)[:, 0])
            else:
                tops.append(r.max(axis=1))
        return np.maximum(np.concatenate(tops, axis=1), 0), places

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        out = []
        for at in range(0, len(x), _CHUNK):
            z = self.pooled(x[at:at + _CHUNK])[0] @ self.out + self.bias
            z = np.exp(z - z.max(axis=1, keepdims=True))
            out.append(z / z.sum(axis=1, keepdims=True))
        return np.concatenate(out)

    def _step(self, x: np.ndarray, y: np.ndarray, rate: float, state: dict) -> None:
        pooled, places = self.pooled(x, where=True)
        z = pooled @ self.out + self.bias
        z = np.exp(z - z.max(axis=1, keepdims=True))
        d = z / z.sum(axis=1, keepdims=True)
        d[np.arange(len(y)), y] -= 1
        d /= len(y)
        back = (d @ self.out.T) * (pooled > 0)
        grads = {"out": pooled.T @ d, "bias": d.sum(axis=0)}
        rows, cols = np.arange(len(x))[:, None], np.arange(FILTERS)[None, :]
        for n, (table, at) in enumerate(zip(self.tables, places, strict=True)):
            g = back[:, n * FILTERS:(n + 1) * FILTERS]
            for k in range(len(table)):  # only the place of the largest response learns
                byte = x[rows, at + k]
                grad = np.zeros_like(table[k])
                np.add.at(grad, (byte, np.broadcast_to(cols, byte.shape)), g)
                grad[0] = 0
                grads[n, k] = grad
        state["t"] = t = state.get("t", 0) + 1
        for name, g in grads.items():  # Adam
            m, v = state.get(name, (0, 0))
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            state[name] = m, v
            step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
            target = getattr(self, name) if isinstance(name, str) else self.tables[name[0]][name[1]]
            target -= step.astype(np.float32)

    def train(self, x: np.ndarray, y: np.ndarray, seed: int = 3) -> None:
        rng, state = np.random.default_rng(seed), {}
        for epoch in range(TRAIN_EPOCHS):
            order = rng.permutation(len(x))
            for at in range(0, len(order), BATCH):
                pick = order[at:at + BATCH]
                self._step(x[pick], y[pick], RATE * (1 - epoch / TRAIN_EPOCHS), state)


def _lowered(docs: DataFrame):
    return F.lower("text").cast("binary")


def quotas(counts: dict[str, int], train_docs: int) -> dict[str, float]:
    """The share of each language's documents to learn from: all languages get the same number, those that
    have fewer all they have, and what they leave goes to the others."""
    out, left = {}, train_docs
    for n, (lang, count) in enumerate(sorted(counts.items(), key=lambda x: (x[1], x[0]))):
        mine = min(count, max(1, left // (len(counts) - n)))
        out[lang], left = mine / count, max(0, left - mine)
    return out


def train(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> tuple[list[str], ByteNet] | None:
    """The languages and the network, from a bounded sample outside the held-out third."""
    rows = docs.where("lang is not null and text is not null").where(~held_out(F.col("doc_id"), HELD_OUT_PARTS))
    share = quotas({r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}, train_docs)
    if not share:
        return None
    bar = F.create_map(*(F.lit(x) for lang, s in share.items() for x in (lang, int(s * (1 << 30)))))[F.col("lang")]
    chosen = rows.where(F.pmod(F.xxhash64(F.lit("language"), "doc_id"), F.lit(1 << 30)) < bar)
    small_batches(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs, rows = [], []
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                x = windows(text)
                pick = np.unique(np.linspace(0, len(x) - 1, TRAIN_WINDOWS).astype(int))
                langs += [lang] * len(pick)
                rows += [w.tobytes() for w in x[pick]]
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(rows, pa.binary())], ["lang", "w"])

    # at most TRAIN_WINDOWS windows of each of the expected train_docs documents
    sample = chosen.select("lang", _lowered(docs).alias("t")).mapInArrow(cut, "lang string, w binary").collect()
    if not sample:
        return None
    sample.sort()
    langs = sorted({r["lang"] for r in sample})
    x = np.stack([np.frombuffer(r["w"], np.uint8) for r in sample])
    net = ByteNet(len(langs))
    net.train(x, np.array([langs.index(r["lang"]) for r in sample]))
    return langs, net


def mean_probabilities(net: ByteNet, texts: list[bytes]) -> list[np.ndarray]:
    """Per text the mean over all its windows; ``_TEXT_CHUNK`` windows, of whichever texts, are scored at
    a time."""
    sums = np.zeros((len(texts), len(net.bias)))
    sizes = np.zeros(len(texts), np.int64)
    held, of, n = [], [], 0

    def flush() -> None:
        if held:
            np.add.at(sums, np.concatenate(of), net.probabilities(np.concatenate(held)))
            held.clear()
            of.clear()

    for k, text in enumerate(texts):
        x = windows(text)
        sizes[k] = len(x)
        for at in range(0, len(x), _TEXT_CHUNK):
            part = x[at:at + _TEXT_CHUNK]
            if n + len(part) > _TEXT_CHUNK:
                flush()
                n = 0
            held.append(part)
            of.append(np.full(len(part), k))
            n += len(part)
    flush()
    return list(sums / np.maximum(sizes, 1)[:, None])


def identify(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score (the mean probability of lang_pred)."""
    spark = docs.sparkSession
    shared = Shared(spark, train(docs))
    rows = docs.select("doc_id", held_out(F.col("doc_id"), HELD_OUT_PARTS).alias("held_out"),
                       F.when(F.col("text").rlike(r"\p{L}"), _lowered(docs)).alias("text"))
    schema = rows.select("doc_id", "held_out").withColumn("lang_pred", F.lit("")).withColumn("score", F.lit(0.0)).schema
    small_batches(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value()
        for b in batches:
            texts = [None if model is None or not t.is_valid else t.as_buffer().to_pybytes() for t in b.column(2)]
            means = [] if model is None else mean_probabilities(model[1], [t for t in texts if t is not None])
            found = iter(means)
            langs, scores = [], []
            for t in texts:
                p = None if t is None else next(found)
                langs.append(UNDETERMINED if p is None else model[0][int(p.argmax())])
                scores.append(0.0 if p is None else min(1.0, float(p.max())))
            yield pa.RecordBatch.from_arrays([*b.columns[:2], pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                             ["doc_id", "held_out", "lang_pred", "score"])

    return rows.mapInArrow(run, schema)
