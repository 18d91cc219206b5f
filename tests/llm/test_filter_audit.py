import re
from itertools import permutations

import numpy as np
import pytest

from tests.llm.fixtures import awkward, documents, prose, with_extras
from ticketflow.llm import filter_audit as op

LABELS = "doc_id long, quality int, toxic int"


def slow(docs, labels):
    """Every order run through, document by document; docs are (doc_id, text, source)."""
    ids = {}
    for d, text, _ in docs:
        if d is not None:
            ids[text or ""] = min(d, ids.get(text or "", d))
    good = {d for d, q, _ in labels if d is not None and q == 1}
    toxic = {d for d, _, t in labels if d is not None and t == 1}

    def fails(d, text):
        text = text or ""
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", text) if x]
        return {k for k, bad in zip("ABCDE", (
            len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text),
            any(c in "#$%&*|" for c in text), d is not None and d > ids[text]), strict=True) if bad}

    parts = {}
    for d, text, source in docs:
        parts.setdefault(source or "", []).append((d, fails(d, text)))
    out = {}
    for part, rows in parts.items():
        shapley, mine = dict.fromkeys("ABCDE", 0), []
        for order in permutations("ABCDE"):
            left = rows
            for step, k in enumerate(order, 1):
                gone = [r for r in left if k in r[1]]
                left = [r for r in left if k not in r[1]]
                shapley[k] += len(gone)
                mine.append((part, "".join(order), step, k, len(left), len(gone), sum(k in f for _, f in rows) - len(gone),
                             sum(f == {k} for _, f in rows), sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone)))
        for part_, order, step, k, *rest in mine:
            out[part_, order, step] = (*rest, shapley[k])
    return out


def got(df):
    rows = df.collect()
    out = {tuple(r[:3]): tuple(r[3:]) for r in rows}
    assert len(out) == len(rows)
    return out


def drawn(n, seed=0):
    rng = np.random.default_rng(seed)
    texts = [prose(80, k) for k in range(6)] + [prose(20), "Word " * 70, prose(60) + " #1", "SHOUT " * 60, "A|B", "", None]
    docs = [(k, texts[rng.integers(len(texts))] if rng.random() < 0.6 else f"{prose(70, k)} {k}", ("s1", "s2", "", None)[rng.integers(4)])
            for k in range(n)]
    labels = [(k, int(rng.integers(2)), int(rng.integers(2))) for k in range(0, n, 2)]
    return docs, labels


@pytest.mark.parametrize("seed", range(2))
def test_equals_every_order_run_through(spark, seed):
    docs, labels = drawn(150, seed)
    rows = documents(spark, [(d, t, "en", s) for d, t, s in docs]).repartition(3)
    assert got(op.audit_documents(rows, spark.createDataFrame(labels, LABELS))) == slow(docs, labels)


def test_potentials_follow_the_recursion(spark):
    rng = np.random.default_rng(3)
    counts = [("p", int(m), int(rng.integers(0, 50)), 0, 0) for m in range(32)]
    frame = spark.createDataFrame(counts, "part string, mask int, n long, good long, toxic long")
    worth = [sum(n for _, m, n, _, _ in counts if m & s) for s in range(32)]
    potential = [0.0] * 32
    for s in range(1, 32):
        members = [k for k in range(5) if s >> k & 1]
        potential[s] = (worth[s] + sum(potential[s - (1 << k)] for k in members)) / len(members)
    for r in op.audit(frame).where("step = 1").collect():
        k = "ABCDE".index(r["filter_order"][0])
        assert r["shapley"] == round(120 * (potential[31] - potential[31 - (1 << k)]))
    total = {r["filter_order"]: 0 for r in op.audit(frame).collect()}
    assert len(total) == 120


def test_other_numbers_of_filters(spark):
    frame = spark.createDataFrame([("p", 1, 4, 0, 0), ("p", 3, 6, 0, 0), ("p", 0, 5, 0, 0)],
                                  "part string, mask int, n long, good long, toxic long")
    found = {(r["filter_order"], r["step"]): r for r in op.audit(frame, "XY").collect()}
    assert len(found) == 4
    assert found["XY", 1]["removed"] == 10 and found["XY", 2]["removed"] == 0 and found["XY", 2]["redundant"] == 6
    assert found["YX", 1]["removed"] == 6 and found["YX", 2]["kept"] == 5
    assert found["XY", 1]["shapley"] == 14 and found["YX", 1]["shapley"] == 6


def test_awkward_rows(spark):
    frame = with_extras(awkward(spark))
    docs = [tuple(r) for r in frame.select("doc_id", "text", "source").collect()]
    labels = [(1, 1, None), (1, 0, 1), (2, None, None), (None, 1, 1), (99, 1, 1), (4, 1, 1)]
    assert got(op.audit_documents(frame, spark.createDataFrame(labels, LABELS))) == slow(docs, labels)
    empty = spark.createDataFrame([], LABELS)
    assert got(op.audit_documents(frame, empty)) == slow(docs, [])
    assert op.audit_documents(documents(spark, []), empty).count() == 0


def test_one_text_in_a_third_of_all_rows(spark):
    docs = [(k, prose(70) if k % 3 else prose(70, k + 1), "hot") for k in range(900)] + [(5, prose(70), "hot")]
    rows = documents(spark, [(d, t, "en", s) for d, t, s in docs])
    assert got(op.audit_documents(rows, spark.createDataFrame([(1, 1, 0), (4, 1, 1)], LABELS))) == slow(
        docs, [(1, 1, 0), (4, 1, 1)])
