import numpy as np

from tests.llm.fixtures import SMALL, awkward, documents, needs_tables, prose, with_extras
from ticketflow.llm import quality_classifier as op
from ticketflow.llm import queries


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@needs_tables
def test_held_out_accuracy(spark):
    got = queries.op3_quality_classifier(spark, SMALL)
    marked = spark.read.parquet(f"{SMALL}/labels.parquet").select("doc_id", "quality")
    rows = got.join(marked, "doc_id").where("held_out").collect()
    good = [r for r in rows if r["quality"] == 1]
    bad = [r for r in rows if r["quality"] == 0]
    assert np.mean([r["predicted"] for r in good]) > 0.97
    assert np.mean([1 - r["predicted"] for r in bad]) > 0.8
    assert got.count() == 1000


def test_features_are_unit_length_and_cover_the_whole_text():
    at, x = op.features(b"One two two, three")
    assert abs(float(x @ x) - 1) < 1e-6 and op._REPEAT in at
    assert op._REPEAT not in op.features(b"one two three")[0]
    long = prose(50_000).encode()
    assert not np.array_equal(op.features(long)[1], op.features(long + b" !!! !!!")[1])
    assert len(op.features(None)[0]) == len(op.features(b"  ")[0]) == 0


def test_ftrl_follows_the_update_rule():
    model, z, n = op.Ftrl(), 0.0, 0.0
    for y in (1, 1, 0, 1):
        w = 0.0 if abs(z) <= op.L1 else -(z - np.sign(z) * op.L1) / ((op.BETA + n**0.5) / op.ALPHA + op.L2)
        g = 1 / (1 + np.exp(-w)) - y
        z, n = z + g - ((n + g * g) ** 0.5 - n**0.5) / op.ALPHA * w, n + g * g
        model.learn(np.array([7]), np.array([1.0]), y, 1.0)
        assert abs(model.z[7] - z) < 1e-12 and abs(model.n[7] - n) < 1e-12


def test_scores_are_sparse_dot_products(spark):
    w = np.random.default_rng(0).normal(size=(1 << op.DIM_BITS) + 1).astype(np.float32)
    for r in op.with_scores(awkward(spark), w).select("text", "score").collect():
        at, x = op.features(None if r["text"] is None else r["text"].encode())
        z = sum(float(w[a]) * float(v) for a, v in zip(at, x, strict=True)) + float(w[-1])
        assert abs(r["score"] - 1 / (1 + np.exp(-z))) < 1e-5


def test_awkward_rows_and_labels(spark):
    docs = with_extras(awkward(spark))
    marks = labels(spark, [(1, 1, 0), (2, 1, None), (2, 0, 0), (9, 0, 0), (9, 0, 1), (None, 1, 0), (7, None, 0), (99, 1, 0)])
    got = op.classify(docs, marks).collect()
    assert len(got) == 13 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    assert op.keep_good(docs, marks).columns == docs.columns


def test_no_labels_reject_nothing(spark):
    docs = awkward(spark)
    assert op.keep_good(docs, labels(spark, [])).count() == docs.count()
    assert {r["score"] for r in op.classify(docs, labels(spark, [])).collect()} == {0.5}
    assert op.classify(documents(spark, []), labels(spark, [(1, 1, 0)])).count() == 0
