import numpy as np

from tests.llm.fixtures import SMALL, needs_tables
from ticketflow.llm import ann as op
from ticketflow.llm import queries


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def slow(ids, x, queries_, k=20):
    """{query: [(id, score)]} nearest first."""
    out = {}
    for q in queries_:
        s = x @ x[list(ids).index(q)]
        out[q] = [(i, v) for v, i in sorted((-v, i) for i, v in zip(ids, s, strict=True) if i != q)][:k]
        out[q] = [(i, -v) for i, v in out[q]]
    return out


@needs_tables
def test_recall_against_brute_force(spark):
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids, x = [r["vec_id"] for r in rows], np.array([r["embedding"] for r in rows], float)
    want = slow(ids, x, [i for i in ids if i % 20 == 0])
    got = queries.op10_nearest_neighbours(spark, SMALL).collect()
    found = {(r["query_id"], r["vec_id"]) for r in got}
    assert len(got) == 20 * len(want)
    assert np.mean([(q, i) in found for q, near in want.items() for i, _ in near]) >= 0.9
    at = {i: n for n, i in enumerate(ids)}
    assert all(abs(r["score"] - x[at[r["query_id"]]] @ x[at[r["vec_id"]]]) < 1e-12 for r in got)
    by = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        by.setdefault(r["query_id"], []).append((r["rank"], -r["score"], r["vec_id"]))
    assert all(v == sorted(v) and [a for a, *_ in v] == list(range(1, len(v) + 1))
               and [(s, i) for _, s, i in v] == sorted((s, i) for _, s, i in v) for v in by.values())


def test_probing_finds_every_code_within_the_radius():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 1 << 16, (3000, 8), dtype=np.uint16)
    codes[1000:2000] = codes[0] ^ (rng.random((1000, 8)) < 0.3).astype(np.uint16)
    index = op.MultiIndex(codes)
    for radius in (0, 1, 3, 7, 8, 20, 45, 60, 128):
        for q in (codes[0], codes[2500], codes[5] ^ np.uint16(9)):
            want = np.flatnonzero(op.distances(codes, q) <= radius)
            assert np.array_equal(index.within(q, radius), want)


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (20, [0.6, 0.8], 1), (1, [1.0, 0.0], 1), (2, [1.0, 0.0], None), (3, [0.0, 0.0], 1), (4, None, 1), (5, [], 1),
            (6, [nan, 1.0], 1), (7, [inf, 1.0], 1), (8, [None, 1.0], 1), (9, [1.0, 2.0, 3.0], 1), (None, [1.0, 1.0], 1), (10, [-1.0, 0.5], 1),
            (10, [-1.0, 0.5], 1), (40, [0.0, 0.0], 1), (60, [30.0, 40.0], 1)]
    usable = op.usable(vectors(spark, rows).selectExpr("*", "1 as v", "2 as block", "3 as rank"))
    x = {0: [1, 0], 20: [.6, .8], 1: [1, 0], 2: [1, 0], 10: [-1, .5], 60: [30, 40]}
    assert {r["vec_id"] for r in usable.collect()} == set(x)
    got = op.search(usable, usable.where("vec_id % 20 = 0")).collect()
    ids = sorted(x)
    want = slow(ids, np.array([x[i] for i in ids], np.float32).astype(float), [0, 20, 60])
    for q, near in want.items():
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert [i for _, i, _ in mine] == [i for i, _ in near]
        assert np.allclose([s for *_, s in mine], [s for _, s in near])
    assert {r["query_id"] for r in got} == {0, 20, 60}


def test_empty_tables(spark):
    assert op.search(op.usable(vectors(spark, [])), op.usable(vectors(spark, []))).count() == 0
    some = op.usable(vectors(spark, [(1, [1.0, 2.0], 0)]))
    assert op.search(some, some.where("vec_id = 0")).count() == 0
    assert op.search(some, some).count() == 0


def test_blocks_give_the_same(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = vectors(spark, [(k, [float(v) for v in rng.normal(size=12)], 0) for k in range(400)])
    usable = op.usable(rows)
    ids = list(range(400))
    x = np.array([r["embedding"] for r in rows.orderBy("vec_id").collect()], float)
    want = slow(ids, x, [i for i in ids if i % 20 == 0])
    monkeypatch.setattr(op, "BLOCK_ROWS", 64)
    monkeypatch.setattr(op, "BATCH_ROWS", 5)
    got = op.search(usable, usable.where("vec_id % 20 = 0")).collect()
    found = {(r["query_id"], r["vec_id"]) for r in got}
    assert len(got) == 20 * 20 and np.mean([(q, i) in found for q, n in want.items() for i, _ in n]) >= 0.9


def clustered(n, centres=60, dim=24, seed=3):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, dim))
    x = middle[rng.integers(0, centres, n)] + 0.25 * rng.normal(size=(n, dim))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def test_the_index_selects_where_vectors_cluster(spark, monkeypatch):
    """Rows that are probed and reranked, counted, over several blocks; and the recall."""
    monkeypatch.setattr(op, "BLOCK_ROWS", 1500)
    x = clustered(6000)
    rows = op.usable(vectors(spark, [(k, [float(v) for v in row], 0) for k, row in enumerate(x)]))
    asked = rows.where("vec_id % 20 = 0")
    codes = op.learn_codes(rows)
    radius = op.learn_radius(rows, asked, codes)
    index = op.MultiIndex(codes.rows(x))
    probed = reranked = 0
    for q in range(0, 6000, 200):
        code = codes.queries(x[q:q + 1])[0]
        reranked += len(index.within(code, radius))
        small, more = divmod(radius, len(index.tables))
        near = np.bitwise_count(index.codes ^ code) <= np.where(np.arange(len(code)) <= more, small, small - 1)
        probed += int(near.any(axis=1).sum())
    assert reranked < 0.1 * 30 * 6000 and probed < 0.6 * 30 * 6000
    got = {(r["query_id"], r["vec_id"]) for r in op.search(rows, asked).collect()}
    want = slow(list(range(6000)), np.float32(x).astype(float), range(0, 6000, 20))
    assert len(got) == 300 * 20 and np.mean([(q, i) in got for q, near in want.items() for i, _ in near]) >= 0.9


def test_queries_that_find_too_few_go_round_again(spark, monkeypatch):
    monkeypatch.setattr(op, "learn_radius", lambda *_: 2)
    x = clustered(300, 40)
    rows = op.usable(vectors(spark, [(k, [float(v) for v in row], 0) for k, row in enumerate(x)]))
    got = op.search(rows, rows.where("vec_id % 20 = 0")).collect()
    assert len(got) == 15 * 20 and len({(r["query_id"], r["rank"]) for r in got}) == 300
    assert len({(r["query_id"], r["vec_id"]) for r in got}) == 300


def test_very_many_equal_scores_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(op, "BLOCK_ROWS", 40)
    rows = vectors(spark, [(k, [1.0, 0.0] if k % 3 else [0.0, 1.0], 0) for k in range(300)])
    usable = op.usable(rows)
    got = {}
    for r in op.search(usable, usable.where("vec_id in (20, 60)")).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
    like = lambda q: [k for k in range(300) if (k % 3 == 0) == (q % 3 == 0) and k != q][:20]
    assert {q: [i for _, i in sorted(v)] for q, v in got.items()} == {20: like(20), 60: like(60)}
