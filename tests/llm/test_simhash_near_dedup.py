import random

import xxhash

from tests.llm.fixtures import TINY, awkward, documents, needs_tables, prose, with_extras
from ticketflow.llm import queries
from ticketflow.llm import simhash_near_dedup as op


def slow_fingerprint(text):
    white = " \t\n\x0b\x0c\r"
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = "".join(" " if c in white else c for c in low).split(" ")
    words = [w for w in words if w]
    if not words:
        return 0
    shingles = [" ".join(words[k:k + 3]) for k in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(fps):
    """Smallest index reachable, over all pairs."""
    root = list(range(len(fps)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(fps)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 3:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [find(k) for k in range(len(fps))]


def test_fingerprint_equals_majority_of_shingle_bits():
    for text in (None, "", "one", "one two", "A b\tC\x0bd\x85e", "ÄB c d e", prose(700), prose(90_000, 2)):
        assert op.fingerprint(None if text is None else text.encode()) == slow_fingerprint(text)


@needs_tables
def test_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{TINY}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    fps = [slow_fingerprint(r["text"]) for r in rows]
    ids = [r["doc_id"] for r in rows]
    want = {(i, f"{f:016x}", ids[c]) for i, f, c in zip(ids, fps, slow_components(fps), strict=True)}
    got = queries.op1_simhash_near_dedup(spark, TINY).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(rows)


def test_components_over_planted_distances(spark):
    rng = random.Random(4)
    fps = set()
    for _ in range(60):
        base = rng.getrandbits(64)
        fps.add(base)
        for _ in range(rng.randrange(5)):  # chains and clouds at distances 1 to 5
            base ^= sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 6)))
            fps.add(base)
    fps |= {0, 1, 7, 15, (1 << 63) | (1 << 31)}
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    got = {r["fp"]: r["root"] for r in op.components(df).collect()}
    group = slow_components(fps)
    by_root = {}
    for f, g in zip(signed, group, strict=True):
        by_root.setdefault(got.get(f, f), set()).add(g)
        assert (f in got) == (group.count(g) > 1)
    assert all(len(g) == 1 for g in by_root.values()) and len(by_root) == len(set(group))


def test_a_dense_cloud_yields_stars_not_pairs(spark):
    cloud = [1 << k for k in range(63)] + [0]
    edges = op.links(spark.createDataFrame([(f,) for f in cloud], "fp long"))
    assert edges.count() < 4 * len(cloud) ** 1.5
    assert all((r["a"] ^ r["b"]).bit_count() <= 3 for r in edges.collect())


def test_awkward_rows(spark):
    got = op.near_duplicates(with_extras(awkward(spark))).collect()
    assert len(got) == 13
    zero = [r for r in got if r["fingerprint"] == "0" * 16]
    assert {r["doc_id"] for r in zero} >= {None, 3, 4, 5} and {r["component_id"] for r in zero} == {3}
    assert {r["component_id"] for r in got if r["doc_id"] in (1, 2)} == {1}
    kept = op.deduplicate(with_extras(awkward(spark)))
    assert kept.columns == with_extras(awkward(spark)).columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 6, 7, 8, 9, 10]


def test_all_ids_null_and_empty_table(spark):
    both = documents(spark, [(None, "a b c d"), (None, "a b c d")])
    assert [r["component_id"] for r in op.near_duplicates(both).collect()] == [None, None]
    assert op.deduplicate(both).count() == 1
    assert op.near_duplicates(documents(spark, [])).count() == 0
    assert op.deduplicate(documents(spark, [])).count() == 0
