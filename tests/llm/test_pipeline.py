import hashlib
import re

import numpy as np

import corpus_pipeline
from tests.llm.fixtures import SMALL, TINY, awkward, needs_tables, with_extras
from tests.llm.test_mixing import slow_mix
from tests.llm.test_sharding import slow_table
from tests.llm.test_simhash_near_dedup import slow_components, slow_fingerprint
from ticketflow.llm import decontamination, mixing, quality_classifier, sharding, simhash_near_dedup


@needs_tables
def test_stages_chain_and_take_effect(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, SMALL).cache()
        ids = {r["doc_id"] for r in after.select("doc_id").collect()}
        assert ids <= {r["doc_id"] for r in before.select("doc_id").collect()} and len(ids) == after.count()
        if name != "shard":
            assert after.columns == docs.columns
        if name == "near_dedup":
            assert simhash_near_dedup.near_duplicates(after).where("component_id <> doc_id").count() == 0
        if name == "decontaminate":
            assert decontamination.contaminated(after, bench).count() == 0
            assert decontamination.contaminated(before, bench).count() > 0
            assert before.count() - after.count() == decontamination.contaminated(before, bench).select("doc_id").distinct().count()
        if name in ("quality", "near_dedup", "decontaminate", "mix"):
            assert 0.75 * before.count() < after.count() < before.count()
        before = after
    assert corpus_pipeline.run(spark, SMALL).count() == before.count()


@needs_tables
def test_quality_stage_keeps_good_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    good = labels.where("quality = 1").select("doc_id")
    kept = quality_classifier.keep_good(docs, labels).select("doc_id")
    assert good.join(kept, "doc_id", "left_anti").count() <= 0.02 * good.count()


@needs_tables
def test_stages_take_awkward_rows(spark):
    docs = awkward(spark)
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, docs, TINY).collect()
        stage(spark, with_extras(docs), TINY).collect()
        stage(spark, docs.limit(0), TINY).collect()


def leaked(text, items):
    """Whether some window of an item stands in the text with at most its share of substitutions."""
    words = lambda t: [w for w in re.split(r"[^\w]|_", t.lower()) if w]
    doc = np.array([hash(w) for w in words(text)])
    for item in items:
        it = np.array([hash(w) for w in words(item)])
        win = min(13, len(it))
        need = win - 2 * win // 13
        i, j = np.nonzero(doc[:, None] == it[None, :])
        for d in np.unique(i - j):
            at = np.zeros(len(it))
            at[j[i - j == d]] = 1
            lo, hi = max(0, -d), min(len(it), len(doc) - d)
            if hi - lo >= win and np.convolve(at[lo:hi], np.ones(win), "valid").max() >= need:
                return True
    return False


@needs_tables
def test_run_equals_brute_force(spark):
    read = lambda name: spark.read.parquet(f"{TINY}/{name}.parquet")
    rows = read("documents").orderBy("doc_id").collect()
    weights = quality_classifier.train(read("documents"), read("labels")).astype(float)

    def good(text):
        at, x = quality_classifier.features(text.encode())
        return sum(weights[a] * v for a, v in zip(at, x.astype(float), strict=True)) + weights[-1] >= 0

    rows = [r for r in rows if good(r["text"])]
    group = slow_components([slow_fingerprint(r["text"]) for r in rows])
    rows = [r for n, r in enumerate(rows) if group[n] == n]  # ordered by doc_id: the smallest stays
    items = [r["text"] for r in read("benchmark").collect()]
    rows = [r for r in rows if not leaked(r["text"], items)]
    picked = slow_mix([(r["doc_id"], r["text"], r["lang"], r["source"]) for r in rows], mixing.PIPELINE)
    names = [f"shard-{k:05d}" for k in range(sharding.SHARDS)]
    size = sharding.table_size(len(names))
    table = slow_table(names, size)
    slot = {d: int(hashlib.md5(str(d).encode()).hexdigest()[:15], 16) % size for d, _ in picked}
    by_id = {r["doc_id"]: r for r in rows}
    want = sorted((*by_id[d], slot[d], table[slot[d]]) for d, _ in picked)
    got = sorted(tuple(r) for r in corpus_pipeline.run(spark, TINY).collect())
    assert got == want and 0 < len(got) < 200
