import hashlib
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from tests.llm.fixtures import awkward, documents, prose, with_extras
from ticketflow.llm import mixing as op

LEVELS = ("domain", "lang", "source")


def fill(budget, children):
    """children: {name: (weight, cap)}; raise the shares until the budget is used or all are full."""
    got = dict.fromkeys(children, 0.0)
    left, open_ = budget, {n for n, (w, c) in children.items() if w > 0}
    while open_ and left > 1e-9:
        weight = sum(children[n][0] for n in open_)
        step = min(left / weight, min((children[n][1] - got[n]) / children[n][0] for n in open_))
        for n in open_:
            got[n] += step * children[n][0]
        left -= step * weight
        open_ = {n for n in open_ if children[n][1] - got[n] > 1e-9}
    return got


def slow_budgets(tokens, mix):
    """{leaf: budget} down the tree."""
    out = {(): min(sum(tokens.values()) * mix.budget, sum(tokens.values()) * mix.max_epochs)}
    for n, level in enumerate(LEVELS):
        below = {}
        for node, budget in out.items():
            caps = {}
            for leaf, t in tokens.items():
                if leaf[:n] == node and t:
                    caps[leaf[n]] = caps.get(leaf[n], 0) + t * mix.max_epochs
            weights = getattr(mix, level)
            got = fill(budget, {c: (weights.get(c, mix.default), cap) for c, cap in caps.items()})
            below |= {(*node, c): b for c, b in got.items()}
        out = below
    return out


def slow_mix(rows, mix):
    leaves = {}
    for doc_id, text, lang, source in rows:
        source = source or "unknown"
        leaf = (f"d{crc32(source.encode()) % mix.domains}", lang or "und", source)
        leaves.setdefault(leaf, []).append((doc_id, len((text or "").split())))
    tokens = {leaf: sum(n for _, n in docs) for leaf, docs in leaves.items()}
    out = []
    for leaf, budget in slow_budgets(tokens, mix).items():
        take = int(budget + 1e-6)
        whole, rest = divmod(take, tokens[leaf])
        key = lambda d: hashlib.md5(f"{mix.seed}:{whole + 1}:{'' if d is None else d}".encode()).hexdigest()  # noqa: B023,E731
        by_key, sum_ = {}, 0
        for d, n in leaves[leaf]:
            by_key.setdefault(key(d), []).append((d, n))
        extra = []
        for k in sorted(by_key):
            sum_ += sum(n for _, n in by_key[k])
            if sum_ > rest or not rest:
                break
            extra += [d for d, _ in by_key[k]]
        out += [(d, e + 1) for d, _ in leaves[leaf] for e in range(whole)] + [(d, whole + 1) for d in extra]
    return sorted(out, key=str)


MIXES = [op.Mix(), op.TARGET, op.PIPELINE, op.Mix(budget=0.35, max_epochs=1), op.Mix(budget=3.0, max_epochs=2),
         op.Mix(budget=1.6, max_epochs=4, lang={"en": 9.0, "fr": 0.0}, source={"src0": 0.5})]


@pytest.mark.parametrize("mix", MIXES)
def test_mix_equals_brute_force(spark, mix):
    rows = [(k, prose(3 + k * 7 % 23, k % 5), ("en", "de", "fr", None)[k * k % 4], f"src{min(k % 9, 4)}" if k % 13 else None)
            for k in range(240)]
    got = op.mix_documents(documents(spark, rows), mix).collect()
    assert sorted(((r["doc_id"], r["epoch"]) for r in got), key=str) == slow_mix(rows, mix)


def test_shortages_go_to_siblings_before_ancestors(spark):
    totals = spark.createDataFrame([("d0", "en", "a", 10), ("d0", "en", "b", 500), ("d1", "en", "c", 500)],
                                   "domain string, lang string, source string, tokens long")
    mix = op.Mix(budget=400 / 1010, max_epochs=1)
    got = {r["source"]: r["budget"] for r in op.leaf_budgets(totals, mix).collect()}
    assert got == pytest.approx({"a": 10, "b": 190, "c": 200})
    short = totals.where("source <> 'b'")
    got = {r["source"]: r["budget"] for r in op.leaf_budgets(short, op.Mix(budget=400 / 510, max_epochs=1)).collect()}
    assert got == pytest.approx({"a": 10, "c": 390})


def test_awkward_rows(spark):
    docs = with_extras(awkward(spark))
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in docs.collect()]
    got = op.mix_documents(docs, op.PIPELINE)
    assert set(docs.columns) <= set(got.columns)
    assert sorted(((r["doc_id"], r["epoch"]) for r in got.collect()), key=str) == slow_mix(rows, op.PIPELINE)


def test_repeated_ids_tie_and_empty_table(spark):
    same = documents(spark, [(5, "a b c")] * 40 + [(6, "a b c")] * 40)
    got = [r["doc_id"] for r in op.mix_documents(same, op.Mix(budget=0.6, max_epochs=1)).collect()]
    assert len(got) == 40 and len(set(got)) == 1
    assert op.mix_documents(documents(spark, [])).count() == 0
    assert op.mix_documents(documents(spark, [(1, ""), (2, None)])).count() == 0


def test_shuffled_joins_give_the_same(spark, monkeypatch):
    docs = documents(spark, [(k, prose(5 + k % 7), "en", f"src{k % 5}") for k in range(60)])
    want = sorted(tuple(r) for r in op.mix_documents(docs, op.TARGET).collect())
    monkeypatch.setattr(op, "BROADCAST_LEAVES", 0)
    assert sorted(tuple(r) for r in op.mix_documents(docs, op.TARGET).collect()) == want


@pytest.mark.parametrize("mix", [
    op.Mix(domain={"web": 3.0, "books": 1.0}, domain_of={"src0": "web", "src1": "books", "src2": "web"}, budget=0.5, max_epochs=1),
    op.Mix(domain={"web": 3.0, "books": 1.0}, domain_column="domain", budget=0.5, max_epochs=1)])
def test_domains_of_the_user(spark, mix):
    """A column of documents, or a name for each source; both name the same domains here."""
    names = {"src0": "web", "src1": "books", "src2": "web"}
    rows = [(k, prose(5 + k % 9, k), "en", f"src{k % 4}") for k in range(200)]
    docs = documents(spark, rows)
    by_source = F.create_map(*(F.lit(x) for item in names.items() for x in item))[F.col("source")]
    got = op.mix_documents(docs.withColumn("domain", by_source), mix).collect()
    assert {(r["source"], r["domain"]) for r in got} == {*names.items(), ("src3", "unknown")}
    words = lambda d: sum(len(r["text"].split()) for r in got if r["domain"] == d)
    total = sum(len(r[1].split()) for r in rows)
    tokens = {}
    for _, text, _, source in rows:
        leaf = (names.get(source, "unknown"), "en", source)
        tokens[leaf] = tokens.get(leaf, 0) + len(text.split())
    budgets = slow_budgets(tokens, mix)
    for d in ("web", "books", "unknown"):
        want = sum(b for leaf, b in budgets.items() if leaf[0] == d)
        assert want - 15 * 2 < words(d) <= want + 1e-6
    assert sum(map(words, ("web", "books", "unknown"))) <= total / 2
