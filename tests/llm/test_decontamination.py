from itertools import combinations

from tests.llm.fixtures import awkward, documents, prose, with_extras
from ticketflow.llm import decontamination as op


def benchmark(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


ITEM = "the quick brown fox jumps over a lazy dog while seven wizards quietly brew potions at dawn"


def changed(text, at):
    return " ".join("changed" if k in at else w for k, w in enumerate(text.split()))


def test_masks_hit_every_window_with_two_substitutions():
    for n in range(op.SUBSTITUTIONS + 1):
        for bad in combinations(range(op.WINDOW), n):
            assert any(not {s + k for k in mask} & set(bad)
                       for mask in op.MASKS for s in range(op.WINDOW - mask[-1]))


def test_planted_passages(spark):
    lead, tail = prose(40), prose(40, 2)
    docs = documents(spark, [
        (1, f"{lead} {ITEM} {tail}"), (2, ITEM.upper().replace(" ", ", ")), (3, f"{lead} {changed(ITEM, {3, 11})} {tail}"),
        (4, f"{lead} {changed(ITEM, {0, 1, 4, 5, 8, 9, 12, 13})} {tail}"), (5, f"{lead} {tail}"),
        (6, " ".join(ITEM.split()[:13])), (7, " ".join(ITEM.split()[:12])), (8, lead + " " + " ".join(ITEM.split()[2:]))])
    got = op.contaminated(docs, benchmark(spark, [(70, ITEM), (71, prose(30, 9))])).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(d, 70) for d in (1, 2, 3, 6, 8)}
    assert {r["doc_id"]: r["matched"] for r in got}[1] == op.WINDOW


def test_short_items_need_all_but_their_share(spark):
    item = "nine words make a short item that holds seeds"
    docs = documents(spark, [(1, "so " + item + " end"), (2, "so " + changed(item, {6}) + " end"),
                             (3, changed(item, {3, 6}))])
    got = op.contaminated(docs, benchmark(spark, [(1, item)])).collect()
    assert {r["doc_id"] for r in got} == {1, 2}


def test_awkward_rows(spark):
    docs = with_extras(awkward(spark))
    bench = benchmark(spark, [(1, None), (2, ""), (None, " ".join(prose(80).split()[10:40])), (4, "too short"), (5, prose(20, 9)),
                              (5, prose(20, 9))]).selectExpr("*", "'x' as doc_id", "1 as d", "'y' as w")
    got = op.contaminated(docs, bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(1, None), (2, None), (None, None)} and len(got) == 3
    kept = op.decontaminate(docs, bench)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 3, 4, 5, 6, 7, 8, 9, 10]


def test_empty_tables(spark):
    docs, none = awkward(spark), benchmark(spark, [])
    assert op.contaminated(docs, none).count() == 0
    assert op.decontaminate(docs, none).count() == docs.count()
    assert op.contaminated(documents(spark, []), benchmark(spark, [(1, ITEM)])).count() == 0


def test_shuffled_joins_give_the_same(spark, monkeypatch):
    docs = documents(spark, [(1, prose(20) + " " + ITEM), (2, prose(20)), (3, ITEM)])
    bench = benchmark(spark, [(1, ITEM)])
    want = op.contaminated(docs, bench).collect()
    monkeypatch.setattr(op, "BROADCAST_SEEDS", 0)
    monkeypatch.setattr(op, "BROADCAST_HITS", 0)
    assert sorted(op.contaminated(docs, bench).collect()) == sorted(want) and len(want) == 2


def test_items_of_every_length_are_found_at_every_position(spark):
    items, docs, want = [], [], set()
    for n in range(1, op.WINDOW + 1):
        text = " ".join(f"w{n}x{k}" for k in range(n))
        items.append((n, text))
        allowed = n * op.SUBSTITUTIONS // op.WINDOW
        for bad in [c for m in range(min(n, allowed + 1) + 1) for c in combinations(range(n), m)]:
            docs.append((len(docs), f"before {changed(text, bad)} behind"))
            if len(bad) <= allowed:
                want.add((docs[-1][0], n, n - len(bad)))
    items.append((99, "\u4f60\u597d\u4e16\u754c\u3002\u518d\u89c1"))
    docs.append((len(docs), "\u524d\u3002\u4f60\u597d\u4e16\u754c\u3002\u518d\u89c1\u3002"))
    want.add((docs[-1][0], 99, 2))
    got = op.contaminated(documents(spark, docs), benchmark(spark, items)).collect()
    assert {(r["doc_id"], r["item_id"], r["matched"]) for r in got} == want and len(got) == len(want)
    assert op.SHORT == tuple(range(1, 10))
