from collections import Counter
from math import log10
from zlib import crc32

import numpy as np

from tests.llm.fixtures import TINY, awkward, documents, needs_tables, prose, with_extras
from ticketflow.llm import lm_scoring as op
from ticketflow.llm import queries


def vocabulary(texts):
    counts = Counter(w for t in texts for w in t.lower().encode().split())
    words = sorted(counts.items(), key=lambda x: (-x[1], x[0]))
    neural = {w for w, _ in words[:op.NEURAL]}
    tail = {}
    for w, c in words:
        if w not in neural:
            n, v = tail.get(op.tail_class(w), (0, 0))
            tail[op.tail_class(w)] = (n + c, v + 1)
    return op.Vocabulary(words, tail, len(texts), sum(counts.values()) + len(texts), len(counts) + 1), counts


def slow_base(rows):
    """Per row: held_out, n_tokens, n_known, train tokens, base score."""
    words = lambda t: [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else " " if c in "\t\n\x0b\x0c\r" else c
                                          for c in t or "").split(" ") if w] + [None]
    rem = lambda d: crc32(("" if d is None else str(d)).encode()) % 5
    counts = Counter(w for d, t in rows if rem(d) != 1 for w in words(t))
    n, v = sum(counts.values()), len(counts)
    return [(d, rem(d) == 1, len(words(t)), sum(counts[w] > 0 for w in words(t)), n,
             sum(log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words(t))) for d, t in rows]


def compare(got, rows):
    want = sorted(slow_base(rows), key=str)
    got = sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got), key=str)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5] for g in got], [w[5] for w in want], rtol=1e-9)


@needs_tables
def test_query_counts_and_base_equal_brute_force_and_the_model_beats_it(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{TINY}/documents.parquet").collect()]
    got = queries.op2_lm_scoring(spark, TINY).collect()
    compare(got, rows)
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_rare_words_get_their_counts_by_a_join(spark, monkeypatch):
    monkeypatch.setattr(op, "FREQUENT", 40)
    docs = awkward(spark)
    compare(op.score(with_extras(docs)).collect(), [(r["doc_id"], r["text"]) for r in docs.collect()])


def test_probabilities_sum_to_one():
    v, _ = vocabulary([prose(900, k) for k in range(3)])
    net = op.Network(v)
    s = np.random.default_rng(0).normal(size=(1, op.HIDDEN)).astype(np.float32)
    total = sum(float(np.exp(net.log_probabilities(s, np.array([k]))[0][0])) for k in range(v.slots))
    assert v.neural and abs(total - 1) < 1e-4


def test_gradient_is_that_of_the_loss():
    v, _ = vocabulary([prose(900, k) for k in range(3)])
    net = op.Network(v)
    rng = np.random.default_rng(3)
    x, y = rng.integers(0, v.slots, (4, 3)).astype(np.int32), rng.integers(0, v.slots, (4, 3)).astype(np.int32)
    live = np.ones((4, 3), bool)
    state = rng.normal(size=(3, op.HIDDEN)).astype(np.float32)
    grads = {n: np.zeros(s, np.float32) for n, s in net.shapes.items()}
    _, slots = net.gradients(x, y, live, state, grads)
    table = np.zeros_like(net.inp)
    table[slots] = grads["inp"]
    grad = np.concatenate([(table if n == "inp" else grads[n]).ravel() for n in net.shapes])

    def loss():
        states, _ = net.forward(x, state)
        return -float(net.log_probabilities(states[1:].reshape(-1, op.HIDDEN), y.ravel())[0].mean(dtype=np.float64))

    for k in np.argsort(-np.abs(grad))[:40]:
        was, eps = net.theta[k], 3e-3
        net.theta[k] = was + eps
        up = loss()
        net.theta[k] = was - eps
        down = loss()
        net.theta[k] = was
        assert abs((up - down) / (2 * eps) - grad[k]) < 2e-3 + 0.05 * abs(grad[k])


def test_state_is_carried_across_windows():
    texts = [prose(700, 1), prose(33, 2), "", prose(op.STEPS, 4), prose(5, 6), "unseen words here"]
    v, counts = vocabulary(texts[:-1])
    net = op.Network(v, op.Network(v).theta * 3)
    coder = op.Coder(v)
    n_tokens, known, base, model, rare = (c.to_pylist() for c in op._scored(v, net, coder, [t.encode() for t in texts]))
    for k, t in enumerate(texts):
        words = t.lower().encode().split()
        slots = [v.end_slot, *(v.neural + op.tail_class(w) if w not in v.frequent[:v.neural] else v.frequent.index(w) for w in words), v.end_slot]
        state, total = np.zeros((1, op.HIDDEN), np.float32), 0.0
        for a, b in zip(slots[:-1], slots[1:], strict=True):  # a word at a time
            state = net.forward(np.array([[a]]), state)[0][-1]
            total += float(net.log_probabilities(state, np.array([b]))[0][0]) / np.log(10)
        for w in words:
            if w not in v.frequent[:v.neural]:
                total += v.tail_log[op.tail_class(w)] + (log10(counts[w] + 0.5) if w in counts else 0)
        assert abs(total - model[k]) < 1e-3 * max(1, abs(total))
        assert n_tokens[k] == len(words) + 1 and known[k] == sum(w in counts for w in words) + 1
        assert {r["word"]: r["n"] for r in rare[k]} == Counter(w for w in words if w not in counts)
    numbers, sizes = coder.code([t.encode() for t in texts])
    slots, again = coder.code_slots([t.encode() for t in texts])
    assert np.array_equal(coder.slots(numbers), slots) and np.array_equal(sizes, again)
    coder.numbers.forget()
    assert coder.numbers.new == [] and len(coder.numbers) == len(v.frequent)


def test_windows_hold_every_word_of_every_span_once():
    sizes = np.array([0, 1, 5, 23, 24, 25, 80, 3])
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])
    flat = np.arange(starts[-1] + 1, dtype=np.int32)
    seen, before = [], {}
    for x, y, live, carry, who in op.windows(flat, starts[:-1], starts[1:], lanes=3):
        assert (y[live] == x[live] + 1).all()
        for lane, (c, w) in enumerate(zip(carry, who, strict=True)):
            assert x[0, lane] == (starts[w] if c < 0 else before[c][1] + 1) and (c < 0 or before[c][0] == w)
        before = {lane: (w, x[-1, lane]) for lane, w in enumerate(who)}
        seen += x[live].tolist()
    assert sorted(seen) == list(range(starts[-1]))


def test_awkward_rows_and_empty_table(spark):
    docs = with_extras(awkward(spark))
    got = op.score(docs).collect()
    compare(got, [(r["doc_id"], r["text"]) for r in docs.collect()])
    assert all(np.isfinite(r["score"]) and r["score"] < 0 for r in got)
    assert op.score(documents(spark, [])).count() == 0
    one = op.score(documents(spark, [(1, "no training text")])).collect()
    assert np.isfinite(one[0]["score"])


def test_slots_grow_with_the_counts(spark):
    often, rare = [f"w{k}" for k in range(3_000)], [f"r{k}" for k in range(500)]
    docs = documents(spark, [(k, " ".join(often)) for k in range(12)] + [(99, " ".join(rare))])
    v = op.vocabulary_of(op.count_words(docs), 13)
    assert v.neural == 3_000 > op.NEURAL
    assert set(v.frequent[:v.neural]) <= {w.encode() for w in often}
    assert v.bounds[0] == 0 and v.bounds[-1] == v.neural and len(v.bounds) == v.frequent_classes + 1
    assert v.slots == v.neural + op.TAIL_CLASSES + 1
    left = Counter(op.tail_class(w) for w in v.frequent[v.neural:])
    tokens = Counter()
    for w in v.frequent[v.neural:]:
        tokens[op.tail_class(w)] += v.counts[w]
    assert np.allclose(v.tail_log, [-log10(tokens[k] + 0.5 * (left[k] + 1)) for k in range(op.TAIL_CLASSES)])
    net = op.Network(v)
    s = np.random.default_rng(0).normal(size=(1, op.HIDDEN)).astype(np.float32)
    total = sum(float(np.exp(net.log_probabilities(s, np.array([k]))[0][0])) for k in range(v.slots))
    assert abs(total - 1) < 1e-4
    assert op.softmax_count(4_000_000) > op.softmax_count(400_000) >= op.SLOT_COUNT
    many = op.Vocabulary([(b"%d" % k, 20) for k in range(20_000)], {}, 0, 400_000, 20_000)
    assert max(np.diff(many.bounds)) > op.CLASS_WORDS and many.neural == 20_000


def test_classes_cost_about_the_same():
    counts = [10_000_000 // (k + 10) for k in range(30_000)]
    tokens = sum(counts) + 7
    bounds = op.layout(counts, tokens)
    widths = np.diff(bounds)
    costs = [sum(counts[a:b]) * (b - a) / tokens for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    assert bounds[-1] == sum(c >= op.softmax_count(tokens) for c in counts) and widths[0] == op.CLASS_WORDS
    assert (np.diff(widths[:-1]) >= 0).all() and widths[-2] > 10 * widths[0]
    assert all(c >= 1 for c in costs[:-1]) and max(costs) < 2
    assert op.layout([], 0) == [0] and op.layout([3, 2], 5) == [0, 2]


def test_words_are_runs_of_anything_but_white_space():
    texts = [b"", None, b"  ", b" Two  words\t", b"\x0bA\x0cb\r\nC\x1cd\x85e\xc2\xa0f\n", b"\xff\xfe \x00 Z", "ÄÖ İ".encode(), b"one"]
    want = [(t or b"").lower().split() for t in texts]
    words, sizes = op._words(texts)
    assert words.to_pylist() == [w for t in want for w in t] and sizes.tolist() == [len(t) for t in want]
    assert op._words([])[1].tolist() == [] and op._words([b" "])[1].tolist() == [0]


def test_a_class_costs_the_root_of_the_classes():
    v = op.Vocabulary([(b"%d" % k, 10_000_000 // (k + 10)) for k in range(30_000)], {}, 7, 90_000_000, 30_001)
    assert v.groups[0] == 0 and v.groups[-1] == v.classes > 150
    assert len(v.groups) - 1 + max(np.diff(v.groups)) <= 2 * np.sqrt(v.classes) + 2
    net = op.Network(v)
    assert net.grp.shape[1] == len(v.groups) - 1
    s = np.random.default_rng(0).normal(size=(1, op.HIDDEN)).astype(np.float32)
    y = np.arange(v.slots)
    assert abs(np.exp(net.log_probabilities(np.repeat(s, len(y), axis=0), y)[0].astype(float)).sum() - 1) < 1e-3


def test_rows_of_a_slot_are_added_up():
    rng = np.random.default_rng(1)
    x, rows = (40 * rng.random(3_000) ** 3).astype(int), rng.normal(size=(3_000, 5)).astype(np.float32)
    order = np.argsort(x)
    starts = np.flatnonzero(np.diff(x[order], prepend=-1))
    want = np.zeros((40, 5))
    np.add.at(want, x, rows)
    assert np.allclose(op._sums_by(rows, order, starts), want[x[order][starts]], atol=1e-3)


def test_lanes_end_together():
    sizes = np.random.default_rng(2).integers(1, op.SEGMENT, 3_000)
    order = op.shuffled(sizes, 5)
    assert sorted(order) == list(range(3_000)) and (order != op.shuffled(sizes, 6)).any()
    starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    n = sum(1 for _ in op.windows(np.zeros(sizes.sum() + 1, np.int32), starts[order], (starts + sizes)[order]))
    assert n < 1.08 * sum(-(-sizes // op.STEPS)) / op.LANES
