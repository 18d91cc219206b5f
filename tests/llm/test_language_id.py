import numpy as np

from tests.llm.fixtures import SMALL, awkward, documents, needs_tables, prose, with_extras
from ticketflow.llm import language_id as op
from ticketflow.llm import queries


@needs_tables
def test_held_out_accuracy(spark):
    got = queries.op8_language_id(spark, SMALL)
    langs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang")
    rows = got.join(langs, "doc_id").where("held_out and lang_pred <> 'und'").collect()
    assert len(rows) > 200 and np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.97
    assert got.count() == 1000 and all(0 <= r["score"] <= 1 for r in got.collect())


def test_windows_cover_the_whole_text():
    for n in (0, 1, 127, 128, 129, 5000):
        text = bytes(1 + k % 250 for k in range(n))
        x = op.windows(text)
        assert x.shape == (max(1, -(-n // op.WINDOW)), op.WINDOW + op._PAD)
        assert b"".join(w[:op.WINDOW].tobytes() for w in x)[:n] == text


def test_network_equals_a_plain_convolution():
    net = op.ByteNet(3)
    x = op.windows(prose(40).encode())
    want = []
    for w in x:
        top = []
        for table in net.tables:
            for f in range(op.FILTERS):
                top.append(max(0.0, max(sum(float(table[k][w[p + k], f]) for k in range(len(table)))
                                        for p in range(op.WINDOW))))
        z = np.array(top) @ net.out + net.bias
        want.append(np.exp(z) / np.exp(z).sum())
    assert np.allclose(net.probabilities(x), want, atol=1e-5)


def test_training_lowers_the_loss():
    x = np.concatenate([op.windows(b"abab " * 600), op.windows(b"xyz xyz " * 400)])
    y = np.array([0] * len(op.windows(b"abab " * 600)) + [1] * len(op.windows(b"xyz xyz " * 400)))
    net = op.ByteNet(2)
    net.train(x, y)
    assert (net.probabilities(x).argmax(axis=1) == y).all()


def test_a_step_follows_the_gradient():
    """One step of Adam goes against the sign of the numeric gradient, wherever there is one."""
    x = np.concatenate([op.windows(prose(60, k).encode())[:2] for k in range(3)])
    y = np.array([0, 0, 1, 1, 2, 2])
    net = op.ByteNet(3)
    net.tables = [[t.astype(np.float64) for t in table] for table in net.tables]
    net.out, net.bias = net.out.astype(np.float64), net.bias.astype(np.float64)
    loss = lambda: -float(np.log(net.probabilities(x)[np.arange(6), y].astype(np.float64)).mean())
    parts = {"out": net.out, "bias": net.bias, **{(n, k): t for n, table in enumerate(net.tables) for k, t in enumerate(table)}}
    want, rng = {}, np.random.default_rng(0)
    for name, a in parts.items():
        at = [tuple(i) for i in rng.permutation(np.argwhere(np.ones(a.shape, bool)))[:12]] if isinstance(name, str) else [
            (int(b), int(f)) for b, f in zip(rng.choice(x[:, :op.WINDOW].ravel(), 12), rng.integers(0, op.FILTERS, 12), strict=True)]
        for i in at:
            was, eps = a[i], 1e-6
            a[i] = was + eps
            up = loss()
            a[i] = was - eps
            down = loss()
            a[i] = was
            if abs(up - down) > 2e-4 * eps and (isinstance(name, str) or i[0]):  # padding does not learn
                want[name, i] = (up - down) / (2 * eps)
    before = {k: a.copy() for k, a in parts.items()}
    net._step(x, y, 0.01, state := {})
    assert len(want) > 15
    for (name, i), slope in want.items():
        assert np.sign(before[name][i] - parts[name][i]) == np.sign(slope)
        assert abs(state[name][0][i] * 10 - slope) < 0.01 * abs(slope) + 1e-6  # the first moment is a tenth of it


def test_texts_are_averaged_over_all_their_windows(monkeypatch):
    monkeypatch.setattr(op, "_TEXT_CHUNK", 7)
    net = op.ByteNet(4)
    texts = [prose(n, n).encode() for n in (1, 300, 2, 40, 3, 3, 90)] + [b""]
    got = op.mean_probabilities(net, texts)
    for text, p in zip(texts, got, strict=True):
        assert np.allclose(p, net.probabilities(op.windows(text)).mean(axis=0, dtype=np.float64), atol=1e-6)
    assert op.mean_probabilities(net, []) == []


def test_rare_languages_are_learned(spark):
    share = op.quotas({"en": 1_000_000, "de": 50_000, "is": 90}, 2_400)
    assert share["is"] == 1 and abs(share["en"] * 1_000_000 - 1155) < 1 and abs(share["de"] * 50_000 - 1155) < 1
    assert op.quotas({"a": 3, "b": 5}, 100) == {"a": 1, "b": 1} and op.quotas({}, 5) == {}
    rows = [(k, prose(30, k % 3), "en") for k in range(600)] + [(600 + k, "þetta æðir ðó " * 20, "is") for k in range(8)]
    langs, _ = op.train(documents(spark, rows), 40)
    assert langs == ["en", "is"]


def test_awkward_rows(spark):
    docs = with_extras(awkward(spark))
    got = op.identify(docs).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == 13
    for k in (3, 4, 5, 9):
        assert (by[k]["lang_pred"], by[k]["score"]) == ("und", 0.0)
    assert by[1]["lang_pred"] in ("en", "de") and 0 <= by[1]["score"] <= 1


def test_nothing_to_learn_from(spark):
    docs = documents(spark, [(1, "words", None), (2, None, "en")])
    assert {r["lang_pred"] for r in op.identify(docs).collect()} == {"und"}
    assert op.identify(documents(spark, [])).count() == 0
