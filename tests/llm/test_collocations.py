import re
from collections import Counter

import numpy as np
import pytest

from tests.llm.fixtures import awkward, documents, with_extras
from ticketflow.llm import collocations as op


def slow(rows, least, most, top, inside):
    """The rule, phrase by phrase, over rows of (lang, text)."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            w = [x for x in re.split("[ \t]+", piece) if x]
            n[lang] += len(w)
            for k in range(1, most + 1):
                f.update((lang, tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    cands = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    hidden = set()
    for (lang, p), a in cands.items():
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                part = (lang, p[i:i + k])
                if part in cands and 100 * a >= inside * cands[part]:
                    hidden.add(part)
    out = {}
    for (lang, p), a in cands.items():
        cuts = [(1_000_000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        if (lang, p) not in hidden:
            out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, rank, p.decode(), -a, left, right, n[lang], -s) for lang, found in out.items()
                  for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1))


def got(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in df.collect())


def texts(n, seed=0):
    """Repeated phrases among drawn words, in two languages and none."""
    rng = np.random.default_rng(seed)
    out = []
    for k in range(n):
        words = [f"w{x}" for x in rng.zipf(1.6, 40) if x < 60]
        words[3:3] = ["New", "York", "City"] if k % 2 else ["new", "york"]
        words[9:9] = ["la", "la", "la", "la"] if k % 3 else ["e.g.", "ad", "hoc"]
        out.append((k, " ".join(words).replace("w5 ", "w5, ").replace("w7 ", "w7\n"), ("en", "de", None)[k % 3]))
    return out


@pytest.mark.parametrize(("least", "most", "circle", "inside"), [(10, 3, 3, 50), (3, 4, 2, 80), (5, 2, 1, 50), (10, 3, 5, 20)])
def test_equals_brute_force(spark, least, most, circle, inside):
    rows = texts(160)
    docs = documents(spark, rows).repartition(5, "doc_id")
    found = got(op.collocations(docs, least, most, 25, inside, circle))
    assert found == slow([(r[2], r[1]) for r in rows], least, most, 25, inside)
    assert len(found) > 30


def test_phrases_that_become_active_late_are_counted_over_everything(spark, monkeypatch):
    """A phrase whose words do not occur in the shard scanned first."""
    rows = [(k, "filler text here", "en") for k in range(300)]
    monkeypatch.setattr(op, "CHUNK_BYTES", 100)  # a batch of 256 rows is a chunk, the rest another
    for k in range(260, 273):
        rows[k] = (k, "rare pair here again", "en")
    docs = documents(spark, rows).coalesce(1)
    assert got(op.collocations(docs)) == slow([(r[2], r[1]) for r in rows], 10, 3, 2000, 50)


def test_key_table_entries_may_clash(spark, monkeypatch):
    """With a table of 64 entries all phrases share them: more is counted, nothing is lost."""
    monkeypatch.setattr(op, "TABLE_BITS", 6)
    monkeypatch.setattr(op, "LEAST_TABLE_BITS", 6)
    rows = texts(90, 4)
    assert got(op.collocations(documents(spark, rows))) == slow([(r[2], r[1]) for r in rows], 10, 3, 2000, 50)


def test_scores_beyond_64_bits(spark):
    rows = [("en", 1, "x", 3_000_000_019), ("en", 1, "y", 3_000_000_000), ("en", 2, "x y", 2_999_999_929),
            ("en", 0, "", 9_000_000_000)]
    found = op.scored(spark.createDataFrame(rows, "lang string, length int, phrase string, n long")).first()
    a, left, right = 2_999_999_929, 3_000_000_019, 3_000_000_000
    assert found["score"] == 1_000_000 * a * a // (left * right) and found["n"] == 9_000_000_000


def test_ties_and_rank(spark):
    rows = [(k, f"a{k % 4} b{k % 4}. c{k % 4} d{k % 4}", "en") for k in range(80)]
    found = got(op.collocations(documents(spark, rows), top=5))
    assert [r[2] for r in found] == ["a0 b0", "a1 b1", "a2 b2", "a3 b3", "c0 d0"]
    assert {r[7] for r in found} == {1_000_000} and [r[1] for r in found] == [1, 2, 3, 4, 5]


def test_awkward_rows(spark):
    docs = with_extras(awkward(spark))
    rows = [(r["lang"], r["text"]) for r in docs.select("lang", "text").collect()]
    assert got(op.collocations(docs)) == slow(rows, 10, 3, 2000, 50)
    assert op.collocations(documents(spark, [])).count() == 0
    assert op.collocations(documents(spark, [(1, None), (2, "")])).count() == 0


def test_long_text_and_copies(spark):
    long = "tick tock " * 60_000 + "\U0001f600 ẞ " * 20
    rows = [(1, long, "en"), *((k, "same old text", "en") for k in range(2, 400))]
    assert got(op.collocations(documents(spark, rows))) == slow([(r[2], r[1]) for r in rows], 10, 3, 2000, 50)
