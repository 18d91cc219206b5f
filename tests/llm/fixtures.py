"""Small tables with the awkward cases that every operator has to take."""

from __future__ import annotations

import os

import pytest

TINY, SMALL = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
needs_tables = pytest.mark.skipif(not os.path.isdir(TINY), reason="driver tables not present")

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    """Rows of (doc_id, text[, lang[, source]])."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "src1",
             len(r[1]) if r[1] is not None else None) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda my ny xi omikron pi rho sigma tau".split()


def prose(n, salt=0):
    return " ".join(WORDS[(k * k + 3 * k + salt * (k + 7)) % len(WORDS)] + str((k * (salt + 1)) % 11)
                    for k in range(n))


def awkward(spark):
    """Nulls in every column, empty, blank and long texts, copies and repeated rows."""
    return documents(spark, [
        (1, prose(80)), (2, prose(80)), (2, prose(80)), (3, None), (4, ""), (5, " \t\n "), (6, "one two"),
        (7, prose(60, 3), None, None), (None, prose(80)), (None, None, None, None), (8, prose(30_000, 5), "de", "src2"),
        (9, "!!! ### 123 456"), (10, "Ünïcödé ẞ 漢字 \U0001f600 text", "de", "src3")])


def with_extras(docs):
    """Extra columns whose names an operator may use itself."""
    from pyspark.sql import functions as F

    names = ("fp", "root", "slot", "shard", "score", "epoch", "domain", "d", "key", "item_id", "word", "n_tokens",
             "cutoff", "rule", "vec_id", "quality", "held_out", "predicted", "component_id", "order", "payload")
    return docs.withColumns({n: F.lit("x") for n in names})
