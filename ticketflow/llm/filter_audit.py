"""Filter interaction audit with the potential of Hart and Mas-Colell.

Every document gets a mask of the filters it fails. In the removal game of a part of the corpus, a
coalition of filters is worth the documents that fail at least one of them. The potential is
computed recursively over all coalitions: P(S) = (v(S) + sum of P(S without i)) / |S|, P of none 0.
A filter's Shapley value is the potential of all filters less that of all without it; what a filter
removes at a step of an order is the difference of the coalitions before and after it. Potentials are
kept as |S|! P(S), so all numbers are whole.

Skew: only counts by (part, mask) are left after the first, partially summed, aggregation. Copies are
found by the SHA-256 of the text: rows of one text, filters and part are summed before texts are
compared, so a text that a third of all rows holds is a few rows by then.

Defined results: a null text is empty (and equals an empty one); a null part is the empty string; a null
doc_id has no labels, is no copy and makes none; of repeated rows with one doc_id neither is a copy of the
other; several labels of a document count if any is set; an empty table has no parts and no rows.
"""

from __future__ import annotations

import json
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketflow.llm.common import WHITE

LEAST_WORDS = 50
DISTINCT_PERCENT = 65
CAPITAL_PERCENT = 5
SYMBOLS = "[#$%&*|]"
#: Filters by letter; the last one fails copies and is found over the whole table.
NAMES = "ABCDE"


def text_mask(text: Column) -> Column:
    """Bits 0 to 3 of the mask: too few words, too few distinct ones, too many capitals, a symbol."""
    words = F.array_remove(F.split(text, WHITE, -1), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long")
    fails = (n < LEAST_WORDS, distinct * 100 < n * DISTINCT_PERCENT,
             capitals * 100 > F.length(text) * CAPITAL_PERCENT, text.rlike(SYMBOLS))
    return sum((F.when(f, 1 << k).otherwise(0) for k, f in enumerate(fails)), F.lit(0))


def masked_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): how many of ``docs`` (doc_id, text, source) fail exactly the filters
    of the mask, and how many of these ``labels`` (doc_id, quality, toxic) call good or toxic."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), text_mask(text).alias("mask"),
                       F.unhex(F.sha2(text.cast("binary"), 256)).alias("same"))
    # rows without an id join nothing, each text's at a place of its own
    rows = rows.withColumn("spread", F.when(F.col("doc_id").isNull(), F.xxhash64("same")).otherwise(0))
    rows = rows.groupBy("doc_id", "spread", "part", "mask", "same").agg(F.count("*").alias("n"))
    flag = lambda c: F.max(F.when(F.col(c) == 1, 1).otherwise(0)).alias(c)
    known = (labels.where("doc_id is not null").groupBy("doc_id").agg(flag("quality"), flag("toxic"))
             .withColumn("spread", F.lit(0).cast("long")))
    rows = rows.join(known, ["doc_id", "spread"], "left").select(
        "doc_id", "part", "mask", "same", "n", F.coalesce("quality", F.lit(0)).alias("good"),
        F.coalesce("toxic", F.lit(0)).alias("toxic"))
    # by text: the smallest id, and how many rows have it
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n")))
    texts = rows.groupBy("same", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("doc_id").isNotNull(), F.col("n")).otherwise(0)).alias("ids"),
        first.alias("first"))
    lowest = texts.groupBy("same").agg(F.min("first.doc_id").alias("lowest"))
    copies = F.coalesce(F.col("ids") - F.when(F.col("first.doc_id") == F.col("lowest"), F.col("first.n")).otherwise(0), F.lit(0))
    texts = texts.join(lowest, "same").withColumn("copies", copies)
    copy_bit = 1 << (len(NAMES) - 1)
    each = F.explode(F.array(
        F.struct(F.col("mask"), (F.col("n") - F.col("copies")).alias("n")),
        F.struct((F.col("mask") + copy_bit).alias("mask"), F.col("copies").alias("n"))))
    return (texts.select("part", "good", "toxic", each.alias("m")).select("part", "good", "toxic", "m.mask", "m.n")
            .groupBy("part", "mask").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"),
                                         F.sum(F.col("n") * F.col("toxic")).alias("toxic")))


def coalition_worths(counts: DataFrame, filters: int, column: str) -> Column:
    """By coalition (as a mask): the sum of ``column`` over rows that fail at least one of its filters."""
    hit = lambda s: F.sum(F.when(F.col("mask").bitwiseAND(F.lit(s)) != 0, F.col(column)).otherwise(0))
    return F.array(F.lit(0).cast("long"), *(hit(s) for s in range(1, 1 << filters)))


def potentials(worths: Column, filters: int) -> Column:
    """|S|! P(S) by coalition. Subsets have smaller masks, so one pass in their order finds all it needs."""
    def step(known: Column, s: Column) -> Column:
        smaller = sum((F.when(s.bitwiseAND(F.lit(1 << k)) != 0, F.get(known, s - (1 << k))).otherwise(0)
                       for k in range(filters)), F.lit(0).cast("long"))
        orders = F.element_at(F.array(*(F.lit(factorial(k)).cast("long") for k in range(filters))), F.bit_count(s))
        return F.array_append(known, orders * F.get(worths, s) + smaller)

    return F.aggregate(F.sequence(F.lit(1), F.lit((1 << filters) - 1)), F.array(F.lit(0).cast("long")), step)


def audit(counts: DataFrame, names: str = NAMES) -> DataFrame:
    """A row per part of ``counts`` (part, mask, n, good, toxic), order of the filters and step in it."""
    k, every = len(names), (1 << len(names)) - 1
    worth = {c: coalition_worths(counts, k, c).alias(c) for c in ("n", "good", "toxic")}
    parts = counts.groupBy("part").agg(F.sum("n").alias("total"), *worth.values())
    parts = parts.withColumn("potential", potentials(F.col("n"), k))
    steps = [{"filter_order": "".join(names[i] for i in order), "step": at + 1, "before": sum(1 << i for i in order[:at]),
              "filter": order[at]}
             for order in permutations(range(k)) for at in range(k)]
    listed = F.from_json(F.lit(json.dumps(steps)), "array<struct<filter_order:string,step:int,before:int,filter:int>>")
    rows = parts.select("*", F.explode(listed).alias("s")).select("*", "s.*")
    bit = F.expr("shiftleft(1, filter)")
    after, alone, without = F.col("before") + bit, bit, F.lit(every) - bit
    lost = lambda c: F.get(c, after) - F.get(c, F.col("before"))
    n = F.col("n")
    return rows.select(
        "part", "filter_order", "step", (F.col("total") - F.get(n, after)).alias("kept"), lost(n).alias("removed"),
        (F.get(n, alone) - lost(n)).alias("redundant"),
        (F.get(n, F.lit(every)) - F.get(n, without)).alias("unique_fails"),
        lost(F.col("good")).alias("good_lost"), lost(F.col("toxic")).alias("toxic_lost"),
        (F.get("potential", F.lit(every)) - F.get("potential", without) * k).alias("shapley"))


def audit_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return audit(masked_counts(docs, labels))


def oracle_sql() -> str:
    """The registered query in SQL: every order is run through."""
    letters = ", ".join(f"({k}, '{c}')" for k, c in enumerate(NAMES))
    return f"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
         min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS low
  FROM documents),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels
      WHERE doc_id IS NOT NULL GROUP BY doc_id),
m AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         (len(w) < {LEAST_WORDS})::INT + 2 * (100 * len(list_distinct(w)) < {DISTINCT_PERCENT} * len(w))::INT
         + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > {CAPITAL_PERCENT} * length(text))::INT
         + 8 * regexp_matches(text, '{SYMBOLS}')::INT + 16 * coalesce(doc_id > low, false)::INT AS mask
  FROM d LEFT JOIN l USING (doc_id)),
c AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY ALL),
f(k, name) AS (VALUES {letters}),
o AS (
  SELECT a.name || b.name || c.name || d.name || e.name AS filter_order, [a.k, b.k, c.k, d.k, e.k] AS ks
  FROM f a, f b, f c, f d, f e
  WHERE len(list_distinct([a.k, b.k, c.k, d.k, e.k])) = 5),
s AS (SELECT filter_order, step::INT AS step, ks[step] AS k, list_sum(list_transform(ks[:step - 1], lambda x: 1 << x)) AS before
      FROM (SELECT *, unnest(range(1, 6)) AS step FROM o)),
r AS (
  SELECT part, filter_order, step, k,
         sum(n) FILTER (WHERE mask & (coalesce(before, 0)::INT | (1 << k)) = 0) AS kept,
         sum(n) FILTER (WHERE mask & coalesce(before, 0)::INT = 0 AND mask & (1 << k) <> 0) AS removed,
         sum(n) FILTER (WHERE mask & coalesce(before, 0)::INT <> 0 AND mask & (1 << k) <> 0) AS redundant,
         sum(n) FILTER (WHERE mask = (1 << k)) AS unique_fails,
         sum(good) FILTER (WHERE mask & coalesce(before, 0)::INT = 0 AND mask & (1 << k) <> 0) AS good_lost,
         sum(toxic) FILTER (WHERE mask & coalesce(before, 0)::INT = 0 AND mask & (1 << k) <> 0) AS toxic_lost
  FROM c, s GROUP BY ALL)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
       coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
       coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       (sum(coalesce(removed, 0)) OVER (PARTITION BY part, k))::BIGINT AS shapley
FROM r"""
