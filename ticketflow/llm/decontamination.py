"""Benchmark decontamination with spaced seeds.

A seed is a hash of the words that a fixed mask selects from a run of words, so a substituted
word at a position that the mask ignores does not hide the run. Seeds of the benchmark meet
seeds of the documents in an equality join; around each hit the words are then compared along
its diagonal. A document is contaminated by an item if somewhere on that diagonal ``WINDOW``
words in a row (the whole item, if shorter) hold ``SUBSTITUTIONS`` differing ones at most, in
proportion for shorter items. Any such full window holds a seed of the masks below (a test
goes through all cases), and so does any such run of an item of 10 words or more. For shorter
items the whole item is a seed, without each choice of the words that may differ; it meets the
runs of its length in the documents.

Words are lower-cased runs of letters and digits. Only DataFrame functions are used.

Defined results: null and empty texts, and documents with fewer words than the window, match
nothing; an item of up to 6 words has to occur word for word; in a script without spaces, a clause
counts as one word; repeated documents are judged alike and reported once
for each doc_id and item_id (either may be null); an empty benchmark contaminates nothing.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketflow.llm.common import broadcast_if_small, row_key, staged

#: Positions that a mask selects; the others within its span are ignored.
MASKS = ((0, 1, 2, 3, 5, 6), (0, 1, 2, 4, 7, 8))
WINDOW = 13
SUBSTITUTIONS = 2
#: Rows up to which the benchmark's seeds, or the hits, are broadcast; beyond, both are shuffled.
BROADCAST_SEEDS = 500_000
BROADCAST_HITS = 100_000


def _allowed(n: int) -> int:
    """How many words of an item of ``n`` words may differ."""
    return n * SUBSTITUTIONS // WINDOW


def _seeded(n: int) -> bool:
    """Whether any copy of ``n`` words that differs in the allowed number holds a seed."""
    return all(any(not {s + k for k in mask} & set(bad) for mask in MASKS for s in range(n - mask[-1]))
               for bad in combinations(range(n), _allowed(n)))


#: Lengths of items that the masks alone would miss.
SHORT = tuple(n for n in range(1, WINDOW) if not _seeded(n))

_SPLIT = r"[^\p{L}\p{N}]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), _SPLIT), "")


def _seeds(w: Column) -> Column:
    """All seeds of a word array, mask after mask."""
    def of(n: int, mask: tuple[int, ...]) -> Column:
        span = mask[-1] + 1
        starts = F.when(F.size(w) >= span, F.sequence(F.lit(0), F.size(w) - span)).otherwise(
            F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.xxhash64(
            F.lit(n), *(w[i + F.lit(k)] for k in mask)))
    return F.concat(*(of(n, m) for n, m in enumerate(MASKS)))


def _start(at: Column, size: Column) -> Column:
    """The word at which the ``at``-th of all seeds starts."""
    left, out = at, None
    for mask in MASKS:
        here = F.greatest(size - mask[-1], F.lit(0))
        now = F.when(left < here, left)
        out = now if out is None else F.coalesce(out, now)
        left = left - here
    return out


def _exploded(rows: DataFrame, key: str) -> DataFrame:
    """(key, start, seed) for rows of (key, w), words or their hashes.

    The seeds are a column of their own before they are exploded, and null ones are dropped
    after: so they are computed once, and the explode itself is compiled."""
    seeds = rows.select(key, F.size("w").alias("n"), _seeds(F.col("w")).alias("s"))
    return seeds.select(key, "n", F.posexplode_outer("s").alias("at", "seed")).select(
        key, _start(F.col("at"), F.col("n")).alias("start"), "seed").where("seed is not null")


def _runs(rows: DataFrame, key: str, lengths: list[int], whole: bool = False) -> DataFrame:
    """(key, start, seed) for runs of the given short lengths, each without every choice of the
    words that may differ; with ``whole``, for rows that are such a run."""
    w = F.col("w")

    def of(n: int, left_out: tuple[int, ...]) -> Column:
        fits = F.size(w) == n if whole else F.size(w) >= n
        starts = F.when(fits, F.sequence(F.lit(0), F.size(w) - n)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.struct(i.alias("start"), F.xxhash64(
            F.lit(f"{n} {left_out}"), *(w[i + F.lit(k)] for k in range(n) if k not in left_out)).alias("seed")))

    runs = F.concat(*(of(n, out) for n in lengths for out in combinations(range(n), _allowed(n))))
    # as in ``_exploded``: a plain explode would have its filter compute the words anew for every start
    return (rows.select(key, runs.alias("s")).select(key, F.explode_outer("s").alias("s"))
            .select(key, "s.start", "s.seed").where("seed is not null"))


def _hashed(words_: Column) -> Column:
    return F.transform(words_, lambda x: F.xxhash64(x))


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_key, doc_id, item_id, window, matched): verified overlaps, one row for each document
    content and item; matched is the most equal words in a window."""
    items = staged(benchmark.select(row_key(F.col("item_id"), F.col("text")).alias("item_key"),
                                    "item_id", words(F.col("text")).alias("w"))
                   .where("w is not null").dropDuplicates(["item_key"]), "items")
    short = sorted(r["n"] for r in items.select(F.size("w").alias("n")).where(F.col("n").isin(*SHORT))
                   .distinct().collect())
    item_words = items.select("item_key", _hashed(F.col("w")).alias("w"))
    rows = docs.select(row_key(F.col("doc_id"), F.col("text")).alias("doc_key"),
                       _hashed(words(F.col("text"))).alias("w"))
    item_seeds, doc_seeds = _exploded(item_words, "item_key"), _exploded(rows, "doc_key")
    if short:
        item_seeds = item_seeds.unionByName(_runs(item_words, "item_key", short, whole=True))
        doc_seeds = doc_seeds.unionByName(_runs(rows, "doc_key", short))
    seeds = staged(item_seeds.withColumnRenamed("start", "item_start"), "item_seeds")
    hits = staged(doc_seeds.join(broadcast_if_small(seeds, BROADCAST_SEEDS), "seed")
                  .select("doc_key", "item_key", (F.col("start") - F.col("item_start")).alias("d"))
                  .distinct(), "hits")
    keyed = docs.select("doc_id", "text", row_key(F.col("doc_id"), F.col("text")).alias("doc_key"))
    pairs = (keyed.join(broadcast_if_small(hits, BROADCAST_HITS), "doc_key")
             .join(broadcast_if_small(items, BROADCAST_HITS).withColumnRenamed("w", "iw"), "item_key")
             .withColumn("dw", words(F.col("text"))))
    first = F.greatest(F.lit(0), -F.col("d"))
    aligned = pairs.withColumn("first", first).withColumn(
        "long", F.least(F.size("iw"), F.size("dw") - F.col("d")) - F.col("first")).withColumn(
        "window", F.least(F.lit(WINDOW), F.size("iw"))).where("long >= window")
    equal = F.zip_with(F.slice("dw", F.col("first") + F.col("d") + 1, F.col("long")),
                       F.slice("iw", F.col("first") + 1, F.col("long")),
                       lambda a, b: (a == b).cast("int"))
    best = F.array_max(F.transform(
        F.sequence(F.lit(0), F.col("long") - F.col("window")),
        lambda s: F.aggregate(F.slice("equal", s + 1, F.col("window")), F.lit(0), lambda x, y: x + y)))
    # written, as the windows below would compare the words anew for every start
    compared = staged(aligned.select("doc_key", "doc_id", "item_id", "window", "long",
                                     equal.alias("equal")), "aligned")
    return (compared.withColumn("matched", best)
            .where(F.col("matched") >= F.col("window")
                   - F.floor(F.col("window") * SUBSTITUTIONS / WINDOW))
            .groupBy("doc_key", "doc_id", "item_id")
            .agg(F.max("window").alias("window"), F.max("matched").alias("matched")))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, window, matched) for every document and item that overlap."""
    return (overlaps(docs, benchmark).groupBy("doc_id", "item_id")
            .agg(F.max("window").alias("window"), F.max("matched").alias("matched")))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that overlap with no item. Columns as in ``docs``."""
    bad = staged(overlaps(docs, benchmark).select(F.col("doc_key").alias("__key")).distinct(), "leaks")
    return (docs.withColumn("__key", row_key(F.col("doc_id"), F.col("text")))
            .join(broadcast_if_small(bad, BROADCAST_HITS), "__key", "left_anti").drop("__key"))


def oracle_sql() -> str:
    """``contaminated`` in SQL, with the selected words themselves in place of their hashes."""
    split = "list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> '')"
    seeds = lambda t, k, s: " UNION ALL ".join(
        f"SELECT {k}, i AS {s}, [{n}::VARCHAR, {', '.join(f'w[i + {p + 1}]' for p in m)}] AS seed "
        f"FROM {t}, LATERAL (SELECT unnest(range(0, len(w) - {m[-1]})) AS i)"
        for n, m in enumerate(MASKS))
    return f"""
WITH d AS (SELECT doc_id, {split} AS w FROM documents WHERE text IS NOT NULL),
b AS (SELECT item_id, {split} AS w FROM benchmark WHERE text IS NOT NULL),
ds AS ({seeds('d', 'doc_id', 'ds')}), bs AS ({seeds('b', 'item_id', 'bs')}),
hits AS (SELECT DISTINCT doc_id, item_id, ds.ds - bs.bs AS g FROM ds JOIN bs USING (seed)),
pairs AS (SELECT h.*, d.w AS dw, b.w AS iw, least({WINDOW}, len(b.w)) AS win,
                 greatest(0, -g) AS lo, least(len(b.w), len(d.w) - g) AS hi
          FROM hits h JOIN d USING (doc_id) JOIN b USING (item_id)),
best AS (SELECT doc_id, item_id, win, list_max(list_transform(range(lo, hi - win + 1),
           lambda s: list_sum(list_transform(range(s, s + win),
             lambda j: (dw[j + g + 1] = iw[j + 1])::INT)))) AS matched
         FROM pairs WHERE hi - lo >= win)
SELECT doc_id, item_id, max(win)::INT AS "window", max(matched)::INT AS matched FROM best
WHERE matched >= win - floor(win * {SUBSTITUTIONS} / {WINDOW}) GROUP BY ALL"""
