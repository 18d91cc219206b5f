"""Phrase collocations by dynamic itemset counting.

The documents are dealt out to ``SHARDS`` shards, which are scanned in a circle. Words are counted
from the first scan on. After each scan, the phrases that occurred ``LEAST`` times so far are
looked up, and a phrase one word longer becomes active once both its subphrases (without the last
word, without the first) are among them. From the scan in which it became active, a phrase is counted
for one full circle, so over every document once; lengths are thus counted side by side, and the
scans end when no phrase is left whose circle is open.

Texts are turned into numbers of words once, in chunks of many documents with the chunk's words beside
them, and scans read these. While scans run, phrases are known by keys. What a task needs to know
of the shorter phrases is a table of a byte an entry per length, indexed by the first bits of the key: the
scan from which on. Keys that share an entry only make a phrase active too early (and it is then counted
for that circle), never too late. A table has an entry for each ``BYTES_AN_ENTRY`` bytes of text and
``1 << TABLE_BITS`` at most, so what tasks get is bounded whatever the corpus. The phrases whose keys
reach the threshold are counted once more, word by word, in a last scan, so counts are exact.

Skew: counts are summed by chunk before they are shuffled, as sorted arrays by ranges of keys (as many
ranges as the corpus needs), so a frequent phrase is one number per chunk and languages do not matter; the
best of a language are chosen among the best of its ``TOP_SALTS`` parts.

Defined results: a null or empty text has no words; a null lang counts as ``und``; repeated rows count
each; ties of the score go to the higher count, then to the phrase in byte order; a lang without
candidates has no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from ticketflow.llm.common import Shared, small_batches, staged

LEAST = 10
MOST_WORDS = 3
#: A phrase goes if a longer one has this share of its occurrences, in percent.
INSIDE_PERCENT = 50
TOP = 2000
SHARDS = 3
TABLE_BITS, LEAST_TABLE_BITS = 24, 12
BYTES_AN_ENTRY = 32
TOP_SALTS = 32
#: Bytes of text in a chunk, beside one batch, and bytes of text to a range of keys.
CHUNK_BYTES = 3 << 20
BYTES_A_RANGE = 4 << 20
NEVER = 255

_BREAK = re.compile(rb"[.,;:!?\n-\r]")


class _Numbers(dict):
    """Numbers of the words of one language, drawn from ``words``; what ends a piece has number 0."""

    def __init__(self, lang: int, words: list, langs: list):
        super().__init__({b".": 0})
        self.lang, self.words, self.langs = lang, words, langs

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self.words)
        self.words.append(word)
        self.langs.append(self.lang)
        return n


class Chunk:
    """Texts of many documents as numbers of words; 0 stands between pieces and between texts."""

    def __init__(self, numbers: np.ndarray, words: list[bytes], langs: list[bytes], lang_of: np.ndarray):
        #: ``words[n]`` is word n (n > 0), of language ``langs[lang_of[n]]``
        self.numbers, self.words, self.langs, self.lang_of = numbers, words, langs, lang_of

    @classmethod
    def of(cls, rows: list[tuple[bytes, bytes | None]]) -> Chunk:
        """From rows of (lang, text)."""
        words, lang_of, known, parts = [b""], [0], {}, []
        for lang, text in rows:
            number = known.get(lang)
            if number is None:
                number = known[lang] = _Numbers(len(known), words, lang_of)
            found = _BREAK.sub(b" . ", (text or b"").lower()).split()
            found.append(b".")
            parts.append(np.fromiter(map(number.__getitem__, found), np.int32, len(found)))
        return cls(np.concatenate(parts), words, list(known), np.array(lang_of, np.int32))

    SCHEMA = "shard int, numbers binary, words binary, langs binary, lang_of binary"

    def row(self, shard: int) -> pa.RecordBatch:
        # words hold no line break; langs may, so these are told apart by their lengths
        sizes = np.array([len(x) for x in self.langs], np.int32).tobytes()
        packed = np.int32(len(self.langs)).tobytes() + sizes + b"".join(self.langs)
        return pa.RecordBatch.from_arrays(
            [pa.array([shard], pa.int32()), *(pa.array([x], pa.binary()) for x in (
                self.numbers.tobytes(), b"\n".join(self.words), packed, self.lang_of.tobytes()))],
            ["shard", "numbers", "words", "langs", "lang_of"])

    @classmethod
    def read(cls, numbers: bytes, words: bytes, langs: bytes, lang_of: bytes) -> Chunk:
        n = int(np.frombuffer(langs, np.int32, 1)[0])
        ends = 4 + 4 * n + np.cumsum(np.frombuffer(langs, np.int32, n, 4))
        starts = [4 + 4 * n, *ends[:-1].tolist()] if n else []
        return cls(np.frombuffer(numbers, np.int32), words.split(b"\n"),
                   [langs[i:j] for i, j in zip(starts, ends.tolist(), strict=True)], np.frombuffer(lang_of, np.int32))

    def keys(self) -> np.ndarray:
        """Of each word with its language."""
        heads = [x + b"\n" for x in self.langs]
        of = self.lang_of.tolist()
        return np.fromiter((xxhash.xxh64_intdigest(heads[k] + w) for k, w in zip(of, self.words, strict=True)),
                           np.uint64, len(self.words))


def longer_key(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Keys of phrases from the keys of their first words and of the last word."""
    x = first * np.uint64(0x9E3779B97F4A7C15) ^ (last * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(0x165667B19E3779F9))
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x9E3779B97F4A7C15)
    return x


def at(keys: np.ndarray, entries: int) -> np.ndarray:
    """Where keys stand in a table of so many entries (a power of two): by their first bits."""
    return (keys >> np.uint64(65 - entries.bit_length())).astype(np.int64)


def packed(table: np.ndarray, empty: int) -> tuple:
    """What ``unpacked`` needs to make ``table`` again; the smaller of all entries and those set."""
    where = np.flatnonzero(table != empty)
    if len(where) * 5 > len(table):
        return len(table), None, table
    return len(table), where.astype(np.int32), table[where]


def unpacked(size: int, where: np.ndarray | None, values: np.ndarray, empty: int) -> np.ndarray:
    if where is None:
        return values
    out = np.full(size, empty, values.dtype)
    out[where] = values
    return out


def phrases(numbers: np.ndarray, keys: np.ndarray, most: int):
    """(length, starts, keys) of all phrases within pieces, for each length up to ``most``."""
    is_word = np.append(numbers > 0, False)
    starts = np.flatnonzero(is_word)
    now = keys[numbers[starts]]
    for length in range(1, most + 1):
        yield length, starts, now
        if length < most:
            fits = is_word[starts + length]  # a piece has an end, so this stays inside
            starts, now = starts[fits], now[fits]
            now = longer_key(now, keys[numbers[starts + length]])


def shortened(keys: np.ndarray, ranges: int) -> np.ndarray:
    """The first bits of keys: those that tell the range, and 32 more. There are as many ranges as the corpus
    needs, so the share of keys that fall together is the same at any size."""
    return keys >> np.uint64(33 - ranges.bit_length())


def entry(short: np.ndarray, entries: int, ranges: int) -> np.ndarray:
    """Where the keys that ``short`` came from stand in a table."""
    return (short >> np.uint64(32 + ranges.bit_length() - entries.bit_length())).astype(np.int64)


def _ranges(length: int, short: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """A row per range of keys: (length, range, keys, n), for sorted ``short`` keys."""
    keys, part = (short & np.uint64(0xFFFFFFFF)).astype(np.uint32), (short >> np.uint64(32)).astype(np.int32)
    first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(keys) else np.zeros(0, int)
    last = [*first[1:].tolist(), len(keys)]
    spans = list(zip(first.tolist(), last, strict=False))
    return pa.RecordBatch.from_arrays(
        [pa.array([length] * len(spans), pa.int32()), pa.array(part[first]),
         pa.array([keys[i:j].tobytes() for i, j in spans], pa.binary()),
         pa.array([n[i:j].astype(np.int64).tobytes() for i, j in spans], pa.binary())], ["length", "range", "keys", "n"])


_COUNTS = "length int, range int, keys binary, n binary"


def _summed(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The keys of a range, each once, with their sums."""
    keys = np.concatenate([np.frombuffer(k, np.uint32) for k in pdf["keys"]])
    n = np.concatenate([np.frombuffer(x, np.int64) for x in pdf["n"]])
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, int)
    return keys[first], np.add.reduceat(n[order], first) if len(keys) else n


def _bits(keys: np.ndarray, part: int, entries: int, ranges: int) -> bytes:
    """Which of the table entries of a range ``keys`` fall on, as bits."""
    own = entries // ranges
    out = np.zeros(own, bool)
    out[entry(keys.astype(np.uint64) | np.uint64(part << 32), entries, ranges) - part * own] = True
    return np.packbits(out).tobytes()


def _collected(rows: DataFrame, entries: int, ranges: int) -> np.ndarray:
    """A table's bits from those of its ranges: (range, bits). ``entries`` bits of each scan reach the
    driver, 2 MB at most."""
    out, own = np.zeros(entries, bool), entries // ranges
    for r in rows.collect():
        out[r["range"] * own:(r["range"] + 1) * own] |= np.unpackbits(np.frombuffer(r["bits"], np.uint8), count=own).view(bool)
    return out


def _scan(chunks: DataFrame, scan: int, circle: int, tables: list[np.ndarray], most: int, ranges: int,
          heavy: int) -> DataFrame:
    """(length, range, keys, n, bits) of what is active in this scan, over the shard it reads; bits are the
    entries of keys that were found ``heavy`` times."""
    shared, entries = Shared(chunks.sparkSession, [packed(t, NEVER) for t in tables]), len(tables[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [unpacked(*t, NEVER) for t in shared.value()]
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                chunk = Chunk.read(*row)
                keys, before = chunk.keys(), None
                for length, starts, mine in phrases(chunk.numbers, keys, most):
                    if length == 1:
                        if scan < circle:
                            n = np.bincount(chunk.numbers, minlength=len(keys))[1:]
                            order = np.argsort(keys[1:], kind="stable")
                            yield _ranges(1, shortened(keys[1:][order], ranges), n[order])
                    else:
                        since = np.maximum(before[starts], before[starts + 1])
                        due = mine[(since <= scan) & (scan - circle < since.astype(np.int16))]
                        yield _ranges(length, *np.unique(shortened(due, ranges), return_counts=True))
                    if length < most:  # the scan in which phrases of this length were known, by where they start
                        before = np.full(len(chunk.numbers) + 1, NEVER, np.uint8)
                        before[starts] = tables[length - 1][at(mine, entries)]
        pa.default_memory_pool().release_unused()  # the worker is kept for other tasks

    def total(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        keys, n = _summed(pdf)
        return pd.DataFrame({"length": [key[0]], "range": [key[1]], "keys": [keys.tobytes()], "n": [n.tobytes()],
                             "bits": [_bits(keys[n >= heavy], int(key[1]), entries, ranges)]})

    return (chunks.select("numbers", "words", "langs", "lang_of").mapInArrow(run, _COUNTS)
            .groupBy("length", "range").applyInPandas(total, _COUNTS + ", bits binary"))


def _reached(counts: list[DataFrame], length: int, least: int, entries: int, ranges: int) -> np.ndarray:
    """The table entries of phrases counted ``least`` times so far. A phrase is counted in one circle of
    scans, one of which holds its share of the threshold; only keys on such entries are summed."""
    mine = reduce(DataFrame.unionByName, (c.where(F.col("length") == length) for c in counts))
    shared = Shared(mine.sparkSession, packed(_collected(mine.select("range", "bits"), entries, ranges), False))

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = unpacked(*shared.value(), False)
        for b in batches:
            for part, keys, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
                short = np.frombuffer(keys, np.uint32).astype(np.uint64) | np.uint64(part << 32)
                kept = wanted[entry(short, entries, ranges)]
                yield _ranges(length, short[kept], np.frombuffer(n, np.int64)[kept])

    def reached(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        keys, n = _summed(pdf)
        return pd.DataFrame({"range": [key[0]], "bits": [_bits(keys[n >= least], int(key[0]), entries, ranges)]})

    return _collected(mine.select("range", "keys", "n").mapInArrow(within, _COUNTS).groupBy("range")
                      .applyInPandas(reached, "range int, bits binary"), entries, ranges)


def active_entries(shards: DataFrame, circle: int, least: int, most: int, entries: int, ranges: int) -> list[np.ndarray]:
    """For each length the table entries of the phrases whose keys occur ``least`` times, found by
    cyclic scans over ``shards`` (chunks with their shard)."""
    tables = [np.full(entries, NEVER, np.uint8) for _ in range(max(1, most - 1))]
    counts, scan, last = [], 0, 0  # last: the latest scan in which a phrase became active
    while scan < last + circle:
        counts.append(staged(_scan(shards.where(F.col("shard") == scan % circle), scan, circle, tables, most, ranges,
                                   ceil(least / circle)), "phrase_counts"))
        for length in range(1, most):
            # phrases of this length are counted from scan length - 1 on at the earliest, and no longer
            # than a circle after the shorter ones, all of which are known once their circle is over
            if length - 1 <= scan < length * circle:
                fresh = _reached(counts[length - 1:], length, least, entries, ranges) & (tables[length - 1] == NEVER)
                if fresh.any():
                    tables[length - 1][fresh] = last = scan + 1
        scan += 1
    return [*(t != NEVER for t in tables[:most - 1]), _reached(counts[most - 1:], most, least, entries, ranges)]


def count_exactly(chunks: DataFrame, wanted: list[np.ndarray]) -> DataFrame:
    """(lang, length, phrase, n) of phrases whose keys fall on ``wanted``; length 0 has all words."""
    shared, entries = Shared(chunks.sparkSession, [packed(w, False) for w in wanted]), len(wanted[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = [unpacked(*w, False) for w in shared.value()]

        def rows(langs: pa.Array, length: int, phrase: pa.Array, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [langs, pa.array(np.full(len(n), length, np.int32)), phrase, pa.array(n.astype(np.int64))],
                ["lang", "length", "phrase", "n"])

        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                chunk = Chunk.read(*row)
                numbers, names, langs = chunk.numbers, pa.array(chunk.words, pa.binary()), pa.array(chunk.langs, pa.binary())
                in_all = np.bincount(chunk.lang_of[numbers[numbers > 0]], minlength=len(chunk.langs))
                yield rows(langs, 0, pa.array([b""] * len(langs), pa.binary()), in_all)
                for length, starts, keys in phrases(numbers, chunk.keys(), len(wanted)):
                    starts = starts[wanted[length - 1][at(keys, entries)]]
                    group = numbers[starts].astype(np.int64)
                    for k in range(1, length):  # the first words as one number, with the next word
                        if k > 1:
                            _, group = np.unique(group, return_inverse=True)
                        group = group << 32 | numbers[starts + k]
                    _, one, n = np.unique(group, return_index=True, return_counts=True)
                    if len(n):
                        first = starts[one]
                        spelt = [names.take(pa.array(numbers[first + k])) for k in range(length)]
                        phrase = spelt[0] if length == 1 else pc.binary_join_element_wise(*spelt, b" ")
                        yield rows(langs.take(pa.array(chunk.lang_of[numbers[first]])), length, phrase, n)
        pa.default_memory_pool().release_unused()

    # few and long tasks: a frequent phrase is a row for each of them
    tasks = 2 * chunks.sparkSession.sparkContext.defaultParallelism
    return (chunks.select("numbers", "words", "langs", "lang_of").coalesce(tasks)
            .mapInArrow(run, "lang binary, length int, phrase binary, n long")
            .groupBy("lang", "length", "phrase").agg(F.sum("n").alias("n"))
            .withColumns({c: F.col(c).cast("string") for c in ("lang", "phrase")}))


def in_chunks(docs: DataFrame, circle: int) -> tuple[DataFrame, int]:
    """``docs`` (lang, text) as chunks, dealt out to shards; and their bytes. Staged."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size, shard = [], 0, TaskContext.get().partitionId()
        for b in batches:
            rows += zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)
            size += b.column(1).nbytes
            if size > CHUNK_BYTES:
                yield Chunk.of(rows).row(shard % circle)
                rows, size, shard = [], 0, shard + 1
        if rows:
            yield Chunk.of(rows).row(shard % circle)
        pa.default_memory_pool().release_unused()

    rows = docs.select(F.coalesce("lang", F.lit("und")).cast("binary").alias("lang"), F.col("text").cast("binary").alias("text"))
    seen = Observation()
    chunks = rows.mapInArrow(run, Chunk.SCHEMA).observe(seen, F.sum(F.length("numbers")).alias("n"))
    out = staged(chunks, "phrase_shards", by=["shard"])
    return out, seen.get["n"] or 0


def counted_phrases(docs: DataFrame, least: int = LEAST, most: int = MOST_WORDS, circle: int = SHARDS) -> DataFrame:
    """(lang, length, phrase, n): all words' number (length 0, phrase ''), and the words and the phrases
    of up to ``most`` words that occur ``least`` times in ``docs`` (lang, text)."""
    spark = docs.sparkSession
    small_batches(spark)
    shards, size = in_chunks(docs, circle)
    small_batches(spark, 1)  # a row is a chunk from here on, or a range of keys
    # tables and ranges are as large as the corpus needs, and nothing but cost hangs on either
    entries = 1 << min(TABLE_BITS, max(LEAST_TABLE_BITS, (size // BYTES_AN_ENTRY).bit_length()))
    ranges = min(entries, 1 << max(4, (size // BYTES_A_RANGE).bit_length()))
    wanted = active_entries(shards, circle, least, most, entries, ranges)
    out = staged(count_exactly(shards, wanted).where((F.col("n") >= least) | (F.col("length") == 0)), "phrases")
    small_batches(spark)
    return out


def scored(counted: DataFrame) -> DataFrame:
    """(lang, phrase, words, a, l, r, n, score) of the phrases of two and more words in ``counted``, by
    the cut with the lowest score."""
    total = counted.where("length = 0").select("lang", F.col("n").alias("total"))
    known = counted.where("length > 0").select("lang", "phrase", "n")
    cuts = (counted.where("length > 1").withColumn("words", F.split("phrase", " "))
            .select("lang", "phrase", "words", F.col("n").alias("a"),
                    F.explode(F.sequence(F.lit(1), F.col("length") - 1)).alias("k"))
            .withColumns({"first": F.array_join(F.slice("words", 1, F.col("k")), " "),
                          "rest": F.array_join(F.slice("words", F.col("k") + 1, F.size("words")), " ")}))
    both = (cuts.join(known.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l")), ["lang", "first"])
            .join(known.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r")), ["lang", "rest"]))
    wide = lambda c: F.col(c).cast("decimal(18,0)")
    both = both.withColumns({"top": wide("a") * wide("a") * F.lit(1_000_000), "bottom": wide("l") * wide("r")})
    lowest = (both.withColumn("score", F.expr("top div bottom")).groupBy("lang", "phrase")
              .agg(F.min(F.struct("score", "k", "l", "r", "a", "words")).alias("m")))
    return lowest.join(total, "lang").select(
        "lang", "phrase", "m.words", "m.a", "m.l", "m.r", F.col("total").alias("n"), "m.score")


def whole_phrases(found: DataFrame, inside_percent: int = INSIDE_PERCENT) -> DataFrame:
    """Without the phrases that lie in a longer one which has ``inside_percent`` of their occurrences."""
    parts = F.flatten(F.transform(F.sequence(F.lit(2), F.size("words") - 1), lambda length: F.transform(
        F.sequence(F.lit(1), F.size("words") - length + 1), lambda k: F.array_join(F.slice("words", k, length), " "))))
    inside = (found.where(F.size("words") > 2).select("lang", F.explode(parts).alias("phrase"), "a")
              .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    return found.join(inside, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * inside_percent)).drop("longer", "words")


def best(found: DataFrame, top: int = TOP) -> DataFrame:
    """The first ``top`` of each lang, with their rank; the best of parts of a lang come first."""
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    part = F.pmod(F.xxhash64("phrase"), F.lit(TOP_SALTS))
    of_parts = found.withColumn("part", part).withColumn(
        "at", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("at") <= top)
    return (of_parts.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
            .where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))


def collocations(docs: DataFrame, least: int = LEAST, most: int = MOST_WORDS, top: int = TOP,
                 inside_percent: int = INSIDE_PERCENT, circle: int = SHARDS) -> DataFrame:
    """Each lang's first ``top`` phrases of ``docs`` (lang, text)."""
    return best(whole_phrases(scored(counted_phrases(docs, least, most, circle)), inside_percent), top)


def oracle_sql() -> str:
    """The registered query in SQL."""
    return f"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM p),
g AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest(range(1, {MOST_WORDS + 1})) AS k))
  GROUP BY ALL),
t AS (SELECT lang, sum(f)::BIGINT AS n FROM g WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f, string_split(phrase, ' ') AS w FROM g WHERE k >= 2 AND f >= {LEAST}),
x AS (
  SELECT c.lang, c.k, c.phrase, c.f AS a, l.f AS l, r.f AS r, cut,
         ((1000000::HUGEINT * c.f * c.f) // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM c) c
  JOIN g l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:cut], ' ')
  JOIN g r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[cut + 1:], ' ')),
b AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
i AS (
  SELECT lang, array_to_string(w[i:i + j - 1], ' ') AS phrase, max(f) AS f
  FROM (SELECT *, unnest(range(1, k - j + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS j FROM c)) GROUP BY ALL),
q AS (
  SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY b.score DESC, b.a DESC, b.phrase) AS rank,
         b.phrase, b.a, b.l, b.r, t.n, b.score
  FROM b JOIN t ON t.lang = b.lang LEFT JOIN i ON i.lang = b.lang AND i.phrase = b.phrase
  WHERE i.f IS NULL OR 100 * i.f < {INSIDE_PERCENT} * b.a)
SELECT * FROM q WHERE rank <= {TOP}"""
