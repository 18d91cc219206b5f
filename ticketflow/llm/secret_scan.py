"""Secret scans over an incremental ledger of content-addressed blobs.

Every version of every path is addressed by the SHA-256 of its content. The ledger holds which
(blob, rule, rule version) pairs were scanned, and what was found. A run scans only pairs that
the ledger lacks, once per blob however many paths hold it, appends them, and joins the findings
of the current rule versions back to all paths. A run's findings count once its pairs are
written, so a run that dies halfway leaves nothing behind that is read.

Positions are in code points, found with SQL functions alone: between two matches lies the text
that splitting at the pattern leaves, so the running sum of both lengths gives each start.

Defined results: a null text counts as empty; repeated rows are rows of their own with the same
findings; a text without secrets has zero counts and the digest of the empty string.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketflow.llm.common import staged
from ticketflow.session import scratch_path


@dataclass(frozen=True)
class Rule:
    """A pattern for Java's regular expressions; matches whose ``group`` is shorter than
    ``least`` are dropped after matching."""

    name: str
    pattern: str
    version: int = 1
    group: int = 0
    least: int = 1
    base: bool = False


#: Base rules in their order, then those this operator adds. Runs of hex digits and of key
#: characters are maximal, so their least length can stand in the pattern itself.
RULES = (
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         group=1, least=6, base=True),
    Rule("access", r"AKIA[A-Z0-9]{16,}", base=True),
    Rule("hex", r"[0-9a-f]{24,}", base=True),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)


#: So many blobs that are due, or fewer, are broadcast to pick their texts: a digest and six names each.
FEW_BLOBS = 50_000


def blob_id(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def _lengths(texts: Column) -> Column:
    return F.transform(texts, F.length)


def _matches(rule: Rule, order: int, todo: Column) -> Column:
    """Gaps and lengths of a rule's matches in ``text``; null where the rule isn't due."""
    due = F.array_contains(todo, rule.name) & F.col("text").rlike(rule.pattern)
    p = F.lit(rule.pattern)
    return F.when(due, F.struct(
        F.lit(rule.name).alias("rule"), F.lit(rule.version).alias("version"), F.lit(order).alias("place"),
        F.lit(rule.least).alias("least"),
        F.arrays_zip(_lengths(F.split("text", rule.pattern, -1)).alias("gap"),
                     _lengths(F.regexp_extract_all("text", p, F.lit(0))).alias("size"),
                     _lengths(F.regexp_extract_all("text", p, F.lit(rule.group))).alias("tested"),
                     ).alias("found")))


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(blob, rule, version, place, start, end) for ``blobs`` (blob, text, todo: names of the
    rules that are due)."""
    due = blobs.select("blob", F.explode(F.array_compact(F.array(
        *(_matches(r, n, F.col("todo")) for n, r in enumerate(rules))))).alias("r"))
    each = due.select("blob", "r.rule", "r.version", "r.place", "r.least",
                      F.posexplode("r.found").alias("n", "f")).where("f.size is not null")
    upto = Window.partitionBy("blob", "rule").orderBy("n")  # the matches of one rule in one text
    end = F.sum(F.col("f.gap") + F.col("f.size")).over(upto)
    return (each.withColumn("end", end).where("f.tested >= least")
            .select("blob", "rule", "version", "place", (F.col("end") - F.col("f.size")).alias("start"), "end"))


class Ledger:
    """Scanned pairs and findings below a shared folder."""

    def __init__(self, spark, path: str):
        self.spark, self.path = spark, path

    def _read(self, name: str, schema: str) -> DataFrame:
        folder = os.path.join(self.path, name)
        jvm_path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        fs = jvm_path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(jvm_path):
            fields = (c.split() for c in schema.split(","))
            return self.spark.range(0).select(*(F.lit(None).cast(kind).alias(n) for n, kind in fields))
        return self.spark.read.schema(schema).parquet(folder)

    def pairs(self) -> DataFrame:
        return self._read("pairs", "blob string, rule string, version int, run string")

    def findings(self) -> DataFrame:
        found = self._read("findings", "blob string, rule string, version int, place int, start long,"
                                       " end long, run string")
        # findings of a run that never recorded its pairs do not count
        return found.join(self.pairs().select("blob", "rule", "version", "run"),
                          ["blob", "rule", "version", "run"], "left_semi")

    def update(self, texts: DataFrame, rules: tuple[Rule, ...]) -> None:
        """Scan what is new in ``texts`` (blob, text)."""
        run = uuid.uuid4().hex
        known = F.array(*(F.struct(F.lit(r.name).alias("rule"), F.lit(r.version).alias("version"))
                          for r in rules))
        due = (texts.select("blob").distinct().select("blob", F.explode(known).alias("r"))
               .select("blob", "r.rule", "r.version")
               .join(self.pairs().select("blob", "rule", "version"), ["blob", "rule", "version"], "left_anti"))
        due = staged(due, "due_pairs")
        todo = due.groupBy("blob").agg(F.collect_set("rule").alias("todo"))  # as many as rules
        blobs_due = due.select("blob").distinct().limit(FEW_BLOBS + 1).count()
        if not blobs_due:  # nothing new: no text is moved
            return
        if blobs_due <= FEW_BLOBS:  # only texts that are due are moved
            blobs = texts.join(F.broadcast(todo), "blob").dropDuplicates(["blob"])
        else:
            blobs = texts.dropDuplicates(["blob"]).join(todo, "blob")  # copies collapse before the shuffle
        mark = F.lit(run).alias("run")
        scan_blobs(blobs, rules).select("*", mark).select(
            "blob", "rule", "version", "place", F.col("start").cast("long"), F.col("end").cast("long"),
            "run").write.mode("append").parquet(os.path.join(self.path, "findings"))
        due.select("*", mark).write.mode("append").parquet(os.path.join(self.path, "pairs"))


def findings_by_path(versions: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Scan what is new in ``versions`` (path, text) and return (path, blob, spans) for every row:
    spans is the array of (start, end, place, rule) found by the current rule versions."""
    addressed = versions.select("path", blob_id(F.col("text")).alias("blob"),
                                F.coalesce("text", F.lit("")).alias("text"))
    paths = staged(addressed.select("path", "blob"), "versions")
    ledger.update(addressed.select("blob", "text"), rules)
    current = F.lit(False)
    for r in rules:
        current = current | ((F.col("rule") == r.name) & (F.col("version") == r.version))
    spans = (ledger.findings().where(current).groupBy("blob")
             .agg(F.array_sort(F.collect_set(F.struct("start", "place", "end", "rule"))).alias("spans")))
    return paths.join(spans, "blob", "left").select(
        "path", "blob", F.coalesce("spans", F.array().cast("array<struct<start:bigint,place:int,end:bigint,rule:string>>"))
        .alias("spans"))


def scan_documents(docs: DataFrame, rules: tuple[Rule, ...] = RULES, ledger: Ledger | None = None) -> DataFrame:
    """Per document row: doc_id, counts of the base kinds, digest of the base spans, all spans."""
    spark = docs.sparkSession
    ledger = ledger or Ledger(spark, scratch_path(spark, "secret_ledger"))
    found = findings_by_path(docs.select(F.col("doc_id").alias("path"), "text"), ledger, rules)
    written = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["rule"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["rule"].isin([r.name for r in rules if r.base]))
    count = lambda name: F.size(F.filter("spans", lambda s: s["rule"] == name)).cast("long")
    counts = [count(r.name).alias(f"n_{r.name}") for r in rules if r.base]
    return found.select(F.col("path").alias("doc_id"), *counts,
                        F.sha2(written(base).cast("binary"), 256).alias("base_sha256"),
                        written(F.col("spans")).alias("spans"))


def oracle_sql(rules: tuple[Rule, ...] = RULES) -> str:
    """The registered query in SQL."""
    each = " UNION ALL ".join(f"""
SELECT rid, '{r.name}' AS rule, {n} AS place, unnest(range(1, len(m) + 1)) AS i, g, m, t, {r.least} AS least
FROM (SELECT rid, regexp_split_to_array(text, p) AS g, regexp_extract_all(text, p, 0) AS m,
             regexp_extract_all(text, p, {r.group}) AS t
      FROM d, (SELECT '{r.pattern.replace("'", "''")}' AS p)
      WHERE regexp_matches(text, p)) x""" for n, r in enumerate(rules))
    base = ", ".join(f"'{r.name}'" for r in rules if r.base)
    counts = ", ".join(f"count(*) FILTER (WHERE rule = '{r.name}') AS n_{r.name}" for r in rules if r.base)
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
e AS ({each}),
s AS (SELECT rid, rule, place, (list_sum(list_transform(g[:i], lambda x: length(x)))
             + coalesce(list_sum(list_transform(m[:i - 1], lambda x: length(x))), 0))::BIGINT AS a, length(m[i]) AS n
      FROM e WHERE length(t[i]) >= least),
w AS (SELECT *, rule || ':' || a || ':' || (a + n) AS span FROM s)
SELECT doc_id, {counts},
       sha256(coalesce(string_agg(span, ',' ORDER BY a, place) FILTER (WHERE rule IN ({base})), '')) AS base_sha256,
       coalesce(string_agg(span, ',' ORDER BY a, place), '') AS spans
FROM d LEFT JOIN w USING (rid) GROUP BY rid, doc_id"""
