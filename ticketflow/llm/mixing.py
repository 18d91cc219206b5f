"""Mix sources to target weights by hierarchical budgeting.

A tree of domain, language and source carries weights. A total budget of tokens flows down:
every node's budget is split among its children by weight, each child taking no more than its
subtree can give (its tokens times ``max_epochs``); what a child cannot take goes to its
siblings, and leaves the node only when the whole subtree is short, which the split one level
up has settled before. Each leaf then takes whole epochs of its documents and, of one more epoch
in an order seeded for that epoch, the longest prefix within the rest of its budget.

The prefix of a leaf is found without sorting the leaf in one task: documents fall in buckets
of their order key, bucket totals say in which bucket the budget ends, and only that bucket's
documents are ordered. Only DataFrame functions are used.

Defined results: a null language or source counts as ``und`` or ``unknown``; null and empty
texts hold no tokens; a leaf without tokens gives no row; documents that tie in the order
(the same doc_id) enter a prefix together or not at all; repeated rows are rows; the columns
``domain``, ``epoch`` and ``n_tokens`` of the input are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketflow.llm.common import broadcast_if_small, staged

LEVELS = ("domain", "lang", "source")
_BUCKET_HEX = 3
BROADCAST_LEAVES = 100_000


@dataclass(frozen=True)
class Mix:
    """Target weights (a name that is not listed weighs ``default``), budget and seed."""

    domain: dict[str, float] = field(default_factory=dict)
    lang: dict[str, float] = field(default_factory=dict)
    source: dict[str, float] = field(default_factory=dict)
    default: float = 1.0
    #: Tokens to take, as a share of those there are.
    budget: float = 1.0
    max_epochs: int = 2
    seed: int = 17
    #: Where a document's domain comes from: a column of its own, else its source by name (others:
    #: ``unknown``), else one of so many by a hash of the source, as in the registered query.
    domain_column: str | None = None
    domain_of: dict[str, str] = field(default_factory=dict)
    domains: int = 4


#: Weights of the registered query and of the pipeline.
TARGET = Mix(domain={"d0": 4.0, "d1": 3.0, "d2": 2.0, "d3": 1.0},
             lang={"en": 4.0, "de": 2.0, "fr": 2.0, "es": 2.0})
#: The pipeline repeats nothing and leaves a tenth of the tokens, from what outweighs its target.
PIPELINE = Mix(domain=TARGET.domain, lang=TARGET.lang, budget=0.9, max_epochs=1)


def _leaf(mix: Mix) -> dict[str, Column]:
    source = F.coalesce(F.col("source"), F.lit("unknown"))
    if mix.domain_column:
        domain = F.coalesce(F.col(mix.domain_column).cast("string"), F.lit("unknown"))
    elif mix.domain_of:
        known = F.create_map(*(F.lit(x) for item in sorted(mix.domain_of.items()) for x in item))
        domain = F.coalesce(F.try_element_at(known, source), F.lit("unknown"))
    else:
        domain = F.concat(F.lit("d"), (F.crc32(source.cast("binary")) % mix.domains).cast("string"))
    return {"domain": domain, "lang": F.coalesce(F.col("lang"), F.lit("und")), "source": source}


def _tokens(text: Column) -> Column:
    """Words of the text: runs of anything but white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _weight(level: str, mix: Mix) -> Column:
    out = F.lit(float(mix.default))
    for name, w in getattr(mix, level).items():
        out = F.when(F.col(level) == name, F.lit(float(w))).otherwise(out)
    return out


def _split_budget(nodes: DataFrame, level: str, mix: Mix) -> DataFrame:
    """``nodes`` (the names down to ``level``, cap, budget of the parent) with their own budget:
    min(cap, share * weight), the share being the one that uses up the parent's budget. Children
    are taken by cap over weight, so those that are filled come first."""
    parent = list(LEVELS[:LEVELS.index(level)])
    w = Window.partitionBy(*parent).orderBy(F.col("cap") / F.col("w"), level)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    after = w.rowsBetween(0, Window.unboundedFollowing)
    share = (F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("w").over(after)
    shared = (nodes.withColumn("w", _weight(level, mix)).where("w > 0").withColumn("share", share)
              .withColumn("filled", F.col("cap") <= F.col("share") * F.col("w")))
    final = F.min(F.when(~F.col("filled"), F.struct((F.col("cap") / F.col("w")).alias("r"), level, "share"))
                  ).over(Window.partitionBy(*parent))["share"]
    return (shared.withColumn("final", final)
            .withColumn("budget", F.when(F.col("filled"), F.col("cap").cast("double"))
                        .otherwise(F.col("final") * F.col("w")))
            .select(*parent, level, "budget"))


def leaf_budgets(totals: DataFrame, mix: Mix) -> DataFrame:
    """``totals`` (domain, lang, source, tokens) with ``budget``, in tokens."""
    caps = totals.where("tokens > 0").withColumn("cap", F.col("tokens") * mix.max_epochs)
    budget = caps.agg(F.sum(F.col("tokens")).alias("all")).select(
        F.least(F.col("all") * mix.budget, F.col("all").cast("double") * mix.max_epochs).alias("budget"))
    for n, level in enumerate(LEVELS):
        parent = list(LEVELS[:n])
        nodes = caps.groupBy(*parent, level).agg(F.sum("cap").alias("cap"))
        nodes = nodes.join(budget, parent) if parent else nodes.join(F.broadcast(budget))  # one row
        budget = _split_budget(nodes, level, mix)
    return totals.join(budget, list(LEVELS))


def _order(mix: Mix, epoch: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(mix.seed)), epoch.cast("string"),
                             F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))


def decisions(docs: DataFrame, mix: Mix) -> DataFrame:
    """A row for each leaf: tokens, budget, whole ``epochs`` taken, and ``cutoff``, the last
    order key taken of the epoch after those (null: none)."""
    own = [c for c in (mix.domain_column,) if c and c not in ("doc_id", "lang", "source", "text")]
    rows = staged(docs.select("doc_id", "lang", "source", "text", *own).select(
        "doc_id", *(c.alias(n) for n, c in _leaf(mix).items()), _tokens(F.col("text")).alias("n_tokens")),
        "mix_rows")
    totals = rows.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens")).where("tokens > 0")
    leaves = staged(
        leaf_budgets(totals, mix)
        .withColumn("take", F.floor(F.col("budget") + 1e-6))
        .withColumn("epochs", F.floor(F.col("take") / F.col("tokens")).cast("int"))
        .withColumn("rest", F.col("take") - F.col("epochs") * F.col("tokens")), "leaves")
    known = broadcast_if_small(leaves.select(*LEVELS, "epochs", "rest"), BROADCAST_LEAVES)
    keyed = (rows.join(known, list(LEVELS)).where("rest > 0")
             .withColumn("key", _order(mix, F.col("epochs") + 1))
             .withColumn("bucket", F.substring("key", 1, _BUCKET_HEX)))
    run = Window.partitionBy(*LEVELS).orderBy("bucket")
    ends = (keyed.groupBy(*LEVELS, "bucket").agg(F.sum("n_tokens").alias("n"), F.max("key").alias("last"),
                                                 F.first("rest").alias("rest"))
            .withColumn("upto", F.sum("n").over(run)))  # a row for each bucket
    end = ends.groupBy(*LEVELS).agg(
        F.max(F.when(F.col("upto") <= F.col("rest"), F.col("last"))).alias("full"),
        F.min(F.when(F.col("upto") > F.col("rest"), F.struct("bucket", (F.col("upto") - F.col("n")).alias("upto")))
              ).alias("cut"))
    end = staged(end.select(*LEVELS, "full", F.col("cut.bucket").alias("bucket"),
                            F.col("cut.upto").alias("upto")), "mix_ends")
    ordered = Window.partitionBy(*LEVELS).orderBy("key")
    inside = (keyed.join(broadcast_if_small(end.where("bucket is not null"), BROADCAST_LEAVES),
                         [*LEVELS, "bucket"])
              .groupBy(*LEVELS, "key").agg(F.sum("n_tokens").alias("n"), F.first("upto").alias("upto"),
                                           F.first("rest").alias("rest"))
              .withColumn("upto", F.col("upto") + F.sum("n").over(ordered))
              .where("upto <= rest").groupBy(*LEVELS).agg(F.max("key").alias("part")))
    return staged(leaves.join(end.select(*LEVELS, "full"), list(LEVELS), "left")
                  .join(inside, list(LEVELS), "left")
                  .select(*LEVELS, "tokens", "budget", "epochs",
                          F.greatest("full", "part").alias("cutoff")), "mix_leaves")


def mix_documents(docs: DataFrame, mix: Mix = TARGET) -> DataFrame:
    """The selected rows of ``docs``, one for each epoch that takes them, with ``epoch`` (from 1)
    and ``domain``; a leaf's language and source keep their input values."""
    leaves = broadcast_if_small(
        decisions(docs, mix).select(*(F.col(c).alias(f"__{c}") for c in LEVELS), F.col("epochs").alias("__epochs"),
                                    F.col("cutoff").alias("__cutoff")), BROADCAST_LEAVES)
    leaf = _leaf(mix)
    named = docs.select("*", *(c.alias(f"__{n}") for n, c in leaf.items())).drop("domain", "epoch")
    docs = docs.drop("domain", "epoch")
    key = _order(mix, F.col("__epochs") + 1)
    copies = F.col("__epochs") + F.when(F.col("__cutoff").isNull(), 0).otherwise(
        (key <= F.col("__cutoff")).cast("int"))
    return (named.join(leaves, [f"__{c}" for c in LEVELS]).withColumn("__copies", copies)
            .where("__copies > 0")
            .select(*docs.columns, F.col("__domain").alias("domain"),
                    F.explode(F.sequence(F.lit(1), F.col("__copies"))).alias("epoch")))


def oracle_sql(mix: Mix = TARGET) -> str:
    """The registered query in SQL."""
    def weight(level: str) -> str:
        names = " ".join(f"WHEN '{n}' THEN {w}" for n, w in getattr(mix, level).items())
        return f"CASE {level} {names} ELSE {mix.default} END::DOUBLE" if names else f"{mix.default}::DOUBLE"

    parts = []
    for n, level in enumerate(LEVELS):
        up = list(LEVELS[:n])
        by = f"PARTITION BY {', '.join(up)}" if up else ""
        join = f"JOIN b{n - 1} USING ({', '.join(up)})" if up else "CROSS JOIN b_all"
        key = ", ".join([*up, level])
        parts.append(f"""
n{n} AS (SELECT {key}, cap, budget, {weight(level)} AS w
         FROM (SELECT {key}, sum(cap)::DOUBLE AS cap FROM caps GROUP BY {key}) {join}),
s{n} AS (SELECT *, (budget - coalesce(sum(cap) OVER (w_all ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                   / sum(w) OVER (w_all ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lam
         FROM n{n} WINDOW w_all AS ({by} ORDER BY cap / w, {level})),
b{n} AS (SELECT {key}, CASE WHEN cap <= lam * w THEN cap
           ELSE w * arg_min(lam, row(cap / w, {level})) FILTER (WHERE cap > lam * w) OVER ({by}) END AS budget
         FROM s{n})""")
    leaf = ", ".join(LEVELS)
    # DuckDB has no crc32; the domains of the sources are given by the rule's results
    return f"""
WITH src AS (SELECT * FROM (VALUES {_domain_values(mix)}) t(source, domain)),
r AS (SELECT doc_id, domain, coalesce(lang, 'und') AS lang, d.source AS source,
             len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS n
      FROM (SELECT * REPLACE (coalesce(source, 'unknown') AS source) FROM documents) d JOIN src USING (source)),
tot AS (SELECT {leaf}, sum(n)::BIGINT AS tokens FROM r GROUP BY ALL HAVING tokens > 0),
caps AS (SELECT *, tokens * {mix.max_epochs} AS cap FROM tot),
b_all AS (SELECT least(sum(tokens) * {mix.budget}::DOUBLE, sum(tokens) * {mix.max_epochs}::DOUBLE) AS budget FROM tot),
{','.join(parts)},
l AS (SELECT {leaf}, tokens, floor(budget + 1e-6)::BIGINT AS take, take // tokens AS epochs,
             take - epochs * tokens AS rest FROM tot JOIN b{len(LEVELS) - 1} USING ({leaf})),
k AS (SELECT r.*, epochs, rest,
             md5('{mix.seed}:' || (epochs + 1)::VARCHAR || ':' || coalesce(doc_id::VARCHAR, '')) AS key
      FROM r JOIN l USING ({leaf})),
p AS (SELECT *, sum(n) OVER (PARTITION BY {leaf} ORDER BY key) AS upto FROM k),
o AS (SELECT *, max(key) FILTER (WHERE upto <= rest AND rest > 0) OVER (PARTITION BY {leaf}) AS cutoff FROM p),
c AS (SELECT *, epochs + coalesce((key <= cutoff)::INT, 0) AS copies FROM o)
SELECT doc_id, domain, lang, source, unnest(range(1, copies + 1))::INT AS epoch FROM c"""


def _domain_values(mix: Mix) -> str:
    from zlib import crc32

    names = ["unknown", *(f"src{k}" for k in range(100))]
    return ", ".join(f"('{n}', 'd{crc32(n.encode()) % mix.domains}')" for n in names)
