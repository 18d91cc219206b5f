"""Extensions (described by the reference's docs, not built there): reconciling a
historical seed with daily loads, and incremental current-state upserts.

Both rest on one property of ``dedup_latest`` under a total version order:
``dedup(a U b) == dedup(dedup(a) U b)``. The retained state is therefore the
*unfiltered, unparsed* latest version per key; the box filter and parsing are applied
when publishing, so a newer out-of-box version still removes a ticket.
Precondition: the bronze history is append-only (a rewritten bronze partition that
*removes* versions needs the full rebuild).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticketflow.operators.silver import dedup_latest, publish_view


def seed_reconcile(seed: DataFrame, daily: DataFrame, key: str = "ticket_id",
                   order: str = "last_activity", tie_breakers: Iterable[str] = ()) -> DataFrame:
    """Latest version per key over a seed and daily loads whose columns may differ
    (missing columns are null on the side that lacks them)."""
    both = seed.unionByName(daily, allowMissingColumns=True)
    return dedup_latest(both, key, order, tuple(tie_breakers))


def upsert_current(current: DataFrame, changes: DataFrame, key: str = "ticket_id",
                   order: str = "last_activity", tie_breakers: Iterable[str] = ()) -> DataFrame:
    """New current state = latest version per key of (state U changes).

    Map-side group limits keep the shuffle to at most one row per key per input
    partition, so a key with many changes ships little."""
    return dedup_latest(current.unionByName(changes, allowMissingColumns=True), key, order,
                        tuple(tie_breakers))


#: Silver view of a current-state table, which needs no dedup.
publish_state = publish_view


def scd2_history(snapshots: DataFrame, attribute: str = "district", key: str = "ticket_id",
                 order: str = "last_activity", tie_breakers: Iterable[str] = ()) -> DataFrame:
    """Type-2 history of one attribute per key: a row per run of equal values with
    ``valid_from`` (first version of the run), ``valid_to`` (first version of the next
    run, null while current) and ``is_current``.

    Every version counts, those of one day too. One exchange on the key serves the run
    starts and their successors; the windows look one row back or ahead, so a key with
    very many versions is streamed (and spilled), never held.
    """
    newest_last = [F.col(c).asc_nulls_first() for c in (order, *tie_breakers)]
    versions = Window.partitionBy(key).orderBy(*newest_last)
    marked = snapshots.select(
        key, attribute, order, *tie_breakers,
        F.lag(F.struct(attribute)).over(versions).alias("_before"))
    # a struct, so that a first version (no row before) differs from a null value before
    runs = marked.where(~F.struct(attribute).eqNullSafe(F.col("_before")))
    following = F.lead(F.struct(order)).over(versions)
    return runs.select(key, attribute, F.col(order).alias("valid_from"),
                       following[order].alias("valid_to"), following.isNull().alias("is_current"))


def scd2_bounds(snapshots: DataFrame, attribute: str = "district", key: str = "ticket_id",
                order: str = "last_activity", tie_breakers: Iterable[str] = ()) -> DataFrame:
    """``scd2_history`` with the first and the last version of every run (``first_seen``, ``last_seen``:
    structs of the order and the tie breakers), which ``scd2_merge`` goes on from. Versions are
    streamed in order after one exchange on the key."""
    names = [order, *tie_breakers]
    by_key = Window.partitionBy(key).orderBy(*(F.col(c).asc_nulls_first() for c in names))
    rows = snapshots.select(key, attribute, *names).withColumns({
        "_self": F.struct(*names), "_before": F.lag(F.struct(attribute)).over(by_key),
        "_previous": F.lag(F.struct(*names)).over(by_key), "_following": F.lead(F.struct(attribute)).over(by_key)})
    # starts of runs, and the key's very last version, which ends the last run
    edges = rows.withColumn("_start", ~F.struct(attribute).eqNullSafe(F.col("_before")))
    edges = edges.where(F.col("_start") | F.col("_following").isNull())
    then = F.lead(F.struct("_start", "_previous", "_self", F.col(order).alias("_at"))).over(by_key)
    edges = edges.withColumn("_then", then)
    last = (F.when(F.col("_then").isNull(), F.col("_self")).when(F.col("_then._start"), F.col("_then._previous"))
            .otherwise(F.col("_then._self")))
    ended = F.coalesce("_then._start", F.lit(False))
    return edges.where("_start").select(
        key, attribute, F.col(order).alias("valid_from"), F.when(ended, F.col("_then._at")).alias("valid_to"),
        (~ended).alias("is_current"), F.col("_self").alias("first_seen"), last.alias("last_seen"))


def scd2_merge(history: DataFrame, versions: DataFrame, snapshots: DataFrame, attribute: str = "district",
               key: str = "ticket_id", order: str = "last_activity", tie_breakers: Iterable[str] = ()) -> DataFrame:
    """``scd2_bounds`` of all versions, from that of the earlier ones (``history``) and the new
    ``versions``; versions may be late.

    Rows of keys without new versions pass unsorted. Of the others, the first and the last version of each
    run and the new versions are put in order, and runs are found anew; that is exact unless a late version
    with another value falls inside a run, as the run's versions after it are not in the history. Only keys
    with such a version are made again from ``snapshots`` (all versions)."""
    ties = tuple(tie_breakers)
    names = [order, *ties]
    keys = versions.select(key).distinct()
    open_ = F.col("first_seen") != F.col("last_seen")
    mark = lambda seen, inside: F.struct(*(F.col(f"{seen}.{c}").alias(c) for c in names), inside.alias("_inside"))
    marks = F.when(open_, F.array(mark("first_seen", F.lit(True)), mark("last_seen", F.lit(False)))).otherwise(
        F.array(mark("first_seen", F.lit(False))))
    old = (history.join(keys, key, "left_semi").select(key, attribute, F.explode(marks).alias("m"))
           .select(key, attribute, "m.*"))
    merged = old.unionByName(versions.select(key, attribute, *names, F.lit(None).cast("boolean").alias("_inside")))
    upto = (Window.partitionBy(key).orderBy(*(F.col(c).asc_nulls_first() for c in names), F.col("_inside").asc_nulls_last())
            .rowsBetween(Window.unboundedPreceding, 0))
    run = F.last(F.when(F.col("_inside").isNotNull(), F.struct("_inside", F.col(attribute).alias("v"))), ignorenulls=True).over(upto)
    broken = (merged.withColumn("_run", run).where(F.col("_inside").isNull() & F.col("_run._inside")
                                                   & ~F.col("_run.v").eqNullSafe(F.col(attribute))).select(key).distinct())
    whole = merged.join(broken, key, "left_anti").select(key, attribute, *names)
    again = snapshots.join(broken, key, "left_semi").select(key, attribute, *names)
    fresh = scd2_bounds(whole.unionByName(again), attribute, key, order, ties)
    return history.join(keys, key, "left_anti").select(*fresh.columns).unionByName(fresh)


def as_of(facts: DataFrame, history: DataFrame, at: str, attribute: str = "district", key: str = "ticket_id",
          name: str | None = None) -> DataFrame:
    """``facts`` with the value that ``attribute`` had at their time ``at`` (column ``name``), null before
    the first version and for facts without a time. Facts and history rows of a key are merged in one order of time, and each fact
    takes the last history value before or at it: one exchange on the key, no pairs."""
    name = name or attribute
    columns = facts.columns
    left = facts.select(F.struct(*columns).alias("_fact"), F.col(key).alias("_key"), F.col(at).alias("_at"),
                        F.lit(None).cast(history.schema[attribute].dataType).alias("_value"), F.lit(1).alias("_order"))
    right = history.select(F.lit(None).cast(left.schema["_fact"].dataType).alias("_fact"), F.col(key).alias("_key"),
                           F.col("valid_from").cast(facts.schema[at].dataType).alias("_at"), F.col(attribute).alias("_value"),
                           F.lit(0).alias("_order"), F.col("valid_to").cast(facts.schema[at].dataType).alias("_until"))
    left = left.withColumn("_until", F.lit(None).cast(facts.schema[at].dataType))
    # of rows that start at one time, the one that lasts comes last
    upto = (Window.partitionBy("_key").orderBy("_at", "_order", F.col("_until").asc_nulls_last())
            .rowsBetween(Window.unboundedPreceding, 0))
    # wrapped, so that a null value in the history counts as one
    held = F.last(F.when(F.col("_order") == 0, F.struct("_value")), ignorenulls=True).over(upto)
    merged = left.unionByName(right).withColumn("_held", held["_value"]).where("_order = 1")
    value = F.when(F.col("_at").isNotNull(), F.col("_held"))
    return merged.select(*(F.col("_fact")[c].alias(c) for c in columns if c != name), value.alias(name))
