"""Gated silver publish: bronze -> current state -> candidate -> one-pass gate ->
publish.

The run first writes the *current state*: the latest, unfiltered, unparsed version
per key (the only shuffle of bronze). Because that is one row per distinct key, its
written row count is also the gate's distinct-bronze baseline -- no second shuffle of
bronze. The candidate (parse -> box -> status of the state) is written once, the gate
aggregates the written candidate in one pass, the bridge is exploded from the same
rows, and only then does the table pointer move. A failing gate raises and leaves the
previous publish current. The state table is what incremental upserts extend.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from ticketflow.config import CATEGORY_ARRAY, FEED_STATE_CODES, GateConfig
from ticketflow.operators.quality import assert_quality
from ticketflow.operators.silver import dedup_latest, explode_bridge, publish_view
from ticketflow.sources.lake import run_path, set_current, write_table

TICKETS, BRIDGE, STATE = "tickets", "ticket_category", "state"


def publish_silver(spark: SparkSession, bronze: DataFrame, out_root: str,
                   key: str = "ticket_id", order: str = "last_activity",
                   tie_breakers: Iterable[str] = (), cfg: GateConfig = GateConfig(),
                   state_map: Mapping[str, str] = FEED_STATE_CODES,
                   categories: str = CATEGORY_ARRAY, run_id: str | None = None,
                   report=print) -> dict:
    """``key``, the box of ``cfg`` and ``state_map`` hold for every step; a gate configured
    for the default key checks ``key`` instead."""
    run_id = run_id or uuid.uuid4().hex[:16]
    if key != cfg.key:
        cfg = replace(cfg, key=key, not_null=tuple(key if c == cfg.key else c for c in cfg.not_null))
    state_path = run_path(out_root, run_id, STATE)
    write_table(dedup_latest(bronze, key, order, tuple(tie_breakers)), state_path)
    state = spark.read.parquet(state_path)
    tickets_path = run_path(out_root, run_id, TICKETS)
    write_table(publish_view(state, cfg.bbox, state_map=state_map, lon=cfg.lon, lat=cfg.lat),
                tickets_path)
    staged = spark.read.parquet(tickets_path)
    # counted from what was written: a metric of the writing job may count a rerun task twice
    results = assert_quality(staged, state.count(), cfg, report=report)
    bridge_path = run_path(out_root, run_id, BRIDGE)
    write_table(explode_bridge(staged, categories, key), bridge_path)
    set_current(spark, out_root, run_id)
    return {"run_id": run_id, "checks": results,
            "bridge_rows": spark.read.parquet(bridge_path).count()}
