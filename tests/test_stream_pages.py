"""Streams: pages landed twice, restarts, late pages; the change log's epochs."""

import json
import os
import shutil

import pytest

from ticketflow.plans.bronze_load import load_bronze
from ticketflow.session import scratch_path
from ticketflow.sources.feed import read_pages
from ticketflow.streaming import change_log as logs
from ticketflow.streaming import pages as op


def page(day, offset, keys, at="08:00:00"):
    poll = f"2025-01-{day:02d}"
    return {"poll_id": poll, "page_offset": offset, "features": [
        {"geometry": {"type": "Point", "coordinates": [100.5, 13.8]},
         "properties": {"ticket_id": k, "last_activity": f"{poll} {at}", "note": "kept"}} for k in keys]}


def land(folder, name, *pages):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, f"{name}.json"), "w") as f:
        f.writelines(json.dumps(p) + "\n" for p in pages)


def keys(df):
    return sorted((r["ticket_id"], str(r["dt"]), r["_run_id"]) for r in df.collect())


def test_replayed_pages_and_a_restart_equal_the_batch_load(spark, tmp_path):
    src, once = str(tmp_path / "src"), str(tmp_path / "once")
    log, ckpt = scratch_path(spark, "log"), scratch_path(spark, "ckpt")
    days = {d: [page(d, 0, [f"a{d}", f"b{d}"], "20:00:00"), page(d, 2, [f"c{d}"], "01:00:00")] for d in range(1, 7)}
    land(src, "1", *days[1], *days[2])
    land(src, "2", *days[2], *days[3], *days[3])  # landed twice, within and across files
    first = op.run_pages(spark, src, log, ckpt, "2 days", ingested_at="x", max_files_per_trigger=1)
    assert first.pages == 10 and first.late_pages == 0
    land(src, "3", *days[4], *days[3], *days[5])
    land(src, "4", *days[6], *days[6], *days[5])
    second = op.run_pages(spark, src, log, ckpt, "2 days", ingested_at="x", max_files_per_trigger=1)
    assert second.pages == 12 and second.late_pages == 0  # files of before the restart are not read again
    for d in days:
        land(once, str(d), *days[d])
    batch = scratch_path(spark, "batch")
    load_bronze(read_pages(spark, once), batch, 2, ingested_at="x")
    assert keys(op.read_pages_log(spark, log)) == keys(spark.read.parquet(batch))
    assert {r["extra"]["note"] for r in op.read_pages_log(spark, log).collect()} == {"kept"}
    assert op.run_pages(spark, src, log, ckpt, "2 days", ingested_at="x").pages == 0


def test_late_pages_are_dropped_and_counted_and_state_expires(spark, tmp_path):
    src, log, ckpt = str(tmp_path / "src"), scratch_path(spark, "log"), scratch_path(spark, "ckpt")
    for n, day in enumerate((1, 2, 9, 20)):
        land(src, str(n), page(day, 0, [f"t{day}"]))
        done = op.run_pages(spark, src, log, ckpt, "3 days", ingested_at="x")
    assert done.remembered == 1  # pages of days 1, 2 and 9 are forgotten
    land(src, "9", page(2, 0, ["again"]), page(19, 0, ["t19"]))
    done = op.run_pages(spark, src, log, ckpt, "3 days", ingested_at="x")
    assert done.late_pages == 1
    assert [k for k, *_ in keys(op.read_pages_log(spark, log))] == ["t1", "t19", "t2", "t20", "t9"]


def test_a_batch_that_runs_again_counts_once(spark, tmp_path):
    """The checkpoint forgets that its last batch was committed."""
    src, log, ckpt = str(tmp_path / "src"), scratch_path(spark, "log"), scratch_path(spark, "ckpt")
    land(src, "1", page(1, 0, ["a", "b"]))
    op.run_pages(spark, src, log, ckpt, ingested_at="x")
    was = keys(op.read_pages_log(spark, log))
    commits = ckpt.removeprefix("file:") + "/commits"
    last = max((n for n in os.listdir(commits) if n.isdigit()), key=int)
    for n in (last, f".{last}.crc"):
        if os.path.exists(f"{commits}/{n}"):
            os.remove(f"{commits}/{n}")
    land(src, "2", page(2, 0, ["c"]))
    op.run_pages(spark, src, log, ckpt, ingested_at="x")
    assert keys(op.read_pages_log(spark, log)) == sorted([*was, ("c", "2025-01-02", "2025-01-02")])


COLS = "ticket_id string, last_activity string, n long"


def versions(spark, *rows):
    return spark.createDataFrame(list(rows), COLS)


def state(df):
    return sorted(tuple(r) for r in df.select("ticket_id", "last_activity", "n").collect())


def test_compaction_keeps_the_state_and_readers_keep_their_epoch(spark, scratch):
    log = logs.ChangeLog(spark, scratch, logs.latest_versions())
    for k in range(4):
        log.append(versions(spark, ("A", f"{k}", k), ("B", f"{k % 2}", k), (f"K{k}", "0", k)), k)
    old = log.read()
    want = state(old)
    assert want[0] == ("A", "3", 3) and len(log.open_batches()) == 4
    assert log.compact() == 3 and log.open_batches() == []
    assert state(log.read()) == want == state(old)  # planned before the compaction, read after it
    log.append(versions(spark, ("A", "9", 9)), 4)
    files = log.read().inputFiles()  # the base and the open batch, no others
    assert len(log.open_batches()) == 1 and any("/base/" in f for f in files)
    assert {f.split("/deltas/")[1][:12] for f in files if "/deltas/" in f} == {"000000000004"}
    assert ("A", "9", 9) in state(log.read())
    assert log.vacuum() == 4 and ("A", "9", 9) in state(log.read())
    assert log.compact() == 4 and log.vacuum() == 2 and ("K0", "0", 0) in state(log.read())


def test_replayed_and_unfinished_batches(spark, scratch):
    log = logs.ChangeLog(spark, scratch, logs.summed(["ticket_id"], "n"))
    add = lambda k, n: log.append(versions(spark, ("A", "0", n), ("A", "1", n)), k)
    totals = lambda: {r["ticket_id"]: r["n"] for r in log.read().collect()}
    add(0, 1)
    add(0, 1)  # replayed before the compaction
    add(1, 10)
    assert totals() == {"A": 22}
    assert log.compact() == 1
    add(1, 10)  # and after it
    assert totals() == {"A": 22} and log.open_batches() == []
    add(3, 100)  # batch 2 has not come: nothing beyond it may be folded
    assert log.compact() == 1 and totals() == {"A": 222}
    half = f"{scratch.removeprefix('file:')}/deltas/{2:012d}-dead"
    shutil.copytree(f"{scratch.removeprefix('file:')}/deltas/{log.open_batches()[0]}", half)
    os.remove(f"{half}/_SUCCESS")
    assert totals() == {"A": 222} and log.compact() == 1  # an attempt that died counts for nothing
    add(2, 1000)
    assert totals() == {"A": 2222} and log.compact() == 3 and totals() == {"A": 2222}


def test_an_empty_log_is_told(spark, scratch):
    with pytest.raises(FileNotFoundError):
        logs.ChangeLog(spark, scratch, logs.latest_versions()).read()
    assert logs.ChangeLog(spark, scratch, logs.latest_versions()).compact() == -1
