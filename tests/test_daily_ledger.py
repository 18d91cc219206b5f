"""The daily fact kept by deltas: equal to a rebuild whatever changes, and only the changed years' files."""

import datetime as dt
import os
from random import Random

import pytest
from pyspark.sql import functions as F

from ticketflow.operators import gold
from ticketflow.plans import daily_ledger as op
from ticketflow.sources import lake

SCHEMA = "ticket_id long, district string, timestamp timestamp, timestamp_finished timestamp, problem_type_fondue array<string>"


def ticket(rng, key, years=(2019, 2020, 2021, 2022)):
    at = dt.datetime(rng.choice(years), rng.randint(1, 12), rng.randint(1, 28), rng.randint(0, 23))
    done = at + dt.timedelta(days=rng.randint(0, 500)) if rng.random() < 0.6 else None
    return (key, rng.choice(["P", "Q", "R", None, " "]), at, done,
            rng.choice([["x"], ["x", "y"], ["x", "x"], [], None, [None, "y"]]))


def fact(df):
    return sorted(tuple(r) for r in df.select(*gold.DAILY_COLUMNS).collect())


def frame(spark, tickets):
    return spark.createDataFrame(list(tickets), SCHEMA)


def rebuilt(spark, tickets):
    return fact(gold.fact_daily(frame(spark, tickets), exact_median=True))


def year_files(root, manifest, table="fact"):
    at = root.removeprefix("file:")
    return {y: sorted(os.listdir(f"{lake.run_path(at, r, table)}/year={y}")) for y, r in manifest.tables[table].items()}


@pytest.mark.parametrize("seed", range(2))
def test_refreshes_equal_rebuilds(spark, scratch, seed):
    rng = Random(seed)
    state = {k: ticket(rng, k) for k in range(60)}
    op.refresh_daily_ledger(spark, scratch, frame(spark, state.values()))
    assert fact(op.read_daily(spark, scratch)) == rebuilt(spark, state.values())
    for turn in range(3):  # changed, new and vanished tickets; other years, and a wider calendar
        keys = rng.sample(sorted(state), 6)
        old = [state[k] for k in keys]
        for k in keys:
            del state[k]
        fresh = [ticket(rng, k, (2018, 2020, 2023) if turn == 1 else (2020,)) for k in [*keys[:4], 100 + turn]]
        state.update({t[0]: t for t in fresh})
        op.refresh_daily_ledger(spark, scratch, frame(spark, fresh), frame(spark, old))
        assert fact(op.read_daily(spark, scratch)) == rebuilt(spark, state.values())


def grid_tickets(years=(2019, 2020, 2021, 2022)):
    """Every district and category, and both ends of the calendar, so the grid stays when others change."""
    return [(k, d, dt.datetime(y, m, day), None, ["x", "y"]) for k, (d, y, m, day) in enumerate(
        (d, y, m, day) for d in ("P", "Q") for y in years for m, day in ((1, 1), (12, 31)))]


def test_only_changed_years_are_written(spark, scratch):
    tickets = [*grid_tickets(), (100, "P", dt.datetime(2020, 5, 1), None, ["x"])]
    op.refresh_daily_ledger(spark, scratch, frame(spark, tickets))
    before = op.Manifest(spark, scratch, lake.current_run(spark, scratch))
    files = year_files(scratch, before)
    done = (100, "P", dt.datetime(2020, 5, 1), dt.datetime(2020, 6, 1), ["x"])
    wrote = op.refresh_daily_ledger(spark, scratch, frame(spark, [done]), frame(spark, tickets[-1:]))
    assert wrote["ledger_years"] == wrote["fact_years"] == [2020]
    after = op.Manifest(spark, scratch, lake.current_run(spark, scratch))
    assert {y: f for y, f in year_files(scratch, after).items() if y != 2020} == {y: f for y, f in files.items() if y != 2020}
    assert {y: r for y, r in after.tables["fact"].items() if y != 2020} == {y: r for y, r in before.tables["fact"].items() if y != 2020}
    # later years moved by what they start with alone
    assert fact(op.read_daily(spark, scratch)) == rebuilt(spark, [*tickets[:-1], done])
    assert fact(op.read_daily(spark, scratch, [2021])) == [r for r in rebuilt(spark, [*tickets[:-1], done]) if r[2].year == 2021]
    assert op.refresh_daily_ledger(spark, scratch, frame(spark, [done]), frame(spark, [done]))["fact_years"] == []


def test_a_new_district_writes_all_years_from_the_ledger(spark, scratch):
    tickets = grid_tickets()
    op.refresh_daily_ledger(spark, scratch, frame(spark, tickets))
    new = (200, "R", dt.datetime(2021, 3, 1), None, ["x"])
    assert op.refresh_daily_ledger(spark, scratch, frame(spark, [new]))["fact_years"] == [2019, 2020, 2021, 2022]
    assert fact(op.read_daily(spark, scratch)) == rebuilt(spark, [*tickets, new])
    op.refresh_daily_ledger(spark, scratch, frame(spark, []), frame(spark, [new]))
    assert fact(op.read_daily(spark, scratch)) == rebuilt(spark, tickets)


def test_a_refresh_that_dies_leaves_the_old_fact_in_force(spark, scratch, monkeypatch):
    tickets = grid_tickets()
    op.refresh_daily_ledger(spark, scratch, frame(spark, tickets))
    was, change = fact(op.read_daily(spark, scratch)), (0, "P", dt.datetime(2019, 1, 1), dt.datetime(2019, 2, 1), ["x"])
    args = (frame(spark, [change]), frame(spark, tickets[:1]))

    def dies(*_, **__):
        raise OSError("gone")

    with monkeypatch.context() as m:
        m.setattr(op, "set_current", dies)
        with pytest.raises(OSError):
            op.refresh_daily_ledger(spark, scratch, *args)
    assert fact(op.read_daily(spark, scratch)) == was
    op.refresh_daily_ledger(spark, scratch, *args)
    assert fact(op.read_daily(spark, scratch)) == rebuilt(spark, [change, *tickets[1:]])


def test_an_overtaken_refresh_is_refused(spark, scratch, monkeypatch):
    tickets = grid_tickets()
    op.refresh_daily_ledger(spark, scratch, frame(spark, tickets))
    real = op.set_current

    def overtaken(spark, root, run, onto=None):
        real(spark, root, "other")
        return real(spark, root, run, onto)

    monkeypatch.setattr(op, "set_current", overtaken)
    with pytest.raises(lake.Outrun):
        op.refresh_daily_ledger(spark, scratch, frame(spark, tickets[:1]))


def test_empty_table(spark, scratch):
    op.refresh_daily_ledger(spark, scratch, frame(spark, []))
    assert op.read_daily(spark, scratch).count() == 0
    tickets = grid_tickets()
    op.refresh_daily_ledger(spark, scratch, frame(spark, tickets))
    assert fact(op.read_daily(spark, scratch)) == rebuilt(spark, tickets)


def test_the_delta_is_all_that_is_read_of_tickets(spark, scratch):
    rows = op.contributions(frame(spark, grid_tickets()[:1])).where(F.col("kind") == op.OPENED)
    assert sorted((r["district"], r["category"], str(r["date"]), r["n"]) for r in rows.collect()) == [
        ("P", "x", "2019-01-01", 1), ("P", "y", "2019-01-01", 1)]
