"""Counts of a run: observed while it writes, one scan of each table, one exchange of keys for the checks."""

import random

import pytest
from pyspark.sql import functions as F

from chronoreg.operators import balance, checks, report
from chronoreg.plans.publish import RegisterStore, run_and_publish
from chronoreg.plans.run import run
from chronoreg.sources.fixtures import FIXTURE_PARAMS, derived_inputs
from chronoreg.sources.tables import State
from helpers import HI, interim, state

SF = "/root/testdata/sf0.001"


def nodes(df):
    found = []

    def walk(node):
        found.append(node)
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    old = df.sparkSession.conf.get("spark.sql.adaptive.enabled")
    df.sparkSession.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        walk(df.select("*")._jdf.queryExecution().executedPlan())
    finally:
        df.sparkSession.conf.set("spark.sql.adaptive.enabled", old)
    return found


@pytest.fixture(scope="module")
def stored(spark):
    """A run on tables that are files, so that a plan shows which of them it scans."""
    inp = derived_inputs(spark, SF)
    res = run(inp.interim, inp.state, FIXTURE_PARAMS)
    kept = State(*[res.stage(df, f"state_{n}") for n, df in inp.state.tables().items()])
    return run(inp.interim, kept, FIXTURE_PARAMS)


def scans(df, name):
    files = [n.relation().location().rootPaths().toString() for n in nodes(df) if n.nodeName().startswith("Scan parquet")]
    return sum(f"/state_{name}" in f for f in files)


def test_the_log_scans_each_asked_table_once(stored):
    assert [scans(stored.changelog, n) for n in balance.MARKS] == [1, 1, 1]
    assert [scans(stored.log_of("building_link"), n) for n in balance.MARKS] == [0, 1, 0]


def test_counts_by_system_end_scan_each_table_once(stored):
    assert [scans(report.count_by_sys_end(stored.before, stored.applied), n) for n in balance.MARKS] == [1, 1, 1]


def test_checks_take_one_exchange_of_keys(stored):
    plan = nodes(balance.tally(stored.before, stored.applied))
    assert sum(n.nodeName() == "Exchange" for n in plan) == 2  # by key, and the one row of the result
    assert sum("Join" in n.nodeName() for n in plan) == 0
    assert [scans(balance.tally(stored.before, stored.applied), n) for n in balance.MARKS] == [1, 1, 1]


def test_observed_counts_are_the_staged_rows(stored):
    assert stored.counted["candidates"] == stored.selection.candidates.count()
    for kind, name in (("INSERT", "inserts"), ("UPDATE", "updates"), ("DELETE", "deletes")):
        rows = stored.classified.filter(F.col("change") == kind)
        assert stored.counted[name] == rows.count() and stored.counted[f"{name}_no_part"] == rows.filter("part_of_building_id IS NULL").count()
    assert report.preview_rows(stored.counted) == [r.asDict() for r in report.preview_counts(stored.changes).collect()]


def test_tally_agrees_with_each_check(stored):
    found = stored.tally
    assert found["exclusive_links"] == checks.exclusive_links(stored.state).first()["violations"] > 0
    unique = checks.open_unique(stored.register.after).first()
    assert (found["open_unique"], found["max_open_per_key"]) == (unique["violations"], unique["max_rows_per_key"])
    bad = [r["violations"] for r in checks.intervals(stored.state).collect()]
    assert [found[f"intervals_{m}"] for m in balance.MARKS] == bad and min(bad) > 0
    after = balance.tally(stored.state, None, stored.retired_end).first().asDict()
    assert after == found


@pytest.mark.parametrize("seed", range(3))
def test_random_states(spark, seed):
    """NULL keys, repeated keys and both kinds of link open, counted as they are."""
    rng = random.Random(seed)
    start = lambda: rng.choice(["2020-01-01 00:00:00", "2021-01-01 00:00:00", None])
    row = lambda link: (rng.choice([1, 2, 3, None]), link, start(), HI, rng.choice(["2023-01-01 00:00:00", None]), rng.choice([HI, None, "2022-01-01 00:00:00", "2024-01-01 00:00:00"]), "N")
    st = state(spark, [row(rng.randint(1, 2)) for _ in range(25)], [row(rng.randint(1, 5)) for _ in range(25)], [row("p") for _ in range(25)])
    found = balance.tally(st, None).first()
    assert found["exclusive_links"] == checks.exclusive_links(st).first()["violations"]
    assert found["open_unique"] == checks.open_unique(st.register).first()["violations"]
    assert [found[f"intervals_{m}"] for m in balance.MARKS] == [r["violations"] for r in checks.intervals(st).collect()]


def test_commit_logs_what_the_dry_run_says(spark, scratch_dir):
    """Twice the same clock: rows that the first run closed count as retired in the second one's log."""
    store = RegisterStore(spark, scratch_dir)
    B1, B2, S0 = "2024-01-01 00:00:00", "2024-01-02 00:00:00", "2020-01-01 00:00:00"
    params = FIXTURE_PARAMS.with_(version_no=1.0)
    one = interim(spark, [(i, 1, 1.0, 10, None if i % 2 else f"p{i}", S0, HI, B1) for i in range(1, 9)])
    two = interim(spark, [(i, 1, 1.0, 10, None if i % 2 else f"p{i}", S0, HI, B2) for i in range(3, 9)])
    three = interim(spark, [(i, 1, 1.0, 10, None if i % 2 else f"p{i}", S0, HI, B2) for i in range(5, 10)])
    for n, snapshot in enumerate((one, two, three), 1):
        dry = run_and_publish(spark, snapshot, store, params)
        done = run_and_publish(spark, snapshot, store, params, mode="commit")
        assert dry.changelog == done.changelog and dry.violations == done.violations and dry.counts == done.counts and done.version == n
    logged = {r.table_name: (r.records_added, r.records_retired, r.total_records_after) for r in store.changelog().collect() if r.total_records_after in (5, 3, 2)}
    assert logged["Dwelling_Register_Skinny"] == (1, 2, 5)
    assert logged["Dwelling_Building_Reference"] == (1, 2, 3)  # one closed by each of the last two runs, at one clock
