"""Strict staging ends a run inside its plan; the recent log reads only recent folders."""

import pytest

from chronoreg.model import RunParams
from chronoreg.plans.publish import RegisterStore, run_and_publish
from chronoreg.sources.changelog import append_log, read_log, recent_log
from helpers import HI, interim, rows

S0, E1, B1, B2 = "2020-01-01 00:00:00", "2022-01-01 00:00:00", "2024-01-01 00:00:00", "2024-01-02 00:00:00"
P = RunParams(version_no=1.0, run_ts="2024-06-01 12:00:00", strict_staging=True)
BASE = [(1, 1, 1.0, 10, None, S0, HI, B1), (2, 1, 1.0, 10, "p" * 21, S0, HI, B1)]
BAD = {"a NULL building id": (1, 1, 1.0, None, None, S0, E1, B2), "a long part id": (2, 1, 1.0, 10, "p" * 22, S0, E1, B2)}


@pytest.mark.parametrize("mode", ["dry_run", "commit"])
@pytest.mark.parametrize("case", BAD)
def test_strict_run_aborts(spark, scratch_dir, case, mode):
    store = RegisterStore(spark, scratch_dir)
    run_and_publish(spark, interim(spark, BASE), store, P, mode="commit")
    before = {n: rows(df) for n, df in store.state().tables().items()}
    snapshot = interim(spark, [BAD[case], *(r for r in BASE if r[0] != BAD[case][0])])
    with pytest.raises(Exception, match="staging holds"):
        run_and_publish(spark, snapshot, store, P.with_(batch_filter=False), mode=mode)
    assert store.current_version() == 1
    assert {n: rows(df) for n, df in store.state().tables().items()} == before
    done = run_and_publish(spark, snapshot, store, P.with_(batch_filter=False, strict_staging=False), mode="commit")
    assert done.version == 2


def test_strict_run_takes_what_the_columns_hold(spark, scratch_dir):
    """Inserts are staged elsewhere: a long part id or no building id is no failure there."""
    store = RegisterStore(spark, scratch_dir)
    odd = [(3, 1, 1.0, None, None, S0, HI, B1), (4, 1, 1.0, 10, "p" * 40, S0, HI, B1)]
    assert run_and_publish(spark, interim(spark, [*BASE, *odd]), store, P, mode="commit").version == 1
    update = [(2, 1, 1.0, 10, "p" * 21, S0, E1, B2), *(r for r in [*BASE, *odd] if r[0] != 2)]
    assert run_and_publish(spark, interim(spark, update), store, P.with_(batch_filter=False), mode="commit").version == 2


def partition_filters(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line.split("PartitionFilters: [")[1].split("]")[0] for line in plan.splitlines() if "PartitionFilters: [" in line]


def test_recent_log_reads_recent_folders(spark, scratch_dir):
    store = RegisterStore(spark, scratch_dir)
    for hour in ("08", "11", "12"):
        run_and_publish(spark, interim(spark, BASE), store, P.with_(run_ts=f"2024-06-01 {hour}:30:00", change_ts=None), mode="commit")
    found = store.recent_changes("2024-06-01 13:00:00")
    assert {str(r.change_date) for r in found.collect()} == {"2024-06-01 11:30:00", "2024-06-01 12:30:00"} and found.count() == 6
    assert any("v#" in f and "IN (2,3)" in f for f in partition_filters(found)), partition_filters(found)
    assert store.recent_changes("2024-06-01 23:00:00").count() == 0
    assert RegisterStore(spark, f"{scratch_dir}/none").recent_changes("2024-06-01 13:00:00").count() == 0


def test_log_by_day(spark, scratch_dir):
    path, store = f"{scratch_dir}/log", RegisterStore(spark, f"{scratch_dir}/store")
    for day in ("2024-05-30 23:30:00", "2024-05-31 23:30:00", "2024-06-01 00:30:00"):
        run_and_publish(spark, interim(spark, BASE), store, P.with_(run_ts=day, change_ts=None), mode="commit")
    append_log(store.changelog().limit(4), path)
    append_log(store.changelog().exceptAll(read_log(spark, path).drop("change_day")), path)
    assert rows(read_log(spark, path).drop("change_day")) == rows(store.changelog())
    recent = recent_log(spark, path, "2024-06-01 01:00:00")
    assert rows(recent) == rows(store.recent_changes("2024-06-01 01:00:00")) and recent.count() == 6
    assert any("change_day" in f and ">= 2024-05-31" in f for f in partition_filters(recent)), partition_filters(recent)
