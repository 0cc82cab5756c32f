"""Publish: dry run keeps nothing, commit is all-or-nothing, versions read back exactly."""

import os

import pytest
from pyspark.errors import AnalysisException

from chronoreg.model import RunParams
from chronoreg.plans.publish import PublishError, RegisterStore, StoreError, run_and_publish
from chronoreg.plans.run import ParquetStage, run
from helpers import interim, rows

V = 1.0
B1, B2 = "2024-01-01 00:00:00", "2024-01-02 00:00:00"
S0 = "2020-01-01 00:00:00"
E1 = "2022-01-01 00:00:00"
HI = "9999-01-01 00:00:00"
P = RunParams(version_no=V, run_ts="2024-06-01 12:00:00")


def _snap(spark):
    return interim(spark, [(1, 1, V, 10, None, S0, HI, B2), (2, 1, V, 10, "p2", S0, E1, B2),
                           (1, 1, V, 10, None, S0, E1, B1)])


def test_dry_run_keeps_nothing(spark, scratch_dir):
    store = RegisterStore(spark, scratch_dir)
    report = run_and_publish(spark, _snap(spark), store, P)
    assert report.mode == "dry_run" and report.version == 1
    assert store.current_version() is None
    assert {r["table_name"]: r["records_added"] for r in report.changelog} == {
        "Dwelling_Register_Skinny": 2, "Dwelling_Building_Reference": 1,
        "Dwelling_Part_of_Building_Reference": 1}


def test_commit_then_rerun_is_idempotent(spark, scratch_dir):
    store = RegisterStore(spark, scratch_dir)
    first = run_and_publish(spark, _snap(spark), store, P, mode="commit")
    assert first.version == 1 and store.current_version() == 1
    assert store.state().register.count() == 2
    second = run_and_publish(spark, _snap(spark), store, P, mode="commit")
    assert second.version == 2
    assert all(r["records_added"] == 0 and r["records_modified"] == 0 for r in second.changelog)
    assert rows(store.state(2).register) == rows(store.state(1).register)
    assert store.changelog().count() == 6


def test_history_is_append_only_across_versions(spark, scratch_dir):
    store = RegisterStore(spark, scratch_dir)
    run_and_publish(spark, _snap(spark), store, P.with_(batch_ts=B1), mode="commit")
    run_and_publish(spark, _snap(spark), store, P, mode="commit")
    reg2 = store.state(2).register
    assert reg2.count() == 3  # one closed by the update, two open
    assert rows(store.state(1).register) == {(1, 1, S0, E1, B1, HI, "N")}


def test_failure_mid_publish_leaves_the_pointer(spark, scratch_dir, monkeypatch):
    store = RegisterStore(spark, scratch_dir)
    run_and_publish(spark, _snap(spark), store, P.with_(batch_ts=B1), mode="commit")
    before = rows(store.state().register)
    real = store._write_table

    def broken(df, name, version, attempt):
        if name == "part_link":
            raise RuntimeError("disk gone")
        return real(df, name, version, attempt)

    monkeypatch.setattr(store, "_write_table", broken)
    with pytest.raises(RuntimeError):
        run_and_publish(spark, _snap(spark), store, P, mode="commit")
    assert store.current_version() == 1
    assert rows(store.state().register) == before
    monkeypatch.setattr(store, "_write_table", real)
    assert run_and_publish(spark, _snap(spark), store, P, mode="commit").version == 2


def test_strict_commit_refuses_a_state_that_breaks_a_rule(spark, scratch_dir):
    store = RegisterStore(spark, scratch_dir)
    run_and_publish(spark, _snap(spark), store, P, mode="commit")
    with pytest.raises(PublishError):
        run_and_publish(spark, _snap(spark), store, P.with_(batch_ts=B1), mode="commit", strict=True)
    assert store.current_version() == 1


def test_second_run_on_one_base_is_refused(spark, scratch_dir):
    store = RegisterStore(spark, scratch_dir)
    stage = ParquetStage(spark)
    one = run(interim(spark, [(1, 1, V, 10, None, S0, HI, B2)]), store.state(), P, stage=stage)
    other = run(interim(spark, [(2, 1, V, 10, None, S0, HI, B2)]), store.state(), P, stage=ParquetStage(spark))
    assert store.publish(one, "commit").version == 1
    with pytest.raises(PublishError):
        store.publish(other, "commit")
    assert {r[0] for r in rows(store.state().register)} == {1}


def test_missing_committed_table_raises(spark, scratch_dir):
    store = RegisterStore(spark, scratch_dir)
    run_and_publish(spark, _snap(spark), store, P, mode="commit")
    os.rename(os.path.join(scratch_dir, "register"), os.path.join(scratch_dir, "elsewhere"))
    with pytest.raises(AnalysisException):
        store.state().register.count()
    os.rename(os.path.join(scratch_dir, "_commits"), os.path.join(scratch_dir, "no_commits"))
    with pytest.raises(StoreError):
        store.state()


def test_version_is_never_replaced(spark, scratch_dir):
    store = RegisterStore(spark, scratch_dir)
    run_and_publish(spark, _snap(spark), store, P, mode="commit")
    with pytest.raises(AnalysisException):
        store._write_commit(1, "other", 1, P.run_ts, P.change_ts)


def test_purge_deletes_test_rows_and_recent_log(spark, scratch_dir):
    store = RegisterStore(spark, scratch_dir)
    snap = interim(spark, [(1, 0, V, 0, None, S0, HI, B2), (2, 1, V, 10, "tst1", S0, HI, B2), (3, 1, V, 10, None, S0, HI, B2)])
    run_and_publish(spark, snap, store, P, mode="commit")
    dry = {r["table_name"]: (r["rows_kept"], r["rows_removed"]) for r in store.purge_test_rows(P.run_ts)}
    assert store.current_version() == 1 and store.state().register.count() == 3
    assert dry["Dwelling_Register_Skinny"] == (2, 1) and dry["Table_Changelog"] == (0, 3)
    store.purge_test_rows(P.run_ts, "commit")
    assert {r[0] for r in rows(store.state().register)} == {2, 3}
    assert {r[0] for r in rows(store.state().building_link)} == {3}
    assert store.state().part_link.count() == 0 and store.changelog().count() == 0
    again = run_and_publish(spark, snap, store, P, mode="commit")  # the next run builds on the purged version
    assert again.version == 3 and store.state().register.count() == 3


def test_recent_changes_come_from_the_stored_log(spark, scratch_dir):
    store = RegisterStore(spark, scratch_dir)
    run_and_publish(spark, _snap(spark), store, P.with_(batch_ts=B1, run_ts="2024-06-01 02:00:00", change_ts="2024-06-01 02:00:00"), mode="commit")
    run_and_publish(spark, _snap(spark), store, P, mode="commit")
    assert store.changelog().count() == 6 and store.recent_changes(P.run_ts).count() == 3


def test_report_has_the_preview_counts(spark, scratch_dir):
    report = run_and_publish(spark, _snap(spark), RegisterStore(spark, scratch_dir), P)
    assert {(r["count_name"], r["change"]): r["n"] for r in report.counts} == {
        ("total_considered_records", None): 2, ("dwell_inserts", "INSERT"): 2}


def test_publish_drops_its_staging_folder(spark, scratch_dir):
    from chronoreg.plans.run import staging_root

    root = staging_root(spark)
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    store = RegisterStore(spark, scratch_dir)
    run_and_publish(spark, _snap(spark), store, P, mode="commit")
    after = set(os.listdir(root)) if os.path.isdir(root) else set()
    assert {d for d in after - before if d.startswith("run-")} == set()
    assert store.state().register.count() == 2  # the committed tables do not depend on staging
