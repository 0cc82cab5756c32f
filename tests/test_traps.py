"""Small cases for the behaviours the original process has by construction."""

from pyspark.sql import functions as F

from chronoreg.model import RunParams
from chronoreg.operators import checks
from chronoreg.operators.select import candidates_ambiguous
from chronoreg.plans.run import run, select
from chronoreg.sources.tables import empty_state, open_rows
from helpers import HI, interim, materialise, rows, state

V = 1.0
B1, B2 = "2024-01-01 00:00:00", "2024-01-02 00:00:00"
S0, S1 = "2020-01-01 00:00:00", "2021-01-01 00:00:00"
E1, E2 = "2022-01-01 00:00:00", "2023-01-01 00:00:00"
OLD = "2019-01-01 00:00:00"
NOW = "2024-06-01 12:00:00"
P = RunParams(version_no=V, run_ts=NOW)


def _counts(res):
    return (res.changes.deletes.count(), res.changes.inserts.count(), res.changes.relinks.count())


def test_t2_key_open_under_unlisted_scenario_is_ignored(spark):
    snap = interim(spark, [(1, 1, V, 10, None, S0, E1, B2)])
    st = state(spark, register=[(1, 7, S0, HI, OLD)], building=[(1, 10, S0, HI, OLD)])
    assert _counts(run(snap, st, P)) == (0, 0, 0)


def test_t4_null_effective_end_is_never_an_update(spark):
    snap = interim(spark, [(1, 1, V, 10, None, S0, None, B2), (2, 1, V, 10, None, S0, E1, B2)])
    st = state(spark, register=[(1, 1, S0, HI, OLD), (2, 1, S0, None, OLD)],
               building=[(1, 10, S0, HI, OLD), (2, 10, S0, None, OLD)])
    assert _counts(run(snap, st, P)) == (0, 0, 0)


def test_t5_second_part_link_is_closed_and_the_kept_part_opened_again(spark):
    snap = interim(spark, [(1, 1, V, 10, "p1", S0, HI, B2)])
    st = state(spark, register=[(1, 1, S0, HI, OLD)],
               part=[(1, "p1", S0, HI, OLD), (1, "p2", S0, HI, OLD)])
    res = run(snap, st, P)
    assert rows(res.changes.relinks.select("old_pob_id", "part_of_building_id")) == {("p2", "p1")}
    part = res.state.part_link
    assert part.count() == 3
    assert rows(open_rows(part).select("part_of_building_id")) == {("p1",)}
    assert open_rows(part).count() == 2  # two open rows for one key remain


def test_t6_building_to_other_building_is_missed(spark):
    snap = interim(spark, [(1, 1, V, 20, None, S0, HI, B2)])
    st = state(spark, register=[(1, 1, S0, HI, OLD)], building=[(1, 10, S0, HI, OLD)])
    assert _counts(run(snap, st, P)) == (0, 0, 0)


def test_t7_replaying_an_older_batch_ends_rows_before_they_start(spark):
    snap = interim(spark, [(1, 1, V, 10, None, S0, E1, B1), (1, 1, V, 10, None, S0, HI, B2)])
    first = run(snap, empty_state(spark), P)
    replay = run(snap, materialise(spark, first.state), P.with_(batch_ts=B1))
    bad = {r["table_name"]: r["violations"] for r in checks.intervals(replay.state).collect()}
    assert bad["Dwelling_Register_Skinny"] == 1
    assert bad["Dwelling_Building_Reference"] == 1


def test_t9_link_open_by_null_end_is_not_closed_by_an_update(spark):
    snap = interim(spark, [(1, 1, V, 10, None, S0, E1, B2)])
    st = state(spark, register=[(1, 1, S0, HI, OLD)],
               building=[(1, 10, S0, HI, OLD, None, "N")])
    res = run(snap, st, P)
    assert res.changes.inserts.filter(F.col("change") == "UPDATE").count() == 1
    assert open_rows(res.state.building_link).count() == 2


def test_t10_changed_start_is_a_delete_and_an_insert(spark):
    snap = interim(spark, [(1, 1, V, 10, None, S1, HI, B2)])
    st = state(spark, register=[(1, 1, S0, HI, OLD)], building=[(1, 10, S0, HI, OLD)])
    res = run(snap, st, P)
    assert rows(res.changes.deletes.select("change")) == {("DELETE",)}
    assert rows(res.changes.inserts.select("change")) == {("INSERT",)}
    closed = res.state.building_link.filter(F.col("effective_start_date") == F.lit(S0).cast("timestamp_ntz"))
    assert rows(closed.select("sys_end_date", "sys_deleted_ind")) == {(NOW, "Y")}


def test_t12_ambiguous_rows_keep_their_own_system_end(spark):
    snap = interim(spark, [(1, 5, V, 10, None, S0, HI, B2, "2024-01-05 00:00:00", "N"),
                           (1, 5, V, 11, None, S0, HI, B2, "2024-01-05 00:00:00", "Y")])
    res = run(snap, empty_state(spark), P)
    assert rows(res.selection.candidates.select("building_id", "sys_end_date", "sys_deleted_ind")) == {
        (0, "2024-01-05 00:00:00", "N")}
    assert res.selection.candidates.count() == 1
    # C2 alone groups on the snapshot's own flag before replacing it: two rows
    sel = res.selection
    c2 = candidates_ambiguous(snap, sel.scenarios, P)
    assert c2.count() == 2 and rows(c2.select("sys_deleted_ind")) == {("N",)}
    assert open_rows(res.state.register).count() == 0
    assert res.state.register.count() == 1


def test_several_candidates_per_key_update_once_and_insert_each(spark):
    snap = interim(spark, [(1, 1, V, 10, None, S0, E1, B2), (1, 1, V, 10, None, S0, E2, B2)])
    st = state(spark, register=[(1, 1, S0, HI, OLD)], building=[(1, 10, S0, HI, OLD)])
    res = run(snap, st, P)
    assert res.changes.inserts.filter(F.col("change") == "UPDATE").count() == 2
    reg = res.state.register
    assert reg.filter(F.col("sys_end_date") == F.lit("2024-01-01 23:59:59").cast("timestamp_ntz")).count() == 1
    assert open_rows(reg).count() == 2
    assert checks.open_unique(reg).first()["violations"] == 1


def test_t1_batch_filter(spark):
    snap = interim(spark, [(1, 1, V, 10, None, S0, E1, B1), (1, 1, V, 10, None, S0, E2, B2)])
    assert select(snap, P).candidates.count() == 1
    assert rows(select(snap, P).candidates.select("effective_end_date")) == {(E2,)}
    assert select(snap, P.with_(batch_filter=False)).candidates.count() == 2
    assert select(snap, P.with_(batch_ts=B1)).candidates.count() == 1


def test_scenario_in_an_older_batch_keeps_its_rows(spark):
    snap = interim(spark, [(1, 1, V, 10, None, S0, HI, B1), (2, 2, V, 10, None, S0, HI, B2)])
    st = state(spark, register=[(1, 1, S0, HI, OLD), (2, 2, S0, HI, OLD)])
    assert _counts(run(snap, st, P)) == (0, 0, 0)
    # an explicit batch says nothing about a scenario that has no rows in it
    assert _counts(run(snap, st, P.with_(batch_ts=B2))) == (0, 0, 0)
    # as coded: all batches, whatever their dates
    assert _counts(run(snap, st, P.with_(batch_filter=False))) == (0, 0, 0)


def test_listed_scenario_without_any_row_is_retired(spark):
    snap = interim(spark, [(2, 2, V, 10, None, S0, HI, B2)])
    st = state(spark, register=[(1, 1, S0, HI, OLD), (2, 2, S0, HI, OLD)])
    assert _counts(run(snap, st, P.with_(scenarios=(1, 2)))) == (1, 0, 0)


def test_explicit_list_keeps_the_excluded_scenario(spark):
    snap = interim(spark, [(1, 999, V, 10, None, S0, HI, B2), (2, 1, V, 10, None, S0, HI, B2)])
    assert select(snap, P).candidates.count() == 1
    assert select(snap, P.with_(scenarios=(999, 1))).candidates.count() == 2


def test_version_is_compared_exactly_as_double(spark):
    snap = interim(spark, [(1, 1, 0.54, 10, None, S0, HI, B2)])
    assert select(snap, P.with_(version_no=0.54)).candidates.count() == 1
    assert select(snap, P.with_(version_no=0.5400001)).candidates.count() == 0


def test_fractional_batch_rounds_to_the_second(spark):
    snap = interim(spark, [(1, 1, V, 10, None, S0, HI, "2024-01-02 00:00:00.600000")])
    sel = select(snap, P)
    assert rows(sel.scenarios.frame.select("batch")) == {("2024-01-02 00:00:01",)}
    assert sel.candidates.count() == 1


def test_deleted_key_closes_register_and_link_with_the_run_clock(spark):
    snap = interim(spark, [(2, 1, V, 10, None, S0, HI, B2)])
    st = state(spark, register=[(1, 1, S0, HI, OLD), (2, 1, S0, HI, OLD)],
               building=[(2, 10, S0, HI, OLD)], part=[(1, "p9", S0, HI, OLD)])
    res = run(snap, st, P)
    assert rows(res.state.register.filter("dwelling_id = 1").select("sys_end_date", "sys_deleted_ind")) == {
        (NOW, "Y")}
    assert rows(res.state.part_link.select("sys_end_date", "sys_deleted_ind")) == {(NOW, "Y")}


def test_readers_check_and_cast_the_declared_schema(spark, scratch_dir):
    import os

    import pytest as _pytest

    from chronoreg.sources.tables import SchemaError, read_interim

    snap = interim(spark, [(1, 1, V, 10, None, S0, HI, B2)])
    wide = snap.withColumn("scenario_no", F.col("scenario_no").cast("long"))
    wide.write.parquet(os.path.join(scratch_dir, "wide"))
    back = read_interim(spark, os.path.join(scratch_dir, "wide"))
    assert dict(back.dtypes)["scenario_no"] == "int" and back.count() == 1
    snap.drop("version_no").write.parquet(os.path.join(scratch_dir, "short"))
    with _pytest.raises(SchemaError):
        read_interim(spark, os.path.join(scratch_dir, "short"))
