"""The documented two-step manual test, row for row, plus re-run idempotence."""

import pytest

from chronoreg.model import RunParams
from chronoreg.plans.run import run
from chronoreg.sources.fixtures import B1, B2, GOLDEN_NOW, PART_P, PART_Q, golden_interim
from chronoreg.sources.tables import empty_state
from helpers import materialise, rows

HI = "9999-01-01 00:00:00"
S0, E0, S1 = "1900-05-15 00:00:00", "2021-03-12 00:00:00", "2021-03-12 00:00:01"
E1, S2, E2, S3 = "2023-04-17 00:00:00", "2023-04-17 00:00:01", "2024-08-07 00:00:00", "2024-08-07 00:00:01"
B2_1 = "2023-07-30 12:53:00"

STEP1 = {
    "register": {(0, 0, S0, HI, B1, HI, "N"), (0, 99, S1, E1, B1, HI, "N"),
                 (99998888, 0, S0, E0, B1, HI, "N"), (99998888, 0, S1, E1, B1, HI, "N"),
                 (99999999, 0, S0, HI, B1, HI, "N")},
    "building_link": {(0, 0, S0, HI, B1, HI, "N"), (0, 0, S1, E1, B1, HI, "N"),
                      (99998888, 0, S1, E1, B1, HI, "N"), (99999999, 999999999, S0, HI, B1, HI, "N")},
    "part_link": {(99998888, PART_P, S0, E0, B1, HI, "N")},
}
STEP2 = {
    "register": {(0, 0, S0, HI, B1, B2_1, "N"), (0, 0, S0, E0, B2, HI, "N"),
                 (0, 99, S1, E1, B1, B2_1, "N"), (0, 0, S1, E1, B2, HI, "N"),
                 (0, 99, S2, HI, B2, HI, "N"), (98765432, 99, S2, E2, B2, HI, "N"),
                 (98765432, 0, S3, HI, B2, HI, "N"), (99998888, 0, S0, E0, B1, HI, "N"),
                 (99998888, 0, S1, E1, B1, HI, "N"), (99998888, 0, S2, HI, B2, HI, "N"),
                 (99999999, 0, S0, HI, B1, GOLDEN_NOW, "Y")},
    "building_link": {(0, 0, S0, HI, B1, B2_1, "N"), (0, 0, S0, E0, B2, HI, "N"),
                      (0, 0, S1, E1, B1, B2_1, "N"), (0, 0, S1, E1, B2, HI, "N"),
                      (0, 0, S2, HI, B2, HI, "N"), (98765432, 0, S2, E2, B2, HI, "N"),
                      (98765432, 998765432, S3, HI, B2, HI, "N"), (99998888, 0, S0, E0, B2, HI, "N"),
                      (99998888, 0, S1, E1, B1, B2_1, "N"),
                      (99999999, 999999999, S0, HI, B1, GOLDEN_NOW, "Y")},
    "part_link": {(99998888, PART_P, S0, E0, B1, B2_1, "N"), (99998888, PART_Q, S1, E1, B2, HI, "N"),
                  (99998888, PART_P, S2, HI, B2, HI, "N")},
}


def _log(result):
    return {r["table_name"]: (r["records_added"], r["records_modified"], r["records_retired"],
                              r["total_records_after"]) for r in result.changelog.collect()}


@pytest.fixture(scope="module")
def steps(spark):
    interim = golden_interim(spark)
    p1 = RunParams(version_no=0.0, run_ts="2024-01-01 00:00:00", batch_ts=B1)
    r1 = run(interim, empty_state(spark), p1)
    s1 = materialise(spark, r1.state)
    p2 = RunParams(version_no=0.0, run_ts=GOLDEN_NOW)
    r2 = run(interim, s1, p2)
    return interim, p1, r1, s1, p2, r2


def test_step1_rows(steps):
    _, _, r1, _, _, _ = steps
    for name, df in r1.state.tables().items():
        assert rows(df) == STEP1[name], name


def test_step1_changelog(steps):
    assert _log(steps[2]) == {"Dwelling_Register_Skinny": (5, 0, 0, 5),
                              "Dwelling_Building_Reference": (4, 0, 0, 4),
                              "Dwelling_Part_of_Building_Reference": (1, 0, 0, 1)}


def test_step2_rows(steps):
    r2 = steps[5]
    for name, df in r2.state.tables().items():
        assert rows(df) == STEP2[name], name
    assert (r2.state.register.count(), r2.state.building_link.count(), r2.state.part_link.count()) == (11, 10, 3)


def test_step2_changelog(steps):
    assert _log(steps[5]) == {"Dwelling_Register_Skinny": (4, 2, 1, 8),
                              "Dwelling_Building_Reference": (3, 3, 1, 6),
                              "Dwelling_Part_of_Building_Reference": (1, 1, 0, 2)}


def test_rerun_step1_changes_nothing(spark, steps):
    interim, p1, _, s1, _, _ = steps
    again = run(interim, s1, p1)
    assert again.changes.deletes.count() == 0
    assert again.changes.inserts.count() == 0
    assert again.changes.relinks.count() == 0


def test_rerun_step2_changes_nothing(spark, steps):
    interim, _, _, _, p2, r2 = steps
    again = run(interim, materialise(spark, r2.state), p2)
    assert (again.changes.deletes.count(), again.changes.inserts.count(),
            again.changes.relinks.count()) == (0, 0, 0)
