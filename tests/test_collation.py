"""Part ids that differ in case only: one id under a collation that takes no account of case, two by default."""

from dataclasses import replace

from chronoreg.model import DWELLINGS, RunParams
from chronoreg.operators import digest, report
from chronoreg.plans.run import run
from helpers import HI, interim, rows, state

NOCASE = replace(DWELLINGS, collation="UTF8_LCASE")
S0, B1, B2 = "2020-01-01 00:00:00", "2023-01-01 00:00:00", "2024-01-02 00:00:00"
P = RunParams(version_no=1.0, run_ts="2024-06-01 12:00:00")


def _inputs(spark):
    snapshot = interim(spark, [(1, 1, 1.0, 5, "PART1", S0, HI, B2), (2, 1, 1.0, 5, "new2", S0, HI, B2), (3, 1, 1.0, 5, None, S0, HI, B2)])
    before = state(spark, [(i, 1, S0, HI, B1) for i in (1, 2, 3)],
                   part=[(1, "part1", S0, HI, B1), (2, "OLD2", S0, HI, B1), (3, "TST3", S0, HI, B1)])
    return snapshot, before


def test_same_id_is_no_relink(spark):
    snapshot, before = _inputs(spark)
    one, two = run(snapshot, before, P, NOCASE), run(snapshot, before, P)
    assert {r.dwelling_id for r in one.relinks.collect()} == {2, 3}
    assert {r.dwelling_id for r in two.relinks.collect()} == {1, 2, 3}
    kept = {(r.dwelling_id, r.part_of_building_id) for r in one.part_link.after.filter("sys_end_date > '4999-01-01'").collect()}
    assert kept == {(1, "part1"), (2, "new2")}  # ids stay as they are written


def test_one_candidate_of_two_spellings(spark):
    snapshot = interim(spark, [(1, 1, 1.0, 5, p, S0, HI, B2) for p in ("pQ", "PQ", "Pq", "pr")] + [(2, 5, 1.0, 5, p, S0, HI, B2) for p in ("x", "X")])
    found = run(snapshot, state(spark), P, NOCASE).selection.candidates
    assert {(r.dwelling_id, r.part_of_building_id) for r in found.collect()} == {(1, "PQ"), (1, "pr"), (2, "X")}
    assert run(snapshot, state(spark), P).selection.candidates.count() == 6


def test_like_takes_no_account_of_case(spark):
    snapshot, before = _inputs(spark)
    like = report.test_row_predicates(NOCASE)["part_link"]
    assert run(snapshot, before, P, NOCASE).before.part_link.filter(like).count() == 1
    assert before.part_link.filter(like).count() == 0


def test_a_change_closes_the_link_however_it_is_written(spark):
    """The link row equals the update's part but for case: only its end differs (R5), as byte by byte its id does too."""
    snapshot = interim(spark, [(1, 1, 1.0, 5, "PART1", S0, "2022-01-01 00:00:00", B2)])
    before = state(spark, [(1, 1, S0, HI, B1)], part=[(1, "part1", S0, HI, B1)])
    for spec in (NOCASE, DWELLINGS):
        res = run(snapshot, before, P, spec)
        assert [(r.sys_deleted_ind, str(r.sys_end_date)) for r in res.part_link.named.collect()] == [("N", "2024-01-01 23:59:59")]


def test_digests_with_a_collation(spark):
    snapshot, before = _inputs(spark)
    by_digest = run(snapshot, before, P, NOCASE, digests=digest.digests(before, NOCASE))
    assert rows(by_digest.relinks) == rows(run(snapshot, before, P, NOCASE).relinks)
