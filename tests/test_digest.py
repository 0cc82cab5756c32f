"""Digest comparison: equal leaves are not joined, and nothing is lost for it."""

import random

import pytest
from pyspark.sql import functions as F

from chronoreg.operators import digest
from chronoreg.plans.run import ParquetStage, run
from chronoreg.sources.fixtures import FIXTURE_PARAMS, derived_inputs
from chronoreg.sources.tables import State
from helpers import HI, interim, rows, state

SF = "/root/testdata/sf0.001"
TREE = digest.Tree(tops=16, leaves=4096)


def _rerun(spark, inp):
    """A second run of the same snapshot, on the first one's result."""
    stage = ParquetStage(spark)
    first = run(inp.interim, inp.state, FIXTURE_PARAMS, stage=stage)
    after = State(*[stage(df, f"after_{n}") for n, df in first.state.tables().items()])
    return run(inp.interim, after, FIXTURE_PARAMS, digests=digest.digests(after, tree=TREE))


def test_rerun_joins_only_what_can_never_be_equal(spark):
    """Only NULL ends stay different from what the register writes for them (a NULL is no change)."""
    inp = derived_inputs(spark, SF, hard=False)
    known = inp.interim.filter(F.col("effective_end_date").isNotNull() & (F.col("dwelling_id") % 20 != 11))
    kept = inp.state
    keep = lambda df: df.filter(~(F.col("dwelling_id") % 20).isin(5, 11, 15))
    again = _rerun(spark, type(inp)(known, State(*[keep(df) for df in (kept.register, kept.building_link, kept.part_link)])))
    assert again.selection.candidates.count() > 1000
    assert [r[digest.LEAF] for r in again.unequal_register.collect()] == [digest.NO_LEAF]
    assert [r[digest.LEAF] for r in again.unequal_links.collect()] == [digest.NO_LEAF]
    joined = [digest.within(df, again.unequal_register, again.digests).count() for df in (again.before.register, again.selection.candidates)]
    assert joined == [0, 0] and again.classified.count() == 0 and again.relinks.count() == 0


def test_few_leaves_of_a_whole_rerun(spark):
    again = _rerun(spark, derived_inputs(spark, SF))
    plain = run(again.interim, again.before, FIXTURE_PARAMS)
    assert sorted(map(str, again.deletes.collect())) == sorted(map(str, plain.deletes.collect()))
    assert sorted(map(str, again.relinks.collect())) == sorted(map(str, plain.relinks.collect()))
    joined = digest.within(again.selection.candidates, again.unequal_register, again.digests).count()
    assert 0 < joined < 0.25 * again.selection.candidates.count()


@pytest.mark.parametrize("seed", range(6))
def test_random_tables(spark, seed):
    """Repeated keys, NULL keys and ends, unlisted scenarios: with and without digests, one tree of four leaves."""
    rng = random.Random(seed)
    starts = ["2020-01-01 00:00:00", "2021-01-01 00:00:00", None]
    ends = [HI, "2022-01-01 00:00:00", None]
    one = lambda: rng.choice([1, 2, 3, 4, 5, 6, None])
    cands = [(one(), rng.choice([1, 1, 1, 2, 7]), 1.0, rng.randint(1, 3), rng.choice([None, None, "p", "q"]), rng.choice(starts), rng.choice(ends), "2024-01-02 00:00:01") for _ in range(12)]
    reg = [(one(), rng.choice([1, 1, 1, 2, 9]), rng.choice(starts), rng.choice(ends), "2023-01-01 00:00:01") for _ in range(10)]
    reg += [(c[0], c[1], c[5], c[6], "2023-01-01 00:00:01") for c in cands[:6]]
    building = [(one(), rng.randint(1, 3), rng.choice(starts), HI, "2023-01-01 00:00:01") for _ in range(5)] + [(c[0], c[3], c[5], c[6], "2023-01-01 00:00:01") for c in cands if not c[4]]
    part = [(c[0], c[4], c[5], c[6], "2023-01-01 00:00:01") for c in cands if c[4]] + [(one(), "p", rng.choice(starts), HI, "2023-01-01 00:00:01") for _ in range(3)]
    params = FIXTURE_PARAMS.with_(version_no=1.0, scenarios=rng.choice([(), (1,), (1, 2, 8)]))
    snapshot, before = interim(spark, cands), state(spark, reg, building, part)
    plain = run(snapshot, before, params)
    tree = digest.Tree(2, rng.choice([2, 4096]))
    other = run(snapshot, before, params, digests=digest.digests(before, tree=tree))
    for name in ("deletes", "inserts", "relinks"):
        one_, two = (sorted(map(str, getattr(r, name).collect())) for r in (plain, other))
        assert one_ == two, name


def test_equal_sets_with_a_repeated_key(spark):
    """Both sides hold the same two rows of a key; the pairs that differ are changes all the same."""
    start, ends = "2020-01-01 00:00:00", [HI, "2022-01-01 00:00:00"]
    snapshot = interim(spark, [(1, 1, 1.0, 5, None, start, e, "2024-01-02 00:00:01") for e in ends])
    before = state(spark, [(1, 1, start, e, "2023-01-01 00:00:01") for e in ends])
    params = FIXTURE_PARAMS.with_(version_no=1.0)
    res = run(snapshot, before, params, digests=digest.digests(before, tree=TREE))
    assert rows(res.deletes) == rows(run(snapshot, before, params).deletes) and res.deletes.count() == 2


def test_hashes_tell_nulls_and_columns_apart(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, "a", None), (1, None, None), (1, "a", "a")], "k long, x string, y string")
    found = df.select(*digest._hashes(["k", "x", "y"])).distinct().count()
    assert found == 4
