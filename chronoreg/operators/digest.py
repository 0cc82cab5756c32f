"""Which keys can have changed at all: digests of a snapshot and of the open tables, compared before any row is joined.

A key's hash names a leaf, and `Tree.leaves` leaves hang under each of `Tree.tops` tops.  A leaf's digest is free of
order: how many rows it has and the sums of two independent 64-bit hashes of what the comparison looks at, so it is one
partial aggregate.  Tops are compared first, then the leaves of unequal tops.  A leaf that is equal on both sides holds
no change, provided that no key has two rows there: two equal sets of rows with a repeated key still form pairs that
differ.  The side that is kept (register, links) is grouped by key once for that; a key with several open rows makes its
leaf unequal for good, and so the joins see it.  Rows with a NULL key component never match and have a leaf of their
own, which is never equal.

The digests of the kept side are relations like any other: :func:`digests` makes them from a state, a deployment may
keep them beside its tables, and then a run of an unchanged snapshot reads the snapshot and the digests, compares, and
has no leaf to join.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoreg.model import DWELLINGS, EFF_END, Spec
from chronoreg.operators.select import ScenarioSet
from chronoreg.sources.tables import State, open_rows

LEAF = "_leaf"
TOP = "_top"
NO_LEAF = -1  # of rows with a NULL key component
ROWS = "_rows"
SUMS = ("_one_high", "_one_low", "_two_high", "_two_low")
REPEATED = "_repeated"


@dataclass(frozen=True)
class Tree:
    """How finely keys are told apart: about as many leaves as a run has changed keys at most, times ten or more."""

    tops: int = 1024
    leaves: int = 1024

    def leaf(self, keys: list[str]) -> Column:
        known = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
        return F.when(known, F.pmod(F.xxhash64(*keys), F.lit(self.tops * self.leaves))).otherwise(F.lit(NO_LEAF).cast("long"))

    def top(self) -> Column:
        return F.floor(F.col(LEAF) / self.leaves).alias(TOP)


@dataclass(frozen=True)
class Digests:
    """Of the register by leaf and scenario, of both kinds of link together by leaf."""

    register: DataFrame
    links: DataFrame
    tree: Tree = Tree()


def _hashes(columns: list[str]) -> list[Column]:
    """Both hashes in halves, so that their sums stay within 64 bits; a NULL is told from every value."""
    parts = [c for name in columns for c in (F.col(name).isNull(), F.col(name))]
    hashes = [F.xxhash64(F.lit(seed), *parts) for seed in (11, 1_000_003)]
    halves = [x for h in hashes for x in (F.shiftright(h, 32), h.bitwiseAND(F.lit(0xFFFFFFFF)))]
    return [x.cast("long").alias(name) for name, x in zip(SUMS, halves, strict=True)]


def _sums() -> list[Column]:
    return [F.sum(name).alias(name) for name in (ROWS, *SUMS)]


def _plain(rows: DataFrame, keys: list[str], values: list[str], tree: Tree) -> DataFrame:
    """The digest of rows whose keys may repeat: one partial aggregate by leaf."""
    hashed = rows.select(tree.leaf(keys).alias(LEAF), F.lit(1).cast("long").alias(ROWS), *_hashes([*keys, *values]))
    return hashed.groupBy(LEAF).agg(*_sums())


def _keyed(rows: DataFrame, keys: list[str], values: list[str], by: list[str], tree: Tree) -> DataFrame:
    """The digest by leaf and `by`, with the repeated keys of each leaf counted apart (their `by` is NULL)."""
    hashed = rows.select(*keys, *by, F.lit(1).cast("long").alias(ROWS), *_hashes([*keys, *values]))
    # One row for each key: combined map-side, so a key that many rows hold is one row a task.
    alone = F.col(ROWS) == 1
    per_key = hashed.groupBy(*keys).agg(*_sums(), *(F.min(c).alias(c) for c in by))
    leaves = per_key.select(tree.leaf(keys).alias(LEAF), ROWS, *SUMS, *(F.when(alone, F.col(c)).alias(c) for c in by), F.when(alone, 0).otherwise(1).cast("long").alias(REPEATED))
    return leaves.groupBy(LEAF, *by).agg(*_sums(), F.sum(REPEATED).alias(REPEATED))


def _links(state: State, spec: Spec) -> DataFrame:
    """The open links of both kinds as (key, part): a building link has none."""
    part = open_rows(state.part_link).select(*spec.keys, spec.sub_parent)
    return part.unionByName(open_rows(state.building_link).select(*spec.keys, F.lit(None).cast("string").alias(spec.sub_parent)))


def digests(state: State, spec: Spec = DWELLINGS, tree: Tree = Tree()) -> Digests:
    """The digests of a state's open rows, not yet stored."""
    keys = list(spec.keys)
    register = _keyed(open_rows(state.register), keys, [spec.scenario, EFF_END], [spec.scenario], tree)
    return Digests(register, _keyed(_links(state, spec), keys, [spec.sub_parent], [], tree), tree)


def _unequal(one: DataFrame, two: DataFrame, tree: Tree) -> DataFrame:
    """The leaves that differ between `one` (plain) and `two` (with repeated keys); the one without a key always does."""
    compared = [ROWS, *SUMS]

    def differing(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
        other = right.select(F.col(on).alias("_on"), *(F.col(c).alias(f"_r{c}") for c in compared), REPEATED)
        same = reduce(Column.__and__, [F.coalesce(F.col(c), F.lit(0)) == F.coalesce(F.col(f"_r{c}"), F.lit(0)) for c in compared])
        both = left.join(other, left[on] == other["_on"], "full")
        return both.filter(~same | (F.coalesce(F.col(REPEATED), F.lit(0)) > 0)).select(F.coalesce(F.col(on), F.col("_on")).alias(on))

    tops = differing(one.groupBy(tree.top()).agg(*_sums()), two.groupBy(tree.top()).agg(*_sums(), F.sum(REPEATED).alias(REPEATED)), TOP)
    below = [df.withColumn(TOP, tree.top()).join(tops, TOP, "left_semi").drop(TOP) for df in (one, two)]
    leaves = differing(*below, LEAF)
    never = one.sparkSession.range(NO_LEAF, NO_LEAF + 1).select(F.col("id").alias(LEAF))
    return leaves.filter(F.col(LEAF) != NO_LEAF).unionByName(never)


def unequal_register(cands: DataFrame, scenarios: ScenarioSet, kept: Digests, spec: Spec = DWELLINGS) -> DataFrame:
    """The leaves in which D1, D2 or D3 can find something.

    The candidates' keys, scenarios and effective ends against those of the listed scenarios' open rows.  A key that is
    open twice counts in whatever scenario it stands.
    """
    listed = scenarios.keep(kept.register.filter(F.col(REPEATED) == 0), spec.scenario)
    register = listed.unionByName(kept.register.filter(F.col(REPEATED) > 0)).groupBy(LEAF).agg(*_sums(), F.sum(REPEATED).alias(REPEATED))
    return _unequal(_plain(cands, list(spec.keys), [spec.scenario, EFF_END], kept.tree), register, kept.tree)


def unequal_links(cands: DataFrame, kept: Digests, spec: Spec = DWELLINGS) -> DataFrame:
    """The leaves in which D7 or D8 can find something: the candidates' keys and parts against the open links'."""
    return _unequal(_plain(cands, list(spec.keys), [spec.sub_parent], kept.tree), kept.links, kept.tree)


def within(df: DataFrame, leaves: DataFrame, kept: Digests, spec: Spec = DWELLINGS) -> DataFrame:
    """The rows whose leaf is listed.  The list is stored, so its measured size decides how it is joined."""
    return df.withColumn(LEAF, kept.tree.leaf(list(spec.keys))).join(leaves, LEAF, "left_semi").select(*df.columns)
