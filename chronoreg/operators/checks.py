"""Integrity checks (K1-K5).  Each returns one row per table with a violation count,
so a clean result is a row of zeros, never an empty frame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoreg.functions import is_open
from chronoreg.model import DWELLINGS, SYS_CREATE, SYS_END, Spec
from chronoreg.operators.balance import MARKS
from chronoreg.sources.tables import State, open_rows


def all_violations(tallied: dict, spec: Spec = DWELLINGS) -> dict[str, int]:
    """K1, K3 and K5 of a :func:`balance.tally` row."""
    names = zip(MARKS, (spec.register_table, spec.parent_table, spec.sub_parent_table), strict=True)
    return {"exclusive_links": tallied["exclusive_links"], "open_unique": tallied["open_unique"],
            **{f"intervals:{name}": tallied[f"intervals_{mark}"] for mark, name in names}}


def exclusive_links(state: State, spec: Spec = DWELLINGS) -> DataFrame:
    """K1: open building links whose key also has an open part link."""
    keys = list(spec.keys)
    part_keys = open_rows(state.part_link).select(*keys).distinct()  # combined map-side
    both = open_rows(state.building_link).select(*keys).join(part_keys, keys, "left_semi")
    return both.agg(F.count(F.lit(1)).alias("violations"))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by more than one row (partial aggregate first, so a hot key is cheap)."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(F.count(F.when(F.col("_n") > 1, 1)).alias("violations"),
                       F.coalesce(F.max("_n"), F.lit(0)).alias("max_rows_per_key"))


def open_unique(register: DataFrame, spec: Spec = DWELLINGS) -> DataFrame:
    """K3: at most one open register row per key."""
    return duplicate_keys(open_rows(register), list(spec.keys))


def candidate_unique(cands: DataFrame, spec: Spec = DWELLINGS) -> DataFrame:
    """K4: candidate keys are unique."""
    return duplicate_keys(cands, list(spec.keys))


def intervals(state: State, spec: Spec = DWELLINGS) -> DataFrame:
    """K5: closed rows that end before they were created, per table."""
    out = None
    for name, df in ((spec.register_table, state.register), (spec.parent_table, state.building_link),
                     (spec.sub_parent_table, state.part_link)):
        bad = ~is_open(SYS_END) & (F.col(SYS_END) < F.col(SYS_CREATE))
        row = df.agg(F.count(F.when(bad, 1)).alias("violations")).select(
            F.lit(name).alias("table_name"), "violations")
        out = row if out is None else out.unionByName(row)
    return out
