"""Counts, change log, inspection and purge.

Every count is an aggregate over whole tables; a change-log row is never computed
with one query per number.  What a run stages is counted while it is written (observed
metrics), so the changes of a run are known without another job.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoreg.functions import hours_before, second_before, ts
from chronoreg.model import (
    CHANGE,
    CHANGELOG_TABLE,
    CHANGELOG_SCHEMA,
    COUNT_CANDIDATES,
    COUNT_DELETES,
    COUNT_INSERTS,
    COUNT_MAINTENANCE,
    COUNT_RELINKS,
    CHANGE_DELETE,
    CHANGE_INSERT,
    CHANGE_UPDATE,
    DWELLINGS,
    EFF_END,
    EFF_START,
    LOG_COLUMNS,
    RECENT_HOURS,
    SYS_CREATE,
    SYS_END,
    TEST_BUILDING_IDS_ABOVE,
    TEST_PART_PREFIX,
    TEST_SCENARIOS,
    TS_FORMAT,
    RunParams,
    Spec,
)
from chronoreg.operators.apply import Applied
from chronoreg.operators.balance import MARKS, by_sys_end, totals
from chronoreg.operators.diff import Changes
from chronoreg.sources.tables import State

# --- G1-G6 ---------------------------------------------------------------------------


def count_candidates(cands: DataFrame) -> DataFrame:
    """G1."""
    return cands.agg(F.count(F.lit(1)).alias(COUNT_CANDIDATES))


def count_by_change(staged: DataFrame, name: str) -> DataFrame:
    """Staged rows per change kind, ordered by kind."""
    return staged.groupBy(CHANGE).agg(F.count(F.lit(1)).alias(name)).orderBy(CHANGE)


def count_relinks(relinks: DataFrame) -> DataFrame:
    """G4."""
    return relinks.agg(F.count(F.lit(1)).alias(COUNT_RELINKS))


def start_bucket(after: str, otherwise: str) -> Column:
    """the effective start when later than ``after``, else the fixed ``otherwise``."""
    return (F.when(F.col(EFF_START) > ts(after), F.col(EFF_START))
            .otherwise(ts(otherwise)).alias("changed_start_date"))


def count_maintenance(deletes: DataFrame, bucket: tuple[str, str] | None = None) -> DataFrame:
    """Closing rows per change kind and effective end (and start bucket, F12)."""
    keys = [F.col(CHANGE), F.col(EFF_END)]
    if bucket is not None:
        keys.append(start_bucket(*bucket))
    return (deletes.groupBy(*keys)
            .agg(F.count(F.lit(1)).alias(COUNT_MAINTENANCE))
            .orderBy(CHANGE, EFF_END))


def count_by_sys_end(before: State, applied: Applied, spec: Spec = DWELLINGS) -> DataFrame:
    """Rows per system end date in its order, for each table, before and after the run; one scan of each table."""
    parts = [by_sys_end(df, getattr(applied, mark)).select(F.lit(name).alias("table_name"), "stage", SYS_END, "n")
             for (mark, df), name in zip(before.tables().items(), table_names(spec), strict=True)]
    return reduce(DataFrame.unionByName, parts).orderBy("table_name", "stage", SYS_END)


def table_names(spec: Spec = DWELLINGS) -> tuple[str, str, str]:
    """The tables' names as the change log writes them, in the order of a state."""
    return spec.register_table, spec.parent_table, spec.sub_parent_table


def count_groupings(changes: Changes, bucket: tuple[str, str]) -> DataFrame:
    """G2-G5 and F12 as grouping sets of one pass over the staged rows.

    (side, grouping, change, effective_end_date, changed_start_date, n): closing rows by change, by change and
    effective end, and by both and the start bucket; opening rows by change.
    """
    rows = changes.deletes.select(F.lit("closing").alias("side"), CHANGE, EFF_END, start_bucket(*bucket)).unionByName(
        changes.inserts.select(F.lit("opening").alias("side"), CHANGE, F.lit(None).cast("timestamp_ntz").alias(EFF_END),
                               F.lit(None).cast("timestamp_ntz").alias("changed_start_date")))
    side, change, end, start = (F.col(c) for c in ("side", CHANGE, EFF_END, "changed_start_date"))
    sets = rows.groupingSets([[side, change], [side, change, end], [side, change, end, start]], side, change, end, start)
    level = F.grouping(end) + F.grouping(start)
    name = F.when(level == 2, "change").when(level == 1, "effective_end").otherwise("start_bucket")
    counted = sets.agg(F.count(F.lit(1)).alias("n"), name.alias("grouping"))
    return counted.filter((F.col("side") == "closing") | (F.col("grouping") == "change")).select(
        "side", "grouping", CHANGE, EFF_END, "changed_start_date", "n")


# --- L1-L4 ---------------------------------------------------------------------------

def change_metrics(spec: Spec = DWELLINGS) -> dict[str, Column]:
    """What the classification is observed by while it is written: changes by kind and link, the latest UPDATE end."""
    kind, no_part = F.col(CHANGE), F.col(spec.sub_parent).isNull()
    found: dict[str, Column] = {}
    for name, change in (("inserts", CHANGE_INSERT), ("updates", CHANGE_UPDATE), ("deletes", CHANGE_DELETE)):
        found[name] = F.count(F.when(kind == change, 1))
        found[f"{name}_no_part"] = F.count(F.when((kind == change) & no_part, 1))
    return found | {"latest_update_end": F.max(F.when(kind == CHANGE_UPDATE, second_before(SYS_CREATE)))}


def relink_metrics(spec: Spec = DWELLINGS) -> dict[str, Column]:
    return {"relinks": F.count(F.lit(1)), "relinks_no_part": F.count(F.when(F.col(spec.sub_parent).isNull(), 1))}


def retired_end(counted: dict, params: RunParams) -> str | None:
    """The one system end date the link tables count as retired (decision X4), from the observed changes.

    The original takes the first staged closing row, in no order.  Here: the run's clock when any DELETE exists, else
    the greatest UPDATE end; None when nothing closes.
    """
    if counted["deletes"]:
        return params.run_ts
    latest = counted["latest_update_end"]
    return latest.strftime(TS_FORMAT + ".%f") if latest else None


def log_rows(counted: dict, after: dict[str, tuple], params: RunParams, spec: Spec = DWELLINGS) -> list[tuple]:
    """L1-L3: the change-log rows by the observed changes and, for each table, its (total, retired).

    register: added = INSERT, modified = UPDATE, retired = DELETE, total = open rows after.  Link tables: added and
    modified split by whether the row has a part, modified also counts the relinks, retired = rows of the table (any
    age) whose system end is the retired one.
    """
    c = counted
    split = {"register": (c["inserts"], c["updates"]),
             "building_link": (c["inserts_no_part"], c["updates_no_part"] + c["relinks_no_part"])}
    split["part_link"] = (c["inserts"] - c["inserts_no_part"], c["updates"] - c["updates_no_part"] + c["relinks"] - c["relinks_no_part"])
    when = datetime.strptime(params.change_ts, TS_FORMAT)
    out = []
    for mark, name in zip(split, table_names(spec), strict=True):
        if mark in after:
            total, retired = after[mark]
            values = dict(zip(LOG_COLUMNS, (when, name, spec.process, *split[mark], c["deletes"] if mark == "register" else retired, total), strict=False))
            out.append(tuple(values.get(column) for column in LOG_COLUMNS))
    return out


def changelog(before: State, applied: Applied, counted: dict, params: RunParams, spec: Spec = DWELLINGS,
              tables: tuple[str, ...] = MARKS) -> DataFrame:
    """L1-L3 as a frame: one conditional aggregate over each asked table."""
    end, parts = retired_end(counted, params), []
    blank = {mark: (None, None) for mark in MARKS}
    for row, mark in zip(log_rows(counted, blank, params, spec), MARKS, strict=True):
        if mark not in tables:
            continue
        known = dict(zip(LOG_COLUMNS, row, strict=True))
        sums = totals(getattr(before, mark), getattr(applied, mark), end)
        counts = {"total_records_after": F.col("total")} | ({} if mark == "register" else {"records_retired": F.col("retired")})
        parts.append(sums.select(*[counts.get(f.name, ts(known[f.name]) if f.name == "change_date" else F.lit(known[f.name]))
                                   .cast(f.dataType).alias(f.name) for f in CHANGELOG_SCHEMA.fields]))
    return reduce(DataFrame.unionByName, parts)


def preview_rows(counted: dict) -> list[dict]:
    """G1-G4 from the observed changes, as :func:`preview_counts` orders them; what there is none of has no row."""
    kinds = {CHANGE_DELETE: counted["deletes"], CHANGE_INSERT: counted["inserts"], CHANGE_UPDATE: counted["updates"]}
    rows = [(COUNT_RELINKS, None, counted["relinks"]), (COUNT_CANDIDATES, None, counted["candidates"])]
    rows += [(COUNT_DELETES, k, kinds[k]) for k in (CHANGE_DELETE, CHANGE_UPDATE)]
    rows += [(COUNT_INSERTS, k, kinds[k]) for k in (CHANGE_INSERT, CHANGE_UPDATE)]
    return [dict(zip(("count_name", CHANGE, "n"), r, strict=True)) for r in sorted(rows, key=lambda r: (r[0], r[1] or "")) if r[2]]


def preview_counts(changes: Changes) -> DataFrame:
    """G1-G4 in one frame: (count_name, change, n), in a fixed order."""
    rows = [changes.candidates.select(F.lit(COUNT_CANDIDATES).alias("count_name"), F.lit(None).cast("string").alias(CHANGE)),
            changes.deletes.select(F.lit(COUNT_DELETES).alias("count_name"), CHANGE),
            changes.inserts.select(F.lit(COUNT_INSERTS).alias("count_name"), CHANGE),
            changes.relinks.select(F.lit(COUNT_RELINKS).alias("count_name"), F.lit(None).cast("string").alias(CHANGE))]
    return (reduce(DataFrame.unionByName, rows).groupBy("count_name", CHANGE).agg(F.count(F.lit(1)).alias("n"))
            .orderBy("count_name", CHANGE))


def recent_changes(log: DataFrame, now: str, hours: int = RECENT_HOURS) -> DataFrame:
    """L4: change-log rows younger than ``hours`` at ``now``."""
    return log.filter(F.col("change_date") > ts(hours_before(now, hours)))


# --- O1, O5 --------------------------------------------------------------------------


def test_row_predicates(spec: Spec = DWELLINGS) -> dict[str, Column]:
    """Which rows of each table belong to the documented manual test."""
    return {
        "register": F.col(spec.scenario).isin(list(TEST_SCENARIOS)),
        "building_link": (F.col(spec.parent) == 0) | (F.col(spec.parent) > TEST_BUILDING_IDS_ABOVE),
        "part_link": F.col(spec.sub_parent).like(TEST_PART_PREFIX + "%"),
    }


def inspect(df: DataFrame, predicate: Column, spec: Spec = DWELLINGS, limit: int = 1000) -> DataFrame:
    """O1: the first ``limit`` matching rows by (entity, start, system create).

    The three sort keys are not unique, so the remaining columns break ties; the plan
    is a take-ordered (per-partition top-k, then a merge), never a global sort.
    """
    head = [spec.entity, EFF_START, SYS_CREATE]
    rest = [c for c in df.columns if c not in head]
    return df.filter(predicate).orderBy(*head, *rest).limit(limit)


def purge(df: DataFrame, predicate: Column) -> DataFrame:
    """``DELETE FROM t WHERE p`` keeps the rows where ``p`` is not true."""
    return df.filter(~F.coalesce(predicate, F.lit(False)))


def purge_predicates(now: str, spec: Spec = DWELLINGS) -> dict[str, Column]:
    """The test rows of the three tables and the change log's recent rows."""
    return {**test_row_predicates(spec), "changelog": F.col("change_date") > ts(hours_before(now))}


def purge_counts(state: State, log: DataFrame, now: str, spec: Spec = DWELLINGS) -> DataFrame:
    """O5 on all four tables: rows kept and removed per table."""
    preds = purge_predicates(now, spec)
    frames = dict(state.tables(), changelog=log)
    names = {"register": spec.register_table, "building_link": spec.parent_table,
             "part_link": spec.sub_parent_table, "changelog": CHANGELOG_TABLE}
    out = None
    for key, df in frames.items():
        hit = F.coalesce(preds[key], F.lit(False))
        row = df.agg(F.count(F.when(~hit, 1)).alias("rows_kept"),
                     F.count(F.when(hit, 1)).alias("rows_removed")) \
            .select(F.lit(names[key]).alias("table_name"), "rows_kept", "rows_removed")
        out = row if out is None else out.unionByName(row)
    return out
