"""Apply a change set to the three bitemporal tables.

Parquet files are immutable, so every closing step is a pure function
``table -> table'``: an update-join that rewrites the open rows it matches.  Closed
rows are never touched again (decision X7), so they pass straight through and only the
open part of a table is joined.

The original process runs five UPDATE statements in order.  The two steps on one link
table touch disjoint keys (relinks exclude every key of the deletes), so each link
table is closed in one pass over the union of its requests; the result is the same as
running the statements one after the other.

When several request rows match one target row, the original picks an arbitrary one.
Here the pick is deterministic: the greatest (system end, effective end, flag) tuple,
computed as ``max(struct(...))`` - a partial aggregate, so a hot key is combined on the
map side before it is shuffled.  Targets whose key no request names skip all that.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoreg.functions import is_open, second_before
from chronoreg.model import (
    DELETED,
    DWELLINGS,
    EFF_END,
    EFF_START,
    OLD_PART,
    SYS_CREATE,
    SYS_END,
    RunParams,
    Spec,
)
from chronoreg.operators.diff import Changes
from chronoreg.sources.tables import State

SET_COLUMNS = (SYS_END, EFF_END, DELETED)  # order = tie-break order of the pick
NEW = "new_"
REQ = "req_"
TOUCHED = "_touched"
BY = "_by"
BY_CHANGE = "change"
BY_RELINK = "relink"


WAS_END = "_was_sys_end"


def _pick(alias: str = "") -> str:
    """The new values as one comparable struct; its max is the deterministic pick."""
    fields = ", ".join(f"{alias}`{NEW}{c}` AS `{c}`" for c in SET_COLUMNS)
    return f"struct({fields}, {alias}`{BY}` AS `{BY}`)"


def _merge(targets: DataFrame, columns: list[str]) -> DataFrame:
    """Every target column, the set columns taken from ``_pick`` where one matched, plus
    ``_touched``, ``_by`` and the system end before.

    Written as SQL expressions: one gateway call for the whole projection."""
    out = [f"CASE WHEN _pick IS NOT NULL THEN _pick.`{c}` ELSE `{c}` END AS `{c}`" if c in SET_COLUMNS
           else f"`{c}`" for c in columns]
    return targets.selectExpr(*out, f"_pick IS NOT NULL AS `{TOUCHED}`", f"_pick.`{BY}` AS `{BY}`",
                              f"`{SYS_END}` AS `{WAS_END}`")


def _untouched(targets: DataFrame) -> DataFrame:
    return targets.selectExpr("*", f"false AS `{TOUCHED}`", f"CAST(NULL AS STRING) AS `{BY}`",
                              f"`{SYS_END}` AS `{WAS_END}`")


def _split(targets: DataFrame, requests: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(targets whose key a request names, the others).

    A semi and an anti join on the distinct request keys read the same shuffled targets, and only the named rows go
    through the pick."""
    named = requests.select(*keys).distinct()
    return targets.join(named, keys, "left_semi"), targets.join(named, keys, "left_anti")


def update_from(targets: DataFrame, requests: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """``UPDATE t SET <SET_COLUMNS> FROM requests r JOIN targets t ON <keys>``.

    ``requests`` carries the keys, ``new_<col>`` for each set column and ``_by`` (a tag reported in the result).
    Returns (named targets with the set columns replaced, the other targets).
    """
    named, others = _split(targets, requests, keys)
    reduced = requests.groupBy(*keys).agg(F.expr(f"max({_pick()})").alias("_pick"))
    return _merge(named.join(reduced, keys), targets.columns).select(*targets.columns, TOUCHED, BY, WAS_END), others


# --- requests ------------------------------------------------------------------------


def register_close_requests(deletes: DataFrame, spec: Spec = DWELLINGS) -> DataFrame:
    """A1 requests: every staged closing row, keyed on (entity, system create, start)."""
    return deletes.select(
        spec.entity, SYS_CREATE, EFF_START,
        *[F.col(c).alias(NEW + c) for c in SET_COLUMNS], F.lit(BY_CHANGE).alias(BY))


def link_close_requests(deletes: DataFrame, relinks: DataFrame, link: str, parent_side: bool,
                        spec: Spec = DWELLINGS) -> DataFrame:
    """A2+A4 (``parent_side``) or A3+A5 requests against one link table.

    By change: the link row closes when it differs from the staged row in link id,
    effective end or system end (R5).  By relink: the link row whose id equals the
    relink's building (A4, only when the candidate now has a part) or old part id (A5,
    only when the part is gone or different) closes one second before the new batch.
    """
    by_change = deletes.select(
        spec.entity, EFF_START,
        F.col(link).alias(REQ + "link"), F.col(EFF_END).alias(REQ + EFF_END),
        F.col(SYS_END).alias(REQ + SYS_END), F.lit(None).cast(deletes.schema[link].dataType)
        .alias(REQ + "match"),
        *[F.col(c).alias(NEW + c) for c in SET_COLUMNS], F.lit(BY_CHANGE).alias(BY))
    if parent_side:
        eligible = F.col(spec.sub_parent).isNotNull()
        match = F.col(spec.parent)
    else:
        eligible = F.col(spec.sub_parent).isNull() | (F.col(spec.sub_parent) != F.col(OLD_PART))
        match = F.col(OLD_PART)
    by_relink = relinks.filter(eligible).select(
        spec.entity, EFF_START,
        F.lit(None).cast(by_change.schema[REQ + "link"].dataType).alias(REQ + "link"),
        F.lit(None).cast("timestamp_ntz").alias(REQ + EFF_END),
        F.lit(None).cast("timestamp_ntz").alias(REQ + SYS_END),
        match.cast(by_change.schema[REQ + "match"].dataType).alias(REQ + "match"),
        F.col(EFF_END).alias(NEW + EFF_END),
        second_before(SYS_CREATE).alias(NEW + SYS_END),
        F.col(DELETED).alias(NEW + DELETED),
        F.lit(BY_RELINK).alias(BY))
    return by_change.unionByName(by_relink)


def _differs(link: str, top: str = "") -> str:
    """A request by change differs from the link row in link id, effective end or system end (true, not unknown)."""
    pairs = ((f"{REQ}link", link), (REQ + EFF_END, EFF_END), (REQ + SYS_END, SYS_END))
    return "coalesce(" + " OR ".join(f"({top}`{r}` != `{t}`)" for r, t in pairs) + ", false)"


def _close_named(named: DataFrame, requests: DataFrame, link: str, keys: list[str]) -> DataFrame:
    """The pick for each named link row, without pairing a key's rows with all of its requests.

    By relink: one reduced request per key and link id.  By change: the key's greatest request, where it differs
    from the row.  Only rows that it equals in every compared value look at the key's other requests, and of these
    rows one per distinct combination does.
    """
    columns = named.columns
    change = requests.filter(F.col(BY) == BY_CHANGE)
    relink = (requests.filter(F.col(BY) == BY_RELINK).groupBy(*keys, F.col(REQ + "match").alias(link))
              .agg(F.expr(f"max({_pick()})").alias("_relink")))
    asked = [REQ + "link", REQ + EFF_END, REQ + SYS_END]
    fields = ", ".join(f"`{c}`" for c in asked)
    top = change.groupBy(*keys).agg(F.expr(f"max(struct({_pick()} AS pick, {fields}))").alias("_top"))
    rows = named.join(top, keys, "left").join(relink, [*keys, link], "left").selectExpr(
        *[f"`{c}`" for c in columns], "_relink", "_top",
        f"CASE WHEN {_differs(link, '_top.')} THEN _top.pick END AS _change")
    compared = [link, EFF_END, SYS_END]
    # Whether a row must look further follows from its key and its compared values alone.
    equal = rows.filter("_change IS NULL AND _top IS NOT NULL").select(*keys, *compared).distinct()
    others = change.groupBy(*keys, *asked).agg(F.expr(f"max({_pick()})").alias("_next"))
    further = (equal.join(others, keys).filter(_differs(link)).groupBy(*keys, *compared)
               .agg(F.max("_next").alias("_next")))
    found = further.select(*[F.col(c).alias(f"_k_{c}") for c in (*keys, *compared)], "_next")
    matched = rows.join(found, [rows[c].eqNullSafe(found[f"_k_{c}"]) for c in (*keys, *compared)], "left")
    return _merge(matched.withColumn("_pick", F.greatest("_change", "_next", "_relink")), columns)


# --- steps ---------------------------------------------------------------------------


def split_open(table: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(open rows, closed rows); the closed rows are never rewritten."""
    open_ = is_open(SYS_END)
    return table.filter(open_), table.filter(~open_)


@dataclass(frozen=True)
class TableUpdate:
    """One table after a run, in the parts a store needs.

    ``kept``: closed rows, passed through untouched (``None`` when the whole table was a target); ``others``: targets
    whose key no request names, as they were; ``named``: targets whose key one names, after closing, with
    ``_touched``, ``_by`` and ``_was_sys_end``; ``inserted``: the opening rows.
    """

    kept: DataFrame | None
    others: DataFrame
    named: DataFrame
    inserted: DataFrame

    @cached_property
    def updated(self) -> DataFrame:
        """All targets after closing."""
        return self.named.unionByName(_untouched(self.others))

    @cached_property
    def rewritten(self) -> DataFrame:
        """Rows a versioned store writes for this run (targets and new rows)."""
        return self.others.unionByName(self.named.drop(TOUCHED, BY, WAS_END)).unionByName(self.inserted)

    @cached_property
    def after(self) -> DataFrame:
        """The whole table after the run."""
        return self.rewritten if self.kept is None else self.kept.unionByName(self.rewritten)


def close_register(register: DataFrame, deletes: DataFrame, params: RunParams | None = None,
                   spec: Spec = DWELLINGS) -> tuple[DataFrame | None, DataFrame, DataFrame]:
    """A1: close the register rows matched by (entity, system create, start).

    Only open rows are targets unless ``params.close_history`` asks for the original's
    behaviour of also rewriting closed rows with the same identity.
    Returns (kept closed rows, named targets, other targets).
    """
    keys = [spec.entity, SYS_CREATE, EFF_START]
    requests = register_close_requests(deletes, spec)
    if params is not None and params.close_history:
        return None, *update_from(register, requests, keys)
    open_, closed = split_open(register)
    return closed, *update_from(open_, requests, keys)


def close_links(link_table: DataFrame, deletes: DataFrame, relinks: DataFrame, link: str,
                parent_side: bool, spec: Spec = DWELLINGS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A2+A4 or A3+A5 on one link table; only open link rows are targets."""
    keys = [spec.entity, EFF_START]
    open_, closed = split_open(link_table)
    requests = link_close_requests(deletes, relinks, link, parent_side, spec)
    named, others = _split(open_, requests, keys)
    return closed, _close_named(named, requests, link, keys), others


def new_register_rows(inserts: DataFrame, spec: Spec = DWELLINGS) -> DataFrame:
    """Every staged opening row (INSERT and UPDATE)."""
    return inserts.select(*spec.register_columns)


def new_building_rows(inserts: DataFrame, relinks: DataFrame, spec: Spec = DWELLINGS) -> DataFrame:
    """A7 + A9: opening rows without a part go to the building links."""
    cols = spec.parent_link_columns
    no_part = F.col(spec.sub_parent).isNull()
    return inserts.filter(no_part).select(*cols).unionByName(relinks.filter(no_part).select(*cols))


def new_part_rows(inserts: DataFrame, relinks: DataFrame, spec: Spec = DWELLINGS) -> DataFrame:
    """A8 + A10: opening rows with a part go to the part links."""
    cols = spec.sub_parent_link_columns
    has_part = F.col(spec.sub_parent).isNotNull()
    return inserts.filter(has_part).select(*cols).unionByName(relinks.filter(has_part).select(*cols))


@dataclass(frozen=True)
class Applied:
    """The three tables after a run."""

    register: TableUpdate
    building_link: TableUpdate
    part_link: TableUpdate

    @cached_property
    def state(self) -> State:
        return State(self.register.after, self.building_link.after, self.part_link.after)


def _reinsert_join(new_rows: DataFrame, target: TableUpdate, spec: Spec,
                   other_scenario: bool = False) -> DataFrame:
    """The original's ``LEFT OUTER JOIN`` of new rows with the open rows of the target
    table (after the closings) on the business key - for the register also on a
    different scenario.  Nothing is taken from the right side, so a new row is kept
    once, or once per matching open row when a key holds two or more (decision X6
    drops this; ``RunParams.reinsert_join`` keeps it).  A plain join, no arrays: AQE
    can split a hot key on the new rows' side.
    """
    keys = list(spec.keys)
    opened = target.updated.filter(is_open(SYS_END))
    right = opened.select(*[F.col(k).alias(f"_o_{k}") for k in keys],
                          F.col(spec.scenario).alias("_o_s") if other_scenario else F.lit(None).alias("_o_s"))
    cond = [new_rows[k] == right[f"_o_{k}"] for k in keys]
    if other_scenario:
        cond.append(new_rows[spec.scenario] != right["_o_s"])
    return new_rows.join(right, cond, "left").select(*new_rows.columns)


def _as_is(df: DataFrame, name: str) -> DataFrame:
    return df


def _reinserted(update: TableUpdate, params: RunParams | None, spec: Spec, other_scenario: bool = False) -> TableUpdate:
    """The relinks' keys are disjoint from the inserts', so joining both kinds of new rows with the open rows left by
    the closings equals the original's statement order."""
    if params is None or not params.reinsert_join:
        return update
    return replace(update, inserted=_reinsert_join(update.inserted, update, spec, other_scenario))


def update_register(register: DataFrame, deletes: DataFrame, inserts: DataFrame, params: RunParams | None = None,
                    spec: Spec = DWELLINGS, stage=_as_is) -> TableUpdate:
    """A1 and A6.  ``stage`` stores the named rows: what the run touches, however large the table is."""
    kept, named, others = close_register(register, deletes, params, spec)
    update = TableUpdate(kept, others, stage(named, "named_register"), new_register_rows(inserts, spec))
    return _reinserted(update, params, spec, other_scenario=True)


def update_links(link_table: DataFrame, changes: Changes, parent_side: bool, params: RunParams | None = None,
                 spec: Spec = DWELLINGS, stage=_as_is) -> TableUpdate:
    """A2, A4, A7 and A9 on the building links, or A3, A5, A8 and A10 on the part links."""
    link, opened = (spec.parent, new_building_rows) if parent_side else (spec.sub_parent, new_part_rows)
    kept, named, others = close_links(link_table, changes.deletes, changes.relinks, link, parent_side, spec)
    update = TableUpdate(kept, others, stage(named, f"named_{link}"), opened(changes.inserts, changes.relinks, spec))
    return _reinserted(update, params, spec)
