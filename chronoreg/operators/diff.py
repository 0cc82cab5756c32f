"""Change detection: snapshot candidates against the open register.

All joins are equi-joins on the business key (entity, effective start).  They are
written as the join kind they mean (anti, semi, inner, left outer) rather than as an
outer join filtered on NULL, so Catalyst plans LeftAnti/LeftSemi directly and AQE can
split a skewed key on the large side.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoreg.functions import second_before, ts
from chronoreg.model import (
    BUILDING_RELINK_OLD_PART,
    CHANGE,
    CHANGE_DELETE,
    CHANGE_INSERT,
    CHANGE_UPDATE,
    DELETE_BUILDING_ID,
    DELETE_PART_ID,
    DELETED,
    DWELLINGS,
    EFF_END,
    EFF_START,
    FLAG_DELETED,
    FLAG_LIVE,
    OLD_PART,
    STAGED_PART_LENGTH,
    SYS_CREATE,
    SYS_END,
    UPDATE_PART_DEFAULT,
    RunParams,
    Spec,
)
from chronoreg.operators.select import ScenarioSet
from chronoreg.sources.tables import open_rows

REG_PREFIX = "reg_"


@dataclass(frozen=True)
class Changes:
    """The change set of one run (staging relations of the original process)."""

    candidates: DataFrame
    deletes: DataFrame  # DELETE and UPDATE closing rows
    inserts: DataFrame  # INSERT and UPDATE opening rows
    relinks: DataFrame  # link changes of unchanged keys


def _has_keys(keys: list[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def classify(register: DataFrame, cands: DataFrame, scenarios: ScenarioSet,
                   params: RunParams, spec: Spec = DWELLINGS) -> DataFrame:
    """D1 + D2 + D3 as classified pairs, in a form every join of which AQE can split.

    D3 is an inner join (either side can be split when a key is hot).  D1 and D2 are
    anti joins against the *distinct* keys of the other side, so a key held by many
    rows is combined map-side before it is shuffled and the right side never holds
    more than one row per key.  The register and candidate projections are shared by
    the joins that read them, so each big input is shuffled once (reused exchange);
    the two extra shuffles carry keys only.

    D1 stages the register row, D2 the candidate, D3 both, of a listed scenario with a
    different effective end or scenario; a NULL on either side is never a difference.
    With an explicit batch D1 leaves out scenarios that have no rows in it.
    """
    keys = list(spec.keys)
    wanted = {*keys, spec.scenario, EFF_END, SYS_CREATE}
    reg_cols = [c for c in spec.register_columns if c in wanted]  # table order, see below
    out = [*spec.candidate_columns, *[REG_PREFIX + c for c in reg_cols], CHANGE]
    keyed = _has_keys(keys)
    open_reg = open_rows(register)
    # Shared inputs with raw column names in table order: aliases come after the joins and
    # the pruned projections keep one order, so Catalyst sees the same subtree under each
    # exchange and reuses it.  NULL-key rows never match: they skip the joins.
    listed = scenarios.keep(open_reg, spec.scenario).select(*reg_cols)
    listed_keyed = listed.filter(keyed)
    cand = cands.select(*spec.candidate_columns)
    cand_keyed = cand.filter(keyed)
    cand_keys = cand_keyed.select(*keys).distinct()
    open_keys = open_reg.filter(keyed).select(*keys).distinct()

    as_reg = [F.col(c).alias(REG_PREFIX + c) for c in reg_cols]
    gone = listed_keyed.join(cand_keys, keys, "left_anti").unionByName(listed.filter(~keyed))
    if params.batch_filter and params.batch_ts is not None:
        gone = scenarios.keep_present(gone, spec.scenario)
    deletes = gone.select(*as_reg)
    inserts = cand_keyed.join(open_keys, keys, "left_anti").unionByName(cand.filter(~keyed))
    pairs = cand_keyed.join(listed_keyed, [cand_keyed[k] == listed_keyed[k] for k in keys], "inner")
    pairs = pairs.filter((listed_keyed[EFF_END] != cand_keyed[EFF_END])
                         | (listed_keyed[spec.scenario] != cand_keyed[spec.scenario]))
    pairs = pairs.select(*[cand_keyed[c] for c in spec.candidate_columns],
                         *[listed_keyed[c].alias(REG_PREFIX + c) for c in reg_cols])
    return (deletes.withColumn(CHANGE, F.lit(CHANGE_DELETE))
            .unionByName(inserts.withColumn(CHANGE, F.lit(CHANGE_INSERT)), allowMissingColumns=True)
            .unionByName(pairs.withColumn(CHANGE, F.lit(CHANGE_UPDATE)), allowMissingColumns=True)
            .select(*out))


def closing_rows(classified: DataFrame, params: RunParams, spec: Spec = DWELLINGS) -> DataFrame:
    """D1 + D4 from classified pairs: the staged closing side."""
    is_delete = F.col(CHANGE) == CHANGE_DELETE
    if params.strict_staging:
        classified = _as_staged(classified, spec)
    return classified.filter(F.col(CHANGE).isin(CHANGE_DELETE, CHANGE_UPDATE)).select(
        F.col(REG_PREFIX + spec.entity).alias(spec.entity),
        F.when(is_delete, F.lit(DELETE_BUILDING_ID).cast("long")).otherwise(F.col(spec.parent))
        .alias(spec.parent),
        F.when(is_delete, F.lit(DELETE_PART_ID))
        .otherwise(F.coalesce(F.col(spec.sub_parent), F.lit(UPDATE_PART_DEFAULT))).alias(spec.sub_parent),
        F.col(REG_PREFIX + spec.scenario).alias(spec.scenario),
        F.col(REG_PREFIX + EFF_START).alias(EFF_START),
        F.col(REG_PREFIX + EFF_END).alias(EFF_END),
        F.col(REG_PREFIX + SYS_CREATE).alias(SYS_CREATE),
        F.when(is_delete, ts(params.run_ts)).otherwise(second_before(SYS_CREATE)).alias(SYS_END),
        F.when(is_delete, F.lit(FLAG_DELETED)).otherwise(F.lit(FLAG_LIVE)).alias(DELETED),
        CHANGE)


def _as_staged(classified: DataFrame, spec: Spec) -> DataFrame:
    """The closing side's columns as the original stages them: made from the literals of a DELETE, they hold no NULL
    building id and no part id longer than the literal's.  The guards are part of the columns, so no reader of the
    staged rows gets past them, and the first such UPDATE ends the run before anything is published.
    """
    update, parent, part = F.col(CHANGE) == CHANGE_UPDATE, F.col(spec.parent), F.col(spec.sub_parent)
    key = F.concat(F.lit(f" of {spec.entity} "), F.coalesce(F.col(spec.entity).cast("string"), F.lit("NULL")))
    empty = F.raise_error(F.concat(F.lit(f"staging holds no NULL {spec.parent}"), key)).cast("long")
    long = F.raise_error(F.concat(F.lit(f"staging holds {STAGED_PART_LENGTH} characters of {spec.sub_parent}, not "), part, key)).cast("string")
    return classified.withColumns({
        spec.parent: F.when(update & parent.isNull(), empty).otherwise(parent),
        spec.sub_parent: F.when(update & (F.char_length(part) > STAGED_PART_LENGTH), long).otherwise(part)})


def opening_rows(classified: DataFrame, spec: Spec = DWELLINGS) -> DataFrame:
    """D2 + D5 from classified pairs: the staged opening side."""
    return classified.filter(F.col(CHANGE).isin(CHANGE_INSERT, CHANGE_UPDATE)).select(
        *spec.candidate_columns, CHANGE)


def classified_keys(classified: DataFrame, spec: Spec = DWELLINGS) -> DataFrame:
    """The classification reduced to key, both scenarios and change kind."""
    return classified.select(
        F.coalesce(F.col(spec.entity), F.col(REG_PREFIX + spec.entity)).alias(spec.entity),
        F.coalesce(F.col(EFF_START), F.col(REG_PREFIX + EFF_START)).alias(EFF_START),
        F.col(REG_PREFIX + spec.scenario),
        F.col(spec.scenario).alias("cand_" + spec.scenario),
        CHANGE)


def matched_updates(classified: DataFrame, spec: Spec = DWELLINGS) -> DataFrame:
    """D3: the candidate row of each update with the register row's own values, prefixed."""
    return classified.filter(F.col(CHANGE) == CHANGE_UPDATE).select(
        *spec.candidate_columns, *[REG_PREFIX + c for c in (spec.scenario, EFF_END, SYS_CREATE)])


def touched_keys(classified: DataFrame, spec: Spec = DWELLINGS) -> DataFrame:
    """Distinct keys of every classified change: the exclusion set of the relinks.

    Same set as ``changed_keys``, read from the one staged relation; the distinct is a
    partial aggregate, so a key repeated by many changes is one row per task.
    """
    return classified.select(
        *[F.coalesce(F.col(k), F.col(REG_PREFIX + k)).alias(k) for k in spec.keys]).distinct()


def changed_keys(deletes: DataFrame, inserts: DataFrame, spec: Spec = DWELLINGS) -> DataFrame:
    """Keys already handled as an insert, update or delete."""
    keys = list(spec.keys)
    return deletes.select(*keys).unionByName(inserts.select(*keys)).distinct()


_KIND = "_link_kind"


def _relink_pairs(cands: DataFrame, building_link: DataFrame, part_link: DataFrame,
                  changed: DataFrame, spec: Spec, colocated: bool = False) -> DataFrame:
    """D7 and D8 with one join: candidates against the union of both open link tables.

    Part side (D7): the open part link differs from the candidate's part (part ->
    building when the candidate has none, part -> other part); the old part id is kept
    to find the link row to close.  Building side (D8): the candidate now has a part;
    the building id comes from the link row and the old part id is a fixed marker.
    Keys already changed by an insert, update or delete are left out (one anti join).

    ``colocated`` joins each table for itself: a union has no buckets, the tables do.
    """
    keys = list(spec.keys)
    parts = open_rows(part_link).select(
        *keys, F.col(spec.sub_parent).alias(OLD_PART),
        F.lit(None).cast("long").alias("_link_parent"), F.lit("part").alias(_KIND))
    buildings = open_rows(building_link).select(
        *keys, F.lit(None).cast(part_link.schema[spec.sub_parent].dataType).alias(OLD_PART),
        F.col(spec.parent).alias("_link_parent"), F.lit("building").alias(_KIND))
    part = F.col(spec.sub_parent)
    on_part = (F.col(_KIND) == "part") & (part.isNull() | (part != F.col(OLD_PART)))
    on_building = (F.col(_KIND) == "building") & part.isNotNull()
    if colocated:
        pairs = cands.join(parts, keys).filter(on_part).unionByName(cands.join(buildings, keys).filter(on_building))
    else:
        pairs = cands.join(parts.unionByName(buildings), keys, "inner").filter(on_part | on_building)
    return pairs.join(changed, keys, "left_anti").select(
        spec.entity,
        F.when(F.col(_KIND) == "part", F.col(OLD_PART)).otherwise(F.lit(BUILDING_RELINK_OLD_PART))
        .alias(OLD_PART),
        spec.sub_parent,
        F.when(F.col(_KIND) == "part", F.col(spec.parent)).otherwise(F.col("_link_parent"))
        .alias(spec.parent),
        EFF_START, EFF_END, SYS_CREATE, SYS_END, F.lit(FLAG_LIVE).alias(DELETED), _KIND)


def find_part_relinks(cands: DataFrame, building_link: DataFrame, part_link: DataFrame,
                      changed: DataFrame, spec: Spec = DWELLINGS) -> DataFrame:
    """D7 alone: relinks found from the part links."""
    pairs = _relink_pairs(cands, building_link, part_link, changed, spec)
    return pairs.filter(F.col(_KIND) == "part").drop(_KIND)


def find_building_relinks(cands: DataFrame, building_link: DataFrame, part_link: DataFrame,
                          changed: DataFrame, spec: Spec = DWELLINGS) -> DataFrame:
    """D8 alone: relinks found from the building links."""
    pairs = _relink_pairs(cands, building_link, part_link, changed, spec)
    return pairs.filter(F.col(_KIND) == "building").drop(_KIND)


def find_relinks(cands: DataFrame, building_link: DataFrame, part_link: DataFrame,
                 changed: DataFrame, spec: Spec = DWELLINGS, colocated: bool = False) -> DataFrame:
    """Bag union of D7 and D8."""
    return _relink_pairs(cands, building_link, part_link, changed, spec, colocated).drop(_KIND)
