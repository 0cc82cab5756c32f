"""Registered queries: each takes (spark, sf_dir) and returns a lazy DataFrame.

Every query reads the whole ``orders`` table of ``sf_dir`` through the derived inputs
(``chronoreg.sources.fixtures``), runs the operators it names, and returns the result
with the same column names as its DuckDB oracle in ``oracle_sql()``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoreg.functions import hours_before
from chronoreg.model import (
    CHANGE,
    CHANGE_DELETE,
    CHANGE_INSERT,
    CHANGELOG_TABLE,
    COUNT_CANDIDATES,
    COUNT_DELETES,
    COUNT_INSERTS,
    COUNT_MAINTENANCE,
    COUNT_RELINKS,
    DWELLINGS,
    OLD_PART,
    TEST_BUILDING_IDS_ABOVE,
    TEST_PART_PREFIX,
    TEST_SCENARIOS,
    RunParams,
)
from chronoreg.operators import checks, diff, digest, report
from chronoreg.operators.apply import BY, BY_CHANGE, BY_RELINK, TOUCHED, WAS_END
from chronoreg.operators.balance import VIOLATIONS, tally
from chronoreg.operators.select import (
    auto_scenarios,
    candidates_ambiguous,
    candidates_main,
    latest_batch,
)
from chronoreg.plans import oracle as O
from chronoreg.plans.run import ParquetStage, Run, Selection, run, select
from chronoreg.sources.bucketed import read_bucketed, save_bucketed
from chronoreg.sources.changelog import append_log, recent_log
from chronoreg.sources.fixtures import FIXTURE_PARAMS, STALE_BATCH, Inputs, derived_inputs, mixed_case, older_batch, older_log
from chronoreg.sources.tables import State, open_rows, read_interim, read_state

P = FIXTURE_PARAMS
START_BUCKET = ("1995-06-07 00:00:00", "1995-05-24 00:00:00")  # F12 bucket inside the order dates
EXPLICIT = P.with_(scenarios=(0, 99, 999, 5))
ALL_BATCHES = P.with_(batch_filter=False)
REINSERT = P.with_(reinsert_join=True)
CLOSE_HISTORY = P.with_(close_history=True)
SPEC = DWELLINGS

Query = Callable[[SparkSession, str], DataFrame]


def _inputs(spark: SparkSession, sf_dir: str, hard: bool = True) -> Inputs:
    return derived_inputs(spark, sf_dir, SPEC, hard)


def _run(spark: SparkSession, sf_dir: str, params: RunParams = P) -> Run:
    """A run of its own for each query; it computes what the query asks for."""
    inp = _inputs(spark, sf_dir)
    return run(inp.interim, inp.state, params, SPEC, ParquetStage(spark))


def _sel(spark: SparkSession, sf_dir: str, params: RunParams = P) -> tuple[Inputs, Selection]:
    inp = _inputs(spark, sf_dir)
    return inp, select(inp.interim, params, SPEC, ParquetStage(spark))


def _stored(spark: SparkSession, sf_dir: str) -> Inputs:
    """The inputs written as Parquet and read through the readers."""
    stage, inp = ParquetStage(spark), _inputs(spark, sf_dir)
    for name, df in {"interim": inp.interim, **inp.state.tables()}.items():
        stage(df, name)
    paths = [f"{stage.folder}/{name}" for name in inp.state.tables()]
    return Inputs(read_interim(spark, f"{stage.folder}/interim", SPEC), read_state(spark, *paths, SPEC))


def _touched(df: DataFrame, by: str | None = None) -> DataFrame:
    hit = F.col(TOUCHED) if by is None else F.col(TOUCHED) & (F.col(BY) == by)
    return df.filter(hit).drop(TOUCHED, BY, WAS_END)


def _rerun_counts(hard: bool, digests: bool = False) -> Query:
    """K2: what a second run of the same snapshot on the first one's result would change, by digests or by joins alone."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        inp = _inputs(spark, sf_dir, hard)
        stage = ParquetStage(spark)
        first = run(inp.interim, inp.state, P, SPEC, stage)
        state = State(*[stage(df, f"after_{name}") for name, df in first.state.tables().items()])
        kept = _stored_digests(state, stage) if digests else None
        changes = run(inp.interim, state, P, SPEC, ParquetStage(spark), digests=kept).changes
        tagged = reduce(DataFrame.unionByName, [getattr(changes, name).select(F.lit(name).alias("t"))
                                                for name in ("deletes", "inserts", "relinks")])
        return tagged.agg(*[F.count(F.when(F.col("t") == name, 1)).alias(name) for name in ("deletes", "inserts", "relinks")])

    return query


def _digested(spark: SparkSession, sf_dir: str) -> Run:
    """A run that joins the keys of unequal leaves only."""
    inp = _inputs(spark, sf_dir)
    stage = ParquetStage(spark)
    return run(inp.interim, inp.state, P, SPEC, stage, digests=_stored_digests(inp.state, stage))


def _collated(spark: SparkSession, sf_dir: str) -> Run:
    """A run that takes no account of the case of part ids, on inputs that differ in it."""
    inp = mixed_case(_inputs(spark, sf_dir), SPEC)
    return run(inp.interim, inp.state, P, replace(SPEC, collation="UTF8_LCASE"), ParquetStage(spark))


def _colocated(spark: SparkSession, sf_dir: str) -> Run:
    """A run on state tables that the catalog keeps bucketed on the business key."""
    inp = _inputs(spark, sf_dir)
    stage, prefix = ParquetStage(spark), f"chronoreg_{uuid.uuid4().hex}"
    save_bucketed(inp.state, prefix, f"{stage.folder}/bucketed", SPEC)
    return run(inp.interim, read_bucketed(spark, prefix, SPEC), P, SPEC, stage, colocated=True)


def _stored_digests(state: State, stage: ParquetStage) -> digest.Digests:
    found = digest.digests(state, SPEC)
    return digest.Digests(stage(found.register, "register_digest"), stage(found.links, "link_digest"), found.tree)


def _plain(df: DataFrame, columns: list[str]) -> DataFrame:
    """Collated text as plain strings, as the result's readers compare bytes."""
    return df.withColumns({c: F.collate(c, "UTF8_BINARY") for c in columns})


def _log_table(name: str) -> Query:
    return lambda s, d: _run(s, d).log_of(name)


def _preview_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1-G4 as counted while the change set was written."""
    rows = report.preview_rows(_run(spark, sf_dir).counted)
    return spark.createDataFrame([tuple(r.values()) for r in rows], f"count_name string, {CHANGE} string, n long")


def _tallied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1, K3 and K5 in one row, from one aggregate by key."""
    res = _run(spark, sf_dir)
    return tally(res.before, res.applied, None, SPEC).select(*VIOLATIONS)


def _log_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = older_log(spark, sf_dir, P).unionByName(_run(spark, sf_dir).changelog)
    return report.recent_changes(log, P.change_ts)


def _log_recent_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L4 from a log that is kept by day."""
    res = _run(spark, sf_dir)
    path = f"{res.stage.folder}/log_by_day"
    append_log(older_log(spark, sf_dir, P), path)
    append_log(res.changelog, path)
    return recent_log(spark, path, P.change_ts)


def _purged(name: str) -> Query:
    return lambda s, d: report.purge(getattr(_run(s, d), name).after, report.test_row_predicates(SPEC)[name])


def _purge_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    res = _run(spark, sf_dir)
    log = older_log(spark, sf_dir, P).unionByName(res.changelog)
    return report.purge_counts(res.state, log, P.change_ts, SPEC)


def _by_sys_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    res = _run(spark, sf_dir)
    return report.count_by_sys_end(res.before, res.applied, SPEC)


def _multi_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deletes where one scenario's newest snapshot is older than the others'."""
    inp = _inputs(spark, sf_dir)
    return run(older_batch(inp.interim, SPEC), inp.state, P, SPEC, ParquetStage(spark)).deletes


def _changed(res: Run) -> DataFrame:
    return diff.changed_keys(res.deletes, res.inserts, SPEC)


QUERIES: dict[str, Query] = {
    # P1-P3
    "scenarios_auto": lambda s, d: auto_scenarios(_inputs(s, d).interim, P, SPEC),
    "scenarios_explicit": lambda s, d: _sel(s, d, EXPLICIT)[1].candidates
    .groupBy(SPEC.scenario).agg(F.count(F.lit(1)).alias("n")),
    "batch_latest": lambda s, d: latest_batch(_inputs(s, d).interim, P, SPEC),
    # C1-C4
    "candidates_main": lambda s, d: (lambda i, x: candidates_main(
        i.interim, x.scenarios, P, SPEC))(*_sel(s, d)),
    "candidates_ambiguous": lambda s, d: (lambda i, x: candidates_ambiguous(
        i.interim, x.scenarios, P, SPEC))(*_sel(s, d)),
    "candidates": lambda s, d: _sel(s, d)[1].candidates,
    "candidates_all_batches": lambda s, d: _sel(s, d, ALL_BATCHES)[1].candidates,
    # Written and read through the readers
    "scan_interim": lambda s, d: _stored(s, d).interim,
    "scan_register": lambda s, d: open_rows(_stored(s, d).state.register),
    "scan_building_link": lambda s, d: open_rows(_stored(s, d).state.building_link),
    "scan_part_link": lambda s, d: open_rows(_stored(s, d).state.part_link),
    # R1
    "open_register": lambda s, d: open_rows(_inputs(s, d).state.register),
    "open_building_links": lambda s, d: open_rows(_inputs(s, d).state.building_link),
    "open_part_links": lambda s, d: open_rows(_inputs(s, d).state.part_link),
    # D1-D9
    "deletes_only": lambda s, d: _run(s, d).deletes.filter(F.col(CHANGE) == CHANGE_DELETE),
    "inserts_only": lambda s, d: _run(s, d).inserts.filter(F.col(CHANGE) == CHANGE_INSERT),
    "updates_matched": lambda s, d: diff.matched_updates(_run(s, d).classified, SPEC),
    "deletes_all": lambda s, d: _run(s, d).deletes,
    "inserts_all": lambda s, d: _run(s, d).inserts,
    "changed_keys": lambda s, d: _changed(_run(s, d)),
    "classify_one_pass": lambda s, d: diff.classified_keys(_run(s, d).classified, SPEC),
    "deletes_multi_batch": _multi_batch,
    "relinks_part": lambda s, d: (lambda r: diff.find_part_relinks(
        r.selection.candidates, r.before.building_link, r.before.part_link, _changed(r), SPEC))(_run(s, d)),
    "relinks_building": lambda s, d: (lambda r: diff.find_building_relinks(
        r.selection.candidates, r.before.building_link, r.before.part_link, _changed(r), SPEC))(_run(s, d)),
    "relinks_all": lambda s, d: _run(s, d).relinks,
    # D1-D3, D7-D9 and K2 after a comparison of digests
    "deletes_by_digest": lambda s, d: _digested(s, d).deletes,
    "inserts_by_digest": lambda s, d: _digested(s, d).inserts,
    "relinks_by_digest": lambda s, d: _digested(s, d).relinks,
    "check_rerun_by_digest": _rerun_counts(hard=True, digests=True),
    # S2-S4 bucketed, J1-J5 without a shuffle of the state
    "deletes_colocated": lambda s, d: _colocated(s, d).deletes,
    "inserts_colocated": lambda s, d: _colocated(s, d).inserts,
    "relinks_colocated": lambda s, d: _colocated(s, d).relinks,
    "building_after_colocated": lambda s, d: _colocated(s, d).building_link.after,
    # The original's usual collation, which takes no account of case
    "relinks_collated": lambda s, d: _plain(_collated(s, d).relinks, [OLD_PART, SPEC.sub_parent]),
    "part_after_collated": lambda s, d: _plain(_collated(s, d).part_link.after, [SPEC.sub_parent]),
    "building_after_collated": lambda s, d: _collated(s, d).building_link.after,
    "inspect_part_collated": lambda s, d: _plain(_collated(s, d).part_link.after.filter(
        report.test_row_predicates(SPEC)["part_link"]), [SPEC.sub_parent]),
    # A1-A5
    "register_closed": lambda s, d: _touched(_run(s, d).register.named),
    "building_closed_by_change": lambda s, d: _touched(_run(s, d).building_link.named, BY_CHANGE),
    "part_closed_by_change": lambda s, d: _touched(_run(s, d).part_link.named, BY_CHANGE),
    "building_closed_by_relink": lambda s, d: _touched(_run(s, d).building_link.named, BY_RELINK),
    "part_closed_by_relink": lambda s, d: _touched(_run(s, d).part_link.named, BY_RELINK),
    # A6-A11
    "register_after": lambda s, d: _run(s, d).register.after,
    "building_after": lambda s, d: _run(s, d).building_link.after,
    "part_after": lambda s, d: _run(s, d).part_link.after,
    # G1-G6
    "count_candidates": lambda s, d: report.count_candidates(_sel(s, d)[1].candidates),
    "count_deletes": lambda s, d: report.count_by_change(_run(s, d).deletes, COUNT_DELETES),
    "count_inserts": lambda s, d: report.count_by_change(_run(s, d).inserts, COUNT_INSERTS),
    "count_relinks": lambda s, d: report.count_relinks(_run(s, d).relinks),
    "count_maintenance": lambda s, d: report.count_maintenance(_run(s, d).deletes),
    "count_maintenance_by_start": lambda s, d: report.count_maintenance(
        _run(s, d).deletes, START_BUCKET),
    "count_by_sys_end": _by_sys_end,
    # L1-L4
    "changelog_register": _log_table("register"),
    "changelog_building": _log_table("building_link"),
    "changelog_part": _log_table("part_link"),
    "changelog_all": lambda s, d: _run(s, d).changelog,
    "changelog_recent": _log_recent,
    "changelog_recent_pruned": _log_recent_pruned,
    # O1, O5
    "inspect_register": lambda s, d: report.inspect(
        _run(s, d).register.after, report.test_row_predicates(SPEC)["register"], SPEC),
    "inspect_building": lambda s, d: report.inspect(
        _run(s, d).building_link.after, report.test_row_predicates(SPEC)["building_link"], SPEC),
    "inspect_part": lambda s, d: report.inspect(
        _run(s, d).part_link.after, report.test_row_predicates(SPEC)["part_link"], SPEC),
    "purge_test_rows": _purge_counts,
    "register_purged": _purged("register"),
    "building_purged": _purged("building_link"),
    "part_purged": _purged("part_link"),
    # the original as coded: every batch, left joins before the inserts, closed rows rewritten
    "register_after_all_batches": lambda s, d: _run(s, d, ALL_BATCHES).register.after,
    "register_after_reinsert": lambda s, d: _run(s, d, REINSERT).register.after,
    "register_after_close_history": lambda s, d: _run(s, d, CLOSE_HISTORY).register.after,
    "count_preview": lambda s, d: report.preview_counts(_run(s, d).changes),
    "count_preview_observed": _preview_observed,
    "count_groupings": lambda s, d: report.count_groupings(_run(s, d).changes, START_BUCKET),
    # K1-K5
    "check_exclusive_links": lambda s, d: checks.exclusive_links(_run(s, d).state, SPEC),
    "check_open_unique": lambda s, d: checks.open_unique(_run(s, d).register.after, SPEC),
    "check_candidate_unique": lambda s, d: checks.candidate_unique(_sel(s, d)[1].candidates, SPEC),
    "check_intervals": lambda s, d: checks.intervals(_run(s, d).state, SPEC),
    "check_tally": _tallied,
    "check_rerun_empty": _rerun_counts(hard=False),
    "check_rerun_dirty": _rerun_counts(hard=True),
}


# --- oracle SQL ----------------------------------------------------------------------

_OPEN = O.is_open()
_SCENARIOS = ", ".join(map(str, TEST_SCENARIOS))
_TEST_ROWS = {  # which rows the documented manual test wrote
    "register": f"scenario_no IN ({_SCENARIOS})",
    "building_link": f"building_id = 0 OR building_id > {TEST_BUILDING_IDS_ABOVE}",
    "part_link": f"starts_with(part_of_building_id, '{TEST_PART_PREFIX}')",
}
_AFTER = {"register": "reg_after", "building_link": "bld_after", "part_link": "prt_after"}
_NAMES = {"register": SPEC.register_table, "building_link": SPEC.parent_table, "part_link": SPEC.sub_parent_table}
_COLUMNS = {"register": O.REG_COLS, "building_link": O.BLD_COLS, "part_link": O.PRT_COLS}


def _inspect_sql(name: str) -> str:
    head = ["dwelling_id", "effective_start_date", "sys_create_date"]
    columns = [c.strip() for c in _COLUMNS[name].split(",")]
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in [*head, *(c for c in columns if c not in head)])
    return f"SELECT * FROM {_AFTER[name]} WHERE {_TEST_ROWS[name]} ORDER BY {order} LIMIT 1000"


def _purged_sql(name: str) -> str:
    return f"SELECT * FROM {_AFTER[name]} WHERE ({_TEST_ROWS[name]}) IS NOT TRUE"


def _union(parts) -> str:
    return "\nUNION ALL ".join(parts)


def _counts_by_sys_end() -> str:
    before = {"register": "fx_register", "building_link": "fx_building", "part_link": "fx_part"}
    return _union(f"SELECT '{_NAMES[t]}' AS table_name, '{stage}' AS stage, sys_end_date, count(*) AS n "
                  f"FROM {rels[t]} GROUP BY ALL" for stage, rels in (("before", before), ("after", _AFTER)) for t in _NAMES)


def _purge_sql(since: str) -> str:
    rows = [(_NAMES[t], _AFTER[t], _TEST_ROWS[t]) for t in _NAMES]
    rows.append((CHANGELOG_TABLE, "(SELECT change_date FROM log UNION ALL SELECT change_date FROM fx_log)",
                 f"change_date > TIMESTAMP '{since}'"))
    return _union(f"SELECT '{n}' AS table_name, count(*) FILTER (WHERE ({w}) IS NOT TRUE) AS rows_kept, "
                  f"count(*) FILTER (WHERE ({w}) IS TRUE) AS rows_removed FROM {rel}" for n, rel, w in rows)


def _unique_sql(rel: str, where: str = "true") -> str:
    return (f"SELECT count(*) FILTER (WHERE n > 1) AS violations, COALESCE(max(n), 0) AS max_rows_per_key "
            f"FROM (SELECT count(*) AS n FROM {rel} WHERE {where} "
            f"GROUP BY dwelling_id, effective_start_date)")


def _preview_sql() -> str:
    kinds = [(COUNT_DELETES, "dels"), (COUNT_INSERTS, "ins")]
    totals = [(COUNT_CANDIDATES, "cand"), (COUNT_RELINKS, "rel")]
    return _union([*(f"SELECT '{n}' AS count_name, change, count(*) AS n FROM {r} GROUP BY ALL" for n, r in kinds),
                   *(f"SELECT '{n}', CAST(NULL AS VARCHAR), count(*) FROM {r} HAVING count(*) > 0" for n, r in totals)])


def _groupings_sql() -> str:
    bucket = (f"if(effective_start_date > TIMESTAMP '{START_BUCKET[0]}', effective_start_date, TIMESTAMP '{START_BUCKET[1]}')")
    none = "CAST(NULL AS TIMESTAMP)"
    kinds = [("closing", "change", "dels", none, none), ("closing", "effective_end", "dels", "effective_end_date", none),
             ("closing", "start_bucket", "dels", "effective_end_date", bucket), ("opening", "change", "ins", none, none)]
    return _union(f'SELECT \'{side}\' AS side, \'{name}\' AS "grouping", change, {end} AS effective_end_date, '
                  f"{start} AS changed_start_date, count(*) AS n FROM {rel} GROUP BY ALL" for side, name, rel, end, start in kinds)


def _tally_sql() -> str:
    exclusive = f"""(SELECT count(*) FROM bld_after b
  WHERE {O.is_open('b')} AND EXISTS (SELECT 1 FROM prt_after p WHERE {O.is_open('p')} AND p.dwelling_id = b.dwelling_id
    AND p.effective_start_date = b.effective_start_date)) AS exclusive_links"""
    bad = ", ".join(f"(SELECT count(*) FROM {_AFTER[t]} WHERE NOT {_OPEN} AND sys_end_date < sys_create_date) AS intervals_{t}" for t in _NAMES)
    return f"SELECT {exclusive}, violations AS open_unique, max_rows_per_key AS max_open_per_key, {bad} FROM ({_unique_sql('reg_after', _OPEN)})"


def oracle_sql() -> dict[str, str]:
    w = O.with_chain
    since = hours_before(P.change_ts)
    capitals = lambda rel, third: (f"(SELECT * REPLACE (if(dwelling_id % 3 = {third}, upper(part_of_building_id), "  # noqa: E731
                                   f"part_of_building_id) COLLATE NOCASE AS part_of_building_id) FROM {rel})")
    nocase = lambda final: w(final, interim=capitals("fx_interim", 1), prt=capitals("fx_part", 0))
    rerun = O.chain("r2_", P, "fx_interim", "reg_after", "bld_after", "prt_after")
    rerun_counts = "SELECT " + ", ".join(f"(SELECT count(*) FROM r2_{r}) AS {n}" for n, r in
                                         (("deletes", "dels"), ("inserts", "ins"), ("relinks", "rel")))
    closed = lambda t, why: f"SELECT {_COLUMNS[t]} FROM {O.DONE[t]} WHERE why = '{why}'"
    return {
        "scenarios_auto": w("SELECT id FROM scen"),
        "scenarios_explicit": w("SELECT scenario_no, count(*) AS n FROM cand GROUP BY scenario_no", EXPLICIT),
        "batch_latest": w("SELECT max(batch) AS batch_ts FROM scen"),
        "candidates_main": w("SELECT * FROM c1"),
        "candidates_ambiguous": w("SELECT * FROM c2"),
        "candidates": w("SELECT * FROM cand"),
        "candidates_all_batches": w("SELECT * FROM cand", ALL_BATCHES),
        "scan_interim": w("SELECT * FROM fx_interim"),
        **{f"{q}_register": w(f"SELECT * FROM fx_register WHERE {_OPEN}") for q in ("open", "scan")},
        "open_building_links": w(f"SELECT * FROM fx_building WHERE {_OPEN}"),
        "scan_building_link": w(f"SELECT * FROM fx_building WHERE {_OPEN}"),
        "open_part_links": w(f"SELECT * FROM fx_part WHERE {_OPEN}"),
        "scan_part_link": w(f"SELECT * FROM fx_part WHERE {_OPEN}"),
        "deletes_only": w("SELECT * FROM dels WHERE change = 'DELETE'"),
        "inserts_only": w("SELECT * FROM ins WHERE change = 'INSERT'"),
        "updates_matched": w("SELECT * FROM changed"),
        "deletes_all": w("SELECT * FROM dels"),
        "inserts_all": w("SELECT * FROM ins"),
        **{f"{q}_{how}": w(f"SELECT * FROM {rel}") for how in ("by_digest", "colocated")
           for q, rel in (("deletes", "dels"), ("inserts", "ins"), ("relinks", "rel"))},
        "building_after_colocated": w("SELECT * FROM bld_after"),
        "relinks_collated": nocase("SELECT * REPLACE (old_pob_id || '' AS old_pob_id, part_of_building_id || '' AS part_of_building_id) FROM rel"),
        "part_after_collated": nocase("SELECT * FROM prt_after"),
        "building_after_collated": nocase("SELECT * FROM bld_after"),
        "inspect_part_collated": nocase(f"SELECT * FROM prt_after WHERE part_of_building_id ILIKE '{TEST_PART_PREFIX}%'"),
        "deletes_multi_batch": w("SELECT * FROM dels", interim=f"""(SELECT * REPLACE (CASE WHEN scenario_no = 1
  THEN TIMESTAMP '{STALE_BATCH}' ELSE sys_create_date END AS sys_create_date) FROM fx_interim)"""),
        "changed_keys": w("SELECT * FROM chg"),
        "classify_one_pass": w("""
SELECT dwelling_id, effective_start_date, scenario_no AS reg_scenario_no,
       CAST(NULL AS INTEGER) AS cand_scenario_no, change FROM dels WHERE change = 'DELETE'
UNION ALL SELECT dwelling_id, effective_start_date, CAST(NULL AS INTEGER), scenario_no, change FROM ins WHERE change = 'INSERT'
UNION ALL SELECT dwelling_id, effective_start_date, reg_scenario_no, scenario_no, 'UPDATE' FROM changed"""),
        "relinks_part": w("SELECT * EXCLUDE (side) FROM moves WHERE side = 'part'"),
        "relinks_building": w("SELECT * EXCLUDE (side) FROM moves WHERE side = 'building'"),
        "relinks_all": w("SELECT * FROM rel"),
        "register_closed": w(closed("register", "change")),
        "building_closed_by_change": w(closed("building_link", "change")),
        "part_closed_by_change": w(closed("part_link", "change")),
        "building_closed_by_relink": w(closed("building_link", "relink")),
        "part_closed_by_relink": w(closed("part_link", "relink")),
        "register_after": w("SELECT * FROM reg_after"),
        "register_after_all_batches": w("SELECT * FROM reg_after", ALL_BATCHES),
        "register_after_reinsert": w("SELECT * FROM reg_after", REINSERT),
        "register_after_close_history": w("SELECT * FROM reg_after", CLOSE_HISTORY),
        "building_after": w("SELECT * FROM bld_after"),
        "part_after": w("SELECT * FROM prt_after"),
        "count_candidates": w(f"SELECT count(*) AS {COUNT_CANDIDATES} FROM cand"),
        "count_deletes": w(f"SELECT change, count(*) AS {COUNT_DELETES} FROM dels GROUP BY change"),
        "count_inserts": w(f"SELECT change, count(*) AS {COUNT_INSERTS} FROM ins GROUP BY change"),
        "count_relinks": w(f"SELECT count(*) AS {COUNT_RELINKS} FROM rel"),
        "count_preview": w(_preview_sql()),
        "count_maintenance": w(f"SELECT change, effective_end_date, count(*) AS {COUNT_MAINTENANCE} "
                               "FROM dels GROUP BY change, effective_end_date"),
        "count_maintenance_by_start": w(f"""
SELECT change, effective_end_date, if(effective_start_date > TIMESTAMP '{START_BUCKET[0]}', effective_start_date,
  TIMESTAMP '{START_BUCKET[1]}') AS changed_start_date, count(*) AS {COUNT_MAINTENANCE} FROM dels GROUP BY ALL"""),
        "count_by_sys_end": w(_counts_by_sys_end()),
        **{f"changelog_{q}": w(f"SELECT * FROM log WHERE table_name = '{t}'") for q, t in
           (("register", SPEC.register_table), ("building", SPEC.parent_table), ("part", SPEC.sub_parent_table))},
        "changelog_all": w("SELECT * FROM log"),
        "count_preview_observed": w(_preview_sql()),
        "count_groupings": w(_groupings_sql()),
        "check_tally": w(_tally_sql()),
        **{f"changelog_recent{q}": w("SELECT * FROM (SELECT * FROM log UNION ALL BY NAME SELECT * FROM fx_log) "
                                     f"WHERE change_date > TIMESTAMP '{since}'") for q in ("", "_pruned")},
        "inspect_register": w(_inspect_sql("register")),
        "inspect_building": w(_inspect_sql("building_link")),
        "inspect_part": w(_inspect_sql("part_link")),
        "purge_test_rows": w(_purge_sql(since)),
        "register_purged": w(_purged_sql("register")),
        "building_purged": w(_purged_sql("building_link")),
        "part_purged": w(_purged_sql("part_link")),
        "check_exclusive_links": w(f"""
SELECT count(*) AS violations FROM bld_after b
JOIN (SELECT DISTINCT dwelling_id, effective_start_date FROM prt_after WHERE {_OPEN}) p USING (dwelling_id, effective_start_date)
WHERE {O.is_open('b')}"""),
        "check_open_unique": w(_unique_sql("reg_after", _OPEN)),
        "check_candidate_unique": w(_unique_sql("cand")),
        "check_intervals": w(_union(f"SELECT '{_NAMES[t]}' AS table_name, count(*) FILTER (WHERE NOT {_OPEN} "
                                    f"AND sys_end_date < sys_create_date) AS violations FROM {_AFTER[t]}" for t in _NAMES)),
        "check_rerun_empty": w(rerun_counts, extra=rerun, hard=False),
        "check_rerun_dirty": w(rerun_counts, extra=rerun),
        "check_rerun_by_digest": w(rerun_counts, extra=rerun),
    }


def queries() -> dict[str, Query]:
    return dict(QUERIES)
