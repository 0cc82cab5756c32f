"""DuckDB SQL for every registered query: the independent oracle.

Written from the rules, not from the plans.  All sides of a key are counted in one relation, which tells what is
missing where; links of both kinds are one relation of moves; what closes a table's rows is one list of closers with
the values they look at and the values they write; rows are numbered, so each keeps its own best closer; the change log
counts facts.  The Spark plans are built from semi and anti joins, reduced requests and signed contributions, so the two
agree only when they mean the same thing.

Inputs are derived from the ``orders`` view with the same rules as ``chronoreg.sources.fixtures``.
"""

from __future__ import annotations

from chronoreg.model import (
    BUILDING_LINK_TABLE,
    BUILDING_RELINK_OLD_PART,
    DELETE_BUILDING_ID,
    DELETE_PART_ID,
    HIGH_DATE,
    LOG_COLUMNS,
    OPEN_CUTOFF,
    PART_LINK_TABLE,
    PROCESS_NAME,
    REGISTER_TABLE,
    TEST_PART_PREFIX,
    UPDATE_PART_DEFAULT,
    RunParams,
)
from chronoreg.sources import fixtures as fx

HI = f"TIMESTAMP '{HIGH_DATE}'"
T_COLS = "effective_start_date, effective_end_date, sys_create_date, sys_end_date, sys_deleted_ind"
CAND_COLS = ("dwelling_id, scenario_no, version_no, building_id, part_of_building_id, "
             "effective_start_date, effective_end_date, sys_create_date, sys_end_date, sys_deleted_ind")
REG_COLS = f"dwelling_id, scenario_no, {T_COLS}"
BLD_COLS = f"dwelling_id, building_id, {T_COLS}"
PRT_COLS = f"dwelling_id, part_of_building_id, {T_COLS}"


def is_open(alias: str = "") -> str:
    a = f"{alias}." if alias else ""
    return f"({a}sys_end_date IS NULL OR {a}sys_end_date > TIMESTAMP '{OPEN_CUTOFF}')"


_EASY = f"""
fx_base AS (
  SELECT o_orderkey AS k, o_orderkey % 20 AS m, o_custkey AS c, o_orderdate AS es,
         o_orderdate + INTERVAL 365 DAY AS ee FROM orders),
ez_interim AS (
  SELECT k AS dwelling_id,
    CAST(CASE WHEN m = 13 THEN 999 WHEN m = 4 THEN 99 WHEN m IN (11,12) THEN 5 ELSE k % 5 END AS INTEGER) AS scenario_no,
    CAST(CASE WHEN m = 16 THEN {fx.OTHER_VERSION} ELSE {fx.FIXTURE_VERSION} END AS DOUBLE) AS version_no,
    CASE WHEN m = 10 THEN c + 1 ELSE c END AS building_id,
    CASE WHEN m IN (8,17) THEN concat('pob', CAST(k AS VARCHAR))
         WHEN m = 9 THEN concat('new', CAST(k AS VARCHAR)) END AS part_of_building_id,
    es AS effective_start_date,
    CASE WHEN m = 2 THEN ee WHEN m = 15 THEN CAST(NULL AS TIMESTAMP) ELSE {HI} END AS effective_end_date,
    TIMESTAMP '{fx.CURRENT_BATCH}' AS sys_create_date, {HI} AS sys_end_date, 'N' AS sys_deleted_ind
  FROM fx_base WHERE m <> 1
  UNION ALL
  SELECT k, 5, CAST({fx.FIXTURE_VERSION} AS DOUBLE), c + 1, CAST(NULL AS VARCHAR), es, {HI},
    TIMESTAMP '{fx.CURRENT_BATCH}', {HI}, 'N' FROM fx_base WHERE m IN (11,12)
  UNION ALL
  SELECT k, CAST(k % 5 AS INTEGER), CAST({fx.FIXTURE_VERSION} AS DOUBLE), c, CAST(NULL AS VARCHAR), es, ee,
    TIMESTAMP '{fx.STALE_BATCH}', {HI}, 'N' FROM fx_base WHERE m = 18),
ez_register AS (
  SELECT k AS dwelling_id,
    CAST(CASE WHEN m IN (3,4) THEN 99 WHEN m = 5 THEN 77 WHEN m = 11 THEN 5 ELSE k % 5 END AS INTEGER) AS scenario_no,
    es AS effective_start_date, {HI} AS effective_end_date,
    TIMESTAMP '{fx.REGISTER_BATCH}' AS sys_create_date,
    CASE WHEN m = 6 THEN TIMESTAMP '{fx.CLOSED_BEFORE}' WHEN m = 14 THEN CAST(NULL AS TIMESTAMP)
         ELSE {HI} END AS sys_end_date,
    'N' AS sys_deleted_ind FROM fx_base WHERE m NOT IN (0,12)),
ez_building AS (
  SELECT r.dwelling_id, CASE WHEN m = 11 THEN CAST(0 AS BIGINT) ELSE c END AS building_id,
         {', '.join('r.' + c.strip() for c in T_COLS.split(','))}
  FROM ez_register r JOIN fx_base ON k = r.dwelling_id WHERE m NOT IN (1,7,9,17)),
ez_part AS (
  SELECT r.dwelling_id, concat('pob', CAST(k AS VARCHAR)) AS part_of_building_id,
         {', '.join('r.' + c.strip() for c in T_COLS.split(','))}
  FROM ez_register r JOIN fx_base ON k = r.dwelling_id WHERE m IN (1,7,9,17))"""

_T = (f"es, {HI}, TIMESTAMP '{fx.REGISTER_BATCH}', {HI}, 'N'")


def _hard(case: int, eighth: int) -> str:
    return f"fx_base WHERE m = {case} AND k // 20 % 8 = {eighth}"


_LOG = f"""
fx_log AS (SELECT TIMESTAMP '{fx.FIXTURE_PARAMS.change_ts}' - to_hours(CAST(k // 20 % 5 AS BIGINT)) AS change_date,
  '{REGISTER_TABLE}' AS table_name, '{PROCESS_NAME}' AS process, CAST(1 AS BIGINT) AS records_added,
  CAST(0 AS BIGINT) AS records_modified, CAST(0 AS BIGINT) AS records_retired, k AS total_records_after,
  CAST(NULL AS VARCHAR) AS source, CAST(NULL AS TIMESTAMP) AS source_from_date, CAST(NULL AS TIMESTAMP) AS source_to_date
  FROM fx_base WHERE m = 0)"""

_PLAIN = """
fx_interim AS (SELECT * FROM ez_interim), fx_register AS (SELECT * FROM ez_register),
fx_building AS (SELECT * FROM ez_building), fx_part AS (SELECT * FROM ez_part)"""

_HARD = f"""
fx_interim AS (
  SELECT * REPLACE (sys_create_date + CASE WHEN dwelling_id // 20 % 8 = 6 THEN INTERVAL 400 MILLISECOND
    ELSE INTERVAL 0 SECOND END AS sys_create_date) FROM ez_interim
  UNION ALL SELECT k, CAST((k + 1) % 5 AS INTEGER), {fx.FIXTURE_VERSION}, c + 1, NULL, es, {HI},
    TIMESTAMP '{fx.CURRENT_BATCH}', {HI}, 'N' FROM {_hard(3, 2)}),
fx_register AS (
  SELECT * REPLACE (CASE WHEN dwelling_id % 20 = 16 AND dwelling_id // 20 % 8 = 4 THEN 77 ELSE scenario_no END AS scenario_no)
  FROM ez_register
  UNION ALL SELECT k, CAST(k % 5 AS INTEGER), es, {HI}, TIMESTAMP '{fx.SECOND_BATCH}', {HI}, 'N' FROM {_hard(15, 7)}
  UNION ALL SELECT k, CAST(k % 5 AS INTEGER), es, {HI}, TIMESTAMP '{fx.REGISTER_BATCH}', TIMESTAMP '{fx.BEFORE_CREATION}', 'N'
    FROM {_hard(1, 6)}),
fx_building AS (
  SELECT * FROM ez_building
  UNION ALL SELECT k, c, es, {HI}, TIMESTAMP '{fx.REGISTER_BATCH}', NULL, 'N' FROM {_hard(2, 1)}
  UNION ALL SELECT k, c + 2, {_T} FROM {_hard(19, 3)}
  UNION ALL SELECT k, c + 3, es, {HI}, TIMESTAMP '{fx.REGISTER_BATCH}', TIMESTAMP '{fx.BEFORE_CREATION}', 'N' FROM {_hard(13, 1)}),
fx_part AS (
  SELECT * FROM ez_part
  UNION ALL SELECT k, '{TEST_PART_PREFIX}' || k, {_T} FROM {_hard(19, 3)}
  UNION ALL SELECT k, '{TEST_PART_PREFIX}' || k, {_T} FROM {_hard(16, 4)}
  UNION ALL SELECT k, '{TEST_PART_PREFIX}' || k, {_T} FROM {_hard(17, 5)}
  UNION ALL SELECT k, '{TEST_PART_PREFIX}' || k, es, {HI}, TIMESTAMP '{fx.REGISTER_BATCH}', TIMESTAMP '{fx.BEFORE_CREATION}', 'N'
    FROM {_hard(14, 2)})"""


def fixture(hard: bool = True) -> list[str]:
    return [_EASY.strip(), (_HARD if hard else _PLAIN).strip(), _LOG.strip()]


DONE = {"register": "reg_done", "building_link": "bld_done", "part_link": "prt_done"}


def _ts(value: str | None) -> str:
    return "CAST(NULL AS TIMESTAMP)" if value is None else f"TIMESTAMP '{value}'"


def _second(column: str) -> str:
    return f"date_trunc('second', {column} + INTERVAL 500 MILLISECOND)"


def _any_true(*conditions: str) -> str:
    """True where one of the conditions is, whatever the unknown ones would be."""
    return f"list_contains([{', '.join(conditions)}], true)"


def _closed(name: str, source: str, closers: str, keys: str, cols: str, fits: str, target: str) -> list[str]:
    """``name``_done: every row of ``source`` with its best closer's values and why (NULL where none fits)."""
    new = {"effective_end_date": "to_ee", "sys_end_date": "to_se", "sys_deleted_ind": "to_di"}
    out = ", ".join(f"if(why IS NULL, {c}, {new[c]}) AS {c}" if c in new else c for c in map(str.strip, cols.split(",")))
    return [
        f"{name}_rows AS MATERIALIZED (SELECT row_number() OVER () AS rid, * FROM {source})",
        f"""{name}_best AS (SELECT DISTINCT ON (rid) rid, to_ee, to_se, to_di, why
  FROM {name}_rows t JOIN {closers} c USING ({keys}) WHERE ({target}) AND {fits}
  ORDER BY rid, to_se DESC NULLS LAST, to_ee DESC NULLS LAST, to_di DESC NULLS LAST)""",
        f"{name}_done AS (SELECT {out}, why FROM {name}_rows LEFT JOIN {name}_best USING (rid))",
    ]


def _opened(params: RunParams, done: str, source: str, cols: str, other_scenario: bool = False) -> str:
    """The new rows, once or (as the original's left join does) once for each open row of the key."""
    if not params.reinsert_join:
        return f"SELECT {cols} FROM {source}"
    also = " AND o.scenario_no <> i.scenario_no" if other_scenario else ""
    n = (f"(SELECT count(*) FROM {done} o WHERE {is_open('o')} AND o.dwelling_id = i.dwelling_id "
         f"AND o.effective_start_date = i.effective_start_date{also})")
    return f"SELECT {cols} FROM (SELECT {cols}, unnest(range(greatest(1, {n}))) AS copy FROM {source} i)"


def chain(p: str, params: RunParams, interim: str, reg: str, bld: str, prt: str) -> list[str]:
    """All CTEs of one run over the given input relations, names prefixed with ``p``."""
    version = f"version_no = {float(params.version_no)!r}"
    amb = f"scenario_no IN ({', '.join(map(str, params.ambiguous_scenarios))})"
    key = "dwelling_id, effective_start_date"
    if params.scenarios:
        ids = f"(SELECT DISTINCT unnest([{', '.join(str(int(i)) for i in params.scenarios)}]) AS id) LEFT JOIN {p}held USING (id)"
    else:
        ids = f"{p}held WHERE id NOT IN ({', '.join(map(str, params.excluded_scenarios))})"
    if not params.batch_filter:
        batch, present = "CAST(NULL AS TIMESTAMP)", "true"
    elif params.batch_ts:
        batch, present = _ts(params.batch_ts), f"COALESCE(list_contains(seconds, {_ts(params.batch_ts)}), false)"
    else:
        batch, present = _second("newest"), "true"
    in_batch = f"{_second('i.sys_create_date')} = s.batch" if params.batch_filter else "true"
    values = "part_of_building_id, effective_start_date, effective_end_date, sys_create_date"
    ctes = [
        f"""{p}held AS (SELECT scenario_no AS id, max(sys_create_date) AS newest,
  list(DISTINCT {_second('sys_create_date')}) AS seconds FROM {interim} i WHERE {version} GROUP BY 1)""",
        f"{p}scen AS (SELECT id, {batch} AS batch, {present} AS present FROM {ids})",
        f"""{p}snap AS (SELECT i.*, {amb} AS unsure FROM {interim} i JOIN {p}scen s ON s.id = i.scenario_no
  WHERE {version} AND {in_batch})""",
        f"""{p}c1 AS (SELECT dwelling_id, scenario_no, version_no, building_id, {values}, {HI} AS sys_end_date,
  'N' AS sys_deleted_ind FROM {p}snap WHERE NOT unsure)""",
        f"""{p}c2 AS (SELECT * EXCLUDE (was) FROM (SELECT DISTINCT dwelling_id, scenario_no, version_no,
  CAST(0 AS BIGINT) AS building_id, {values}, sys_end_date, 'N' AS sys_deleted_ind, sys_deleted_ind AS was
  FROM {p}snap WHERE unsure))""",
        f"""{p}cand AS (SELECT DISTINCT dwelling_id, scenario_no, version_no, if(unsure, 0, building_id) AS building_id,
  {values}, if(unsure, sys_end_date, {HI}) AS sys_end_date, 'N' AS sys_deleted_ind FROM {p}snap)""",
        # what each key has on either side; rows with an unknown key component meet nothing
        f"""{p}sides AS (SELECT {key}, count(*) FILTER (WHERE side = 'snapshot') AS arriving,
  count(*) FILTER (WHERE side = 'register') AS standing
  FROM (SELECT {key}, 'snapshot' AS side FROM {p}cand UNION ALL SELECT {key}, 'register' FROM {reg} WHERE {is_open()})
  WHERE dwelling_id IS NOT NULL AND effective_start_date IS NOT NULL GROUP BY {key})""",
        f"""{p}changed AS (SELECT c.*, r.scenario_no AS reg_scenario_no, r.effective_end_date AS reg_effective_end_date,
  r.sys_create_date AS reg_sys_create_date FROM {p}cand c JOIN {reg} r USING ({key})
  WHERE {is_open('r')} AND r.scenario_no IN (SELECT id FROM {p}scen)
  AND {_any_true('r.effective_end_date <> c.effective_end_date', 'r.scenario_no <> c.scenario_no')})""",
        f"""{p}dels AS (
  SELECT dwelling_id, CAST({DELETE_BUILDING_ID} AS BIGINT) AS building_id, '{DELETE_PART_ID}' AS part_of_building_id,
    scenario_no, effective_start_date, effective_end_date, sys_create_date, {_ts(params.run_ts)} AS sys_end_date,
    'Y' AS sys_deleted_ind, 'DELETE' AS change
  FROM {reg} r LEFT JOIN {p}sides k USING ({key})
  WHERE {is_open('r')} AND COALESCE(arriving, 0) = 0 AND scenario_no IN (SELECT id FROM {p}scen WHERE present)
  UNION ALL
  SELECT dwelling_id, building_id, COALESCE(part_of_building_id, '{UPDATE_PART_DEFAULT}'), reg_scenario_no,
    effective_start_date, reg_effective_end_date, reg_sys_create_date, sys_create_date - INTERVAL 1 SECOND, 'N', 'UPDATE'
  FROM {p}changed)""",
        f"""{p}ins AS (
  SELECT c.*, 'INSERT' AS change FROM {p}cand c LEFT JOIN {p}sides k USING ({key}) WHERE COALESCE(standing, 0) = 0
  UNION ALL SELECT {CAND_COLS}, 'UPDATE' FROM {p}changed)""",
        f"{p}chg AS (SELECT {key} FROM {p}dels UNION SELECT {key} FROM {p}ins)",
        # open links of both kinds beside the candidate that now says something else
        f"""{p}links AS (SELECT {key}, 'part' AS side, part_of_building_id AS had_part, CAST(NULL AS BIGINT) AS had_building
    FROM {prt} WHERE {is_open()}
  UNION ALL SELECT {key}, 'building', NULL, building_id FROM {bld} WHERE {is_open()})""",
        f"""{p}moves AS (SELECT dwelling_id, COALESCE(had_part, '{BUILDING_RELINK_OLD_PART}') AS old_pob_id, part_of_building_id,
  if(side = 'part', building_id, had_building) AS building_id, effective_start_date, effective_end_date, sys_create_date,
  sys_end_date, 'N' AS sys_deleted_ind, side
  FROM {p}cand JOIN {p}links USING ({key}) ANTI JOIN {p}chg USING ({key})
  WHERE if(side = 'part', part_of_building_id IS NULL OR part_of_building_id <> had_part, part_of_building_id IS NOT NULL))""",
        f"{p}rel AS (SELECT * EXCLUDE (side) FROM {p}moves)",
        f"""{p}closers AS (SELECT {key}, sys_create_date, 'change' AS why, building_id AS at_building, part_of_building_id AS at_part,
    effective_end_date AS at_ee, sys_end_date AS at_se, effective_end_date AS to_ee, sys_end_date AS to_se,
    sys_deleted_ind AS to_di FROM {p}dels
  UNION ALL SELECT {key}, NULL, 'relink', if(part_of_building_id IS NOT NULL, building_id, NULL),
    if(part_of_building_id IS NULL OR part_of_building_id <> old_pob_id, old_pob_id, NULL), NULL, NULL,
    effective_end_date, sys_create_date - INTERVAL 1 SECOND, sys_deleted_ind FROM {p}rel)""",
    ]

    def fits(link: str, at: str) -> str:
        other = _any_true(f"c.{at} <> t.{link}", "c.at_ee <> t.effective_end_date", "c.at_se <> t.sys_end_date")
        return f"if(c.why = 'relink', c.{at} = t.{link}, {other})"

    ctes += _closed(f"{p}reg", reg, f"{p}closers", f"{key}, sys_create_date", REG_COLS, "c.why = 'change'",
                    "true" if params.close_history else is_open("t"))
    for name, source, cols, link, at in (("bld", bld, BLD_COLS, "building_id", "at_building"),
                                         ("prt", prt, PRT_COLS, "part_of_building_id", "at_part")):
        # a relink of the other side has no link of this one to look for
        ctes += _closed(f"{p}{name}", source, f"(SELECT * EXCLUDE (sys_create_date) FROM {p}closers)", key, cols,
                        fits(link, at), is_open("t"))
    for name, cols, part in (("bld", BLD_COLS, "IS NULL"), ("prt", PRT_COLS, "IS NOT NULL")):
        arriving = (f"(SELECT {cols} FROM {p}ins WHERE part_of_building_id {part} "
                    f"UNION ALL SELECT {cols} FROM {p}rel WHERE part_of_building_id {part})")
        ctes.append(f"{p}{name}_new AS ({_opened(params, f'{p}{name}_done', arriving, cols)})")
    ctes.append(f"{p}reg_new AS ({_opened(params, f'{p}reg_done', f'{p}ins', REG_COLS, other_scenario=True)})")
    for name, cols in (("reg", REG_COLS), ("bld", BLD_COLS), ("prt", PRT_COLS)):
        ctes.append(f"{p}{name}_after AS (SELECT {cols} FROM {p}{name}_done UNION ALL SELECT {cols} FROM {p}{name}_new)")

    retired = (f"(SELECT CASE WHEN bool_or(change = 'DELETE') THEN {_ts(params.run_ts)} "
               f"ELSE max(sys_end_date) END FROM {p}dels)")
    side = f"if(part_of_building_id IS NULL, '{BUILDING_LINK_TABLE}', '{PART_LINK_TABLE}')"
    what = "if(change = 'INSERT', 'added', 'modified')"
    tables = [(REGISTER_TABLE, "reg"), (BUILDING_LINK_TABLE, "bld"), (PART_LINK_TABLE, "prt")]
    facts = [f"SELECT '{REGISTER_TABLE}' AS name, {what} AS fact FROM {p}ins",
             f"SELECT {side}, {what} FROM {p}ins",
             f"SELECT {side}, 'modified' FROM {p}rel",
             f"SELECT '{REGISTER_TABLE}', 'retired' FROM {p}dels WHERE change = 'DELETE'",
             *(f"SELECT '{t}', 'open' FROM {p}{n}_after WHERE {is_open()}" for t, n in tables),
             *(f"SELECT '{t}', 'retired' FROM {p}{n}_after WHERE sys_end_date = {retired}" for t, n in tables[1:])]
    counts = ", ".join(f"count(*) FILTER (WHERE fact = '{f}') AS {c}" for f, c in zip(
        ("added", "modified", "retired", "open"), LOG_COLUMNS[3:7], strict=True))
    ctes += [
        f"{p}facts AS ({' UNION ALL '.join(facts)})",
        f"""{p}log AS (SELECT {_ts(params.change_ts)} AS change_date, name AS table_name, '{PROCESS_NAME}' AS process, {counts},
  CAST(NULL AS VARCHAR) AS source, CAST(NULL AS TIMESTAMP) AS source_from_date, CAST(NULL AS TIMESTAMP) AS source_to_date
  FROM (SELECT unnest([{', '.join(f"'{t}'" for t, _ in tables)}]) AS name) LEFT JOIN {p}facts USING (name) GROUP BY name)""",
    ]
    return ctes


def with_chain(final: str, params: RunParams = fx.FIXTURE_PARAMS, extra: list[str] | None = None, hard: bool = True,
               interim: str = "fx_interim", prt: str = "fx_part") -> str:
    ctes = fixture(hard) + chain("", params, interim, "fx_register", "fx_building", prt)
    ctes += extra or []
    return "WITH " + ",\n".join(ctes) + "\n" + final.strip()
