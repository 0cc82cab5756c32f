"""Differential test: random inputs, the whole Spark run against the DuckDB oracle chain.

The inputs are drawn from small domains so that keys collide, NULLs appear in keys and
compared columns, scenarios are excluded or ambiguous, several batches and versions are
present, and link tables hold several rows per key.  The oracle is the same SQL the
registered queries are checked with, run here on the generated relations.
"""

import random
import duckdb
import pandas as pd
import pytest

from chronoreg.model import RunParams
from chronoreg.plans import oracle as O
from chronoreg.plans.run import ParquetStage, run
from helpers import interim, state
from tools.compare import _rows

HI = "9999-01-01 00:00:00"
STARTS = ["2020-01-01 00:00:00", "2020-06-01 00:00:00", None]
ENDS = [HI, HI, "2022-01-01 00:00:00", "2023-01-01 00:00:00", None]
BATCHES = ["2024-01-01 00:00:00", "2024-01-02 00:00:00"]
OLD = ["2019-01-01 00:00:00", "2023-06-01 00:00:00"]
SYS_ENDS = [HI, HI, HI, None, "2023-03-01 00:00:00"]
NOW = "2024-06-01 12:00:00"


def _pick(rng, values):
    return values[rng.randrange(len(values))]


def _generate(seed):
    rng = random.Random(seed)
    ids = [1, 2, 3, 4, 5, None]
    snap = []
    for _ in range(rng.randint(15, 30)):
        snap.append((_pick(rng, ids), _pick(rng, [0, 1, 5, 5, 99, 999]), _pick(rng, [1.0, 1.0, 2.0]),
                     _pick(rng, [0, 1, 2]), _pick(rng, [None, None, "p1", "p2"]), _pick(rng, STARTS),
                     _pick(rng, ENDS), _pick(rng, BATCHES), _pick(rng, [HI, HI, "2024-02-01 00:00:00"]),
                     _pick(rng, ["N", "Y"])))
    reg = [(_pick(rng, ids), _pick(rng, [0, 1, 5, 7, 99]), _pick(rng, STARTS), _pick(rng, ENDS),
            _pick(rng, OLD), _pick(rng, SYS_ENDS), "N") for _ in range(rng.randint(8, 16))]
    bld = [(_pick(rng, ids), _pick(rng, [0, 1, 2]), _pick(rng, STARTS), _pick(rng, ENDS), _pick(rng, OLD),
            _pick(rng, SYS_ENDS), "N") for _ in range(rng.randint(6, 14))]
    prt = [(_pick(rng, ids), _pick(rng, ["p1", "p2", "p3"]), _pick(rng, STARTS), _pick(rng, ENDS),
            _pick(rng, OLD), _pick(rng, SYS_ENDS), "N") for _ in range(rng.randint(4, 10))]
    return snap, reg, bld, prt


def _duck_frame(rows, columns):
    """Timestamps stay text here (year 9999 is out of pandas' range); DuckDB casts them."""
    return pd.DataFrame(rows, columns=columns, dtype=object)


CAND = ["dwelling_id", "scenario_no", "version_no", "building_id", "part_of_building_id",
        "effective_start_date", "effective_end_date", "sys_create_date", "sys_end_date", "sys_deleted_ind"]
T = ["effective_start_date", "effective_end_date", "sys_create_date", "sys_end_date", "sys_deleted_ind"]


def _oracle(snap, reg, bld, prt, params, final):
    con = duckdb.connect()
    frames = {"r_interim": _duck_frame(snap, CAND), "r_reg": _duck_frame(reg, ["dwelling_id", "scenario_no", *T]),
              "r_bld": _duck_frame(bld, ["dwelling_id", "building_id", *T]),
              "r_prt": _duck_frame(prt, ["dwelling_id", "part_of_building_id", *T])}
    types = {"dwelling_id": "BIGINT", "scenario_no": "INTEGER", "version_no": "DOUBLE", "building_id": "BIGINT",
             "part_of_building_id": "VARCHAR", "sys_deleted_ind": "VARCHAR"}
    for name, df in frames.items():
        con.register(name + "_raw", df)
        cols = ", ".join(f"CAST({c} AS {types.get(c, 'TIMESTAMP')}) AS {c}" for c in df.columns)
        con.execute(f"CREATE TABLE {name} AS SELECT {cols} FROM {name}_raw")
    sql = "WITH " + ",\n".join(O.chain("", params, "r_interim", "r_reg", "r_bld", "r_prt")) + "\n" + final
    cur = con.execute(sql)
    return _rows([d[0] for d in cur.description], cur.fetchall())


@pytest.mark.parametrize("seed", [11, 12, 13, 14])
@pytest.mark.parametrize("params", [RunParams(version_no=1.0, run_ts=NOW),
                                    RunParams(version_no=1.0, run_ts=NOW, scenarios=(1, 5, 999), batch_filter=False),
                                    RunParams(version_no=1.0, run_ts=NOW, batch_filter=False, reinsert_join=True),
                                    RunParams(version_no=1.0, run_ts=NOW, close_history=True)],
                         ids=["auto", "explicit-allbatches", "reinsert-join", "close-history"])
def test_random_run_matches_oracle(spark, seed, params):
    snap, reg, bld, prt = _generate(seed)
    res = run(interim(spark, snap), state(spark, reg, bld, prt), params, stage=ParquetStage(spark))
    for table, df in (("reg_after", res.state.register), ("bld_after", res.state.building_link),
                      ("prt_after", res.state.part_link), ("log", res.changelog)):
        got = _rows(df.columns, [tuple(r) for r in df.collect()])
        want = _oracle(snap, reg, bld, prt, params, f"SELECT * FROM {table}")
        assert got == want, table


S0, E1, OLD0, B2 = "2020-01-01 00:00:00", "2022-01-01 00:00:00", "2019-01-01 00:00:00", "2024-01-02 00:00:00"
DUP_SNAP = [(1, 1, 1.0, 10, None, S0, E1, B2, HI, "N")]
# two open rows under unlisted scenarios with their own create dates: the update's closing
# (matched on entity, create and start) leaves them open
DUP_REG = [(1, 1, S0, HI, OLD0, HI, "N"), (1, 7, S0, HI, "2019-02-01 00:00:00", HI, "N"),
           (1, 8, S0, HI, "2019-03-01 00:00:00", HI, "N")]
DUP_BLD = [(1, 10, S0, HI, OLD0, None, "N"), (1, 10, S0, HI, OLD0, None, "N")]


@pytest.mark.parametrize("reinsert,expected", [(False, (4, 3)), (True, (5, 4))])
def test_reinsert_join_multiplies_like_the_original(spark, reinsert, expected):
    params = RunParams(version_no=1.0, run_ts=NOW, reinsert_join=reinsert)
    res = run(interim(spark, DUP_SNAP), state(spark, DUP_REG, DUP_BLD, []), params)
    assert (res.state.register.count(), res.state.building_link.count()) == expected
    for table, df in (("reg_after", res.state.register), ("bld_after", res.state.building_link)):
        got = _rows(df.columns, [tuple(r) for r in df.collect()])
        assert got == _oracle(DUP_SNAP, DUP_REG, DUP_BLD, [], params, f"SELECT * FROM {table}"), table
