"""Inputs derived by Spark from the driver's ``orders`` table.

Every order becomes one dwelling and ``o_orderkey % 20`` picks which change case
it exercises (insert, delete, update, the relink kinds, the traps that must not
change anything, ...).  The derivation is a plain projection of ``orders``, so
the inputs grow with the table and every registered query works on all of it.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoreg.functions import high_date, ts
from chronoreg.model import (
    CHANGELOG_SCHEMA,
    DELETED,
    DWELLINGS,
    EFF_END,
    EFF_START,
    FLAG_LIVE,
    SYS_CREATE,
    SYS_END,
    TEST_PART_PREFIX,
    RunParams,
    Spec,
)
from chronoreg.sources.tables import State

# Batches and dates of the derived fixture.
CURRENT_BATCH = "2024-01-02 00:00:01"
STALE_BATCH = "2024-01-01 00:00:01"
REGISTER_BATCH = "2023-01-01 00:00:01"
SECOND_BATCH = "2023-02-01 00:00:01"
CLOSED_BEFORE = "2023-06-01 00:00:00"
BEFORE_CREATION = "2022-06-01 00:00:00"
FIXTURE_VERSION = 0.54
OTHER_VERSION = 0.1

FIXTURE_PARAMS = RunParams(version_no=FIXTURE_VERSION, run_ts="2024-09-09 13:44:00")


@dataclass(frozen=True)
class Inputs:
    interim: DataFrame
    state: State


def _case(m: Column, cases: dict, default: Column) -> Column:
    expr = None
    for values, value in cases.items():
        cond = m.isin(list(values)) if isinstance(values, tuple) else (m == values)
        expr = F.when(cond, value) if expr is None else expr.when(cond, value)
    return expr.otherwise(default)


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return orders.select(
        F.col("o_orderkey").alias("k"),
        (F.col("o_orderkey") % 20).alias("m"),
        F.col("o_custkey").alias("c"),
        F.col("o_orderdate").alias("es"),
        (F.col("o_orderdate") + F.expr("INTERVAL 365 DAYS")).alias("ee"),
    )


def derived_inputs(spark: SparkSession, sf_dir: str, spec: Spec = DWELLINGS, hard: bool = True) -> Inputs:
    """The inputs of one run.

    ``hard`` adds the rows of ``_hard_cases``; without them every key has one row per table, and a rerun of the same
    snapshot changes nothing.
    """
    base = _base(spark, sf_dir)
    easy = _easy_cases(base, spec)
    if not hard:
        return easy
    more = _hard_cases(base, spec)
    unlisted = (F.col(spec.entity) % 20 == 16) & (F.floor(F.col(spec.entity) / 20) % 8 == 4)
    register = easy.state.register.withColumn(spec.scenario, F.when(unlisted, F.lit(77)).otherwise(F.col(spec.scenario)))
    late = F.floor(F.col(spec.entity) / 20) % 8 == 6
    fraction = F.when(late, F.col(SYS_CREATE) + F.expr("INTERVAL 0.4 SECOND")).otherwise(F.col(SYS_CREATE))
    interim = easy.interim.withColumn(SYS_CREATE, fraction)
    return Inputs(interim=interim.unionByName(more.interim), state=State(
        register.unionByName(more.state.register), easy.state.building_link.unionByName(more.state.building_link),
        easy.state.part_link.unionByName(more.state.part_link)))


def _hard_cases(base: DataFrame, spec: Spec) -> Inputs:
    """Rows that no single-row key can exercise; the g-th eighth of a change case adds one kind.

    m = 3, g = 2: a second candidate of the key in another scenario.  m = 15, g = 7: a second open register row.
    m = 1, g = 6: a closed register row that ends before it was created.  m = 2, g = 1: a second building link, open
    by NULL, that equals what the update would write.  m = 19, g = 3: a second building link and, with a test id, an
    open part link beside it.  m = 16, g = 4: both kinds of link open where no candidate and no listed scenario is
    (the register row's scenario is unlisted there).  m = 17, g = 5: a second part link with a test id.  m = 13, g = 1
    and m = 14, g = 2: a closed building and a closed part link that end before they were created.
    """
    k, m, c = F.col("k"), F.col("m"), F.col("c")
    g = F.floor(k / 20) % 8
    at = lambda case, part: base.filter((m == case) & (g == part))
    temporal = lambda end, create=REGISTER_BATCH: (
        F.col("es").alias(EFF_START), high_date().alias(EFF_END), ts(create).alias(SYS_CREATE), end.alias(SYS_END),
        F.lit(FLAG_LIVE).alias(DELETED))
    test_part = F.concat(F.lit(TEST_PART_PREFIX), k.cast("string"))
    interim = at(3, 2).select(
        k.alias(spec.entity), ((k + 1) % 5).cast("int").alias(spec.scenario), F.lit(FIXTURE_VERSION).alias(spec.version),
        (c + 1).alias(spec.parent), F.lit(None).cast("string").alias(spec.sub_parent), *temporal(high_date(), CURRENT_BATCH))
    register = at(15, 7).select(k.alias(spec.entity), (k % 5).cast("int").alias(spec.scenario), *temporal(high_date(), SECOND_BATCH))
    register = register.unionByName(at(1, 6).select(
        k.alias(spec.entity), (k % 5).cast("int").alias(spec.scenario), *temporal(ts(BEFORE_CREATION))))
    building = at(2, 1).select(k.alias(spec.entity), c.alias(spec.parent), *temporal(ts(None))).unionByName(
        at(19, 3).select(k.alias(spec.entity), (c + 2).alias(spec.parent), *temporal(high_date()))).unionByName(
        at(13, 1).select(k.alias(spec.entity), (c + 3).alias(spec.parent), *temporal(ts(BEFORE_CREATION))))
    part = reduce(DataFrame.unionByName, [
        at(case, of).select(k.alias(spec.entity), test_part.alias(spec.sub_parent), *temporal(high_date()))
        for case, of in ((19, 3), (16, 4), (17, 5))])
    part = part.unionByName(at(14, 2).select(k.alias(spec.entity), test_part.alias(spec.sub_parent), *temporal(ts(BEFORE_CREATION))))
    return Inputs(interim=interim, state=State(register, building, part))


def older_batch(interim: DataFrame, spec: Spec = DWELLINGS, scenario: int = 1) -> DataFrame:
    """The snapshot with one scenario's rows in the older batch."""
    moved = F.when(F.col(spec.scenario) == scenario, ts(STALE_BATCH)).otherwise(F.col(SYS_CREATE))
    return interim.withColumn(SYS_CREATE, moved)


def mixed_case(inp: Inputs, spec: Spec = DWELLINGS) -> Inputs:
    """Part ids in capitals, in a third of the part links and in another third of the snapshot."""
    def capitals(df: DataFrame, third: int) -> DataFrame:
        part = F.col(spec.sub_parent)
        return df.withColumn(spec.sub_parent, F.when(F.col(spec.entity) % 3 == third, F.upper(part)).otherwise(part))

    return Inputs(capitals(inp.interim, 1), State(inp.state.register, inp.state.building_link, capitals(inp.state.part_link, 0)))


def older_log(spark: SparkSession, sf_dir: str, params: RunParams) -> DataFrame:
    """Change-log rows of earlier runs: one for each order of case 0, nought to four hours old."""
    hours = (F.floor(F.col("k") / 20) % 5).cast("int")
    values = {"change_date": ts(params.change_ts) - F.make_dt_interval(hours=hours), "table_name": F.lit(DWELLINGS.register_table),
              "process": F.lit(DWELLINGS.process), "records_added": F.lit(1), "total_records_after": F.col("k")}
    base = _base(spark, sf_dir).filter(F.col("m") == 0)
    return base.select(*[values.get(f.name, F.lit(0 if "records" in f.name else None)).cast(f.dataType).alias(f.name)
                         for f in CHANGELOG_SCHEMA.fields])


def _easy_cases(base: DataFrame, spec: Spec) -> Inputs:
    k, m, c = F.col("k"), F.col("m"), F.col("c")
    usual_scenario = (k % 5).cast("int")
    no_part = F.lit(None).cast("string")

    main = base.filter(m != 1).select(
        k.alias(spec.entity),
        _case(m, {13: F.lit(999), 4: F.lit(99), (11, 12): F.lit(5)}, usual_scenario)
        .cast("int").alias(spec.scenario),
        F.when(m == 16, F.lit(0.1)).otherwise(F.lit(FIXTURE_VERSION)).cast("double")
        .alias(spec.version),
        F.when(m == 10, c + 1).otherwise(c).alias(spec.parent),
        _case(m, {(8, 17): F.concat(F.lit("pob"), k.cast("string")),
                  9: F.concat(F.lit("new"), k.cast("string"))}, no_part).alias(spec.sub_parent),
        F.col("es").alias(EFF_START),
        _case(m, {2: F.col("ee"), 15: ts(None)}, high_date()).alias(EFF_END),
        ts(CURRENT_BATCH).alias(SYS_CREATE),
        high_date().alias(SYS_END),
        F.lit(FLAG_LIVE).alias(DELETED),
    )
    second_building = base.filter(m.isin(11, 12)).select(
        k.alias(spec.entity), F.lit(5).cast("int").alias(spec.scenario),
        F.lit(FIXTURE_VERSION).cast("double").alias(spec.version), (c + 1).alias(spec.parent),
        no_part.alias(spec.sub_parent), F.col("es").alias(EFF_START), high_date().alias(EFF_END),
        ts(CURRENT_BATCH).alias(SYS_CREATE), high_date().alias(SYS_END),
        F.lit(FLAG_LIVE).alias(DELETED),
    )
    stale_batch = base.filter(m == 18).select(
        k.alias(spec.entity), usual_scenario.alias(spec.scenario),
        F.lit(FIXTURE_VERSION).cast("double").alias(spec.version), c.alias(spec.parent),
        no_part.alias(spec.sub_parent), F.col("es").alias(EFF_START), F.col("ee").alias(EFF_END),
        ts(STALE_BATCH).alias(SYS_CREATE), high_date().alias(SYS_END),
        F.lit(FLAG_LIVE).alias(DELETED),
    )
    interim = main.unionByName(second_building).unionByName(stale_batch)

    registered = base.filter(~m.isin(0, 12)).select(
        "k", "m", "c",
        _case(m, {(3, 4): F.lit(99), 5: F.lit(77), 11: F.lit(5)}, usual_scenario)
        .cast("int").alias(spec.scenario),
        F.col("es").alias(EFF_START),
        high_date().alias(EFF_END),
        ts(REGISTER_BATCH).alias(SYS_CREATE),
        _case(m, {6: ts(CLOSED_BEFORE), 14: ts(None)}, high_date()).alias(SYS_END),
        F.lit(FLAG_LIVE).alias(DELETED),
    )
    temporal = [EFF_START, EFF_END, SYS_CREATE, SYS_END, DELETED]
    register = registered.select(k.alias(spec.entity), spec.scenario, *temporal)
    part_cases = m.isin(1, 7, 9, 17)
    building_link = registered.filter(~part_cases).select(
        k.alias(spec.entity), F.when(m == 11, F.lit(0).cast("long")).otherwise(c).alias(spec.parent),
        *temporal)
    part_link = registered.filter(part_cases).select(
        k.alias(spec.entity), F.concat(F.lit("pob"), k.cast("string")).alias(spec.sub_parent),
        *temporal)
    return Inputs(interim=interim, state=State(register, building_link, part_link))


# --- Golden scenario ------------------------------------------------------------
# The documented two-step manual test, with the interim rows reconstructed
# from its expected output.  Used by the unit tests only.
B1 = "2023-07-24 21:46:59"
B2 = "2023-07-30 12:53:01"
GOLDEN_NOW = "2024-09-09 13:44:00"
_HI, _S0, _E0, _S1 = "9999-01-01 00:00:00", "1900-05-15 00:00:00", "2021-03-12 00:00:00", "2021-03-12 00:00:01"
_E1, _S2, _E2, _S3 = "2023-04-17 00:00:00", "2023-04-17 00:00:01", "2024-08-07 00:00:00", "2024-08-07 00:00:01"
PART_P, PART_Q = "tst99999999999999test", "tst99999999999990test"

# (name, dwelling_id, scenario, building, part, start, end, batch)
GOLDEN_ROWS = [
    ("A", 0, 0, 0, None, _S0, _HI, B1),
    ("B", 0, 99, 0, None, _S1, _E1, B1),
    ("C", 99998888, 0, 0, PART_P, _S0, _E0, B1),
    ("D", 99998888, 0, 0, None, _S1, _E1, B1),
    ("E", 99999999, 0, 999999999, None, _S0, _HI, B1),
    ("A2", 0, 0, 0, None, _S0, _E0, B2),
    ("B2r", 0, 0, 0, None, _S1, _E1, B2),
    ("F", 0, 99, 0, None, _S2, _HI, B2),
    ("G", 98765432, 99, 0, None, _S2, _E2, B2),
    ("H", 98765432, 0, 998765432, None, _S3, _HI, B2),
    ("C2", 99998888, 0, 0, None, _S0, _E0, B2),
    ("D2", 99998888, 0, 0, PART_Q, _S1, _E1, B2),
    ("I", 99998888, 0, 0, PART_P, _S2, _HI, B2),
]


def golden_interim(spark: SparkSession, spec: Spec = DWELLINGS) -> DataFrame:
    rows = [(d, s, 0.0, b, p, st, en, bt, _HI, FLAG_LIVE) for _, d, s, b, p, st, en, bt in GOLDEN_ROWS]
    df = spark.createDataFrame(
        rows, f"{spec.entity} long, {spec.scenario} int, {spec.version} double, {spec.parent} long, "
              f"{spec.sub_parent} string, {EFF_START} string, {EFF_END} string, {SYS_CREATE} string, "
              f"{SYS_END} string, {DELETED} string")
    for name in (EFF_START, EFF_END, SYS_CREATE, SYS_END):
        df = df.withColumn(name, F.col(name).cast("timestamp_ntz"))
    return df
