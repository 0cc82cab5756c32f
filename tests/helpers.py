"""Small hand-made inputs for the unit tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoreg.model import (
    interim_schema,
    parent_link_schema,
    register_schema,
    sub_parent_link_schema,
)
from chronoreg.sources.tables import State

HI = "9999-01-01 00:00:00"
TS_COLS = ("effective_start_date", "effective_end_date", "sys_create_date", "sys_end_date")


def frame(spark: SparkSession, rows, schema) -> DataFrame:
    as_text = [tuple(rows_i) for rows_i in rows]
    fields = [f"{f.name} string" if f.name in TS_COLS else f"{f.name} {f.dataType.simpleString()}"
              for f in schema.fields]
    df = spark.createDataFrame(as_text, ", ".join(fields))
    for c in TS_COLS:
        if c in df.columns:
            df = df.withColumn(c, F.col(c).cast("timestamp_ntz"))
    return df


def interim(spark, rows):
    """rows: (id, scenario, version, building, part, start, end, create[, sys_end, flag])"""
    full = [r if len(r) == 10 else (*r, HI, "N") for r in rows]
    return frame(spark, full, interim_schema())


def state(spark, register=(), building=(), part=()):
    def fill(rows):
        return [r if len(r) == 7 else (*r, HI, "N") for r in rows]
    return State(frame(spark, fill(register), register_schema()),
                 frame(spark, fill(building), parent_link_schema()),
                 frame(spark, fill(part), sub_parent_link_schema()))


def rows(df: DataFrame) -> set[tuple]:
    out = set()
    for r in df.collect():
        out.add(tuple(v.strftime("%Y-%m-%d %H:%M:%S") if hasattr(v, "strftime") else v for v in r))
    return out


def materialise(spark, st: State) -> State:
    return State(*[spark.createDataFrame(df.collect(), df.schema)
                   for df in (st.register, st.building_link, st.part_link)])
