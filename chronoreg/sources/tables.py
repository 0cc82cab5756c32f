"""Readers for the interim snapshot and the three state tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoreg.functions import is_open
from chronoreg.model import (
    DWELLINGS,
    SYS_END,
    Spec,
    interim_schema,
    parent_link_schema,
    register_schema,
    sub_parent_link_schema,
)


@dataclass(frozen=True)
class State:
    """The three bitemporal tables, each a whole table (open and closed rows)."""

    register: DataFrame
    building_link: DataFrame
    part_link: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {"register": self.register, "building_link": self.building_link,
                "part_link": self.part_link}


class SchemaError(ValueError):
    """A stored table lacks a declared column."""


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read Parquet and check it against the declared schema.

    Missing columns fail at once (the check reads file footers only).  Every column is
    cast to its declared type; where the stored type already matches, Catalyst drops
    the cast, so pushdown and pruning are unaffected.  Extra stored columns are ignored.
    """
    df = spark.read.parquet(path)
    stored = {f.name: f.dataType for f in df.schema.fields}
    missing = [f.name for f in schema.fields if f.name not in stored]
    if missing:
        raise SchemaError(f"{path}: missing column(s) {missing}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_interim(spark: SparkSession, path: str, spec: Spec = DWELLINGS) -> DataFrame:
    """The full snapshot, checked against its declared schema (no inference)."""
    return read_table(spark, path, interim_schema(spec))


def read_state(spark: SparkSession, register_path: str, building_path: str, part_path: str,
               spec: Spec = DWELLINGS) -> State:
    """The state tables from plain Parquet directories."""
    return State(
        register=read_table(spark, register_path, register_schema(spec)),
        building_link=read_table(spark, building_path, parent_link_schema(spec)),
        part_link=read_table(spark, part_path, sub_parent_link_schema(spec)),
    )


def collated(df: DataFrame, spec: Spec = DWELLINGS) -> DataFrame:
    """The frame with its part ids in the spec's collation: what compares, joins, groups or matches them follows it."""
    if spec.collation is None or spec.sub_parent not in df.columns:
        return df
    return df.withColumn(spec.sub_parent, F.collate(spec.sub_parent, spec.collation))


def collated_state(state: State, spec: Spec = DWELLINGS) -> State:
    return State(**{name: collated(df, spec) for name, df in state.tables().items()})


def open_rows(df: DataFrame) -> DataFrame:
    """Rows still open on the system axis (pushed down to the scan)."""
    return df.filter(is_open(SYS_END))


def empty_state(spark: SparkSession, spec: Spec = DWELLINGS) -> State:
    return State(
        register=spark.createDataFrame([], register_schema(spec)),
        building_link=spark.createDataFrame([], parent_link_schema(spec)),
        part_link=spark.createDataFrame([], sub_parent_link_schema(spec)),
    )
