"""State tables in Spark's own catalog, bucketed on the business key (S2-S4 beside J1-J5).

A bucket holds the rows of some keys, sorted by key, so a join on the key reads a bucketed table where it lies: only the
snapshot's side is shuffled, into as many partitions as there are buckets.  That holds where the number of buckets is
``spark.sql.shuffle.partitions`` (of two sides with different numbers Spark keeps the larger one).  For the register's own
update, whose key has the system create date as well, set ``spark.sql.requireAllClusterKeysForCoPartition`` to false.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoreg.model import DWELLINGS, Spec, parent_link_schema, register_schema, sub_parent_link_schema
from chronoreg.sources.tables import SchemaError, State

TABLES = {"register": register_schema, "building_link": parent_link_schema, "part_link": sub_parent_link_schema}


def save_bucketed(state: State, prefix: str, folder: str, spec: Spec = DWELLINGS, buckets: int | None = None) -> None:
    """Write a state as the tables ``<prefix>_<name>``, their files under ``folder``.

    Rows go to the task of their bucket first, so each bucket is one file.  A key held by very many rows makes its bucket
    large; readers that join it can't be split there by AQE, as a bucket is one partition: leave such a table unbucketed.
    """
    keys = list(spec.keys)
    for name, df in state.tables().items():
        number = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        (df.repartition(number, *keys).write.format("parquet").option("path", f"{folder}/{name}")
         .bucketBy(number, *keys).sortBy(*keys).mode("errorifexists").saveAsTable(f"{prefix}_{name}"))


def read_bucketed(spark: SparkSession, prefix: str, spec: Spec = DWELLINGS) -> State:
    """The state of the tables ``<prefix>_<name>``.

    Columns must have their declared types already: a cast of a key would hide the buckets from a join.
    """
    return State(**{name: _checked(spark.table(f"{prefix}_{name}"), prefix, name, spec) for name in TABLES})


def _checked(df: DataFrame, prefix: str, name: str, spec: Spec) -> DataFrame:
    stored = {f.name: f.dataType for f in df.schema.fields}
    wrong = [f.name for f in TABLES[name](spec).fields if stored.get(f.name) != f.dataType]
    if wrong:
        raise SchemaError(f"{prefix}_{name}: missing column(s) or other type: {wrong}")
    return df.select(*[F.col(f.name) for f in TABLES[name](spec).fields])


def drop_bucketed(spark: SparkSession, prefix: str) -> None:
    """Forget the tables; their files stay, as the catalog does not own them."""
    for name in TABLES:
        spark.sql(f"DROP TABLE IF EXISTS {prefix}_{name}")
