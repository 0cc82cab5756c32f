"""The change log as a table of its own, one folder a day (S9, S10, L4): recent rows are read without the older days."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoreg.functions import hours_before
from chronoreg.model import CHANGELOG_SCHEMA, RECENT_HOURS, TS_FORMAT
from chronoreg.operators.report import recent_changes

DAY = "change_day"
#: Rows without a date are in Spark's default partition; they are younger than nothing.


def append_log(log: DataFrame, path: str) -> None:
    """Add rows to the log's day folders; a failed write leaves none of them."""
    days = log.select(*CHANGELOG_SCHEMA.fieldNames()).withColumn(DAY, F.to_date("change_date"))
    # A day's rows of one run are few; rows of many days go to the task of their day, so that a day is not many files.
    days.repartition(DAY).write.mode("append").partitionBy(DAY).parquet(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Every row of the log, with its day."""
    return spark.read.schema(T.StructType([*CHANGELOG_SCHEMA.fields, T.StructField(DAY, T.DateType())])).parquet(path)


def recent_log(spark: SparkSession, path: str, now: str, hours: int = RECENT_HOURS) -> DataFrame:
    """L4: the rows younger than ``hours`` at ``now``; days that end before are not listed for reading."""
    first = datetime.strptime(hours_before(now, hours), TS_FORMAT).date()
    days = read_log(spark, path).filter(F.col(DAY) >= F.lit(first))
    return recent_changes(days, now, hours).select(*CHANGELOG_SCHEMA.fieldNames())
