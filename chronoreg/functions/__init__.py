"""Column-level helpers (pure ``pyspark.sql.functions`` expressions, no UDFs)."""

from chronoreg.functions.temporal import (
    high_date,
    hours_before,
    is_open,
    round_second,
    same_second,
    second_before,
    ts,
)

__all__ = ["high_date", "hours_before", "is_open", "round_second", "same_second",
           "second_before", "ts"]
