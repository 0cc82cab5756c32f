"""Column expressions for the two time axes.

All timestamps are ``timestamp_ntz``: the register stores wall-clock values and
nothing here depends on the session time zone.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from chronoreg.model import HIGH_DATE, OPEN_CUTOFF, RECENT_HOURS, TS_FORMAT


def ts(value: str | datetime | None) -> Column:
    """A ``timestamp_ntz`` literal (NULL for ``None``)."""
    if isinstance(value, datetime):
        value = value.strftime(TS_FORMAT + ".%f")
    return F.lit(value).cast("timestamp_ntz")


def high_date() -> Column:
    return ts(HIGH_DATE)


def is_open(column: str | Column) -> Column:
    """A row is open while its system end is unknown or lies beyond the cutoff."""
    c = F.col(column) if isinstance(column, str) else column
    return c.isNull() | (c > ts(OPEN_CUTOFF))


def second_before(column: str | Column) -> Column:
    """``DATEADD(s, -1, x)``: the closing end of a row superseded at ``x``."""
    c = F.col(column) if isinstance(column, str) else column
    return c - F.expr("INTERVAL 1 SECOND")


def round_second(column: str | Column) -> Column:
    """Half-up rounding to whole seconds that keeps the NTZ type."""
    c = F.col(column) if isinstance(column, str) else column
    seconds = F.date_part(F.lit("SECOND"), c)
    fraction = seconds - F.floor(seconds)
    truncated = c - F.make_dt_interval(secs=fraction)
    return F.when(fraction >= 0.5, truncated + F.expr("INTERVAL 1 SECOND")).otherwise(truncated)


def same_second(column: str | Column, second: str | None) -> Column:
    """``round_second(column) = second`` written as a range the Parquet scan can prune on."""
    c = F.col(column) if isinstance(column, str) else column
    if second is None:
        return F.lit(False)
    centre = datetime.strptime(second, TS_FORMAT)
    lower = centre - timedelta(milliseconds=500)
    upper = centre + timedelta(milliseconds=500)
    return (c >= ts(lower)) & (c < ts(upper))


def hours_before(value: str, hours: int = RECENT_HOURS) -> str:
    """``DATEADD(HOUR, -hours, value)`` on a parameter."""
    return (datetime.strptime(value, TS_FORMAT) - timedelta(hours=hours)).strftime(TS_FORMAT)
