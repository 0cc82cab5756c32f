"""Tables after a run as balances: what was there, less the named rows as they were, plus these as they are, plus new ones.

A run names few rows of a table (``TableUpdate.named``, staged), so every count of the table after the run follows from
one scan of the table before it and the staged rows; no closing is joined again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoreg.functions import is_open, ts
from chronoreg.model import DWELLINGS, SYS_CREATE, SYS_END, Spec
from chronoreg.operators.apply import WAS_END, Applied, TableUpdate
from chronoreg.sources.tables import State

SIGN = "_sign"
BEFORE = "_before"  # the row counts for the table before the run
MARKS = ("register", "building_link", "part_link")
VIOLATIONS = ("exclusive_links", "open_unique", "max_open_per_key", *(f"intervals_{m}" for m in MARKS))


def balance(before: DataFrame, update: TableUpdate | None, columns: list[str]) -> DataFrame:
    """``columns`` (none of them a set column but the system end) with ``_sign`` and ``_before``."""
    def part(df: DataFrame, sign: int, was: bool = False, end: str = SYS_END) -> DataFrame:
        return df.select(*[F.col(end).alias(c) if c == SYS_END else F.col(c) for c in columns],
                         F.lit(sign).alias(SIGN), F.lit(was).alias(BEFORE))

    parts = [part(before, 1, True)]
    if update is not None:
        parts += [part(update.named, -1, end=WAS_END), part(update.named, 1), part(update.inserted, 1)]
    return reduce(DataFrame.unionByName, parts)


def _signed(condition: Column) -> Column:
    return F.when(condition, F.col(SIGN)).otherwise(0).cast("long")


def totals(before: DataFrame, update: TableUpdate, end: str | None) -> DataFrame:
    """One row (total, retired): the table's open rows after the run, and its rows whose system end is ``end``."""
    rows = balance(before, update, [SYS_END])
    return rows.agg(F.coalesce(F.sum(_signed(is_open(SYS_END))), F.lit(0)).alias("total"),
                    F.coalesce(F.sum(_signed(F.col(SYS_END) == ts(end))), F.lit(0)).alias("retired"))


def by_sys_end(before: DataFrame, update: TableUpdate) -> DataFrame:
    """(stage, sys_end_date, n): the table's rows per system end date before and after the run, in one scan."""
    sums = balance(before, update, [SYS_END]).groupBy(SYS_END).agg(
        F.sum(F.when(F.col(BEFORE), 1).otherwise(0)).alias("before"), F.sum(F.col(SIGN).cast("long")).alias("after"))
    both = F.array(*[F.struct(F.lit(s).alias("stage"), F.col(s).cast("long").alias("n")) for s in ("before", "after")])
    return sums.select(SYS_END, F.explode(both).alias("x")).select("x.stage", SYS_END, "x.n").filter("n > 0")


def tally(before: State, applied: Applied | None, end: str | None = None, spec: Spec = DWELLINGS) -> DataFrame:
    """K1, K3 and K5, and the open and retired rows of every table, in one row.

    Every row of a table becomes flags of its key: open, retired (its system end is ``end``), closed before it was
    created.  One aggregate by key adds them up over all tables (combined map-side, one exchange of keys); rows without
    any flag don't enter it.  Without ``applied`` the tables are counted as they are.
    """
    keys = list(spec.keys)
    flags = {"open": is_open(SYS_END), "retired": F.coalesce(F.col(SYS_END) == ts(end), F.lit(False)),
             "intervals": ~is_open(SYS_END) & (F.col(SYS_END) < F.col(SYS_CREATE))}
    parts = []
    for mark, df in before.tables().items():
        rows = balance(df, getattr(applied, mark) if applied else None, [*keys, SYS_CREATE, SYS_END])
        rows = rows.filter(reduce(Column.__or__, flags.values()))
        parts.append(rows.select(*keys, *[(_signed(flag) if m == mark else F.lit(0).cast("long")).alias(f"{name}_{m}")
                                          for m in MARKS for name, flag in flags.items()]))
    counts = [f"{name}_{m}" for m in MARKS for name in flags]
    per_key = reduce(DataFrame.unionByName, parts).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in counts])
    known = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    shared = F.when(known & (F.col("open_part_link") > 0), F.col("open_building_link")).otherwise(0)
    sums = [F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in counts]
    return per_key.agg(F.coalesce(F.sum(shared), F.lit(0)).cast("long").alias("exclusive_links"),
                       F.count(F.when(F.col("open_register") > 1, 1)).alias("open_unique"),
                       F.coalesce(F.max("open_register"), F.lit(0)).cast("long").alias("max_open_per_key"), *sums)
