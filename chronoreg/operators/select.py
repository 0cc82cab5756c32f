"""Run parameters resolved against the snapshot (P1-P5) and candidate selection."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoreg.functions import high_date, round_second, same_second, ts
from chronoreg.model import (
    AMBIGUOUS_BUILDING_ID,
    DELETED,
    DWELLINGS,
    EFF_END,
    EFF_START,
    FLAG_LIVE,
    SYS_CREATE,
    SYS_END,
    TS_FORMAT,
    RunParams,
    Spec,
)


@dataclass(frozen=True)
class ScenarioSet:
    """The scenarios of a run.

    ``frame`` holds one row per scenario: ``id``, ``batch`` (the chosen batch, to the second; NULL when the run takes
    every batch) and ``present`` (the scenario has rows in that batch).  An explicit list is also kept as literals
    (``ids``), so it becomes an ``IN`` filter inside the Parquet scan; an automatic list is applied as a semi join
    whose strategy follows from its measured size.
    """

    ids: tuple[int, ...] | None = None
    frame: DataFrame | None = None
    since: str | None = None  # no chosen batch is earlier

    def keep(self, df: DataFrame, column: str) -> DataFrame:
        """Rows whose ``column`` is listed."""
        if self.ids is not None:
            return df.filter(F.col(column).isin(list(self.ids)))
        return df.join(self.frame.select(F.col("id").alias(column)), column, "left_semi")

    def keep_present(self, df: DataFrame, column: str) -> DataFrame:
        """Rows whose ``column`` is listed and has rows in its batch."""
        return df.join(self.frame.filter("present").select(F.col("id").alias(column)), column, "left_semi")


def version_rows(interim: DataFrame, params: RunParams, spec: Spec = DWELLINGS) -> DataFrame:
    """P5: exact equality on the version number (double precision)."""
    return interim.filter(F.col(spec.version) == F.lit(float(params.version_no)))


def auto_scenarios(interim: DataFrame, params: RunParams, spec: Spec = DWELLINGS) -> DataFrame:
    """Distinct scenarios of the version, without the excluded ones (NULL drops out)."""
    rows = version_rows(interim, params, spec)
    return (rows.filter(~F.col(spec.scenario).isin(list(params.excluded_scenarios)))
            .select(F.col(spec.scenario).alias("id")).distinct())


def _listed_rows(interim: DataFrame, params: RunParams, spec: Spec) -> DataFrame:
    """The version's rows of the explicit (P1) or automatic (P2) scenarios."""
    rows = version_rows(interim, params, spec)
    if params.scenarios:
        return rows.filter(F.col(spec.scenario).isin(list(params.scenarios)))
    return rows.filter(~F.col(spec.scenario).isin(list(params.excluded_scenarios)))


def latest_batch(interim: DataFrame, params: RunParams, spec: Spec = DWELLINGS) -> DataFrame:
    """P3 as a one-row frame: the latest system create date of all listed scenarios, to the second."""
    latest = _listed_rows(interim, params, spec).agg(F.max(SYS_CREATE).alias("latest"))
    return latest.select(round_second("latest").alias("batch_ts"))


def resolve(interim: DataFrame, params: RunParams, spec: Spec = DWELLINGS, stage=None) -> ScenarioSet:
    """The scenarios with the batch that each of them takes.

    Without an explicit batch that is each scenario's own latest one: a scenario whose newest snapshot is older than
    another's keeps its rows.  With an explicit batch, a scenario without rows in it is not ``present``: its register
    rows are not deletes, for the batch says nothing about them.  One partial aggregate per scenario; the driver
    receives the earliest chosen batch only, as a literal that the scan prunes on.
    """
    listed = _listed_rows(interim, params, spec)
    held = F.lit(True) if params.batch_ts is None else F.coalesce(F.max(same_second(SYS_CREATE, params.batch_ts)), F.lit(False))
    per = listed.groupBy(F.col(spec.scenario).alias("id")).agg(F.max(SYS_CREATE).alias("latest"), held.alias("present"))
    if params.scenarios:
        ids = interim.sparkSession.createDataFrame([(i,) for i in params.scenarios], "id int").distinct()
        per = ids.join(per, "id", "left")
    if not params.batch_filter:
        batch, present = ts(None), F.lit(True)
    elif params.batch_ts is not None:
        batch, present = ts(params.batch_ts), F.coalesce(F.col("present"), F.lit(False))
    else:
        batch, present = round_second("latest"), F.lit(True)
    frame = per.select("id", batch.alias("batch"), present.alias("present"))
    frame = stage(frame, "scenarios") if stage else frame
    since = params.batch_ts
    if params.batch_filter and since is None:
        earliest = frame.agg(F.min("batch").alias("batch")).first()["batch"]
        since = earliest.strftime(TS_FORMAT) if earliest else None
    return ScenarioSet(ids=tuple(params.scenarios) or None, frame=frame, since=since)


def _selected(interim: DataFrame, scenarios: ScenarioSet, params: RunParams, spec: Spec) -> DataFrame:
    """The listed scenarios' rows of the batches that they take."""
    rows = scenarios.keep(version_rows(interim, params, spec), spec.scenario)
    if not params.batch_filter:
        return rows
    if params.batch_ts is not None:
        return rows.filter(same_second(SYS_CREATE, params.batch_ts))
    if scenarios.since is None:
        return rows.filter(F.lit(False))
    half = F.expr("INTERVAL 0.5 SECOND")
    recent = rows.filter(F.col(SYS_CREATE) >= ts(scenarios.since) - half)
    chosen = scenarios.frame.select(F.col("id").alias(spec.scenario), F.col("batch").alias("_batch"))
    near = (F.col(SYS_CREATE) >= F.col("_batch") - half) & (F.col(SYS_CREATE) < F.col("_batch") + half)
    return recent.join(chosen, spec.scenario).filter(near).select(*interim.columns)


def _distinct(rows: DataFrame, spec: Spec) -> DataFrame:
    """UNION's duplicate removal.  Of rows that differ only in how a part id is written, the least spelling stays."""
    if spec.collation is None:
        return rows.distinct()
    spelling = F.min(F.collate(spec.sub_parent, "UTF8_BINARY")).alias("_spelling")
    least = rows.groupBy(*rows.columns).agg(spelling)
    return least.withColumn(spec.sub_parent, F.collate("_spelling", spec.collation)).select(*rows.columns)


def _ambiguous(params: RunParams, spec: Spec) -> Column:
    return F.col(spec.scenario).isin(list(params.ambiguous_scenarios))


def candidates_main(interim: DataFrame, scenarios: ScenarioSet, params: RunParams, spec: Spec = DWELLINGS) -> DataFrame:
    """Listed, non-ambiguous scenarios; system end forced open, flag forced live."""
    rows = _selected(interim, scenarios, params, spec).filter(~_ambiguous(params, spec))
    return rows.select(
        spec.entity, spec.scenario, spec.version, spec.parent, spec.sub_parent,
        EFF_START, EFF_END, SYS_CREATE, high_date().alias(SYS_END), F.lit(FLAG_LIVE).alias(DELETED))


def candidates_ambiguous(interim: DataFrame, scenarios: ScenarioSet, params: RunParams, spec: Spec = DWELLINGS) -> DataFrame:
    """Ambiguous scenarios collapse to building 0, one row per remaining value set.

    The row keeps the snapshot's own system end date.  ``distinct`` runs as a partial
    aggregate before the shuffle, so many copies of one row cost one row per task.
    """
    rows = _selected(interim, scenarios, params, spec).filter(_ambiguous(params, spec))
    # The grouping includes the snapshot's own flag, which the output then replaces: two
    # rows that differ only in that flag stay two (the UNION in C3 merges them).
    grouped = rows.select(
        spec.entity, spec.scenario, spec.version, spec.sub_parent, EFF_START, EFF_END, SYS_CREATE,
        SYS_END, F.col(DELETED).alias("_source_flag")).transform(_distinct, spec)
    return grouped.select(
        spec.entity, spec.scenario, spec.version,
        F.lit(AMBIGUOUS_BUILDING_ID).cast("long").alias(spec.parent), spec.sub_parent,
        EFF_START, EFF_END, SYS_CREATE, SYS_END, F.lit(FLAG_LIVE).alias(DELETED))


def candidates(interim: DataFrame, scenarios: ScenarioSet, params: RunParams, spec: Spec = DWELLINGS) -> DataFrame:
    """The distinct union of C1 and C2, in one scan of the snapshot.

    Both branches read the same filtered rows; the ambiguous override is a ``CASE`` on
    the scenario, and one ``distinct`` (partial + final aggregate) gives the UNION's
    duplicate removal, NULLs comparing equal.
    """
    rows = _selected(interim, scenarios, params, spec)
    amb = _ambiguous(params, spec)
    return rows.select(
        spec.entity, spec.scenario, spec.version,
        F.when(amb, F.lit(AMBIGUOUS_BUILDING_ID).cast("long")).otherwise(F.col(spec.parent))
        .alias(spec.parent),
        spec.sub_parent, EFF_START, EFF_END, SYS_CREATE,
        F.when(amb, F.col(SYS_END)).otherwise(high_date()).alias(SYS_END),
        F.lit(FLAG_LIVE).alias(DELETED)).transform(_distinct, spec)
