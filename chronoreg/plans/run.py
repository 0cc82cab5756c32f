"""One whole run: parameters -> candidates -> change set -> apply -> change log.

Each staging relation -
scenarios, candidates, the classification, relinks and the rows of each table that the
run names - is written once to the session's checkpoint folder and read back, instead of
being recomputed by every output that reads it.  That also cuts the
lineage, so a lost executor never re-reads a table a publish may since have replaced,
and keeps every later plan small.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from chronoreg.model import DWELLINGS, RunParams, Spec
from chronoreg.operators.apply import Applied, TableUpdate, update_links, update_register
from chronoreg.operators.diff import (
    Changes,
    classify,
    closing_rows,
    find_relinks,
    opening_rows,
    touched_keys,
)
from chronoreg.operators.digest import Digests, unequal_links, unequal_register, within
from chronoreg.operators.balance import MARKS, tally
from chronoreg.operators.report import change_metrics, changelog, relink_metrics, retired_end
from chronoreg.operators.select import ScenarioSet, candidates, resolve
from chronoreg.sources.tables import State, collated, collated_state, open_rows

Stage = Callable[..., DataFrame]  # of a frame, its name and what to observe of it


def staging_root(spark: SparkSession) -> str:
    """Where staged relations go: the session's checkpoint folder.

    Only a local session that names none (tests) takes its warehouse folder instead.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = spark.conf.get("spark.sql.warehouse.dir")
    return folder.rstrip("/")


class ParquetStage:
    """Materialise a staging relation once as Parquet under the staging root.

    Each run writes to its own folder, so a retried task or a lost executor only
    re-reads finished files, and later plans start from a small leaf with real
    statistics (AQE sizes joins from them) instead of the whole upstream plan.
    """

    def __init__(self, spark: SparkSession, root: str | None = None) -> None:
        self.spark = spark
        self.folder = f"{root or staging_root(spark)}/run-{uuid.uuid4().hex}"
        self.observed: dict[str, dict] = {}  # metrics by the staged relation's name
        self._files().deleteOnExit(self._path())

    def _path(self):
        return self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)

    def _files(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def __call__(self, df: DataFrame, name: str, metrics: dict[str, Column] | None = None) -> DataFrame:
        """``metrics`` are counted by the tasks that write: each finished task counts once, also where others are lost."""
        path = f"{self.folder}/{name}"
        counting = Observation() if metrics else None
        if counting:
            df = df.observe(counting, *[c.alias(n) for n, c in metrics.items()])
        df.write.mode("errorifexists").parquet(path)
        if counting:
            self.observed[name] = counting.get
        return self.spark.read.parquet(path)

    def drop(self) -> bool:
        """Delete this run's staging folder (the temporary tables' clean-up).

        Call it only when nothing will read the staged frames again; what is not dropped goes when the application ends.
        """
        return bool(self._files().delete(self._path(), True))


@dataclass(frozen=True)
class Selection:
    scenarios: ScenarioSet
    candidates: DataFrame


def select(interim: DataFrame, params: RunParams, spec: Spec = DWELLINGS,
           stage: Stage | None = None) -> Selection:
    stage = stage or ParquetStage(interim.sparkSession)
    scen = resolve(interim, params, spec, stage)
    return Selection(scen, stage(candidates(interim, scen, params, spec), "candidates", {"candidates": F.count(F.lit(1))}))


class Run:
    """One run of a snapshot against the tables as they are; each part is computed (and staged) when first asked for."""

    def __init__(self, interim: DataFrame, before: State, params: RunParams, spec: Spec = DWELLINGS,
                 stage: Stage | None = None, base_version: int | None = None, digests: Digests | None = None,
                 colocated: bool = False) -> None:
        self.interim, self.before, self.params, self.spec = collated(interim, spec), collated_state(before, spec), params, spec
        self.stage = stage or ParquetStage(interim.sparkSession)
        self.base_version = base_version  # the store's version that ``before`` is
        self.digests = digests  # of ``before``; with them only the keys of unequal leaves are joined
        self.colocated = colocated  # ``before`` is bucketed on the business key

    @cached_property
    def selection(self) -> Selection:
        return select(self.interim, self.params, self.spec, self.stage)

    @cached_property
    def unequal_register(self) -> DataFrame:
        """The leaves of the digest tree in which the snapshot and the register differ."""
        sel = self.selection
        return self.stage(unequal_register(sel.candidates, sel.scenarios, self.digests, self.spec), "unequal_register")

    @cached_property
    def unequal_links(self) -> DataFrame:
        return self.stage(unequal_links(self.selection.candidates, self.digests, self.spec), "unequal_links")

    def _within(self, leaves: DataFrame, *frames: DataFrame) -> list[DataFrame]:
        return [within(df, leaves, self.digests, self.spec) for df in frames]

    @cached_property
    def classified(self) -> DataFrame:
        sel = self.selection
        register, cands = self.before.register, sel.candidates
        if self.digests:
            register, cands = self._within(self.unequal_register, open_rows(register), cands)
        return self.stage(classify(register, cands, sel.scenarios, self.params, self.spec), "classified", change_metrics(self.spec))

    @cached_property
    def deletes(self) -> DataFrame:
        return closing_rows(self.classified, self.params, self.spec)

    @cached_property
    def inserts(self) -> DataFrame:
        return opening_rows(self.classified, self.spec)

    @cached_property
    def relinks(self) -> DataFrame:
        cands, building, part = self.selection.candidates, self.before.building_link, self.before.part_link
        if self.digests:
            cands, building, part = self._within(self.unequal_links, cands, open_rows(building), open_rows(part))
        return self.stage(find_relinks(cands, building, part, touched_keys(self.classified, self.spec), self.spec, self.colocated), "relinks",
                          relink_metrics(self.spec))

    @cached_property
    def changes(self) -> Changes:
        return Changes(self.selection.candidates, self.deletes, self.inserts, self.relinks)

    @cached_property
    def register(self) -> TableUpdate:
        return update_register(self.before.register, self.deletes, self.inserts, self.params, self.spec, self.stage)

    @cached_property
    def building_link(self) -> TableUpdate:
        return update_links(self.before.building_link, self.changes, True, self.params, self.spec, self.stage)

    @cached_property
    def part_link(self) -> TableUpdate:
        return update_links(self.before.part_link, self.changes, False, self.params, self.spec, self.stage)

    @cached_property
    def applied(self) -> Applied:
        return Applied(self.register, self.building_link, self.part_link)

    @cached_property
    def counted(self) -> dict:
        """What was observed while the candidates, the classification and the relinks were written."""
        _ = self.selection, self.classified, self.relinks
        return {k: v for name in ("candidates", "classified", "relinks") for k, v in self.stage.observed[name].items()}

    @cached_property
    def retired_end(self) -> str | None:
        return retired_end(self.counted, self.params)

    @property
    def changelog(self) -> DataFrame:
        return self.log_of(*MARKS)

    def log_of(self, *tables: str) -> DataFrame:
        """The change log of some tables; the others are not read."""
        return changelog(self.before, self.applied, self.counted, self.params, self.spec, tables)

    @cached_property
    def tally(self) -> dict:
        """Change-log totals and integrity checks of all tables after the run, in one pass over the tables before it."""
        return tally(self.before, self.applied, self.retired_end, self.spec).first().asDict()

    @property
    def state(self) -> State:
        return self.applied.state


def run(interim: DataFrame, state: State, params: RunParams, spec: Spec = DWELLINGS,
        stage: Stage | None = None, base_version: int | None = None, digests: Digests | None = None,
        colocated: bool = False) -> Run:
    return Run(interim, state, params, spec, stage, base_version, digests, colocated)
