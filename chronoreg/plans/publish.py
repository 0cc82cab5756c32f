"""All-or-nothing publish of a run (A12, A13) as Parquet folders.

Layout under one root (any Hadoop-compatible path the cluster shares)::

    <table>/v=<n>/attempt=<id>/is_open=true/    the whole open set after run n
    <table>/v=<n>/attempt=<id>/is_open=false/   rows run n closed (or inserted already closed)
    changelog/v=<n>/attempt=<id>/               the change-log rows of run n
    _commits/v=<n>/                             one commit record, written last and never replaced

Version ``n`` of a table is its open rows of ``v = n`` plus the closed rows of the committed attempts from its base
to ``n``; reads prune on the partition columns.  A store is created with an empty version 0.  Every attempt writes
folders of its own, so a failed one, or one that loses the race for a version, leaves nothing that a reader sees.  A
run is published only on the version that it was built on.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoreg.functions import hours_before, is_open, ts
from chronoreg.model import (
    CHANGELOG_SCHEMA,
    DWELLINGS,
    RECENT_HOURS,
    SYS_END,
    RunParams,
    Spec,
    parent_link_schema,
    register_schema,
    sub_parent_link_schema,
)
from chronoreg.operators import checks, report
from chronoreg.operators.balance import tally
from chronoreg.plans.run import ParquetStage, Run, run
from chronoreg.sources.tables import State

TABLES = ("register", "building_link", "part_link")
OPEN_FLAG = "is_open"
VERSION = "v"
ATTEMPT = "attempt"


@dataclass(frozen=True)
class PublishReport:
    mode: str
    version: int | None  # version written (commit) or that would be written (dry run)
    changelog: list[dict]
    violations: dict[str, int]
    counts: list[dict] = field(default_factory=list)  # G1-G4


class PublishError(RuntimeError):
    """Validation failed or the store has moved on; nothing was committed."""


class StoreError(RuntimeError):
    """The folder holds tables but no commit records."""


class RegisterStore:
    def __init__(self, spark: SparkSession, root: str, spec: Spec = DWELLINGS) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.spec = spec
        self.schemas = {"register": register_schema(spec), "building_link": parent_link_schema(spec),
                        "part_link": sub_parent_link_schema(spec), "changelog": CHANGELOG_SCHEMA}

    # --- reading ---------------------------------------------------------------------

    def _exists(self, name: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return bool(path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path))

    def _commits(self) -> DataFrame | None:
        """The commit records; None for a store that does not exist yet.  Any other failure to read them raises."""
        if self._exists("_commits"):
            return self.spark.read.parquet(f"{self.root}/_commits")
        if any(self._exists(name) for name in self.schemas):
            raise StoreError(f"{self.root} holds tables but no commit records")
        return None

    def _record(self, version: int | None = None):
        """The commit record of a version (the latest by default)."""
        commits = self._commits()
        if commits is None:
            return None
        if version is not None:
            commits = commits.filter(F.col(VERSION) == version)
        row = commits.orderBy(F.desc(VERSION)).first()
        if row is None:
            raise StoreError(f"{self.root} has no version {version}")
        return row

    def current_version(self) -> int | None:
        """The latest committed version; None before the first commit."""
        record = self._record()
        return record[VERSION] if record and record[VERSION] else None

    def _read(self, name: str, path: str) -> DataFrame:
        """A table's folder with its partition columns; a folder without rows is an empty table, no folder an error."""
        schema = T.StructType([*self.schemas[name].fields, T.StructField(VERSION, T.IntegerType()),
                               T.StructField(ATTEMPT, T.StringType()), T.StructField(OPEN_FLAG, T.BooleanType())])
        return self.spark.read.schema(schema).parquet(path)

    def _committed(self, name: str, record) -> DataFrame:
        """The rows that committed attempts wrote into a table, from the record's base to its version."""
        commits = self._commits().filter(F.col(VERSION).between(max(record["base"], 1), record[VERSION]))
        rows = self._read(name, f"{self.root}/{name}")
        return rows.join(commits.select(VERSION, ATTEMPT), [VERSION, ATTEMPT], "left_semi")

    def table(self, name: str, version: int | None = None) -> DataFrame:
        record = self._record(version)
        schema = self.schemas[name]
        if record is None or not record[VERSION]:
            return self.spark.createDataFrame([], schema)
        rows = self._committed(name, record)
        return rows.filter(~F.col(OPEN_FLAG) | (F.col(VERSION) == record[VERSION])).select(*schema.fieldNames())

    def state(self, version: int | None = None) -> State:
        return State(*[self.table(n, version) for n in TABLES])

    def changelog(self, version: int | None = None) -> DataFrame:
        record = self._record(version)
        if record is None or not record[VERSION]:
            return self.spark.createDataFrame([], CHANGELOG_SCHEMA)
        return self._committed("changelog", record).select(*CHANGELOG_SCHEMA.fieldNames())

    def recent_changes(self, now: str, hours: int = RECENT_HOURS) -> DataFrame:
        """L4: the stored change-log rows younger than ``hours`` at ``now``.

        A run logs at the time that its commit record names, so only the folders of recent commits are read.
        """
        commits, since = self._commits(), hours_before(now, hours)
        if commits is None:
            return report.recent_changes(self.changelog(), now, hours)
        recent = [r[VERSION] for r in commits.filter(F.col("change_ts") > ts(since)).select(VERSION).collect()]  # runs of some hours
        rows = self._committed("changelog", self._record()).filter(F.col(VERSION).isin(recent))
        return report.recent_changes(rows, now, hours).select(*CHANGELOG_SCHEMA.fieldNames())

    # --- writing ---------------------------------------------------------------------

    def _write_commit(self, version: int, attempt: str, base: int, run_ts: str | None, change_ts: str | None) -> None:
        record = self.spark.range(1).select(F.lit(attempt).alias(ATTEMPT), F.lit(base).cast("int").alias("base"),
                                            ts(run_ts).alias("run_ts"), ts(change_ts).alias("change_ts"))
        record.coalesce(1).write.mode("errorifexists").parquet(f"{self.root}/_commits/{VERSION}={version}")

    def _create(self) -> None:
        if self._commits() is None:
            self._write_commit(0, "", 0, None, None)

    def _write_table(self, df: DataFrame, name: str, version: int, attempt: str) -> None:
        (df.withColumn(OPEN_FLAG, is_open(SYS_END))
         .write.mode("errorifexists").partitionBy(OPEN_FLAG)
         .parquet(f"{self.root}/{name}/{VERSION}={version}/{ATTEMPT}={attempt}"))

    def _written(self, name: str, version: int, attempt: str, base: int) -> DataFrame:
        """A table as it will be once this attempt is committed."""
        own = self._read(name, f"{self.root}/{name}/{VERSION}={version}/{ATTEMPT}={attempt}")
        columns = self.schemas[name].fieldNames()
        record = self._record()
        if not record[VERSION] or base == version:
            return own.select(*columns)
        older = self._committed(name, {**record.asDict(), "base": base}).filter(~F.col(OPEN_FLAG))
        return own.select(*columns).unionByName(older.select(*columns))

    def publish(self, result: Run, mode: str = "dry_run", strict: bool = False) -> PublishReport:
        """Write every table of ``result`` as one new version, or none of them.

        ``dry_run`` (the default, as the original ships) computes the preview counts, the change log and the
        integrity checks and keeps nothing.  ``commit`` writes all tables, checks what it wrote and only then adds
        the commit record; with ``strict`` a violation aborts the commit (the original states these rules but
        enforces none).  A store that has a newer version than the run was built on refuses it.
        """
        if mode not in ("dry_run", "commit"):
            raise ValueError(f"unknown mode {mode!r}")
        current = self.current_version()
        version = (current or 0) + 1
        applied = result.applied
        if any(getattr(applied, n).kept is None for n in TABLES):
            raise ValueError("the store keeps closed history as it is; runs with close_history=True can't be published")
        counts = report.preview_rows(result.counted)
        if mode == "dry_run":
            after = {n: (result.tally[f"open_{n}"], result.tally[f"retired_{n}"]) for n in TABLES}
            return PublishReport(mode, version, self._log(result, after), checks.all_violations(result.tally, self.spec), counts)
        if result.base_version != current:
            raise PublishError(f"the run was built on version {result.base_version}, the store is at {current}")
        self._create()
        base = self._record()["base"] or 1
        attempt = uuid.uuid4().hex
        after = {}
        for name in TABLES:
            update, counting = getattr(applied, name), Observation()
            retired = F.col(SYS_END) == ts(result.retired_end)
            rows = update.rewritten.observe(counting, F.count(F.when(is_open(SYS_END), 1)).alias("total"),
                                            F.count(F.when(retired, 1)).alias("retired"))
            self._write_table(rows, name, version, attempt)
            # The log counts rows of any age: of the closed ones, which are not written again, those of one date.
            older = 0 if name == "register" or result.retired_end is None else update.kept.filter(retired).count()
            after[name] = (counting.get["total"], counting.get["retired"] + older)
        log = self._log(result, after)
        (self.spark.createDataFrame([tuple(r.values()) for r in log], CHANGELOG_SCHEMA).coalesce(1).write.mode("errorifexists")
         .parquet(f"{self.root}/changelog/{VERSION}={version}/{ATTEMPT}={attempt}"))
        written = State(*[self._written(n, version, attempt, base) for n in TABLES])
        violations = checks.all_violations(tally(written, None, None, self.spec).first().asDict(), self.spec)
        if strict and any(violations.values()):
            raise PublishError(f"version {version} not committed: {violations}")
        self._write_commit(version, attempt, base, result.params.run_ts, result.params.change_ts)
        return PublishReport(mode, version, log, violations, counts)

    def purge_test_rows(self, now: str, mode: str = "dry_run") -> list[dict]:
        """Delete the manual test's rows from the three tables and the recent rows from the change log.

        Returns the rows kept and removed for each table.  ``commit`` writes what stays as a new version that no
        older rows belong to.
        """
        if mode not in ("dry_run", "commit"):
            raise ValueError(f"unknown mode {mode!r}")
        current = self.current_version()
        state, log = self.state(), self.changelog()
        counts = [r.asDict() for r in report.purge_counts(state, log, now, self.spec).collect()]
        if mode == "commit" and current is not None:
            version, attempt = current + 1, uuid.uuid4().hex
            keep = report.purge_predicates(now, self.spec)
            for name, df in state.tables().items():
                self._write_table(report.purge(df, keep[name]), name, version, attempt)
            (report.purge(log, keep["changelog"]).write.mode("errorifexists")
             .parquet(f"{self.root}/changelog/{VERSION}={version}/{ATTEMPT}={attempt}"))
            self._write_commit(version, attempt, version, now, now)
        return counts

    def _log(self, result: Run, after: dict[str, tuple]) -> list[dict]:
        return [dict(zip(CHANGELOG_SCHEMA.fieldNames(), r, strict=True)) for r in report.log_rows(result.counted, after, result.params, self.spec)]


def run_and_publish(spark: SparkSession, interim: DataFrame, store: RegisterStore, params: RunParams,
                    mode: str = "dry_run", spec: Spec = DWELLINGS, strict: bool = False,
                    keep_staging: bool = False) -> PublishReport:
    """A whole run against the store's current version, then publish (dry run by default).

    The run's staging folder is dropped afterwards (the report holds collected rows
    only), unless ``keep_staging`` asks to keep it for inspection.
    """
    stage = ParquetStage(spark)
    try:
        base = store.current_version()
        result = run(interim, store.state(base), params, spec, stage, base_version=base)
        return store.publish(result, mode, strict)
    finally:
        if not keep_staging:
            stage.drop()
