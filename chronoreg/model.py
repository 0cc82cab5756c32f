"""Data model: fixed values, column names, table spec, schemas and run parameters."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import datetime, timedelta

from pyspark.sql import types as T

# --- Fixed values --------------------------------------------------------------
# These must equal the values of the original change-set process for the
# registers to hold identical rows and the change log identical counts.
HIGH_DATE = "9999-01-01 00:00:00"  # end date carried by open rows
OPEN_CUTOFF = "4999-01-01 00:00:00"  # a sys_end_date later than this is open
FLAG_LIVE = "N"
FLAG_DELETED = "Y"
CHANGE_INSERT = "INSERT"
CHANGE_UPDATE = "UPDATE"
CHANGE_DELETE = "DELETE"
EXCLUDED_SCENARIO = 999  # no longer valid; left out of automatic selection
AMBIGUOUS_SCENARIO = 5  # several candidate buildings per dwelling
AMBIGUOUS_BUILDING_ID = 0  # building written for ambiguous rows
DELETE_BUILDING_ID = 999988880  # staged building id of a DELETE
DELETE_PART_ID = "fake9999999999999test"  # staged part id of a DELETE
BUILDING_RELINK_OLD_PART = "fake9999999999999test"  # old part id of a building-side relink
UPDATE_PART_DEFAULT = "delete101me"  # staged part id of an UPDATE that has none
STAGED_PART_LENGTH = 21  # characters of a staged part id: those of the literal that made the column
PROCESS_NAME = "Dwelling Transfer Step"
REGISTER_TABLE = "Dwelling_Register_Skinny"
BUILDING_LINK_TABLE = "Dwelling_Building_Reference"
PART_LINK_TABLE = "Dwelling_Part_of_Building_Reference"
TEST_SCENARIOS = (0, 99)  # test rows in the register
TEST_BUILDING_IDS_ABOVE = 9999990  # test rows in the building links (also id 0)
TEST_PART_PREFIX = "tst"  # test rows in the part links
RECENT_HOURS = 2  # change-log rows younger than this are "recent"
CHANGELOG_TABLE = "Table_Changelog"
COUNT_CANDIDATES = "total_considered_records"  # report column names
COUNT_DELETES = "dwell_deletes"
COUNT_INSERTS = "dwell_inserts"
COUNT_RELINKS = "PoB_changes"
COUNT_MAINTENANCE = "dwell_deletes_maintenance"
LOG_COLUMNS = ("change_date", "table_name", "process", "records_added", "records_modified", "records_retired",
               "total_records_after", "source", "source_from_date", "source_to_date")  # of the change log, in order
# -------------------------------------------------------------------------------

# Temporal and staging column names shared by every table.
EFF_START = "effective_start_date"
EFF_END = "effective_end_date"
SYS_CREATE = "sys_create_date"
SYS_END = "sys_end_date"
DELETED = "sys_deleted_ind"
CHANGE = "change"
OLD_PART = "old_pob_id"
TEMPORAL = (EFF_START, EFF_END, SYS_CREATE, SYS_END, DELETED)

TS_FORMAT = "%Y-%m-%d %H:%M:%S"


@dataclass(frozen=True)
class Spec:
    """Names of the entity, its classifiers and its two exclusive link kinds.

    The defaults describe dwellings linked either to a building or to a part of a
    building; another register with the same shape only needs other names.
    """

    entity: str = "dwelling_id"
    scenario: str = "scenario_no"
    version: str = "version_no"
    parent: str = "building_id"
    sub_parent: str = "part_of_building_id"
    register_table: str = REGISTER_TABLE
    parent_table: str = BUILDING_LINK_TABLE
    sub_parent_table: str = PART_LINK_TABLE
    process: str = PROCESS_NAME
    #: How part ids compare: None is byte by byte, "UTF8_LCASE" takes no account of case (any collation of Spark's).
    collation: str | None = None

    @property
    def keys(self) -> tuple[str, str]:
        """Business key of a register or link row."""
        return (self.entity, EFF_START)

    @property
    def candidate_columns(self) -> tuple[str, ...]:
        return (self.entity, self.scenario, self.version, self.parent, self.sub_parent,
                EFF_START, EFF_END, SYS_CREATE, SYS_END, DELETED)

    @property
    def register_columns(self) -> tuple[str, ...]:
        return (self.entity, self.scenario) + TEMPORAL

    @property
    def parent_link_columns(self) -> tuple[str, ...]:
        return (self.entity, self.parent) + TEMPORAL

    @property
    def sub_parent_link_columns(self) -> tuple[str, ...]:
        return (self.entity, self.sub_parent) + TEMPORAL


DWELLINGS = Spec()

_TS = T.TimestampNTZType()


def _temporal_fields() -> list[T.StructField]:
    return [
        T.StructField(EFF_START, _TS),
        T.StructField(EFF_END, _TS),
        T.StructField(SYS_CREATE, _TS),
        T.StructField(SYS_END, _TS),
        T.StructField(DELETED, T.StringType()),
    ]


def interim_schema(spec: Spec = DWELLINGS) -> T.StructType:
    return T.StructType([
        T.StructField(spec.entity, T.LongType()),
        T.StructField(spec.scenario, T.IntegerType()),
        T.StructField(spec.version, T.DoubleType()),
        T.StructField(spec.parent, T.LongType()),
        T.StructField(spec.sub_parent, T.StringType()),
        *_temporal_fields(),
    ])


def register_schema(spec: Spec = DWELLINGS) -> T.StructType:
    return T.StructType([
        T.StructField(spec.entity, T.LongType()),
        T.StructField(spec.scenario, T.IntegerType()),
        *_temporal_fields(),
    ])


def parent_link_schema(spec: Spec = DWELLINGS) -> T.StructType:
    return T.StructType([
        T.StructField(spec.entity, T.LongType()),
        T.StructField(spec.parent, T.LongType()),
        *_temporal_fields(),
    ])


def sub_parent_link_schema(spec: Spec = DWELLINGS) -> T.StructType:
    return T.StructType([
        T.StructField(spec.entity, T.LongType()),
        T.StructField(spec.sub_parent, T.StringType()),
        *_temporal_fields(),
    ])


CHANGELOG_SCHEMA = T.StructType([
    T.StructField(name, kind) for name, kind in zip(
        LOG_COLUMNS, (_TS, T.StringType(), T.StringType(), *[T.LongType()] * 4, T.StringType(), _TS, _TS), strict=True)
])


def round_to_second(value: str | datetime | None) -> str | None:
    """Round a timestamp half-up to whole seconds, as a DATETIME2(0) variable does."""
    if value is None:
        return None
    if isinstance(value, str):
        value = datetime.fromisoformat(value.strip().replace("T", " "))
    whole = value.replace(microsecond=0)
    if value.microsecond >= 500_000:
        whole += timedelta(seconds=1)
    return whole.strftime(TS_FORMAT)


@dataclass(frozen=True)
class RunParams:
    """Parameters of one run; timestamps are wall-clock strings (no zone).

    ``run_ts`` is the single clock reading used for every DELETE, ``change_ts``
    the later reading stamped on the change log (defaults to ``run_ts``).
    Nothing inside a plan reads the clock, so a run is reproducible.
    """

    version_no: float
    run_ts: str
    scenarios: tuple[int, ...] = ()  # explicit list; empty = automatic selection
    batch_ts: str | None = None  # explicit batch; None = the latest of each scenario
    batch_filter: bool = True  # restrict candidates to the chosen batches
    change_ts: str | None = None
    excluded_scenarios: tuple[int, ...] = (EXCLUDED_SCENARIO,)
    ambiguous_scenarios: tuple[int, ...] = (AMBIGUOUS_SCENARIO,)
    close_history: bool = False  # also rewrite closed register rows sharing an identity
    reinsert_join: bool = False  # multiply new rows by the open rows they meet (see apply)
    strict_staging: bool = False  # fail on values that the original's staging columns can't hold

    def __post_init__(self) -> None:
        object.__setattr__(self, "run_ts", round_to_second(self.run_ts))
        object.__setattr__(self, "batch_ts", round_to_second(self.batch_ts))
        object.__setattr__(self, "change_ts", round_to_second(self.change_ts or self.run_ts))
        object.__setattr__(self, "scenarios", tuple(self.scenarios))

    def with_(self, **kw) -> "RunParams":
        return replace(self, **kw)
