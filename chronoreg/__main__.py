"""Command line: one change-set run against a store, dry run unless ``--mode commit``.

    spark-submit --conf spark.checkpoint.dir=<shared folder> --py-files chronoreg.zip \\
        chronoreg/__main__.py --interim <snapshot folder> --store <store folder> \\
        --version 0.54 [--mode commit]

(or ``python -m chronoreg ...`` where a local session will do).

Parameters mirror the original's: version, optional scenario list (automatic when
empty), optional batch date (latest when empty).  The clock is read here, once, and
rounded to the second (P4); nothing inside a plan reads it.  Prints the publish report
as one JSON line.
"""

from __future__ import annotations

import argparse
import json
import sys
from datetime import datetime

from pyspark.sql import SparkSession

from chronoreg.model import RunParams, round_to_second
from chronoreg.plans.publish import RegisterStore, run_and_publish
from chronoreg.sources.tables import read_interim


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="chronoreg", description=__doc__.splitlines()[0])
    p.add_argument("--interim", help="folder of the snapshot (Parquet)")
    p.add_argument("--store", required=True, help="root folder of the versioned store")
    p.add_argument("--version", type=float, help="version_no to load")
    p.add_argument("--recent", action="store_true", help="print the stored change-log rows of the last hours and end")
    p.add_argument("--purge-test-rows", action="store_true", help="delete the manual test's rows (with --mode commit) and end")
    p.add_argument("--scenarios", default="", help="comma-separated scenario list; empty = automatic")
    p.add_argument("--batch-ts", default=None, help="batch sys_create_date; empty = each scenario's latest")
    p.add_argument("--no-batch-filter", action="store_true", help="take every batch of the version")
    p.add_argument("--run-ts", default=None, help="clock for deletes; default: now")
    p.add_argument("--change-ts", default=None, help="clock for the change log; default: run clock")
    p.add_argument("--mode", choices=("dry_run", "commit"), default="dry_run")
    p.add_argument("--reinsert-join", action="store_true", help="multiply new rows by the open rows of their key, as the original does")
    p.add_argument("--strict-staging", action="store_true", help="fail on an UPDATE that the original's staging columns can't hold")
    p.add_argument("--strict", action="store_true", help="refuse to commit a state that breaks a rule")
    return p


def params_from(args: argparse.Namespace) -> RunParams:
    scenarios = tuple(int(s) for s in args.scenarios.split(",") if s.strip())
    return RunParams(
        version_no=args.version,
        run_ts=args.run_ts or round_to_second(datetime.now()),
        scenarios=scenarios,
        batch_ts=args.batch_ts or None,
        batch_filter=not args.no_batch_filter,
        change_ts=args.change_ts,
        reinsert_join=args.reinsert_join,
        strict_staging=args.strict_staging,
    )


def _plain(row: dict) -> dict:
    return {k: (v.isoformat(sep=" ") if hasattr(v, "isoformat") else v) for k, v in row.items()}


def main(argv: list[str] | None = None) -> dict:
    args = _parser().parse_args(argv)
    spark = SparkSession.builder.appName("chronoreg").getOrCreate()
    store = RegisterStore(spark, args.store)
    now = args.run_ts or round_to_second(datetime.now())
    if args.recent:
        out = {"changelog": [_plain(r.asDict()) for r in store.recent_changes(now).collect()]}
    elif args.purge_test_rows:
        out = {"mode": args.mode, "purged": store.purge_test_rows(now, args.mode)}
    elif args.interim is None or args.version is None:
        raise SystemExit("--interim and --version are needed for a run")
    else:
        report = run_and_publish(spark, read_interim(spark, args.interim), store, params_from(args), mode=args.mode,
                                 strict=args.strict)
        out = {"mode": report.mode, "version": report.version, "counts": report.counts,
               "violations": report.violations, "changelog": [_plain(r) for r in report.changelog]}
    print(json.dumps(out))
    return out


if __name__ == "__main__":
    main(sys.argv[1:])
