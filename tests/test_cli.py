"""The command line runs the documented two steps against a store."""

import os

from pyspark.sql import functions as F

from chronoreg.__main__ import main
from chronoreg.sources.fixtures import B1, GOLDEN_NOW, golden_interim


def test_cli_dry_run_then_commits(spark, scratch_dir):
    interim_dir = os.path.join(scratch_dir, "interim")
    store_dir = os.path.join(scratch_dir, "store")
    golden_interim(spark).write.parquet(interim_dir)
    base = ["--interim", interim_dir, "--store", store_dir, "--version", "0"]

    dry = main(base + ["--batch-ts", B1, "--run-ts", "2024-01-01 00:00:00"])
    assert dry["mode"] == "dry_run" and dry["version"] == 1
    assert not os.path.exists(os.path.join(store_dir, "_commits"))

    first = main(base + ["--batch-ts", B1, "--run-ts", "2024-01-01 00:00:00", "--mode", "commit"])
    assert first["version"] == 1
    second = main(base + ["--run-ts", GOLDEN_NOW, "--mode", "commit"])
    assert second["version"] == 2
    log = {r["table_name"]: (r["records_added"], r["records_modified"], r["records_retired"],
                             r["total_records_after"]) for r in second["changelog"]}
    assert log["Dwelling_Register_Skinny"] == (4, 2, 1, 8)
    assert log["Dwelling_Building_Reference"] == (3, 3, 1, 6)
    assert log["Dwelling_Part_of_Building_Reference"] == (1, 1, 0, 2)
    assert {(r["count_name"], r["change"]): r["n"] for r in second["counts"]}[("dwell_inserts", "INSERT")] == 4
    reg = spark.read.parquet(os.path.join(store_dir, "register"))
    assert reg.filter((F.col("v") == 2) & F.col("is_open")).count() == 8

    assert len(main(["--store", store_dir, "--recent", "--run-ts", GOLDEN_NOW])["changelog"]) == 3
    purged = main(["--store", store_dir, "--purge-test-rows", "--run-ts", GOLDEN_NOW, "--mode", "commit"])["purged"]
    assert {r["table_name"]: r["rows_kept"] for r in purged}["Dwelling_Register_Skinny"] == 0
