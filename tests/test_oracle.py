"""Every registered query against its DuckDB oracle on the smallest scale factor."""

import pytest

import __spark_entry__ as entry
from chronoreg.plans import queries as register
from tools.compare import compare

SF = "/root/testdata/sf0.001"
NAMES = sorted(register.queries())


def test_every_query_has_an_oracle():
    assert set(register.queries()) == set(register.oracle_sql())
    assert set(register.queries()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, name):
    assert compare(spark, SF, [name], verbose=False) == []


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["dwelling_id", "scenario_no", "effective_start_date", "effective_end_date",
                          "sys_create_date", "sys_end_date", "sys_deleted_ind"]
    assert df.count() > 0
