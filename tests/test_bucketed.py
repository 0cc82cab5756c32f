"""State tables in the catalog, bucketed on the business key: which plans shuffle them, and what reads them."""

import uuid

import pytest

from chronoreg.model import DWELLINGS
from chronoreg.operators.apply import close_links
from chronoreg.operators.diff import classify, find_relinks, touched_keys
from chronoreg.plans.run import run
from chronoreg.sources.bucketed import drop_bucketed, read_bucketed, save_bucketed
from chronoreg.sources.fixtures import FIXTURE_PARAMS, derived_inputs
from chronoreg.sources.tables import SchemaError
from helpers import rows

SF = "/root/testdata/sf0.001"
EXPLICIT = FIXTURE_PARAMS.with_(scenarios=(0, 1, 2, 3, 4, 5, 99))


@pytest.fixture(scope="module")
def bucketed(spark, tmp_path_factory):
    prefix = f"t_{uuid.uuid4().hex}"
    inp = derived_inputs(spark, SF)
    save_bucketed(inp.state, prefix, str(tmp_path_factory.mktemp("bucketed")))
    yield inp.interim, read_bucketed(spark, prefix), prefix
    drop_bucketed(spark, prefix)


@pytest.fixture()
def plain_plans(spark):
    """Joins as on large tables: none is broadcast, and the plan is whole before it runs."""
    names = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in old.items():
        spark.conf.set(n, v)


def shuffled_scans(df, table):
    """How many scans of a table stand under an exchange that carries its rows (not partial aggregates of them)."""
    found = 0

    def walk(node, shuffled):
        nonlocal found
        name = node.nodeName()
        if table in node.toString() and "Scan" in name:
            found += shuffled
        for i in range(node.children().size()):
            walk(node.children().apply(i), shuffled or name == "Exchange")

    walk(df._jdf.queryExecution().executedPlan(), False)
    return found


def scans(df, table):
    text = df._jdf.queryExecution().executedPlan().toString()
    return sum("FileScan" in line and table in line for line in text.splitlines())


def test_classification_does_not_shuffle_the_register(spark, bucketed, plain_plans):
    interim, state, prefix = bucketed
    res = run(interim, state, EXPLICIT, colocated=True)
    plan = classify(state.register, res.selection.candidates, res.selection.scenarios, EXPLICIT)
    assert scans(plan, f"{prefix}_register") > 1 and shuffled_scans(plan, f"{prefix}_register") == 0


def test_relinks_and_link_closing_do_not_shuffle_the_links(spark, bucketed, plain_plans):
    interim, state, prefix = bucketed
    res = run(interim, state, EXPLICIT, colocated=True)
    plan = find_relinks(res.selection.candidates, state.building_link, state.part_link, touched_keys(res.classified), colocated=True)
    for table in ("building_link", "part_link"):
        assert scans(plan, f"{prefix}_{table}") == 1 and shuffled_scans(plan, f"{prefix}_{table}") == 0
    # Of the links only the rows that a request names go on to the pick, and are shuffled there.
    _, _, others = close_links(state.building_link, res.stage(res.deletes, "deletes"), res.relinks, DWELLINGS.parent, True)
    assert scans(others, f"{prefix}_building_link") == 1 and shuffled_scans(others, f"{prefix}_building_link") == 0


def test_same_changes(spark, bucketed):
    interim, state, _ = bucketed
    one, two = run(interim, state, EXPLICIT, colocated=True), run(interim, derived_inputs(spark, SF).state, EXPLICIT)
    for name in ("deletes", "inserts", "relinks"):
        assert rows(getattr(one, name)) == rows(getattr(two, name)), name
    assert rows(one.part_link.after) == rows(two.part_link.after)


def test_other_types_are_refused(spark, tmp_path):
    prefix, state = f"t_{uuid.uuid4().hex}", derived_inputs(spark, SF).state
    other = state.register.withColumn("dwelling_id", state.register.dwelling_id.cast("int"))
    save_bucketed(type(state)(other, state.building_link, state.part_link), prefix, str(tmp_path))
    with pytest.raises(SchemaError):
        read_bucketed(spark, prefix)
    drop_bucketed(spark, prefix)
