"""Plans that must hold at scale: one exchange of a link table, no pairs before the pick."""

from chronoreg.operators.apply import close_links
from chronoreg.plans.run import run
from chronoreg.sources.fixtures import FIXTURE_PARAMS, derived_inputs
from helpers import HI, state

SF = "/root/testdata/sf0.001"


def test_link_closing_shuffles_the_link_table_once(spark):
    inp = derived_inputs(spark, SF)
    res = run(inp.interim, inp.state, FIXTURE_PARAMS)
    deletes, relinks = res.stage(res.deletes, "deletes"), res.relinks
    links = res.stage(inp.state.building_link, "links")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        _, named, others = close_links(links, deletes, relinks, "building_id", True)
        plan = named.select("dwelling_id").union(others.select("dwelling_id"))
        text = plan._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    scans = [line for line in text.splitlines() if "FileScan parquet" in line and "/links" in line]
    assert len(scans) <= 2  # one for each side of the split; the second reads the first one's exchange where columns agree


def test_hot_link_key_is_not_paired_with_all_requests(spark):
    """600 link rows and 600 requests of one key: no join of the plan emits their product."""
    start, old = "2020-01-01 00:00:00", "2019-01-01 00:00:00"
    st = state(spark, building=[(1, 10 + i % 3, start, HI, old) for i in range(600)])
    deletes = spark.createDataFrame(
        [(1, 500 + i, "x", 1, start, HI, old, f"2024-01-01 00:{i // 60:02d}:{i % 60:02d}", "N", "UPDATE") for i in range(600)],
        "dwelling_id long, building_id long, part_of_building_id string, scenario_no int, effective_start_date string, "
        "effective_end_date string, sys_create_date string, sys_end_date string, sys_deleted_ind string, change string")
    for c in ("effective_start_date", "effective_end_date", "sys_create_date", "sys_end_date"):
        deletes = deletes.withColumn(c, deletes[c].cast("timestamp_ntz"))
    relinks = spark.createDataFrame([], "dwelling_id long, old_pob_id string, part_of_building_id string, building_id long, "
                                        "effective_start_date timestamp_ntz, effective_end_date timestamp_ntz, "
                                        "sys_create_date timestamp_ntz, sys_end_date timestamp_ntz, sys_deleted_ind string")
    _, named, _ = close_links(st.building_link, deletes, relinks, "building_id", True)
    got = named.collect()
    assert len(got) == 600 and {str(r.sys_end_date) for r in got} == {"2024-01-01 00:09:59"}
    plan = named._jdf.queryExecution().executedPlan()
    produced = []

    def walk(node):
        if "Join" in node.nodeName():
            metrics = node.metrics()
            if metrics.contains("numOutputRows"):
                produced.append(metrics.apply("numOutputRows").value())
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(plan.executedPlan() if hasattr(plan, "executedPlan") else plan)
    assert all(n <= 1200 for n in produced), produced
