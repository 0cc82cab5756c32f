"""A business key holding a third of all rows: AQE splits it, and the result stays whole."""

from pyspark.sql import functions as F

from chronoreg.model import RunParams
from chronoreg.operators.diff import classify
from chronoreg.operators.select import ScenarioSet
from helpers import HI, interim, state

V = 1.0
B = "2024-01-02 00:00:00"
S0, E1 = "2020-01-01 00:00:00", "2022-01-01 00:00:00"
OLD = "2019-01-01 00:00:00"
P = RunParams(version_no=V, run_ts="2024-06-01 00:00:00")

SKEW_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "8",
}


def _with_conf(spark, conf):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    return old


def _restore(spark, old):
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_hot_key_is_split_and_every_pair_kept(spark):
    hot, cold = 3000, 6000
    rows = [(1, 1, V, 10 + i, None, S0, E1, B) for i in range(hot)]  # one key, many rows
    rows += [(100 + i, 1, V, 10, None, S0, HI, B) for i in range(cold)]
    snap = interim(spark, rows).repartition(8)
    st = state(spark, register=[(1, 1, S0, HI, OLD)] + [(100 + i, 1, S0, HI, OLD) for i in range(0, cold, 2)])
    old = _with_conf(spark, SKEW_CONF)
    try:
        cands = snap.select("dwelling_id", "scenario_no", "version_no", "building_id", "part_of_building_id",
                            "effective_start_date", "effective_end_date", "sys_create_date",
                            F.lit(HI).cast("timestamp_ntz").alias("sys_end_date"),
                            F.lit("N").alias("sys_deleted_ind"))
        classified = classify(st.register, cands, ScenarioSet(ids=(1,)), P)
        got = classified.groupBy("change").count().collect()
        counts = {r["change"]: r["count"] for r in got}
        assert counts == {"UPDATE": hot, "INSERT": cold // 2}
        plan = classified._jdf.queryExecution().executedPlan().toString()
        classified.collect()
        final = classified._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in final, final
        assert plan  # the initial plan is kept for the failure message above
    finally:
        _restore(spark, old)
