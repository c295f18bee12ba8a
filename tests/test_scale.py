"""Plan shape and skew: what must hold at 1000x the data (checked on small inputs)."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from portmart.operators.clean import dedup_first
from portmart.operators.pivot import pivot_counts


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _hot(spark, n=30000):
    # one key holds a third of all rows, spread over every input partition
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        (F.col("id") % 97).alias("v"), F.col("id").alias("i")).repartition(12)


def test_hot_key_dedup_is_reduced_map_side(spark):
    df = _hot(spark)
    out = dedup_first(df, ["k"], order_by=["v"])
    plan = _plan(out)
    # a partial group limit before the exchange: a hot key leaves each task as one row
    # (plans print top-down, so the partial step appears after the exchange)
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert plan.index("Partial") > plan.index("Exchange")
    rows = {r["k"]: (r["v"], r["i"]) for r in out.collect()}
    assert rows[0] == (0, 0)
    assert len(rows) == 1 + 20000


def test_hot_key_pivot_partial_counts(spark):
    df = _hot(spark).withColumn("g", F.when(F.col("i") % 2 == 0, "F").otherwise("M"))
    out = pivot_counts(df, ["k"], "g", ["F", "M"], count_col="i")
    assert "partial_count" in _plan(out)
    hot = out.filter("k = 0").first()
    assert (hot["F"], hot["M"]) == (5000, 5000)


def test_partitioned_write_of_hot_value_splits_tasks(spark, tmp):
    from portmart.sinks.writers import write_partitioned
    df = _hot(spark, 60000).withColumn("state", F.when(F.col("k") == 0, "CA").otherwise(F.concat(F.lit("S"), (F.col("i") % 5).cast("string"))))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        write_partitioned(df, f"{tmp}/w", ["state"], max_records_per_file=5000)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = [f for f in os.listdir(f"{tmp}/w/state=CA") if f.endswith(".parquet")]
    assert len(files) >= 4  # the hot value was not written by one task into one file
    assert spark.read.parquet(f"{tmp}/w").count() == 60000


@pytest.fixture(scope="module")
def plans(spark):
    from __spark_entry__ import queries
    return {k: _plan(fn(spark, SF0001)) for k, fn in queries().items()}


def test_no_python_udf_and_no_cross_join_in_any_query(plans):
    for key, plan in plans.items():
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, key
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, key


def test_flagship_pushes_filter_and_prunes_columns(spark):
    from __spark_entry__ import entry
    plan = _plan(entry(spark))
    assert "PushedFilters: [In(o_orderstatus, [F,O])" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string>" in plan


def test_large_estimate_skips_the_counting_job(spark):
    from portmart.operators.joins import broadcast_if_small, estimated_bytes
    big = spark.read.parquet(f"{SF0001}/lineitem.parquet")
    assert estimated_bytes(big) > 1000
    sc = spark.sparkContext
    sc.setJobGroup("size-guard-large", "size guard", False)
    try:
        assert broadcast_if_small(big, max_bytes=1000) is big
    finally:
        sc.setJobGroup("none", "none", False)
    assert sc.statusTracker().getJobIdsForGroup("size-guard-large") == []
    sc.setJobGroup("size-guard-small", "size guard", False)
    try:
        small = spark.read.parquet(f"{SF0001}/nation.parquet")
        assert broadcast_if_small(small) is not small  # proven small: hinted
    finally:
        sc.setJobGroup("none", "none", False)
    assert len(sc.statusTracker().getJobIdsForGroup("size-guard-small")) >= 1  # the bounded count ran


def test_recommended_conf_sizes_partitions():
    from portmart.session import recommended_conf
    c = recommended_conf(100 * 2 ** 40, 8000)
    assert int(c["spark.sql.shuffle.partitions"]) == 409600
    assert int(recommended_conf(10 * 2 ** 20, 64)["spark.sql.shuffle.partitions"]) == 192  # 3 waves
    assert c["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_hot_join_key_is_split_by_aqe(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        n = 90000
        fact = spark.range(n).select(
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5000).alias("custkey"),
            F.col("id").alias("orderkey"),
            F.concat(F.lit("P"), (F.col("id") % 4).cast("string")).alias("priority"))
        dim = spark.range(5000).select(F.col("id").alias("c_custkey"),
                                       F.when(F.col("id") % 2 == 0, "A").otherwise("B").alias("segment"))
        joined = fact.join(dim, F.col("custkey") == F.col("c_custkey"))
        out = pivot_counts(joined, ["priority"], "segment", ["A", "B"], count_col="orderkey")
        rows = {r["priority"]: (r["A"], r["B"]) for r in out.collect()}
        final = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "skew=true" in final
    assert sum((a or 0) + (b or 0) for a, b in rows.values()) == n  # absent pairs are null cells
