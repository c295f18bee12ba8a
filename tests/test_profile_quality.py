"""Profiles (C5-C7, B10, C10, G5) and checks."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portmart.operators.profile import (missing_counts, missing_profile, missing_profile_over_files,
                                        schema_rows, table_shape)
from portmart.operators.quality import (CheckSpec, StepCounter, completeness_check, enforce, run_checks,
                                        schema_check)
from portmart.plans import tables as H


def test_missing_profile_counts_nan_and_null(spark):
    df = spark.createDataFrame([(float("nan"), "a"), (None, None), (1.0, "b"), (2.0, "c")], "x double, s string")
    got = {r["field"]: (r["nulls"], r["pct_missing"]) for r in missing_profile(df).collect()}
    assert got == {"x": (2, 50.0), "s": (1, 25.0)}


def test_limit_is_strictly_greater(spark):
    # 17 of 20 missing = exactly 85%: not reported; 18 of 20 = 90%: reported
    rows = [(None if i < 17 else 1, None if i < 18 else 1) for i in range(20)]
    df = spark.createDataFrame(rows, "a int, b int")
    assert [r["field"] for r in missing_profile(df, limit=85).collect()] == ["b"]


def test_profile_is_one_pass(spark):
    df = spark.range(10).select(*[F.col("id").alias(f"c{i}") for i in range(30)])
    plan = missing_counts(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") <= 1 or "Range" in plan


def test_profile_over_files_equals_single(spark, tmp):
    df = spark.createDataFrame([(i, None if i % 3 else "x") for i in range(100)], "i int, s string")
    df.repartition(4).write.parquet(f"{tmp}/p")
    per_files = {r["field"]: r["nulls"] for r in missing_profile_over_files(spark.read.parquet(f"{tmp}/p")).collect()}
    single = {r["field"]: r["nulls"] for r in missing_profile(df).collect()}
    assert per_files == single


def test_table_shape_and_schema_rows(spark):
    df = spark.createDataFrame([(1, "a")], "a int, b string")
    assert table_shape(df, "t").collect()[0].asDict() == {"table_name": "t", "n_rows": 1, "n_cols": 2}
    assert [(r.position, r.name, r.type) for r in schema_rows(spark, df).collect()] == [(0, "a", "int"), (1, "b", "string")]


EXPECTED = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("v", T.StringType(), True)])


def test_schema_check_strict_and_relaxed(spark):
    same = spark.range(3).select(F.col("id"), F.when(F.col("id") >= 0, F.lit("x")).alias("v"))
    assert schema_check(spark, same, "t", EXPECTED).first()["passed"]
    other_order = same.select("v", "id")
    r = schema_check(spark, other_order, "t", EXPECTED).first()
    assert not r["passed"] and "order" in r["detail"]
    other_type = same.select(F.col("id").cast("int").alias("id"), "v")
    assert not schema_check(spark, other_type, "t", EXPECTED).first()["passed"]
    nullable = same.select(F.when(F.col("id") > 0, F.col("id")).alias("id"), "v")
    assert not schema_check(spark, nullable, "t", EXPECTED).first()["passed"]
    assert schema_check(spark, nullable, "t", EXPECTED, mode="ignore_nullability").first()["passed"]


def test_completeness_fails_on_empty_and_enforce_raises(spark):
    empty = spark.range(0)
    assert not completeness_check(empty, "e").first()["passed"]
    report = run_checks(spark, [CheckSpec("e", empty), CheckSpec("full", spark.range(2))])
    with pytest.raises(AssertionError):
        enforce(report, on_fail="raise")
    rows = enforce(report, on_fail="warn")
    assert sorted((r["table_name"], r["passed"]) for r in rows) == [("e", False), ("full", True)]


def test_step_counter_rides_on_one_action(spark, tmp):
    df = spark.createDataFrame([("d", None, "c", "x"), ("d", 1.0, "c", "x"), ("d", 2.0, "c", "x"), ("e", 3.0, "c", "x")],
                               "dt string, AverageTemperature double, City string, Country string")
    counter = StepCounter("t")
    out = counter.run(df, H.temperature_steps())
    out.write.parquet(f"{tmp}/o")
    assert counter.counts() == [(0, "drop_missing_reading", 4, 3), (1, "dedup_reading_key", 3, 2),
                                (2, "drop_empty_rows", 2, 2)]
