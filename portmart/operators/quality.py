"""Data-quality checks that return rows instead of only logging.

Every check yields rows of ``(table_name, check_name, passed, detail)``. ``enforce`` turns a
report into an exception, so a job can stop on a failed check instead of carrying on.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)

REPORT_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType(), False),
    T.StructField("check_name", T.StringType(), False),
    T.StructField("passed", T.BooleanType(), True),
    T.StructField("detail", T.StringType(), True),
])

STEP_SCHEMA = T.StructType([
    T.StructField("position", T.IntegerType(), False),
    T.StructField("step", T.StringType(), False),
    T.StructField("rows_in", T.LongType(), True),
    T.StructField("rows_out", T.LongType(), True),
])


def completeness_check(df: DataFrame, table_name: str) -> DataFrame:
    """Passes when the table has at least one row; detail is the row count (G1). Lazy."""
    n = F.count(F.lit(1))
    return df.agg(n.alias("_n")).select(
        F.lit(table_name).alias("table_name"), F.lit("completeness").alias("check_name"),
        (F.col("_n") > 0).alias("passed"), F.concat(F.col("_n").cast("string"), F.lit(" rows")).alias("detail"))


def schema_diff(actual: T.StructType, expected: T.StructType, mode: str = "strict") -> list[str]:
    """Differences between two schemas: names, order, types and (in strict mode) nullability."""
    out: list[str] = []
    a = {f.name: f for f in actual.fields}
    e = {f.name: f for f in expected.fields}
    out += [f"missing {n}" for n in e if n not in a]
    out += [f"extra {n}" for n in a if n not in e]
    for n, ef in e.items():
        if n not in a:
            continue
        af = a[n]
        if af.dataType != ef.dataType:
            out.append(f"{n}: type {af.dataType.simpleString()} expected {ef.dataType.simpleString()}")
        elif mode == "strict" and af.nullable != ef.nullable:
            out.append(f"{n}: nullable {str(af.nullable).lower()} expected {str(ef.nullable).lower()}")
    common_a = [f.name for f in actual.fields if f.name in e]
    common_e = [f.name for f in expected.fields if f.name in a]
    if common_a != common_e:
        out.append("column order differs")
    return out


def schema_check(spark: SparkSession, df: DataFrame, table_name: str, expected: T.StructType,
                 mode: str = "strict") -> DataFrame:
    """Passes when the schema equals ``expected`` (G2). ``mode='ignore_nullability'`` compares
    names, order and types only. Uses the analysed schema; runs no job."""
    diffs = schema_diff(df.schema, expected, mode)
    return spark.createDataFrame([(table_name, "schema", not diffs, "; ".join(diffs))], REPORT_SCHEMA)


@dataclass(frozen=True)
class CheckSpec:
    table_name: str
    df: DataFrame
    expected_schema: T.StructType | None = None
    schema_mode: str = "strict"
    completeness: bool = True


def run_checks(spark: SparkSession, specs: Sequence[CheckSpec]) -> DataFrame:
    """Schema and completeness checks over many tables as one report frame."""
    parts = []
    for s in specs:
        if s.expected_schema is not None:
            parts.append(schema_check(spark, s.df, s.table_name, s.expected_schema, s.schema_mode))
        if s.completeness:
            parts.append(completeness_check(s.df, s.table_name))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def enforce(report: DataFrame, on_fail: str = "raise") -> list:
    """Collect a (small) report; log every row and raise or warn when any check failed."""
    rows = report.collect()
    failed = [r for r in rows if not r["passed"]]
    for r in rows:
        (log.info if r["passed"] else log.warning)(
            "check %s %s for %s: %s", r["check_name"], "PASSED" if r["passed"] else "FAILED",
            r["table_name"], r["detail"])
    if failed and on_fail == "raise":
        raise AssertionError("failed checks: " + ", ".join(f"{r['table_name']}/{r['check_name']}" for r in failed))
    return rows


class StepCounter:
    """Before/after row counts of each step of a cleaning run.

    Counts ride on the job that finally consumes the frame (``Observation``), so counting adds
    no scan: call :meth:`run`, then an action (typically the write), then :meth:`report`.
    """

    def __init__(self, name: str = "steps"):
        self.name = name
        self._names: list[str] = []
        self._obs: list[Observation] = []

    def _observe(self, df: DataFrame) -> DataFrame:
        obs = Observation(f"{self.name}_{len(self._obs)}")
        self._obs.append(obs)
        return df.observe(obs, F.count(F.lit(1)).alias("rows"))

    def run(self, df: DataFrame, steps: Sequence[tuple[str, Callable[[DataFrame], DataFrame]]]) -> DataFrame:
        out = self._observe(df)
        for step_name, fn in steps:
            self._names.append(step_name)
            out = self._observe(fn(out))
        return out

    def counts(self) -> list[tuple[int, str, int, int]]:
        got = [o.get.get("rows") for o in self._obs]
        return [(i, n, got[i], got[i + 1]) for i, n in enumerate(self._names)]

    def report(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.counts(), STEP_SCHEMA)
