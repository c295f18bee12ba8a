"""Scalar functions E1-E9 against the reference behaviour (traps T6-T8, T22-T25, T30)."""

import datetime as dt
import math

from pyspark.sql import functions as F

from portmart.functions import (after_first, before_first, parse_date, pct, py_title, sas_day_to_iso,
                                split_part, strip_chain)


def python_days_to_iso(x):
    """Specification: Python's own date arithmetic from the SAS origin; missing and day 0 give
    no date (NaN is left out: Python raises on it)."""
    if x is None or x == 0:
        return None
    return (dt.date(1960, 1, 1) + dt.timedelta(days=x)).isoformat()


def test_sas_day_to_iso_matches_udf_semantics(spark):
    vals = [20574.0, 0.0, None, 1.9, -0.5, -1.0, 366.0, 1.9999999999999, -1e-303, -1e-7, 2.5e-12, 20574.999999999996]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r[0] for r in df.select(sas_day_to_iso("x")).collect()]
    assert got == [python_days_to_iso(v) for v in vals]
    assert got[:5] == ["2016-04-30", None, None, "1960-01-02", "1959-12-31"]


def test_sas_day_nan_is_null_and_zero_flag(spark):
    df = spark.createDataFrame([(float("nan"),), (0.0,)], "x double")
    assert [r[0] for r in df.select(sas_day_to_iso("x")).collect()] == [None, None]
    assert [r[0] for r in df.select(sas_day_to_iso("x", zero_is_null=False)).collect()] == [None, "1960-01-01"]


def test_sas_day_stays_in_codegen(spark):
    df = spark.createDataFrame([(1.0,)], "x double").select(sas_day_to_iso("x").alias("d"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


TITLE_CASES = ["o'hare", "WINSTON-SALEM", "ft. mcCOY's 2nd", "ÉCOLE x1y", "ßtraße", "中a", "", "  spaced  out ",
               "NEW YORK", "ǆemal", "école"]


def test_py_title_equals_python_title(spark):
    df = spark.createDataFrame([(s,) for s in TITLE_CASES] + [(None,)], "s string")
    got = [r[0] for r in df.select(py_title("s")).collect()]
    assert got == [s.title() for s in TITLE_CASES] + [None]
    assert got[:4] == ["O'Hare", "Winston-Salem", "Ft. Mccoy'S 2Nd", "École X1Y"]
    assert got[4].startswith("Ss")


def test_initcap_differs_which_is_why_py_title_exists(spark):
    df = spark.createDataFrame([("o'hare",)], "s string")
    assert df.select(F.initcap("s")).first()[0] == "O'hare"


def test_split_and_strip_rules(spark):
    lines = ["   582  =  'MEXICO Air Sea'", "\t'NYC'\t=\t'NEW YORK, NY'", "\t'AL '=  'ALABAMA' ", "a = b = c", "no equals"]
    df = spark.createDataFrame([(s,) for s in lines], "s string")
    rows = df.select(split_part("s", "=", 0).alias("k"), split_part("s", "=", 1).alias("v")).collect()
    for (k, v), line in zip(rows, lines):
        parts = line.split("=")
        assert k == parts[0]
        assert v == (parts[1] if len(parts) > 1 else None)
    # city rule: tabs, whitespace, quotes; state rule: tabs then quotes only (inner space kept)
    got = df.select(strip_chain(split_part("s", "=", 0), ["\t", None, "'"]).alias("city"),
                    strip_chain(split_part("s", "=", 0), ["\t", "'"]).alias("state")).collect()
    assert got[1]["city"] == "NYC"
    assert got[2]["state"] == "AL "
    assert got[2]["state"] == "\t'AL '".strip("\t").strip("'")


def test_first_comma_split(spark):
    vals = ["NEW YORK, NY", "A, B, C", "NOCOMMA"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = df.select(before_first("s").alias("a"), after_first("s").alias("b")).collect()
    assert [r["a"] for r in got] == [v.split(",", 1)[0] for v in vals]
    assert [r["b"] for r in got] == [" NY", " B, C", None]


def test_parse_date_bad_text_is_null(spark):
    df = spark.createDataFrame([("2016-04-01",), ("nope",), ("2016-4-1",), (None,)], "s string")
    got = [r[0] for r in df.select(parse_date("s")).collect()]
    assert got[0] == dt.date(2016, 4, 1)
    assert got[1] is None and got[3] is None


def test_pct(spark):
    df = spark.createDataFrame([(2014, 10000), (1, 0)], "a long, b long")
    got = [r[0] for r in df.select(pct("a", "b")).collect()]
    assert math.isclose(got[0], 20.14) and got[1] is None


def test_strip_whitespace_is_pythons(spark):
    from portmart.functions import strip_chars
    vals = ["\xa0 MEXICO　", "\x1c\x1dX\x85", " \t'AL'\t "]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    assert [r[0] for r in df.select(strip_chars("s")).collect()] == [v.strip() for v in vals]
