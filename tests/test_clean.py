"""Cleaning operators: deterministic survivors, null handling, strict renames."""

import pytest

from portmart.operators.clean import dedup_first, drop_null_rows, rename_columns
from portmart.plans import tables as H


def test_dedup_survivor_independent_of_partitioning(spark):
    rows = [(k % 7, i, f"v{(i * 37) % 11}") for i, k in enumerate(range(500))]
    df = spark.createDataFrame(rows, "k int, i int, v string")
    base = sorted(dedup_first(df, ["k"], order_by=["v"]).collect())
    for n in (1, 3, 17):
        assert sorted(dedup_first(df.repartition(n), ["k"], order_by=["v"]).collect()) == base
    # survivor is the smallest (v, i)
    for r in base:
        cands = sorted((v, i) for k, i, v in rows if k == r["k"])
        assert (r["v"], r["i"]) == cands[0]


def test_dedup_null_key_kept_once_or_dropped(spark):
    df = spark.createDataFrame([(None, "a"), (None, "b"), (1.0, "c")], "cicid double, g string")
    kept = dedup_first(df, ["cicid"]).collect()
    assert len(kept) == 2 and {r["g"] for r in kept} == {"a", "c"}
    assert [r["g"] for r in dedup_first(df, ["cicid"], drop_null_keys=True).collect()] == ["c"]


def test_dedup_nulls_sort_first(spark):
    df = spark.createDataFrame([(1, None), (1, "x")], "k int, v string")
    assert dedup_first(df, ["k"]).first()["v"] is None


def test_dropna_counts_nan_as_missing(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, None), (3, 1.0)], "k int, x double")
    assert [r["k"] for r in drop_null_rows(df, subset=["x"]).collect()] == [3]


def test_demographics_all_null_row_really_dropped(spark):
    df = spark.createDataFrame([("a", "s", "r", 1), (None, None, None, None)], "City string, State string, Race string, n int")
    assert H.clean_demographics(df).count() == 1


def test_temperature_null_reading_never_wins(spark):
    df = spark.createDataFrame([("2010-01-01", None, "X", "C"), ("2010-01-01", 5.0, "X", "C")],
                               "dt string, AverageTemperature double, City string, Country string")
    out = H.clean_temperature(df).collect()
    assert len(out) == 1 and out[0]["AverageTemperature"] == 5.0


def test_rename_strict_and_ignore(spark):
    df = spark.createDataFrame([(1, 2)], "`Foreign-born` int, b int")
    with pytest.raises(KeyError):
        rename_columns(df, {"Foreign born": "foreign_born_num"})
    assert rename_columns(df, {"Foreign born": "x"}, missing="ignore").columns == ["Foreign-born", "b"]
    assert rename_columns(df, {"Foreign-born": "foreign_born_num"}).columns == ["foreign_born_num", "b"]


def test_arrivals_dedup_before_dropping_empty_rows(spark):
    df = spark.createDataFrame([(1.0, "M", "x"), (1.0, "F", "y"), (None, None, None)],
                               "cicid double, gender string, occup string")
    out = H.clean_arrivals(df)
    assert "occup" not in out.columns
    rows = out.collect()
    assert len(rows) == 1 and rows[0]["gender"] == "F"  # smallest remaining columns win
