"""Key and reference checks whatever the tables' sizes (G1-G3 over D2-D6), co-partitioned storage."""

import pytest
from pyspark.sql import functions as F

from portmart.operators import joins
from portmart.operators.joins import lookup_join
from portmart.operators.keychecks import Key, Reference, as_checks, key_report, require_unique
from portmart.operators.quality import enforce
from portmart.sinks.copartitioned import bucket_count, copartitioned_join, open_table, write_copartitioned


def test_planted_repeats_and_orphans(spark):
    states = spark.createDataFrame([("NY", "a"), ("CA", "b"), ("CA", "c"), ("CA", "d"), (None, "e")], "code string, name string")
    fact = spark.createDataFrame([(1, "NY", 1), (2, "CA", 1), (3, "ZZ", 2), (4, "ZZ", 3), (5, None, 4), (6, "QQ", None)], "id int, state string, m int")
    months = spark.createDataFrame([("NY", 1), ("CA", 1), ("CA", 2)], "s string, m int")
    by_state, code = Key("fact", fact, ["state"], unique=False), Key("states", states, ["code"])
    pair, month = Key("fact", fact, ["state", F.col("m").alias("m")], unique=False), Key("months", months, ["s", "m"])
    report = key_report([Key("fact", fact, ["id"]), code, month], [Reference(by_state, code), Reference(pair, month)])
    got = {(r[0], r[1]): tuple(r)[2:] for r in report.collect()}
    assert got == {
        ("fact", "unique(id)"): (True, 6, 0, 0, 0),
        ("states", "unique(code)"): (False, 2, 1, 2, 1),
        ("months", "unique(s, m)"): (True, 3, 0, 0, 0),
        ("fact", "refers(state -> states.code)"): (False, 4, 2, 3, 1),
        ("fact", "refers(state, m -> months.s, m)"): (False, 4, 2, 2, 2),
    }
    with pytest.raises(AssertionError, match="states/unique"):
        enforce(as_checks(report))


def test_empty_tables_pass(spark):
    none = spark.createDataFrame([], "k int")
    rows = key_report([Key("t", none, ["k"])], [Reference(Key("c", none, ["k"]), Key("p", none, ["k"]))]).collect()
    assert [tuple(r)[2:] for r in rows] == [(True, 0, 0, 0, 0)] * 2


def test_lookup_checks_a_dimension_of_any_size(spark, monkeypatch):
    fact = spark.createDataFrame([("a",), ("b",)], "k string")
    dim = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "c string, v int")
    monkeypatch.setattr(joins, "estimated_bytes", lambda df: 1 << 40)  # as of a large table
    with pytest.raises(ValueError, match="not unique"):
        lookup_join(fact, dim, "k", "c")
    assert sorted(map(tuple, lookup_join(fact, dim.filter("v <> 2"), "k", "c").collect())) == [("a", 1), ("b", 3)]
    assert require_unique(dim.filter("v > 2").unionByName(spark.createDataFrame([(None, 1), (None, 2)], dim.schema)), "c") == 3


def exchanges(df):
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return [line for line in text.splitlines() if "Exchange" in line]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_without_exchange_and_with_a_hot_key(spark, tmp, how):
    rows = [(i, i % 50 if i % 3 else 7, f"f{i}") for i in range(600)] + [(1000, None, "none"), (1001, 99, "orphan")]
    fact = spark.createDataFrame(rows, "id int, k int, what string")
    dim = spark.createDataFrame([(i, f"d{i}") for i in range(60)], "key int, name string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        f = write_copartitioned(fact, f"{tmp}/f", f"cp_fact_{how}", "k", 8, hot_share=2, hot_rows=50)
        d = write_copartitioned(dim, f"{tmp}/d", f"cp_dim_{how}", "key", 8)
        assert [r[0] for r in f.hot_keys().collect()] == [7] and f.cold().filter("k = 7").isEmpty() and f.hot().filter("k = 7").count() > 200
        out = copartitioned_join(f, d, ["id", "what"], ["name"], how)
        plain = fact.join(dim, fact.k == dim.key, how).select("id", "what", "name")
        assert sorted(map(str, out.collect())) == sorted(map(str, plain.collect()))
        cold = copartitioned_join(f, d, ["id", "k"], ["key", "name"], how)
        assert sorted(map(str, cold.collect())) == sorted(map(str, fact.join(dim, fact.k == dim.key, how).select("id", "k", "key", "name").collect()))
        # the only exchanges are broadcasts of the hot keys' few rows
        assert out._jdf.queryExecution().executedPlan().toString().count("SortMergeJoin") and all("BroadcastExchange" in x for x in exchanges(out))
        # named again, as another session would
        spark.sql(f"DROP TABLE cp_fact_{how}")
        again = open_table(spark, f"{tmp}/f", f"cp_fact_{how}", "k", 8)
        assert again.rows().count() == len(rows)
        assert all("BroadcastExchange" in x for x in exchanges(copartitioned_join(again, d, ["id"], ["name"], how)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_bucket_counts_are_compatible():
    assert [bucket_count(x << 30) for x in (0, 1, 4, 5, 100)] == [8, 8, 8, 16, 256] and bucket_count(100 << 40) == 1 << 16
