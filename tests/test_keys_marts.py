"""Surrogate keys (B12), joins (D1-D6) and marts (H17, H18; T17, T18)."""

from pyspark.sql import functions as F

from portmart.operators.joins import broadcast_if_small, lookup_join, month_join, preaggregated_join
from portmart.operators.keys import with_dense_key, with_surrogate_key
from portmart.plans.marts import arrivals_by_state_gender, arrivals_by_visa_gender


def test_dense_key_is_1_to_n_in_key_order(spark):
    import random
    keys = random.Random(7).sample(range(100000), 3000)
    df = spark.createDataFrame([(k, f"n{k}") for k in keys], "k long, name string").repartition(5)
    got = sorted((r["id"], r["k"]) for r in with_dense_key(df, "id", ["k"], num_partitions=7).collect())
    assert got == list(enumerate(sorted(keys), start=1))


def test_surrogate_key_unique_non_null(spark):
    df = with_surrogate_key(spark.range(5000).repartition(7), "sid")
    r = df.agg(F.count("*").alias("n"), F.count_distinct("sid").alias("d"), F.count_if(F.col("sid").isNull()).alias("z")).first()
    assert (r["n"], r["d"], r["z"]) == (5000, 5000, 0)
    assert not df.schema["sid"].nullable


def test_broadcast_only_when_bounded(spark):
    small, big = spark.range(10).withColumnRenamed("id", "k"), spark.range(1000)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hinted = big.join(broadcast_if_small(small, 10), big.id == F.col("k"))
        assert "BroadcastHashJoin" in hinted._jdf.queryExecution().executedPlan().toString()
        unhinted = big.join(broadcast_if_small(small, 9), big.id == F.col("k"))
        assert "BroadcastHashJoin" not in unhinted._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert broadcast_if_small(big, 10) is big


def _fact_dim(spark):
    fact = [(float(i), s, v) for i, (s, v) in enumerate(
        [("NY", "B1"), ("NY", "B1"), ("NY", "B2"), ("NY", "B2"), ("NY", "B2"),
         ("CA", "B1"), ("CA", "B2"), ("TX", "F1"), ("TX", "F1"), ("TX", "F1"), ("TX", "F1"), ("TX", "F1")])]
    genders = ["F", "F", "M", "M", "M", "F", "M", "F", "F", "F", None, "X"]
    dim = [(float(i), g) for i, g in enumerate(genders)]
    f = spark.createDataFrame(fact, "cic_id double, state_code string, visa_type string") \
        .withColumn("immigration_id", F.monotonically_increasing_id())
    d = spark.createDataFrame(dim, "immigration_cic_id double, gender string") \
        .withColumn("immi_demographics_id", F.monotonically_increasing_id())
    return f, d


def test_state_gender_threshold_blanks_pairs(spark):
    f, d = _fact_dim(spark)
    got = {r["state_code"]: (r["F"], r["M"]) for r in arrivals_by_state_gender(f, d, threshold=2).collect()}
    # NY: F=2 (at threshold -> blank), M=3; CA: both 1 -> state gone; TX: F=3, no M rows -> null
    assert got == {"NY": (None, 3), "TX": (3, None)}


def test_distinct_on_or_off_same_result(spark):
    f, d = _fact_dim(spark)
    a = sorted(arrivals_by_state_gender(f, d, threshold=0).collect())
    b = sorted(arrivals_by_state_gender(f, d, threshold=0, distinct=True).collect())
    assert a == b
    assert sorted(arrivals_by_visa_gender(f, d).collect()) == sorted(arrivals_by_visa_gender(f, d, distinct=True).collect())


def test_visa_gender_no_threshold(spark):
    f, d = _fact_dim(spark)
    got = {r["visa_type"]: (r["F"], r["M"]) for r in arrivals_by_visa_gender(f, d).collect()}
    assert got == {"B1": (3, None), "B2": (None, 4), "F1": (3, None)}


def test_lookup_and_preaggregated_joins_keep_fact_rows(spark):
    fact = spark.createDataFrame([(1, "NY"), (2, "ZZ"), (3, None)], "id int, state_code string")
    dim = spark.createDataFrame([("NY", "New York")], "state_code string, state_name string")
    out = lookup_join(fact, dim.withColumnRenamed("state_code", "code"), "state_code", "code")
    assert sorted((r["id"], r["state_name"]) for r in out.collect()) == [(1, "New York"), (2, None), (3, None)]
    detail = spark.createDataFrame([("NY", 1), ("NY", 2), ("CA", 3)], "state_code string, n int")
    pre = preaggregated_join(fact, detail, "state_code", "state_code", [F.sum("n").alias("pop")])
    assert pre.count() == fact.count()
    readings = spark.createDataFrame([("NY", 2016, 4, 10.5)], "city string, y int, m int, t double")
    fm = fact.withColumns({"year": F.lit(2016), "month": F.lit(4)})
    mj = month_join(fm, readings, [("state_code", "city"), ("year", "y"), ("month", "m")])
    assert mj.count() == 3 and mj.filter("t is not null").count() == 1


def test_star_relations_keep_one_row_per_fact_row(spark):
    import datetime as dt
    from portmart.plans import star
    fact = spark.createDataFrame(
        [(1.0, 2016.0, 4.0, "NYC", "NY"), (2.0, 2016.0, 4.0, "ZZZ", "CA"), (3.0, 2016.0, 5.0, "NYC", None)],
        "cic_id double, year double, month double, city_code string, state_code string")
    dim_state = spark.createDataFrame([("NY", "New York"), ("CA", "California")], "state_code string, state_name string")
    dim_city = spark.createDataFrame([("NYC", "New York")], "city_code string, city_name string")
    got = {r["cic_id"]: (r["state_name"], r["city_name"])
           for r in star.fact_with_city_name(star.fact_with_state_name(fact, dim_state), dim_city).collect()}
    assert got == {1.0: ("New York", "New York"), 2.0: ("California", None), 3.0: (None, "New York")}
    demo = spark.createDataFrame(
        [("Albany", "NY", 100, 10, 1, "White", 50), ("Albany", "NY", 100, 10, 1, "Asian", 20),
         ("Buffalo", "NY", 200, 30, 2, "White", 150)],
        "city_code string, state_code string, total_population int, foreign_born_num int, number_of_veterans int, race string, count int")
    d5 = {r["cic_id"]: r["state_population"] for r in star.fact_with_state_demographics(fact, demo).collect()}
    assert d5 == {1.0: 300, 2.0: None, 3.0: None}
    temp = spark.createDataFrame(
        [(dt.date(2016, 4, 1), "New York", "United States", 10.0, 0.5, 2016, 4),
         (dt.date(2016, 4, 1), "New York", "Canada", -3.0, 0.5, 2016, 4)],
        "dt date, city_name string, country_name string, avg_temperature double, avg_temperature_delta double, year int, month int")
    d6 = {r["cic_id"]: r["avg_temperature"] for r in star.fact_with_temperature(fact, dim_city, temp).collect()}
    assert d6 == {1.0: 10.0, 2.0: None, 3.0: None}
    imm = spark.createDataFrame([(1.0, 101.0, 582.0), (2.0, None, float("nan"))],
                                "immigration_cic_id double, country_of_birth double, country_of_residence double")
    ctry = spark.createDataFrame([("101", "ALBANIA"), ("582", "MEXICO")], "country_code string, country_name string")
    d4 = {r["immigration_cic_id"]: (r["birth_country"], r["residence_country"])
          for r in star.immigrant_with_countries(imm, ctry).collect()}
    assert d4 == {1.0: ("ALBANIA", "MEXICO"), 2.0: (None, None)}


def test_sql_marts_equal_dataframe_marts(spark):
    from portmart.plans.marts import arrivals_by_state_gender_sql, arrivals_by_visa_gender_sql
    f, d = _fact_dim(spark)
    for t in (0, 1, 2, 3):
        assert sorted(arrivals_by_state_gender_sql(spark, f, d, threshold=t).collect()) == \
            sorted(arrivals_by_state_gender(f, d, threshold=t).collect())
    assert sorted(arrivals_by_visa_gender_sql(spark, f, d).collect()) == sorted(arrivals_by_visa_gender(f, d).collect())


def test_sql_pivot_keeps_pairs_whose_counted_column_is_null(spark):
    # a pair with rows but only null ids counts 0 (shown), without a threshold; with one it is
    # blanked, and a key left with no pair is dropped, exactly as pivot_counts does
    from portmart.operators.pivot import pivot_counts
    from portmart.plans.marts import sql_pivot_counts
    df = spark.createDataFrame(
        [("a", "F", None), ("a", "M", 1), ("a", "M", 2), ("b", "F", None), ("c", "X", 5), ("d", "F", 7)],
        "k string, g string, id int")
    df.createOrReplaceTempView("pivot_probe")
    for t in (None, 0, 1):
        want = sorted(pivot_counts(df, ["k"], "g", ["F", "M"], count_col="id", threshold=t).collect())
        got = sorted(spark.sql(sql_pivot_counts("pivot_probe", "k", "g", ("F", "M"), "id", t)).collect())
        assert got == want, t
    rows = {r["k"]: (r["F"], r["M"]) for r in spark.sql(sql_pivot_counts("pivot_probe", "k", "g", ("F", "M"), "id")).collect()}
    assert rows == {"a": (0, 2), "b": (0, None), "d": (1, None)}
