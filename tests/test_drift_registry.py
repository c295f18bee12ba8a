"""Profiles over drifting files (C6), stable ids (B12, H7), rejected CSV records."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from portmart import schemas
from portmart.operators.drift import FileProfiles
from portmart.operators.profile import missing_profile_over_files
from portmart.operators.registry import KeyRegistry
from portmart.plans import jobs as P
from portmart.plans import tables as H
from portmart.sinks.versions import Conflict, VersionedTables
from portmart.sources.quarantine import TooManyRejected, read_csv_split


def rows(df):
    return {r["field"]: (r["types"], r["nulls"], r["rows_with"], r["rows"]) for r in df.collect()}


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_files_with_extra_and_missing_columns(spark, tmp, fmt):
    data, states = f"{tmp}/data 1+1", f"{tmp}/states"

    def file(name, schema, *values):
        df = spark.createDataFrame(list(values), schema).coalesce(1)
        (df.write.option("header", True).csv(f"{data}/{name}") if fmt == "csv" else df.write.parquet(f"{data}/{name}"))
    text, number = ("string", "string") if fmt == "csv" else ("string", "double")
    profiles = FileProfiles(spark, states, fmt)
    file("a", "k int, v double", (1, 1.0), (2, None), (3, None if fmt == "csv" else float("nan")))
    assert len(profiles.refresh(data)) == 1 and profiles.refresh(data) == []
    file("b", "k int, note string", (4, None), (None, "x"))
    file("c", "k int, v string", (5, "q"))
    scanned = profiles.refresh(data)
    assert len(scanned) == 2 and not any("/a/" in f for f in scanned)
    k = "string" if fmt == "csv" else "int"
    want = {"k": ([k], 1, 6, 6), "v": (sorted({number, text}), 2, 4, 6), "note": ([text], 1, 2, 6)}
    assert rows(profiles.total(data)) == want
    assert {r["field"]: round(r["pct_missing"], 3) for r in profiles.total(data, limit=20.0).collect()} == {"v": 33.333}
    # a file that went away or changed no longer counts with its old state
    gone = [f for f in os.listdir(f"{data}/b") if f.startswith("part-")][0]
    os.replace(f"{data}/b/{gone}", f"{tmp}/moved")
    assert rows(profiles.total(data)) == {"k": ([k], 0, 4, 4), "v": (sorted({number, text}), 2, 4, 4)}


def test_one_schema_equals_the_whole_profile(spark, tmp):
    df = spark.range(100).select("id", F.when(F.col("id") % 3 == 0, F.col("id")).alias("x"), F.lit(None).cast("string").alias("y"))
    df.repartition(5).write.parquet(f"{tmp}/d")
    df.limit(0).write.parquet(f"{tmp}/d/none")
    profiles = FileProfiles(spark, f"{tmp}/s")
    assert len(profiles.refresh(f"{tmp}/d")) >= 6 and profiles.refresh(f"{tmp}/d") == []
    whole = missing_profile_over_files(spark.read.option("recursiveFileLookup", True).parquet(f"{tmp}/d"))
    got = profiles.total(f"{tmp}/d").select("field", "nulls", "rows", "pct_missing")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, whole.collect()))


KEYS = StructType([StructField("city", StringType()), StructField("n", IntegerType())])


def test_ids_stay_and_have_no_gap(spark, tmp):
    reg = KeyRegistry(spark, f"{tmp}/ids", KEYS)
    first = spark.createDataFrame([("b", 1), ("a", 1), ("a", None), ("a", 1), (None, None)], KEYS)
    one = {tuple(r)[:2]: r["id"] for r in reg.assign(first.withColumn("v", F.lit(0)), "id").select("city", "n", "id").collect()}
    assert sorted(one.values()) == [1, 2, 3, 4]
    more = spark.createDataFrame([("0", 1), ("a", 1), ("z", 9), (None, 5)], KEYS).withColumnRenamed("city", "town")
    two = {tuple(r)[:2]: r["key"] for r in reg.assign(more, "key", on=["town", "n"]).select("town", "n", "key").collect()}
    assert two[("a", 1)] == one[("a", 1)] and sorted({*one.values(), *two.values()}) == list(range(1, 8))
    assert reg.register(more.withColumnRenamed("town", "city")) == 0
    assert {tuple(r)[:2]: r["id"] for r in reg.read().collect()} == one | two
    assert reg.register(spark.createDataFrame([], KEYS)) == 0
    with pytest.raises(ValueError):
        KeyRegistry(spark, f"{tmp}/x", StructType([StructField("ID", StringType())]))


def test_overtaken_registration_starts_again(spark, tmp):
    reg, other = KeyRegistry(spark, f"{tmp}/ids", KEYS), KeyRegistry(spark, f"{tmp}/ids", KEYS)
    plain, calls = reg.store._write, []

    def slow(*a):
        if not calls:  # meanwhile another registration is published
            calls.append(other.register(spark.createDataFrame([("x", 1), ("y", 1)], KEYS)))
        return plain(*a)
    reg.store._write = slow
    assert reg.register(spark.createDataFrame([("y", 1), ("w", 1)], KEYS)) == 1 and calls == [2]
    assert sorted((r["city"], r["id"]) for r in reg.read().collect()) == [("w", 3), ("x", 1), ("y", 2)]


def test_publish_can_insist_on_its_version(spark, tmp):
    schema = StructType([StructField("v", IntegerType()), StructField("year", DoubleType()), StructField("month", DoubleType())])
    store = VersionedTables(spark, tmp, {"t": schema})
    start = store.version()
    store.publish({"t": spark.createDataFrame([(1, 2016.0, 1.0)], schema)}, expect=start)
    with pytest.raises(Conflict):
        store.publish({"t": spark.createDataFrame([(2, 2016.0, 2.0)], schema)}, expect=start)
    assert [r["v"] for r in store.read("t").collect()] == [1]


HEADER = ";".join(schemas.RAW_DEMOGRAPHICS.names)


def demographics(path, *lines):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/d.csv", "w") as fh:
        fh.write("\n".join([HEADER, *lines]) + "\n")


def test_rejected_records_come_back_with_file_and_reason(spark, tmp):
    good = "Rome;Ohio;30.5;1;2;3;4;5;2.5;OH;White;7"
    demographics(f"{tmp}/in", good, "Bath;Ohio;old;1;2;3;4;5;2.5;OH;White;many", "Lyon;Ohio;30.5;1", "Nice;Ohio;30.5;1;2;3;4;5;2.5;OH;White;7;8", "Pisa;Ohio;;1;2;3;4;5;2.5;OH;White;7")
    split = read_csv_split(spark, f"{tmp}/in", schemas.RAW_DEMOGRAPHICS, f"{tmp}/bad", ";")
    assert (split.rows, split.rejected_rows) == (5, 3) and sorted(r["City"] for r in split.good.collect()) == ["Pisa", "Rome"]
    assert split.good.schema == schemas.RAW_DEMOGRAPHICS
    got = {r["record"].split(";")[0]: (r["reasons"], r["file"].rsplit("/", 1)[1]) for r in split.rejected.collect()}
    assert got == {"Bath": (["Median Age: old", "Count: many"], "d.csv"), "Lyon": (["cells"], "d.csv"), "Nice": (["cells"], "d.csv")}


def test_jobs_with_quarantine_and_limit(spark, tmp):
    lines = [f"City{i};Ohio;30.5;1;2;3;4;5;2.5;OH;White;7" for i in range(9)] + ["Bath;Ohio;old;1;2;3;4;5;2.5;OH;White;7"]
    demographics(f"{tmp}/in", *lines)
    res = P.process_demographics(spark, f"{tmp}/in", f"{tmp}/out", on_fail="raise", quarantine=P.Quarantine(f"{tmp}/bad", max_share=0.1))
    assert res.rejected == 1 and spark.read.parquet(res.tables["dim_city_demographics"]).count() == 9
    with pytest.raises(TooManyRejected):
        P.process_demographics(spark, f"{tmp}/in", f"{tmp}/out2", quarantine=P.Quarantine(f"{tmp}/bad2", max_rejected=0))
    assert not os.path.exists(f"{tmp}/out2") and spark.read.parquet(f"{tmp}/bad2").count() == 1
    without = P.process_demographics(spark, f"{tmp}/in", f"{tmp}/out3")  # as before: bad cells are null and counted
    assert without.malformed == {"Median Age": 1} and spark.read.parquet(without.tables["dim_city_demographics"]).count() == 10


def test_demographics_ids_stay_over_refreshes(spark, tmp):
    def run(*names):
        demographics(f"{tmp}/in", *[f"{n};Ohio;30.5;1;2;3;4;5;2.5;OH;White;7" for n in names])
        res = P.process_demographics(spark, f"{tmp}/in", f"{tmp}/out", on_fail="raise", id_path=f"{tmp}/ids")
        return {r["city_code"]: r["id"] for r in spark.read.parquet(res.tables["dim_city_demographics"]).collect()}
    one, two = run("M", "C", "T"), run("A", "T", "M", "Z")
    assert sorted(one.values()) == [1, 2, 3] and (two["T"], two["M"]) == (one["T"], one["M"]) and sorted((two["A"], two["Z"])) == [4, 5]
    assert H.city_demographics_ids(spark, f"{tmp}/ids").read().count() == 5


def test_small_result_to_the_driver(spark):
    """The first rows as pandas, no more than asked for."""
    from portmart.sources.files import preview
    df = spark.range(100).select("id", (F.col("id") * 2).alias("twice")).orderBy("id")
    got = preview(df, 3)
    assert got.columns.tolist() == ["id", "twice"] and got["twice"].tolist() == [0, 2, 4]
    assert len(preview(df.limit(2))) == 2 and "GlobalLimit" in df.limit(3)._jdf.queryExecution().optimizedPlan().toString()


def test_registration_asks_once_and_keeps_repeats_and_nulls_apart(spark, tmp):
    """Keys that are null or repeat, over two registrations; one exchange tells the new ones, and the folder is
    written as the ranges are, without another one."""
    from portmart.sinks.writers import write_partitioned
    reg = KeyRegistry(spark, f"{tmp}/ids", KEYS)
    names = KEYS.names
    first = spark.createDataFrame([tuple(v if i == 0 else None for i in range(len(names))) for v in ("b", None, "b", None)], KEYS)
    assert reg.register(first) == 2
    more = spark.createDataFrame([tuple(v if i == 0 else None for i in range(len(names))) for v in ("c", "b", None, "a", "a")], KEYS)
    plan = reg._unknown(more, reg.store.version())._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    assert reg.register(more) == 2 and reg.register(more) == 0
    assert {r[names[0]]: r["id"] for r in reg.read().collect()} == {None: 1, "b": 2, "a": 3, "c": 4}
    assert all(len([f for f in os.listdir(d) if f.endswith(".parquet")]) == 1 for d, _, fs in os.walk(f"{tmp}/ids/ids") if any(f.endswith(".parquet") for f in fs))
    write_partitioned(spark.range(99, numPartitions=3).selectExpr("id", "1 AS p"), f"{tmp}/plain", ["p"], rebalance=False)
    assert len([f for f in os.listdir(f"{tmp}/plain/p=1") if f.endswith(".parquet")]) == 3
