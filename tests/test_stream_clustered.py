"""Late and repeated arrivals in a stateful stream (H20), clustering by two columns (A10)."""

import glob
import random

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from portmart import schemas
from portmart.plans.tables import clean_month_arrivals
from portmart.sinks.clustered import write_clustered
from portmart.streaming.arrivals import read_arrivals, run_arrival_stream
from test_jobs import arrival


def land(spark, path, *rows):
    made = [arrival(cicid=float(c), i94mon=float(m), arrdate=d, i94addr="NY", gender="F", i94yr=2016.0) for c, m, d in rows]
    spark.createDataFrame(made, schemas.RAW_ARRIVALS).coalesce(1).write.mode("append").parquet(path)


def test_late_and_repeated_files_equal_batch(spark, tmp):
    day = lambda m, d=1: float(20454 + 30 * (m - 1) + d)  # days of 2016
    landing, out, ck = f"{tmp}/in", f"{tmp}/out", f"{tmp}/ck"
    jan, feb, mar = [(i, 1, day(1, i)) for i in range(5)], [(i, 2, day(2, i)) for i in range(5)], [(i, 3, day(3, i)) for i in range(5)]
    run = lambda: run_arrival_stream(spark, landing, out, ck, max_files_per_trigger=1)
    land(spark, landing, *jan, *jan[:2])
    land(spark, landing, *mar)
    assert run() == {"rows": 12, "late_rows": 0, "undated_rows": 0}
    land(spark, landing, *feb)  # late, within the delay
    land(spark, landing, *jan)  # a file that comes again
    land(spark, landing, (9, 3, None), (9, 3, None))  # no day: the month's first
    assert run()["late_rows"] == 0
    land(spark, landing, *mar, (77, 3, day(3, 2)))
    run()
    got = read_arrivals(spark, out).select("cicid", "i94yr", "i94mon", "arrdate")
    batch = clean_month_arrivals(spark.read.schema(schemas.RAW_ARRIVALS).parquet(landing)).select("cicid", "i94yr", "i94mon", "arrdate")
    assert sorted(map(str, got.collect())) == sorted(map(str, batch.collect())) and got.count() == 17
    assert spark.read.parquet(f"{out}/arrivals").filter("month = 2").count() == 5


def test_too_late_rows_are_counted_and_undated_ones_kept(spark, tmp):
    landing, out, ck = f"{tmp}/in", f"{tmp}/out", f"{tmp}/ck"
    land(spark, landing, (1, 12, 20790.0))
    run_arrival_stream(spark, landing, out, ck)
    made = [arrival(cicid=5.0, i94mon=None, arrdate=None, i94addr="NY", gender="F", i94yr=None)]
    spark.createDataFrame(made, schemas.RAW_ARRIVALS).coalesce(1).write.mode("append").parquet(landing)
    land(spark, landing, (2, 1, 20455.0))  # eleven months late
    land(spark, landing, (3, 12, 20791.0))
    said = run_arrival_stream(spark, landing, out, ck, max_files_per_trigger=1)
    assert said["rows"] == 3 and said["late_rows"] == 1
    assert sorted(r["cicid"] for r in read_arrivals(spark, out).collect()) == [1.0, 3.0, 5.0]


def groups_for(path, column, value):
    n = hit = 0
    for file in glob.glob(f"{path}/part-*.parquet"):
        meta = pq.ParquetFile(file).metadata
        for g in range(meta.num_row_groups):
            for i in range(meta.num_columns):
                c = meta.row_group(g).column(i)
                if c.path_in_schema == column:
                    n += 1
                    hit += c.statistics.min <= value <= c.statistics.max
    return hit, n


def test_filters_on_either_column_read_few_groups(spark, tmp):
    rng = random.Random(3)
    states = [f"{a}{b}" for a in "ACMNT" for b in "ALXYZ"]
    rows = [(i, rng.choice(states), rng.randrange(1, 13)) for i in range(20000)]
    df = spark.createDataFrame(rows, "id int, state string, month int")
    write_clustered(df, f"{tmp}/z", ["state", "month"], files=64)
    df.repartitionByRange(64, "month", "state").sortWithinPartitions("month", "state").write.parquet(f"{tmp}/sorted")
    assert sorted(map(tuple, spark.read.parquet(f"{tmp}/z").collect())) == rows
    both = {}
    for layout in ("z", "sorted"):
        both[layout] = [groups_for(f"{tmp}/{layout}", "state", "MX"), groups_for(f"{tmp}/{layout}", "month", 7)]
    (state, n), (month, _) = both["z"]
    assert n >= 32 and state <= n / 3 and month <= n / 3  # either filter leaves most groups unread
    assert state < both["sorted"][0][0]  # sorted by month first, a state is in most of its months' groups


def test_nulls_ties_and_odd_columns(spark, tmp):
    rows = [(None, None, None)] * 5 + [("é" * 20, 1.5, i) for i in range(20)] + [("", float("nan"), 3)]
    df = spark.createDataFrame(rows, "`a b` string, x double, i int")
    write_clustered(df, f"{tmp}/z", ["a b", "x"], files=3)
    assert spark.read.parquet(f"{tmp}/z").count() == len(rows)
    write_clustered(df.limit(0), f"{tmp}/none", ["a b", "x"], files=3)
    assert spark.read.schema(df.schema).parquet(f"{tmp}/none").count() == 0
    days = df.withColumn("d", F.date_add(F.lit("2020-01-01").cast("date"), F.coalesce("i", F.lit(0))))
    write_clustered(days, f"{tmp}/d", ["d", "i"], files=3)
    assert spark.read.parquet(f"{tmp}/d").count() == len(rows)
