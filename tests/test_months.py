"""Months published together, the index of landed files, maintained marts."""

import re

import pytest
from pyspark.sql import functions as F

from portmart import schemas
from portmart.plans import months as M
from portmart.plans import tables as H
from portmart.plans.marts import arrivals_by_state_gender, arrivals_by_visa_gender
from portmart.sinks.versions import Version
from portmart.streaming.landed import read_index, run_month_stream
from test_jobs import arrival


def raw(spark, *rows):
    """(cicid, month, state, gender) rows."""
    return spark.createDataFrame([arrival(cicid=c, i94mon=m, i94addr=s, gender=g, arrdate=20500.0) for c, m, s, g in rows], schemas.RAW_ARRIVALS)


def keys(df, id_col="cic_id"):
    return sorted((str(r["month"]), str(r[id_col])) for r in df.collect())


def test_refresh_replaces_months_in_all_tables(spark, tmp):
    M.refresh_months(raw(spark, (1.0, 3.0, "NY", "F"), (2.0, 3.0, "NY", "M"), (3.0, 4.0, "CA", "M")), tmp)
    report = M.refresh_months(raw(spark, (9.0, 4.0, "CA", "F"), (9.0, 4.0, "CA", "F"), (2.0, 4.0, "CA", "F")), tmp)
    store = M.arrival_months(spark, tmp)
    assert report.version.number == 2 and (report.rows_in, report.repeated, report.without_key) == (3, 1, 0)
    assert report.counts == {M.FACT: 4, M.DIM: 4, M.COUNTS: 3}
    want = [("3.0", "1.0"), ("3.0", "2.0"), ("4.0", "2.0"), ("4.0", "9.0")]
    assert keys(store.read(M.FACT)) == keys(store.read(M.DIM), "immigration_cic_id") == want
    assert store.read(M.FACT).schema.names == schemas.FACT_IMMIGRATION.names
    # an older version still reads as it was
    assert keys(store.read(M.FACT, store.version(1))) == [("3.0", "1.0"), ("3.0", "2.0"), ("4.0", "3.0")]


def test_a_break_between_the_tables_changes_nothing(spark, tmp):
    M.refresh_months(raw(spark, (1.0, 3.0, "NY", "F")), tmp)
    store = M.arrival_months(spark, tmp)
    cleaned = H.clean_month_arrivals(raw(spark, (2.0, 3.0, "CA", "M")), drop_null_keys=False)
    broken = H.build_month_immigrant_dim(cleaned).withColumn("gender", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        store.publish({M.FACT: H.build_month_fact(cleaned), M.DIM: broken})
    assert store.versions() == [1]
    assert keys(store.read(M.FACT)) == keys(store.read(M.DIM), "immigration_cic_id") == [("3.0", "1.0")]
    # what the broken refresh left is cleared away, what is named stays
    assert M.FACT in [g.split("/")[0] for g in store.vacuum(keep=1, older_than_s=-5)]
    assert keys(store.read(M.FACT)) == keys(store.read(M.DIM), "immigration_cic_id") == [("3.0", "1.0")]


def test_vacuum_leaves_young_folders_and_kept_versions(spark, tmp):
    for g in "FM":
        M.refresh_months(raw(spark, (1.0, 3.0, "NY", g)), tmp)
    store = M.arrival_months(spark, tmp)
    assert store.vacuum(keep=2, older_than_s=-5) == [] and store.vacuum(keep=1) == []
    assert store.versions() == [2] and [r["gender"] for r in store.read(M.DIM).collect()] == ["M"]


def test_two_refreshes_at_once_both_count(spark, tmp):
    M.refresh_months(raw(spark, (1.0, 3.0, "NY", "F")), tmp)
    store, other = M.arrival_months(spark, tmp), M.arrival_months(spark, tmp)
    plain = store._commit

    def late(version):
        if not late.done:  # another refresh takes the number first
            late.done = True
            M.refresh_months(raw(spark, (5.0, 5.0, "TX", "M")), tmp)
        return plain(version)
    late.done = False
    store._commit = late
    cleaned = H.clean_month_arrivals(raw(spark, (2.0, 4.0, "CA", "M")))
    version = store.publish({M.FACT: H.build_month_fact(cleaned), M.DIM: H.build_month_immigrant_dim(cleaned), M.COUNTS: M.month_counts(cleaned)})
    assert version.number == 3
    assert keys(other.read(M.FACT)) == [("3.0", "1.0"), ("4.0", "2.0"), ("5.0", "5.0")]
    assert other._commit(Version(3, {})) is False


def test_month_filter_prunes_folders(spark, tmp):
    M.refresh_months(raw(spark, (1.0, 3.0, "NY", "F"), (2.0, 4.0, "NY", "F"), (3.0, 5.0, "NY", "M")), tmp)
    plan = M.arrival_months(spark, tmp).read(M.FACT).filter("month = 4.0")
    assert [r["cic_id"] for r in plan.collect()] == [2.0]
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*month#\d+ = 4\.0", text)


def test_rows_without_key_are_kept_and_counted(spark, tmp):
    rows = [(None, 3.0, "NY", "F"), (None, 3.0, "CA", "F"), (7.0, None, "NY", "M"), (float(1 << 41), 3.0, "NY", "M"), (2.5, 3.0, "TX", "F"), (-1.0, 3.0, "TX", "F"), (1.0, 3.0, "NY", "M")]
    report = M.refresh_months(raw(spark, *rows), tmp)
    assert (report.rows_in, report.repeated, report.without_key) == (7, 1, 2)
    store = M.arrival_months(spark, tmp)
    fact, dim = store.read(M.FACT), store.read(M.DIM)
    assert fact.count() == dim.count() == 6 and fact.select("immigration_id").distinct().count() == 6
    assert sorted(r[0] for r in fact.select("immigration_id").collect()) == sorted(r[0] for r in dim.select("immi_demographics_id").collect())
    assert fact.filter("month is null").count() == 1
    again = M.refresh_months(raw(spark, *rows[2:3]), tmp)  # the month without a number is a month too
    assert store.read(M.FACT).count() == 6 and again.without_key == 1
    for kept, asked in ((M.kept_arrivals_by_state_gender(store, threshold=None), arrivals_by_state_gender(fact, dim, threshold=None)),
                        (M.kept_arrivals_by_visa_gender(store), arrivals_by_visa_gender(fact, dim))):
        assert sorted(map(str, kept.collect())) == sorted(map(str, asked.collect()))


def test_marts_after_refreshes_equal_a_recount(spark, tmp):
    import random
    rng = random.Random(4)
    store = M.arrival_months(spark, tmp)
    for months in ((1.0, 2.0, 3.0), (2.0,), (3.0, 4.0)):
        rows = [(float(rng.randrange(60)), rng.choice(months), rng.choice(["NY", "CA", None]), rng.choice(["F", "M", "X", None])) for _ in range(150)]
        M.refresh_months(raw(spark, *rows).withColumn("visatype", F.when(F.col("cicid") % 2 == 0, "B2").otherwise("WT")), tmp)
        fact, dim = store.read(M.FACT), store.read(M.DIM)
        for threshold in (None, 5):
            kept, asked = M.kept_arrivals_by_state_gender(store, threshold=threshold), arrivals_by_state_gender(fact, dim, threshold=threshold)
            assert sorted(map(str, kept.collect())) == sorted(map(str, asked.collect())) and kept.count()
        assert sorted(map(str, M.kept_arrivals_by_visa_gender(store).collect())) == sorted(map(str, arrivals_by_visa_gender(fact, dim).collect()))
    assert "fact_immigration" not in M.kept_arrivals_by_visa_gender(store)._jdf.queryExecution().executedPlan().toString()


def test_stream_reads_only_files_of_touched_months(spark, tmp):
    land, out, ck = f"{tmp}/landing here", f"{tmp}/tables", f"{tmp}/ck"
    read = []

    def run():
        read.clear()
        run_month_stream(spark, land, out, checkpoint=ck, on_batch=lambda epoch, files, report, bad: read.append((len(files), report.rows_in)))

    def land_file(*rows):
        raw(spark, *rows).coalesce(1).write.mode("append").parquet(land)
    for m in range(1, 9):
        land_file((float(m), float(m), "NY", "F"))
    run()
    assert read == [(8, 8)]
    land_file((100.0, 4.0, "CA", "M"), (101.0, 5.0, "CA", "M"))
    run()
    assert read == [(3, 4)]  # of nine landed files, the three that hold April or May
    land_file((4.0, 4.0, "CA", "M"))  # an arrival that landed before, again
    run()
    assert read == [(3, 3)]  # three files hold rows of April
    store = M.arrival_months(spark, out)
    assert store.read(M.FACT).count() == 10 and store.read(M.FACT).filter("month = 4").count() == 2
    run()
    assert read == []
    index = read_index(spark, out)
    assert index.count() == 11 and index.select("file").distinct().count() == 10


def test_stream_of_csv_checks_headers_and_counts_cells(spark, tmp):
    import os
    land, out = f"{tmp}/csv", f"{tmp}/tables"
    os.makedirs(land)
    names = schemas.RAW_ARRIVALS.names

    def file(name, header, cells):
        with open(f"{land}/{name}", "w") as fh:
            fh.write(",".join(header) + "\n" + ",".join(cells.get(c, "") for c in names) + "\n")
    file("a.csv", names, {"cicid": "1", "i94yr": "2016", "i94mon": "3", "arrdate": "soon"})
    said = []
    run_month_stream(spark, land, out, checkpoint=f"{tmp}/ck", fmt="csv", on_batch=lambda *a: said.append(a[3]))
    assert said == [{"arrdate": 1}] and M.arrival_months(spark, out).read(M.FACT).count() == 1
    file("b.csv", ["other", *names[1:]], {"cicid": "2", "i94yr": "2016", "i94mon": "4"})
    with pytest.raises(Exception):
        run_month_stream(spark, land, out, checkpoint=f"{tmp}/ck", fmt="csv")
    assert M.arrival_months(spark, out).version().number == 1
