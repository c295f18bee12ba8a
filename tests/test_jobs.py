"""Whole jobs on hand-made raw files."""

import os

import pytest
from pyspark.sql import functions as F

from portmart import schemas
from portmart.plans import jobs as P
from portmart.plans.marts import arrivals_by_state_gender
from portmart.plans.tables import build_fact
from portmart.sinks.writers import write_partitioned
from portmart.sources.sas import read_sas, xport_row_range
from test_lookups import LABEL_LINES, CITY, COUNTRY, STATE
from xport import write_xport

ARR_COLS = [(f.name, "num" if f.dataType.typeName() == "double" else "char", 8 if f.dataType.typeName() == "double" else 10)
            for f in schemas.RAW_ARRIVALS.fields]
NAMES = [c[0] for c in ARR_COLS]


def arrival(**kw):
    base = {n: None for n in NAMES}
    base.update({"i94yr": 2016.0, "i94mon": 4.0, "i94cit": 101.0, "i94res": 101.0, "i94port": "NYC",
                 "i94mode": 1.0, "i94visa": 2.0, "visatype": "B2", "biryear": 1980.0, "count": 1.0})
    base.update(kw)
    return tuple(base[n] for n in NAMES)


FILE1 = [
    arrival(cicid=1.0, i94addr="NY", arrdate=20574.0, depdate=20580.0, gender="M"),
    arrival(cicid=1.0, i94addr="NY", arrdate=20574.0, depdate=20580.0, gender="F"),   # dup cicid (T10)
    arrival(cicid=2.0, i94addr="CA", arrdate=0.0, depdate=None, gender="F"),          # 0 -> null (T6)
    arrival(cicid=3.0, i94addr=None, arrdate=1.9, depdate=-0.5, gender="M"),          # floor (T7), null state
    arrival(cicid=None, i94addr="TX", arrdate=20575.0, gender="M"),                   # null key (T11)
]
FILE2 = [
    arrival(cicid=None, i94addr="TX", arrdate=20576.0, gender="F"),
    arrival(cicid=4.0, i94addr="", arrdate=float("nan"), gender="X", occup="ENG"),    # NaN (T8), empty state
    tuple(None for _ in NAMES),                                                       # all-null row
]

TEMPERATURE_CSV = """dt,AverageTemperature,AverageTemperatureUncertainty,City,Country,Latitude,Longitude
2010-01-01,,1.0,Aarhus,Denmark,57.05N,10.33E
2010-01-01,3.5,1.0,Aarhus,Denmark,57.05N,10.33E
2010-1-1,4.5,1.0,Aarhus,Denmark,57.05N,10.33E
nope,5.0,1.0,Aarhus,Denmark,57.05N,10.33E
2010-02-01,NaN,1.0,Aarhus,Denmark,57.05N,10.33E
"""

DEMOGRAPHICS_CSV = """City;State;Median Age;Male Population;Female Population;Total Population;Number of Veterans;Foreign-born;Average Household Size;State Code;Race;Count
Silver Spring;Maryland;33.8;40601;41862;82463;1562;30908;2.6;MD;Hispanic or Latino;25924
Silver Spring;Maryland;33.8;40601;41862;82463;1562;30908;2.6;MD;Hispanic or Latino;25924
Quincy;Massachusetts;41.0;44129;49500;93629;4147;32935;2.39;MA;White;58723
;;;;;;;;;;;
"""


@pytest.fixture()
def raw(tmp):
    os.makedirs(f"{tmp}/arrivals")
    write_xport(f"{tmp}/arrivals/i94_apr16_a.xpt", ARR_COLS, FILE1)
    write_xport(f"{tmp}/arrivals/i94_apr16_b.xpt", ARR_COLS, FILE2)
    with open(f"{tmp}/arrivals/README.txt", "w") as fh:  # not a SAS file: must be skipped
        fh.write("monthly arrivals\n")
    with open(f"{tmp}/temperature.csv", "w") as fh:
        fh.write(TEMPERATURE_CSV)
    with open(f"{tmp}/demographics.csv", "w") as fh:
        fh.write(DEMOGRAPHICS_CSV)
    with open(f"{tmp}/labels.SAS", "w") as fh:
        fh.write("\n".join(LABEL_LINES) + "\n")
    return tmp


def test_sas_scan_one_partition_per_file(spark, raw):
    df = read_sas(spark, f"{raw}/arrivals", sas_format="xport", chunk_size=2)
    assert df.rdd.getNumPartitions() == 2
    rows = df.collect()
    assert len(rows) == len(FILE1) + len(FILE2)
    assert df.schema == schemas.RAW_ARRIVALS
    by = {r["cicid"]: r for r in rows if r["cicid"] is not None}
    assert by[2.0]["arrdate"] == 0.0            # IBM zero snapped back to 0
    assert by[4.0]["arrdate"] is None            # SAS missing (NaN) arrives as null
    assert by[1.0]["arrdate"] == 20574.0
    # per-file view of the scan (A12): each row knows its file; profiles add up per file
    from portmart.operators.profile import missing_counts_by_file
    tagged = read_sas(spark, f"{raw}/arrivals", sas_format="xport", with_source_file=True)
    per_file = {(r["source_file"].rsplit("/", 1)[-1], r["field"]): (r["nulls"], r["rows"]) for r in
                missing_counts_by_file(tagged, F.col("source_file"), ["cicid"]).collect()}
    assert per_file == {("i94_apr16_a.xpt", "cicid"): (1, 5), ("i94_apr16_b.xpt", "cicid"): (2, 3)}


def test_xport_row_ranges_cover_every_row_once():
    # byte ranges of any size, aligned or not with the records, give disjoint row ranges whose
    # union is every row
    for record_start in (0, 80, 960):
        for length in (8, 80, 104, 333):
            for nobs in (0, 1, 7, 50):
                size = record_start + nobs * length + 37
                for split in (1, 50, 80, 81, 1000, size):
                    got = []
                    for lo_b in range(0, size, split):
                        lo, hi = xport_row_range(record_start, length, nobs, lo_b, min(lo_b + split, size))
                        assert 0 <= lo <= hi <= nobs
                        got.extend(range(lo, hi))
                    assert got == list(range(nobs))


def test_large_xport_file_is_read_by_many_tasks(spark, tmp):
    # one file holding all rows: byte-range splits decode it in many tasks, same rows as one task
    os.makedirs(f"{tmp}/big")
    rows = [arrival(cicid=float(i), i94addr=("NY", "CA", "TX")[i % 3], arrdate=20574.0 + i % 30,
                    gender="MF"[i % 2]) for i in range(997)]
    write_xport(f"{tmp}/big/i94_big.xpt", ARR_COLS, rows)
    whole = read_sas(spark, f"{tmp}/big", sas_format="xport", chunk_size=64)
    split = read_sas(spark, f"{tmp}/big", sas_format="xport", chunk_size=64, split_bytes=4_001,
                     with_source_file=True)
    assert whole.rdd.getNumPartitions() == 1
    assert split.rdd.getNumPartitions() > 20
    per_task = split.rdd.glom().map(len).collect()
    assert max(per_task) < len(rows) // 10
    a = sorted(tuple(r) for r in whole.collect())
    b = sorted(tuple(r)[:-1] for r in split.collect())
    assert len(b) == len(rows) and a == b
    assert [r[0] for r in a] == [float(i) for i in range(997)]


def test_all_jobs(spark, raw):
    out = f"{raw}/tables"
    res = P.run_all(spark, P.Inputs(labels=f"{raw}/labels.SAS", arrivals=f"{raw}/arrivals",
                                    demographics=f"{raw}/demographics.csv", temperature=f"{raw}/temperature.csv",
                                    sas_format="xport", country_lines=COUNTRY, city_lines=CITY,
                                    state_lines=STATE), out, on_fail="raise")
    assert all(r["passed"] for job in res.values() for r in job.checks)
    # arrivals: 8 raw -> dedup (1, 2, 3, 4, null) -> drop the all-null survivor? (null key group keeps one row)
    steps = res["arrivals"].steps
    assert steps[0][2] == 8 and steps[1][3] == 5
    fact = spark.read.parquet(f"{out}/fact_immigration")
    got = {r["cic_id"]: r for r in fact.collect()}
    assert got[1.0]["arrival_date"] == "2016-04-30"
    assert got[2.0]["arrival_date"] is None and got[2.0]["departure_date"] is None
    assert got[3.0]["arrival_date"] == "1960-01-02" and got[3.0]["departure_date"] == "1959-12-31"
    assert got[4.0]["arrival_date"] is None
    # null and empty partition values both come back as null
    assert got[3.0]["state_code"] is None and got[4.0]["state_code"] is None
    # the fact and the dimension were built from the same survivor of cicid 1
    dim = spark.read.parquet(f"{out}/dim_immigrant_demographics")
    assert {r["immigration_cic_id"]: r["gender"] for r in dim.collect()}[1.0] == "F"
    # ids written are unique and non-null
    assert fact.select("immigration_id").distinct().count() == fact.count()
    # demographics: duplicate and all-null row removed (T5), State Code is the state_code
    demo = spark.read.parquet(f"{out}/dim_city_demographics")
    assert demo.count() == 2 and {r["state_code"] for r in demo.collect()} == {"MD", "MA"}
    temp = spark.read.parquet(f"{out}/dim_temperature").collect()
    # null and NaN readings dropped; two spellings of one date stay two rows (T12); bad text -> null date
    assert len(temp) == 3
    assert sorted(str(r["dt"]) for r in temp) == ["2010-01-01", "2010-01-01", "None"]
    country = {r[0]: r[1] for r in spark.read.parquet(f"{out}/dim_country").collect()}
    assert country["582"] == "MEXICO"
    # mart over the written tables
    mart = arrivals_by_state_gender(fact, dim, threshold=0).collect()
    # GROUP BY keeps the null state as its own group; the null-cicid row never joins; X is filtered
    assert {r["state_code"]: (r["F"], r["M"]) for r in mart} == {"NY": (1, None), "CA": (1, None), None: (None, 1)}


def test_schema_check_fails_on_bad_table(spark, raw):
    from portmart.operators.quality import schema_check
    bad = spark.read.csv(f"{raw}/demographics.csv", header=True, sep=";")   # all strings
    r = schema_check(spark, bad, "dim_city_demographics", schemas.DIM_CITY_DEMOGRAPHICS).first()
    assert not r["passed"]


def _months(spark, *keys):
    return spark.createDataFrame([arrival(cicid=float(i), i94mon=float(m), i94addr=s, arrdate=20500.0 + i, gender="M")
                                  for i, m, s in keys], schemas.RAW_ARRIVALS)


def test_month_refresh_keeps_other_months(spark, tmp):
    out = f"{tmp}/tables"
    P.publish_arrivals_months(_months(spark, (1, 3, "NY"), (2, 3, "NY"), (3, 4, "NY"), (4, 4, "CA")), out)
    P.refresh_arrivals_months(_months(spark, (9, 4, "CA"), (2, 4, "CA")), out)
    fact = spark.read.parquet(f"{out}/fact_immigration").collect()
    # April is replaced as a whole, March stays; an arrival number may come again in another month
    assert sorted((r["month"], r["cic_id"]) for r in fact) == [(3.0, 1.0), (3.0, 2.0), (4.0, 2.0), (4.0, 9.0)]
    assert len({r["immigration_id"] for r in fact}) == 4
    dim = spark.read.parquet(f"{out}/dim_immigrant_demographics").collect()
    assert sorted((r["month"], r["immigration_cic_id"]) for r in dim) == sorted((r["month"], r["cic_id"]) for r in fact)


def test_months_together_equal_months_one_by_one(spark, tmp):
    march, april = ((1, 3, "NY"), (1, 3, "NY"), (2, 3, "CA")), ((1, 4, "NY"), (5, 4, "CA"))
    P.refresh_arrivals_months(_months(spark, *march, *april), f"{tmp}/together")
    P.refresh_arrivals_months(_months(spark, *march), f"{tmp}/single")
    P.refresh_arrivals_months(_months(spark, *april), f"{tmp}/single")
    for name in P.MONTH_TABLES:
        a, b = (sorted(map(str, spark.read.parquet(f"{tmp}/{d}/{name}").collect())) for d in ("together", "single"))
        assert a == b and len(a) == 4


def test_refresh_refuses_another_layout(spark, tmp):
    write_partitioned(build_fact(_months(spark, (1, 3, "NY"))), f"{tmp}/t/fact_immigration", ["state_code"])
    with pytest.raises(ValueError):
        P.refresh_arrivals_months(_months(spark, (2, 3, "NY")), f"{tmp}/t")


@pytest.mark.parametrize("header", ["dt,AverageTemperature,AverageTemperatureUncertainty,Country,City,Latitude,Longitude",
                                    "dt,AverageTemperature,AverageTemperatureUncertainty,City,Land,Latitude,Longitude",
                                    "dt,AverageTemperature,AverageTemperatureUncertainty,City,Country,Latitude"])
def test_temperature_job_rejects_other_headers(spark, tmp, header):
    import os
    os.makedirs(f"{tmp}/in")
    with open(f"{tmp}/in/t.csv", "w") as fh:
        fh.write(header + "\n1990-01-01,1.5,0.2,Denmark,Aarhus,57N,10E\n")
    with pytest.raises(Exception):
        P.process_temperature(spark, f"{tmp}/in/t.csv", f"{tmp}/out", on_fail="raise")


def test_all_digit_state_code_stays_text(spark, tmp):
    raw = _months(spark, (1, 3, "01"))
    res = P.process_arrivals(spark, "", f"{tmp}/tables", raw=raw)
    from portmart.sources.files import read_parquet
    fact = read_parquet(spark, res.tables["fact_immigration"], schema=schemas.FACT_IMMIGRATION)
    assert [r["state_code"] for r in fact.collect()] == ["01"]


def test_pivot_values_with_marks(spark):
    from portmart.operators.pivot import pivot_counts
    from portmart.plans.marts import sql_pivot_counts
    values = ["a.b", "O'X", "q`t", "back\\slash"]
    df = spark.createDataFrame([(1, v, 1) for v in values for _ in range(2)], "k int, v string, c int")
    df.createOrReplaceTempView("marked")
    one = pivot_counts(df, ["k"], "v", values, count_col="c", threshold=-1)
    two = spark.sql(sql_pivot_counts("marked", "k", "v", tuple(values), "c", -1))
    assert one.columns == two.columns == ["k", *values]
    assert one.collect() == two.collect() and tuple(one.first()) == (1, 2, 2, 2, 2)


def test_csv_inference_and_declared_reads(spark, raw):
    from portmart.sources.files import read_csv
    inferred = read_csv(spark, f"{raw}/demographics.csv", sep=";", infer=True)
    assert dict(inferred.dtypes)["Median Age"] == "double"
    assert dict(inferred.dtypes)["Total Population"] == "int"
    as_text = read_csv(spark, f"{raw}/demographics.csv", sep=";")
    assert set(dict(as_text.dtypes).values()) == {"string"}
    declared = read_csv(spark, f"{raw}/demographics.csv", schema=schemas.RAW_DEMOGRAPHICS, sep=";")
    assert declared.schema == schemas.RAW_DEMOGRAPHICS


def test_airports_cleaning(spark):
    from portmart.plans.tables import clean_airports
    rows = [("00A", "heliport", "Total Rf", 11.0, "NA", "US", "US-PA", "Bensalem", "00A", None, "00A", "-74.9, 40.0")] * 2
    rows.append(tuple([None] * 12))
    df = spark.createDataFrame(rows, schemas.RAW_AIRPORTS)
    assert clean_airports(df).count() == 1


def test_command_line(spark, raw, capsys):
    from portmart.__main__ import main
    out = f"{raw}/cli_tables"
    # the default label ranges find nothing in the short fixture file: checks fail -> exit code 1
    code = main(["run", "--labels", f"{raw}/labels.SAS", "--arrivals", f"{raw}/arrivals", "--demographics",
                 f"{raw}/demographics.csv", "--temperature", f"{raw}/temperature.csv", "--out", out,
                 "--sas-format", "xport", "--on-fail", "warn"], spark=spark)
    assert code == 1
    assert main(["mart", "state-gender", "--tables", out, "--threshold", "0", "--out", f"{raw}/cli_mart", "--show", "5"],
                spark=spark) == 0
    assert "NY" in {r["state_code"] for r in spark.read.parquet(f"{raw}/cli_mart").collect()}
    printed = capsys.readouterr().out
    assert "state_code" in printed and "NY" in printed
    assert main(["profile", "--input", f"{raw}/demographics.csv", "--format", "csv;", "--limit", "10",
                 "--out", f"{raw}/cli_profile"], spark=spark) == 0
    with pytest.raises(SystemExit):  # a result has to go somewhere
        main(["mart", "visa-gender", "--tables", out], spark=spark)


def test_label_job_by_block_names(spark, raw):
    res = P.process_labels(spark, f"{raw}/labels.SAS", f"{raw}/by_name", on_fail="raise",
                           blocks={"country": "i94cntyl", "city": "$i94prtl", "state": "i94addrl"})
    city = {r[0]: r[1] for r in spark.read.parquet(res.tables["dim_city"]).collect()}
    assert city["NYC"] == "New York" and city["ORD"] == "Chicago O'Hare"
    state = {r[0]: r[1] for r in spark.read.parquet(res.tables["dim_state"]).collect()}
    assert state["AL"] == "Alabama State" and "NY " in state
    # by name the country block also takes its line without '=' as a reject, not a row
    country = {r[0]: r[1] for r in spark.read.parquet(res.tables["dim_country"]).collect()}
    assert country == {"582": "MEXICO", "236": "AFGHANISTAN", "101": "ALBANIA"}


def test_arrivals_job_same_tables_with_split_scan(spark, tmp):
    # duplicates of one id fall into different byte ranges; the deterministic survivor makes the
    # published tables identical (surrogate ids aside, which follow the partition layout)
    os.makedirs(f"{tmp}/arr")
    rows = [arrival(cicid=float(i % 150), i94addr=("NY", "CA", None)[i % 3], arrdate=20574.0 + i % 7,
                    gender="MF"[(i // 150) % 2]) for i in range(600)]
    write_xport(f"{tmp}/arr/i94_one.xpt", ARR_COLS, rows)
    key = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(key)
    tables = {}
    for name, split in (("whole", None), ("split", "3000b")):
        if split:
            spark.conf.set(key, split)
        try:
            parts = read_sas(spark, f"{tmp}/arr", sas_format="xport").rdd.getNumPartitions()
            assert (parts > 10) if split else (parts == 1)
            P.process_arrivals(spark, f"{tmp}/arr", f"{tmp}/out_{name}", sas_format="xport")
        finally:
            spark.conf.set(key, old)
        fact = spark.read.parquet(f"{tmp}/out_{name}/fact_immigration").drop("immigration_id")
        dim = spark.read.parquet(f"{tmp}/out_{name}/dim_immigrant_demographics").drop("immi_demographics_id")
        tables[name] = (sorted(map(repr, fact.collect())), sorted(map(repr, dim.collect())))
    assert len(tables["whole"][0]) == 150 and len(tables["whole"][1]) == 150
    assert tables["whole"] == tables["split"]


def test_malformed_cells_are_counted_per_column(spark, tmp_path):
    from pyspark.sql.types import StructType
    from portmart.plans.jobs import process_temperature
    from portmart.sources.files import malformed_cells, read_csv_counted
    (tmp_path / "t.csv").write_text("a;b;c\n1;2.5;x\none;2.5;y\n3;many;z\nfour;many;z\n5;;\n6;1.0\n")
    df, seen = read_csv_counted(spark, f"{tmp_path}/t.csv", StructType.fromDDL("a int, b double, c string"), sep=";")
    assert sorted((r["a"] or 0, r["b"] or 0.0, r["c"] or "") for r in df.collect()) == [
        (0, 0.0, "z"), (0, 2.5, "y"), (1, 2.5, "x"), (3, 0.0, "z"), (5, 0.0, ""), (6, 1.0, "")]
    assert malformed_cells(seen, "t.csv") == {"a": 2, "b": 2, "(record)": 1}
    names = schemas.RAW_TEMPERATURE.fieldNames()
    number = next(f.name for f in schemas.RAW_TEMPERATURE.fields if f.dataType.typeName() == "double")
    row = {"dt": "2000-01-01", "City": "Rome", "Country": "Italy"}
    lines = [",".join(names), *(",".join(row.get(n, v if n == number else "") for n in names) for v in ("12.5", "12..5"))]
    (tmp_path / "temperature.csv").write_text("\n".join(lines) + "\n")
    assert process_temperature(spark, f"{tmp_path}/temperature.csv", f"{tmp_path}/out").malformed == {number: 1}


def test_sas_files_with_other_names_are_read_or_reported(spark, tmp_path):
    from portmart.sources import sas
    for name in ("a.sas7bdat", "B.SAS7BDAT", "c.sas7bdat.bak", "d.xpt"):
        (tmp_path / name).write_bytes(b"x")
    taken = [p.rsplit("/", 1)[1] for p, _ in sas.list_sas_files(spark, str(tmp_path), sas.DEFAULT_GLOBS["sas7bdat"])]
    assert sorted(taken) == ["B.SAS7BDAT", "a.sas7bdat"]
    assert [p.rsplit("/", 1)[1] for p in sas.skipped_files(spark, str(tmp_path))] == ["c.sas7bdat.bak", "d.xpt"]


def test_converted_arrivals_give_the_same_tables(spark, tmp_path):
    from portmart.plans.jobs import process_arrivals
    rows = spark.createDataFrame([tuple(None for _ in schemas.RAW_ARRIVALS.fields)], schemas.RAW_ARRIVALS)
    values = {"double": F.lit(5.0), "string": F.lit("A")}
    rows = rows.select(*[values.get(f.dataType.typeName(), F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.RAW_ARRIVALS.fields])
    rows.write.parquet(f"{tmp_path}/p")
    rows.write.option("header", True).csv(f"{tmp_path}/c")
    out = []
    for kind, path in (("parquet", "p"), ("csv", "c")):
        res = process_arrivals(spark, f"{tmp_path}/{path}", f"{tmp_path}/out_{kind}", sas_format=kind)
        assert res.malformed == {} and res.skipped == []
        out.append([sorted(map(str, spark.read.parquet(res.tables[t]).collect())) for t in sorted(res.tables)])
    assert out[0] == out[1] and len(out[0][0]) == 1
