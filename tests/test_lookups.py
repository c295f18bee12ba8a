"""Label file parsing (A6, A7, C9, E5-E8, H9-H11) on a hand-made label file with hand-derived
expected tables."""

import pytest

from portmart.plans import tables as H
from portmart.sources.labels import line_range, named_block, read_numbered_lines

LABEL_LINES = [
    "/* I94CIT & I94RES - country codes */",
    "value i94cntyl",
    "   582 =  'MEXICO Air Sea, and Not Reported (I-94, no land arrivals)'",
    "   236 =  'AFGHANISTAN'",
    "   582 =  'MEXICO'",
    "   101 =  'ALBANIA' = 'EXTRA'",
    "   this line has no equals sign",
    ";",
    "",
    "value $i94prtl",
    "\t'ALC'\t=\t'ALCAN, AK             '",
    "\t'ANC'\t=\t'ANCHORAGE, AK         '",
    "\t'NYC'\t=\t'NEW YORK, NY          '",
    "\t'XXX'\t=\t'NO COMMA LABEL'",
    "\t'ORD'\t=\t'CHICAGO O'HARE, IL, US'",
    "\t'WSA'\t=\t'WINSTON-SALEM, NC'",
    ";",
    "value i94addrl",
    "\t'AL'='ALABAMA'",
    "\t'NY '='NEW YORK'",
    "\t'DC'='DIST. OF COLUMBIA'",
    "\t'AL'='ALABAMA STATE'",
    ";",
]
COUNTRY, CITY, STATE = (2, 6), (10, 16), (18, 22)


# Expected tables for the fixture, worked out by hand from the cleaning rules: country codes and
# names stripped of whitespace and quotes, names as they are; city labels stripped of tabs,
# whitespace and quotes, cut at the first comma, title-cased; state codes stripped of tabs and
# quotes only (inner space kept), names title-cased; a later line for a code wins.
EXPECTED_COUNTRY = {"582": "MEXICO", "236": "AFGHANISTAN", "101": "ALBANIA"}
EXPECTED_CITY = {"ALC": "Alcan", "ANC": "Anchorage", "NYC": "New York", "XXX": "No Comma Label",
                 "ORD": "Chicago O'Hare", "WSA": "Winston-Salem"}
EXPECTED_STATE = {"AL": "Alabama State", "NY ": "New York", "DC": "Dist. Of Columbia"}


@pytest.fixture()
def label_file(tmp):
    path = f"{tmp}/I94_SAS_Labels_Descriptions.SAS"
    with open(path, "w") as fh:
        fh.write("\n".join(LABEL_LINES) + "\n")
    return path


def test_numbered_lines_keep_file_positions(spark, label_file):
    got = sorted((r["pos"], r["line"]) for r in read_numbered_lines(spark, label_file).collect())
    assert got == list(enumerate(LABEL_LINES))


def test_numbered_lines_across_many_splits(spark, tmp):
    lines = [f"{i} = 'L{i}'" for i in range(3000)]
    path = f"{tmp}/big.txt"
    with open(path, "w") as fh:
        fh.write("\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        df = read_numbered_lines(spark, path)
        assert spark.read.text(path).rdd.getNumPartitions() > 5
        got = sorted((r["pos"], r["line"]) for r in df.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == list(enumerate(lines))


def test_country_city_state_tables(spark, label_file):
    lines = read_numbered_lines(spark, label_file)
    country = {r[0]: r[1] for r in H.build_country_dim(lines, COUNTRY).collect()}
    city = {r[0]: r[1] for r in H.build_city_dim(lines, CITY).collect()}
    state = {r[0]: r[1] for r in H.build_state_dim(lines, STATE).collect()}
    assert country == EXPECTED_COUNTRY
    assert city == EXPECTED_CITY
    assert state == EXPECTED_STATE


def test_line_without_equals_is_rejected_not_fatal(spark, label_file):
    lines = line_range(read_numbered_lines(spark, label_file), 2, 7)
    from portmart.operators.lookups import label_rejects
    assert [r["line"] for r in label_rejects(lines).collect()] == ["   this line has no equals sign"]
    assert {r[0] for r in H.build_country_dim(read_numbered_lines(spark, label_file), (2, 7)).collect()} == \
        {"582", "236", "101"}


def test_named_block_finds_ranges(spark, label_file):
    lines = read_numbered_lines(spark, label_file)
    by_name = {r[0]: r[1] for r in H.build_city_dim(lines, block_name="$i94prtl").collect()}
    assert by_name == EXPECTED_CITY
    blk = sorted(r["pos"] for r in named_block(lines, "i94addrl").collect())
    assert blk == list(range(*STATE))


def test_line_order_sorts_part_numbers_as_numbers_with_one_scan(spark, tmp):
    from portmart.operators.lookups import COUNTRY_RULE, label_table
    from portmart.sources.labels import LINE_ORDER, read_ordered_lines
    import os
    os.makedirs(f"{tmp}/numbered", exist_ok=True)
    for n, name in ((99998, "A"), (100000, "C"), (99999, "B")):
        with open(f"{tmp}/numbered/part-{n:05d}-x-c000.txt", "w") as fh:
            fh.write(f"1 = '{name}'\n")
    got = label_table(read_ordered_lines(spark, f"{tmp}/numbered"), COUNTRY_RULE, "code", "name", order=LINE_ORDER)
    assert [tuple(r) for r in got.collect()] == [("1", "C")]
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1


def test_lines_are_ordered_by_numbers_alone(spark, tmp):
    """What is sorted by does not hold the file's name, however long that is and whatever it is spelled with."""
    from portmart.operators.lookups import COUNTRY_RULE, label_table
    from portmart.sources.labels import LINE_ORDER, read_ordered_lines
    import os
    path = f"{tmp}/a b%20c=ü/" + "9a" * 60
    os.makedirs(path)
    for n in (2, 10, 1):
        with open(f"{path}/part-{n}", "w") as fh:
            fh.write("".join(f"{i} = '{n}'\n" for i in range(n)))
    lines = read_ordered_lines(spark, path)
    assert {dict(lines.dtypes)[c] for c in LINE_ORDER} <= {"int", "bigint"}
    last = [r["line"] for r in lines.orderBy(*LINE_ORDER).collect()]
    assert last == [f"{i} = '{n}'" for n in (1, 2, 10) for i in range(n)]
    got = label_table(lines, COUNTRY_RULE, "code", "name", order=LINE_ORDER)
    assert sorted(tuple(r) for r in got.collect()) == sorted((str(i), "10") for i in range(10))


def test_lookup_with_a_repeated_code_raises(spark):
    from portmart.operators.joins import lookup_join
    fact = spark.createDataFrame([(1, "a")], "id int, k string")
    dim = spark.sql("SELECT * FROM VALUES ('a', 1), ('a', 2), (NULL, 3), (NULL, 4) AS t(c, v)")
    with pytest.raises(ValueError, match="not unique"):
        lookup_join(fact, dim, "k", "c")
    once = lookup_join(fact, dim.filter("v <> 2"), "k", "c")
    assert [tuple(r) for r in once.collect()] == [(1, "a", 1)]


def test_fact_is_not_shuffled_for_readings_and_state_totals(spark):
    from conftest import SF0001
    from portmart.plans.catalog import QUERIES
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for key in ("star_month_reading", "star_state_demographics", "star_temperature"):
            plan = QUERIES[key](spark, SF0001)._jdf.queryExecution().executedPlan().toString()
            assert "Exchange hashpartitioning" not in plan, key
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
