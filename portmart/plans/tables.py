"""Cleaning steps and table builders of the star schema.

Builders are pure ``DataFrame -> DataFrame`` functions (compose them with ``.transform``);
writing and checking belong to ``plans.jobs``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from portmart.functions import month_of, parse_date, sas_day_to_iso, year_of
from portmart.operators.clean import (dedup_first, distinct_rows, drop_columns, drop_null_rows,
                                      rename_columns, select_columns)
from portmart.operators.keys import with_surrogate_key
from portmart.operators.lookups import CITY_RULE, COUNTRY_RULE, STATE_RULE, LabelRule, label_table
from portmart.operators.registry import KeyRegistry
from portmart.sources.labels import line_range, named_block

Step = tuple[str, Callable[[DataFrame], DataFrame]]

# Columns dropped from arrivals for being over 85% missing.
ARRIVALS_SPARSE_COLUMNS = ("entdepu", "occup", "insnum")

# 0-based, end-exclusive line ranges of the three blocks of the label file.
COUNTRY_LINES = (9, 298)
CITY_LINES = (302, 962)
STATE_LINES = (981, 1036)

# Renames of each table, raw name -> published name.
FACT_RENAMES = {
    "cicid": "cic_id", "i94yr": "year", "i94mon": "month", "i94port": "city_code",
    "i94addr": "state_code", "arrdate": "arrival_date", "depdate": "departure_date",
    "i94mode": "mode", "i94visa": "visa", "visatype": "visa_type",
}
IMMIGRANT_RENAMES = {
    "cicid": "immigration_cic_id", "i94cit": "country_of_birth", "i94res": "country_of_residence",
    "biryear": "year_of_birth",
}
DEMOGRAPHICS_RENAMES = {
    "City": "city_code", "State Code": "state_code", "Median Age": "median_age",
    "Male Population": "male_population", "Female Population": "female_population",
    "Total Population": "total_population", "Number of Veterans": "number_of_veterans",
    "Foreign-born": "foreign_born_num", "Average Household Size": "avg_household_size",
    "Race": "race", "Count": "count",
}
TEMPERATURE_RENAMES = {
    "City": "city_name", "Country": "country_name", "AverageTemperature": "avg_temperature",
    "AverageTemperatureUncertainty": "avg_temperature_delta",
}


def apply_steps(df: DataFrame, steps: Sequence[Step]) -> DataFrame:
    for _, fn in steps:
        df = fn(df)
    return df


# --- cleaning (H1-H4) -------------------------------------------------------------------------

def arrivals_steps(drop_null_keys: bool = False, sparse=ARRIVALS_SPARSE_COLUMNS) -> list[Step]:
    """Drop sparse columns, one row per ``cicid`` (deterministic), drop all-null rows (H1).

    Deduplication comes before dropping empty rows, as in the reference. ``drop_null_keys``
    also removes null ``cicid`` rows (the notebook variant)."""
    return [
        ("drop_sparse_columns", lambda d: drop_columns(d, sparse)),
        ("dedup_cicid", lambda d: dedup_first(d, ["cicid"], drop_null_keys=drop_null_keys)),
        ("drop_empty_rows", lambda d: drop_null_rows(d, how="all")),
    ]


def temperature_steps(reading: str = "AverageTemperature",
                      keys: Sequence[str] = ("dt", "City", "Country")) -> list[Step]:
    """Drop rows without a reading, one row per (dt, City, Country), drop all-null rows (H2).

    Null readings go first, so a null-reading duplicate can never be the survivor."""
    return [
        ("drop_missing_reading", lambda d: drop_null_rows(d, how="any", subset=[reading])),
        ("dedup_reading_key", lambda d: dedup_first(d, list(keys))),
        ("drop_empty_rows", lambda d: drop_null_rows(d, how="all")),
    ]


def demographics_steps(keys: Sequence[str] = ("City", "State", "Race")) -> list[Step]:
    """One row per (City, State, Race), then really drop all-null rows (H3)."""
    return [
        ("dedup_city_state_race", lambda d: dedup_first(d, list(keys))),
        ("drop_empty_rows", lambda d: drop_null_rows(d, how="all")),
    ]


def airports_steps() -> list[Step]:
    """Distinct rows, then drop all-null rows (H4, exploration only)."""
    return [("distinct", distinct_rows), ("drop_empty_rows", lambda d: drop_null_rows(d, how="all"))]


def clean_arrivals(df: DataFrame, **kw) -> DataFrame:
    return apply_steps(df, arrivals_steps(**kw))


def clean_temperature(df: DataFrame, **kw) -> DataFrame:
    return apply_steps(df, temperature_steps(**kw))


def clean_demographics(df: DataFrame, **kw) -> DataFrame:
    return apply_steps(df, demographics_steps(**kw))


def clean_airports(df: DataFrame) -> DataFrame:
    return apply_steps(df, airports_steps())


# --- builders (H5-H8) -------------------------------------------------------------------------

def build_fact(df: DataFrame, unique_on_key: bool = True, with_id: bool = True,
               zero_is_null: bool = True) -> DataFrame:
    """Arrivals -> ``fact_immigration`` (H5).

    ``unique_on_key=True`` (input already one row per cicid, as after H1) skips the distinct:
    rows that differ in their key cannot be duplicates, so it would only add a full shuffle.
    """
    out = select_columns(df, list(FACT_RENAMES))
    if not unique_on_key:
        out = distinct_rows(out)
    if with_id:
        out = with_surrogate_key(out, "immigration_id")
    out = rename_columns(out, FACT_RENAMES)
    return out.withColumns({"arrival_date": sas_day_to_iso("arrival_date", zero_is_null),
                            "departure_date": sas_day_to_iso("departure_date", zero_is_null)})


def build_immigrant_dim(df: DataFrame, unique_on_key: bool = True, with_id: bool = True) -> DataFrame:
    """Arrivals -> ``dim_immigrant_demographics`` (H6)."""
    out = select_columns(df, ["cicid", "i94cit", "i94res", "biryear", "gender"])
    if not unique_on_key:
        out = distinct_rows(out)
    if with_id:
        out = with_surrogate_key(out, "immi_demographics_id")
    return rename_columns(out, IMMIGRANT_RENAMES)


def clean_month_arrivals(df: DataFrame, drop_null_keys: bool = True) -> DataFrame:
    """H1 for tables kept by month: one row per (cicid, i94yr, i94mon). Rows without one of them go, or are
    kept, one per combination, without ``drop_null_keys``."""
    return dedup_first(drop_columns(df, ARRIVALS_SPARSE_COLUMNS), ["cicid", "i94yr", "i94mon"], drop_null_keys=drop_null_keys)


def month_id(cicid: str, year: str, month: str) -> Column:
    """An id from the natural key. Whole numbers of a month below 2^40: the month's number above 40
    bits of cicid. Any other key (missing, fractional, negative, larger): a negative number by its hash;
    ``require_unique_ids`` makes sure that no two of those agree."""
    key, y, m = F.col(cicid).try_cast("long"), F.col(year).try_cast("long"), F.col(month).try_cast("long")
    whole = (key.cast("double") == F.col(cicid)) & key.between(0, (1 << 40) - 1)
    whole = whole & (y.cast("double") == F.col(year)) & y.between(0, 100_000) & (m.cast("double") == F.col(month)) & m.between(1, 12)
    said = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("none")) for c in (cicid, year, month)])
    other = -1 - F.xxhash64(said).bitwiseAND(F.lit((1 << 62) - 1))
    return F.when(whole, F.shiftleft(y * 12 + m - 1, 40) + key).otherwise(other)


def require_unique_ids(cleaned: DataFrame) -> None:
    """Raise if two keys that have hashed ids share one (few rows have such keys; the others' ids are
    unique by construction)."""
    odd = cleaned.select(month_id("cicid", "i94yr", "i94mon").alias("id")).filter("id < 0")
    if not odd.groupBy("id").count().filter("count > 1").isEmpty():
        raise ValueError("two arrivals without a regular key share an id")


def build_month_fact(df: DataFrame) -> DataFrame:
    """H5 with ids from the natural key."""
    return build_fact(df, with_id=False).withColumn("immigration_id", month_id("cic_id", "year", "month"))


def build_month_immigrant_dim(df: DataFrame) -> DataFrame:
    """H6 with ids from the natural key, and the year and month it is stored by."""
    keyed = df.select("cicid", "i94cit", "i94res", "biryear", "gender", month_id("cicid", "i94yr", "i94mon").alias("immi_demographics_id"),
                      F.col("i94yr").alias("year"), F.col("i94mon").alias("month"))
    return rename_columns(keyed, IMMIGRANT_RENAMES)


CITY_DEMOGRAPHICS_KEY = StructType([StructField(n, StringType()) for n in ("City", "State", "Race")])


def city_demographics_ids(spark: SparkSession, path: str) -> KeyRegistry:
    """The stored ids of H7's rows, by the key that H3 leaves one row of."""
    return KeyRegistry(spark, path, CITY_DEMOGRAPHICS_KEY)


def build_city_demographics(df: DataFrame, with_id: bool = True, registry: KeyRegistry | None = None) -> DataFrame:
    """Demographics -> ``dim_city_demographics`` (H7).

    ``State Code`` becomes ``state_code`` (the column the fact joins on); the full state name
    is left out, giving the declared 12 columns. With ``registry`` a city, state and race keeps its id over
    all refreshes; without one the id is new on every run."""
    ids = []
    if with_id and registry is not None:
        df, ids = registry.assign(df, "id"), ["id"]
    out = rename_columns(drop_columns(df, ["State"]), DEMOGRAPHICS_RENAMES)
    out = select_columns(out, [*DEMOGRAPHICS_RENAMES.values(), *ids])
    return with_surrogate_key(out, "id") if with_id and registry is None else out


def build_temperature(df: DataFrame, distinct: bool = True) -> DataFrame:
    """Temperatures -> ``dim_temperature`` (H8). The distinct runs on the raw ``dt`` text, before
    parsing, so two spellings of one date stay two rows."""
    out = select_columns(df, ["dt", "City", "Country", "AverageTemperature", "AverageTemperatureUncertainty"])
    if distinct:
        out = distinct_rows(out)
    out = rename_columns(out.withColumn("dt", parse_date("dt")), TEMPERATURE_RENAMES)
    return out.withColumns({"year": year_of("dt"), "month": month_of("dt")})


# --- label lookups (H9-H11) -------------------------------------------------------------------

def _block(lines: DataFrame, lines_range: tuple[int, int] | None, block_name: str | None) -> DataFrame:
    if block_name:
        return named_block(lines, block_name)
    return line_range(lines, *lines_range) if lines_range else lines


def build_label_dim(lines: DataFrame, rule: LabelRule, code_name: str, label_name: str,
                    lines_range: tuple[int, int] | None = None, block_name: str | None = None) -> DataFrame:
    return label_table(_block(lines, lines_range, block_name), rule, code_name, label_name)


def build_country_dim(lines: DataFrame, lines_range=COUNTRY_LINES, block_name: str | None = None) -> DataFrame:
    """``dim_country`` (code, name as is) (H9)."""
    return build_label_dim(lines, COUNTRY_RULE, "country_code", "country_name", lines_range, block_name)


def build_city_dim(lines: DataFrame, lines_range=CITY_LINES, block_name: str | None = None) -> DataFrame:
    """``dim_city`` (port code, title-cased name before the first comma)."""
    return build_label_dim(lines, CITY_RULE, "city_code", "city_name", lines_range, block_name)


def build_state_dim(lines: DataFrame, lines_range=STATE_LINES, block_name: str | None = None) -> DataFrame:
    """``dim_state`` (code, title-cased name)."""
    return build_label_dim(lines, STATE_RULE, "state_code", "state_name", lines_range, block_name)


def with_year_month(df: DataFrame, date_col: str) -> DataFrame:
    """Year and month integer columns of an ISO date text column (partition keys for H20)."""
    d = parse_date(date_col)
    return df.withColumns({"year": F.year(d), "month": F.month(d)})
