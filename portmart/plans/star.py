"""The star schema's relations, which the reference declares but never runs.

Lookup dimensions (states, ports, countries, per-state summaries, per-city-month readings) are
small and are broadcast behind a size check; the fact is not shuffled for those that pass it. Tables
with many rows per join key are aggregated to the key first, so the fact keeps one row per
arrival; the aggregate is staged, so that its size is known and it is computed once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portmart.operators.joins import code_text, lookup_join, month_join
from portmart.sinks.writers import stage


def fact_with_state_name(fact: DataFrame, dim_state: DataFrame) -> DataFrame:
    """fact ⟕ dim_state on state_code."""
    return lookup_join(fact, dim_state.withColumnRenamed("state_code", "_sc"), "state_code", "_sc")


def fact_with_city_name(fact: DataFrame, dim_city: DataFrame) -> DataFrame:
    """fact ⟕ dim_city on the port code (D3)."""
    return lookup_join(fact, dim_city.withColumnRenamed("city_code", "_cc"), "city_code", "_cc")


def immigrant_with_countries(dim_immigrant: DataFrame, dim_country: DataFrame) -> DataFrame:
    """Immigrant dimension ⟕ dim_country twice, for birth and residence.

    Country codes are doubles on the immigrant side (101.0) and text in the lookup ('101')."""
    birth = dim_country.select(F.col("country_code").alias("_bc"), F.col("country_name").alias("birth_country"))
    res = dim_country.select(F.col("country_code").alias("_rc"), F.col("country_name").alias("residence_country"))
    out = lookup_join(dim_immigrant, birth, code_text("country_of_birth"), "_bc")
    return lookup_join(out, res, code_text("country_of_residence"), "_rc")


def state_demographics(dim_city_demographics: DataFrame) -> DataFrame:
    """One row per state from the per-(city, race) rows: city figures repeat on every race row,
    so they are taken once per city, then added up per state."""
    per_city = dim_city_demographics.groupBy("state_code", "city_code").agg(
        F.max("total_population").alias("total_population"),
        F.max("foreign_born_num").alias("foreign_born_num"),
        F.max("number_of_veterans").alias("number_of_veterans"))
    return per_city.groupBy("state_code").agg(
        F.count(F.lit(1)).alias("n_cities"), F.sum("total_population").alias("state_population"),
        F.sum("foreign_born_num").alias("state_foreign_born"), F.sum("number_of_veterans").alias("state_veterans"))


def fact_with_state_demographics(fact: DataFrame, dim_city_demographics: DataFrame) -> DataFrame:
    """fact ⟕ state-level demographics on state_code, aggregated first so the fact does not fan
    out (D5)."""
    per_state = stage(state_demographics(dim_city_demographics).withColumnRenamed("state_code", "_sc"))
    return lookup_join(fact, per_state, "state_code", "_sc", unique=True)  # grouped by state


def monthly_readings(dim_temperature: DataFrame, country: str) -> DataFrame:
    """One reading per (city, year, month) of one country (same-named cities elsewhere are
    left out); where a month has several rows the earliest date wins."""
    best = F.min(F.struct("dt", "avg_temperature", "avg_temperature_delta"))
    return (dim_temperature.filter(F.col("country_name") == country)
            .groupBy("city_name", "year", "month").agg(best.alias("_r"))
            .select(F.col("city_name").alias("_city"), F.col("year").alias("_y"), F.col("month").alias("_m"),
                    F.col("_r.avg_temperature").alias("avg_temperature"),
                    F.col("_r.avg_temperature_delta").alias("avg_temperature_delta")))


def fact_with_temperature(fact: DataFrame, dim_city: DataFrame, dim_temperature: DataFrame,
                          country: str = "United States") -> DataFrame:
    """fact ⟕ dim_city (port -> city name) ⟕ that city's reading for the arrival year and month
    (D6). The fact's year and month are doubles; the readings' are integers."""
    named = fact_with_city_name(fact, dim_city).withColumns(
        {"_fy": F.col("year").try_cast("int"), "_fm": F.col("month").try_cast("int")})
    out = month_join(named, stage(monthly_readings(dim_temperature, country)),
                     [("city_name", "_city"), ("_fy", "_y"), ("_fm", "_m")], broadcast_readings=True)
    return out.drop("_fy", "_fm")
