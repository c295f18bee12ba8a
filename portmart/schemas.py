"""Declared schemas: one per raw input and one per published table.

They are used both to read (no inference pass, no all-string reads) and to check the
published tables (quality.schema_check).
"""

from __future__ import annotations

from pyspark.sql.types import (DateType, DoubleType, IntegerType, LongType, StringType, StructField,
                               StructType)

D, S, I, L = DoubleType(), StringType(), IntegerType(), LongType()


def _struct(*fields: tuple) -> StructType:
    return StructType([StructField(name, dtype, nullable) for name, dtype, nullable in
                       ((f[0], f[1], f[2] if len(f) > 2 else True) for f in fields)])


# --- raw inputs -------------------------------------------------------------------------------

# Monthly arrivals files, in file column order.
RAW_ARRIVALS = _struct(
    ("cicid", D), ("i94yr", D), ("i94mon", D), ("i94cit", D), ("i94res", D), ("i94port", S),
    ("arrdate", D), ("i94mode", D), ("i94addr", S), ("depdate", D), ("i94bir", D), ("i94visa", D),
    ("count", D), ("dtadfile", S), ("visapost", S), ("occup", S), ("entdepa", S), ("entdepd", S),
    ("entdepu", S), ("matflag", S), ("biryear", D), ("dtaddto", S), ("gender", S), ("insnum", S),
    ("airline", S), ("admnum", D), ("fltno", S), ("visatype", S),
)

# City temperature readings (comma CSV with header).
RAW_TEMPERATURE = _struct(
    ("dt", S), ("AverageTemperature", D), ("AverageTemperatureUncertainty", D), ("City", S),
    ("Country", S), ("Latitude", S), ("Longitude", S),
)

# City demographics (';' CSV with header), one row per city, state and race.
RAW_DEMOGRAPHICS = _struct(
    ("City", S), ("State", S), ("Median Age", D), ("Male Population", I), ("Female Population", I),
    ("Total Population", I), ("Number of Veterans", I), ("Foreign-born", I),
    ("Average Household Size", D), ("State Code", S), ("Race", S), ("Count", I),
)

# Airports (comma CSV with header); explored only.
RAW_AIRPORTS = _struct(
    ("ident", S), ("type", S), ("name", S), ("elevation_ft", D), ("continent", S), ("iso_country", S),
    ("iso_region", S), ("municipality", S), ("gps_code", S), ("iata_code", S), ("local_code", S),
    ("coordinates", S),
)

# --- published tables -------------------------------------------------------------------------

FACT_IMMIGRATION = _struct(
    ("cic_id", D), ("year", D), ("month", D), ("city_code", S), ("state_code", S), ("arrival_date", S),
    ("departure_date", S), ("mode", D), ("visa", D), ("visa_type", S), ("immigration_id", L, False),
)

DIM_IMMIGRANT_DEMOGRAPHICS = _struct(
    ("immigration_cic_id", D), ("country_of_birth", D), ("country_of_residence", D),
    ("year_of_birth", D), ("gender", S), ("immi_demographics_id", L, False),
)

DIM_CITY_DEMOGRAPHICS = _struct(
    ("city_code", S), ("state_code", S), ("median_age", D), ("male_population", I),
    ("female_population", I), ("total_population", I), ("number_of_veterans", I),
    ("foreign_born_num", I), ("avg_household_size", D), ("race", S), ("count", I), ("id", L, False),
)

DIM_TEMPERATURE = _struct(
    ("dt", DateType()), ("city_name", S), ("country_name", S), ("avg_temperature", D),
    ("avg_temperature_delta", D), ("year", I), ("month", I),
)

DIM_COUNTRY = _struct(("country_code", S), ("country_name", S))
DIM_CITY = _struct(("city_code", S), ("city_name", S))
DIM_STATE = _struct(("state_code", S), ("state_name", S))

PUBLISHED = {
    "fact_immigration": FACT_IMMIGRATION,
    "dim_immigrant_demographics": DIM_IMMIGRANT_DEMOGRAPHICS,
    "dim_city_demographics": DIM_CITY_DEMOGRAPHICS,
    "dim_temperature": DIM_TEMPERATURE,
    "dim_country": DIM_COUNTRY,
    "dim_city": DIM_CITY,
    "dim_state": DIM_STATE,
}
