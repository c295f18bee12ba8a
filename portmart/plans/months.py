"""The arrivals star kept by month (H20): fact, immigrant dimension and mart counts, published together.

The counts behind the marts (H17, H18) are a third table of the same version: arrivals per month, state,
visa type and gender. A refresh counts its own months only; a mart adds the stored counts up, so it
never reads the fact and always agrees with the version it was asked of.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from portmart import schemas
from portmart.operators.pivot import pivot_finish
from portmart.plans import tables as H
from portmart.plans.marts import GENDERS, STATE_THRESHOLD
from portmart.sinks.versions import Version, VersionedTables
from portmart.sinks.writers import drop_staged, stage

FACT, DIM, COUNTS = "fact_immigration", "dim_immigrant_demographics", "mart_counts"
_MONTH = [StructField("year", DoubleType()), StructField("month", DoubleType())]
TABLES = {
    FACT: schemas.FACT_IMMIGRATION,
    DIM: StructType([*schemas.DIM_IMMIGRANT_DEMOGRAPHICS.fields, *_MONTH]),
    COUNTS: StructType([StructField("state_code", StringType()), StructField("visa_type", StringType()), StructField("gender", StringType()),
                        StructField("n", LongType()), *_MONTH]),
}


@dataclass
class MonthReport:
    """What a refresh did with its rows."""

    version: Version
    rows_in: int = 0
    repeated: int = 0  # rows of an arrival that came more than once in its month
    without_key: int = 0  # kept rows whose cicid, year or month is missing
    counts: dict[str, int] = field(default_factory=dict)


def arrival_months(spark: SparkSession, root: str) -> VersionedTables:
    """The store of the arrivals star below ``root``."""
    return VersionedTables(spark, root, TABLES)


def month_counts(cleaned: DataFrame) -> DataFrame:
    """Arrivals per month, state, visa type and gender.

    The marts join fact and dimension on (cicid, year, month). Both are built of ``cleaned``, which has one
    row per such key, so the join is one to one and its counts are those of the rows with a whole key."""
    whole = F.col("cicid").isNotNull() & F.col("i94yr").isNotNull() & F.col("i94mon").isNotNull()
    return (cleaned.filter(whole).groupBy(F.col("i94addr").alias("state_code"), F.col("visatype").alias("visa_type"), "gender",
                                          F.col("i94yr").alias("year"), F.col("i94mon").alias("month"))
            .agg(F.count(F.lit(1)).alias("n")))


def refresh_months(raw: DataFrame, root: str) -> MonthReport:
    """Replace the months of ``raw`` in fact, dimension and mart counts, all in one version.

    Rows without a month are a month of their own, and rows without a cicid are kept (one a month, as H12
    keeps one); both are counted in the report. Nothing is dropped but repeats of an arrival."""
    spark = raw.sparkSession
    seen, kept = Observation(), Observation()
    missing = F.col("cicid").isNull() | F.col("i94yr").isNull() | F.col("i94mon").isNull()
    rows = raw.observe(seen, F.count(F.lit(1)).alias("n"))
    one = H.clean_month_arrivals(rows, drop_null_keys=False)
    cleaned = stage(one.observe(kept, F.count(F.lit(1)).alias("n"), F.count_if(missing).alias("without_key")))
    H.require_unique_ids(cleaned)
    version = arrival_months(spark, root).publish(
        {FACT: H.build_month_fact(cleaned), DIM: H.build_month_immigrant_dim(cleaned), COUNTS: month_counts(cleaned)},
        sort_within={FACT: ["state_code"]})
    drop_staged(spark, cleaned)
    n, got = seen.get["n"], kept.get
    return MonthReport(version, n, n - got["n"], got["without_key"], {name: version.rows(name) for name in TABLES})


def _mart(counts: DataFrame, key: str, threshold: int | None) -> DataFrame:
    def total(v: str) -> Column:
        return F.sum(F.when(F.col("gender") == v, F.col("n"))).alias(f"_cnt_{v}")
    per = counts.filter(F.col("gender").isin(*GENDERS)).groupBy(key).agg(*[total(v) for v in GENDERS])
    return pivot_finish(per, [key], list(GENDERS), threshold, grouped=True)


def kept_arrivals_by_state_gender(store: VersionedTables, version: Version | None = None, threshold: int | None = STATE_THRESHOLD) -> DataFrame:
    """H17 from the stored counts of ``version`` (the latest)."""
    return _mart(store.read(COUNTS, version), "state_code", threshold)


def kept_arrivals_by_visa_gender(store: VersionedTables, version: Version | None = None) -> DataFrame:
    """H18 from the stored counts of ``version`` (the latest)."""
    return _mart(store.read(COUNTS, version), "visa_type", None)
