"""Mart questions over the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portmart.operators.joins import equi_join
from portmart.operators.pivot import pivot_counts

# The gender categories shown, and the pair threshold of the state question.
GENDERS = ("F", "M")
STATE_THRESHOLD = 20000


def _fact_with_gender(fact: DataFrame, dim: DataFrame, cols: list[str], distinct: bool) -> DataFrame:
    if distinct:
        # The reference's distinct over the whole joined rows: it removes nothing when both
        # sides carry unique ids, but forces a shuffle over every column.
        return equi_join(fact, dim, fact["cic_id"] == dim["immigration_cic_id"], distinct=True)
    on = F.col("cic_id") == F.col("immigration_cic_id")
    keys = [c for c in ("year", "month") if c in dim.columns]  # tables kept by month are keyed by it too
    for c in keys:
        on = on & (F.col(c) == F.col(f"_{c}"))
    side = dim.select("immigration_cic_id", "gender", *[F.col(c).alias(f"_{c}") for c in keys])
    return equi_join(fact.select("cic_id", *keys, *cols), side, on)


def arrivals_by_state_gender(fact: DataFrame, dim: DataFrame, threshold: int | None = STATE_THRESHOLD,
                             distinct: bool = False) -> DataFrame:
    """(state_code, F, M): arrivals per state and gender; (state, gender) pairs with a count at
    or under ``threshold`` are blanked, states with no pair left are dropped (H17)."""
    joined = _fact_with_gender(fact, dim, ["state_code"], distinct)
    return pivot_counts(joined, ["state_code"], "gender", list(GENDERS), count_col="cic_id",
                        threshold=threshold)


def arrivals_by_visa_gender(fact: DataFrame, dim: DataFrame, distinct: bool = False) -> DataFrame:
    """(visa_type, F, M): arrivals per visa type and gender, no threshold."""
    joined = _fact_with_gender(fact, dim, ["visa_type"], distinct)
    return pivot_counts(joined, ["visa_type"], "gender", list(GENDERS), count_col="cic_id")


def sql_pivot_counts(view: str, key: str, category: str, values: tuple, count_col: str,
                     threshold: int | None = None) -> str:
    """Spark SQL for counts of ``count_col`` per (``key``, ``category``) over ``view``, one column
    per category value; pairs at or under ``threshold`` are blanked and keys with no pair left
    are dropped (the SQL form of :func:`pivot_counts`, A13). One aggregation by ``key`` only,
    so the data crosses one exchange (partial counts first). Without a threshold a pair exists
    when it has rows, even if every ``count_col`` in them is null."""
    def text(v: str) -> str:
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"

    def cnt(v: str, what: str) -> str:
        return f"count(CASE WHEN {category} = {text(v)} THEN {what} END)"

    def present(v: str) -> str:
        rows = f"{cnt(v, '1')} > 0"
        return rows if threshold is None else f"{rows} AND {cnt(v, count_col)} > {int(threshold)}"

    def name(v: str) -> str:
        return "`" + v.replace("`", "``") + "`"

    listed = ", ".join(map(text, values))
    cols = ",\n".join(f"               CASE WHEN {present(v)} THEN {cnt(v, count_col)} END AS {name(v)}" for v in values)
    return f"""
        SELECT {key},
{cols}
        FROM {view} WHERE {category} IN ({listed})
        GROUP BY {key}
        HAVING {" OR ".join(f"({present(v)})" for v in values)}"""


def arrivals_by_state_gender_sql(spark, fact: DataFrame, dim: DataFrame,
                                 threshold: int | None = STATE_THRESHOLD, view: str = "fact_with_gender") -> DataFrame:
    """H17 written as Spark SQL over a temp view of the join (A13), threshold and unstack
    included, so nothing is finished in pandas. Same result as :func:`arrivals_by_state_gender`."""
    _fact_with_gender(fact, dim, ["state_code"], distinct=False).createOrReplaceTempView(view)
    return spark.sql(sql_pivot_counts(view, "state_code", "gender", GENDERS, "cic_id", threshold))


def arrivals_by_visa_gender_sql(spark, fact: DataFrame, dim: DataFrame,
                                view: str = "fact_with_gender") -> DataFrame:
    """H18 as Spark SQL over the temp view (no threshold)."""
    _fact_with_gender(fact, dim, ["visa_type"], distinct=False).createOrReplaceTempView(view)
    return spark.sql(sql_pivot_counts(view, "visa_type", "gender", GENDERS, "cic_id"))
