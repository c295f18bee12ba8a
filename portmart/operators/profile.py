"""Profiling: row counts, missing-value profiles, table shapes, schema listings
(B8, B10, C3, C5-C7, C10, G5, H19).

Every profile is a single aggregation over the input: one scan however many columns there
are, with partial aggregation per task, so file count and column count only widen the
aggregate, never multiply the passes.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portmart.functions import is_missing, pct


def row_count(df: DataFrame) -> int:
    """Number of rows (C3). An action; prefer ``Observation`` when the rows are written anyway."""
    return df.count()


def filter_count(df: DataFrame, condition: Column, name: str = "n") -> DataFrame:
    """Rows matching ``condition`` as a one-row frame."""
    return df.filter(condition).agg(F.count(F.lit(1)).alias(name))


def _missing_aggs(df: DataFrame, cols: list[str]) -> list[Column]:
    dtypes = dict(df.dtypes)
    return [F.count_if(is_missing(F.col(_q(c)), dtypes[c])).alias(f"_m{i}") for i, c in enumerate(cols)]


def _unpivot(wide: DataFrame, cols: list[str], carry: list[str]) -> DataFrame:
    cells = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(c).alias("field"),
                               F.col(f"_m{i}").alias("nulls")) for i, c in enumerate(cols)])
    return wide.select(*carry, F.inline(cells))


def missing_counts(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """(position, field, nulls, rows): null count of every column in one pass.

    NaN counts as missing in float/double columns, as pandas ``isnull`` does.
    """
    cols = list(cols) if cols is not None else list(df.columns)
    wide = df.agg(F.count(F.lit(1)).alias("rows"), *_missing_aggs(df, cols))
    return _unpivot(wide, cols, ["rows"]).select("position", "field", "nulls", "rows")


def missing_profile(df: DataFrame, limit: float | None = None,
                    cols: Iterable[str] | None = None) -> DataFrame:
    """(field, nulls, rows, pct_missing), kept where pct_missing > ``limit``."""
    prof = missing_counts(df, cols).withColumn("pct_missing", pct("nulls", "rows"))
    if limit is not None:
        prof = prof.filter(F.col("pct_missing") > F.lit(float(limit)))
    return prof.select("field", "nulls", "rows", "pct_missing")


def missing_counts_by_file(df: DataFrame, file_col: Column | None = None,
                           cols: Iterable[str] | None = None) -> DataFrame:
    """(source_file, field, nulls, rows): the per-file view.

    ``df`` must be a file scan (``_metadata`` is read from it) unless ``file_col`` is given.
    """
    file_col = file_col if file_col is not None else F.col("_metadata.file_path")
    cols = list(cols) if cols is not None else list(df.columns)
    wide = (df.withColumn("source_file", file_col)
              .groupBy("source_file")
              .agg(F.count(F.lit(1)).alias("rows"), *_missing_aggs(df, cols)))
    return _unpivot(wide, cols, ["source_file", "rows"]).select("source_file", "position", "field",
                                                                "nulls", "rows")


def missing_profile_over_files(df: DataFrame, limit: float | None = None,
                               file_col: Column | None = None,
                               cols: Iterable[str] | None = None) -> DataFrame:
    """Per-file counts added up into the dataset-wide profile (C6 + C7 + B10)."""
    per_file = missing_counts_by_file(df, file_col, cols)
    total = (per_file.groupBy("position", "field")
                     .agg(F.sum("nulls").alias("nulls"), F.sum("rows").alias("rows"))
                     .withColumn("pct_missing", pct("nulls", "rows")))
    if limit is not None:
        total = total.filter(F.col("pct_missing") > F.lit(float(limit)))
    return total.select("field", "nulls", "rows", "pct_missing")


def table_shape(df: DataFrame, name: str) -> DataFrame:
    """(table_name, n_rows, n_cols) of one table."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).alias("n_cols"))


def schema_rows(spark: SparkSession, df: DataFrame) -> DataFrame:
    """(position, name, type, nullable) of ``df``'s schema (G5). Metadata only, no job."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    schema = T.StructType([T.StructField("position", T.IntegerType()), T.StructField("name", T.StringType()),
                           T.StructField("type", T.StringType()), T.StructField("nullable", T.BooleanType())])
    return spark.createDataFrame(rows, schema)


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
