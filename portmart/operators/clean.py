"""Projection, renaming, null and duplicate handling."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def select_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Keep the named columns in the given order (B1)."""
    return df.select(*[F.col(_q(c)) for c in cols])


def drop_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Drop the named columns; names that are not present are ignored (B2)."""
    return df.drop(*cols)


def rename_columns(df: DataFrame, mapping: Mapping[str, str], missing: str = "raise") -> DataFrame:
    """Rename by mapping in one projection.

    ``withColumnRenamed`` silently ignores a missing source column, so a misspelt header would
    slip through; here a missing source raises unless ``missing='ignore'``.
    """
    absent = [old for old in mapping if old not in df.columns]
    if absent and missing == "raise":
        raise KeyError(f"cannot rename missing column(s) {absent}; present: {df.columns}")
    return df.withColumnsRenamed({old: new for old, new in mapping.items() if old in df.columns})


def drop_null_rows(df: DataFrame, how: str = "any", subset: Iterable[str] | None = None) -> DataFrame:
    """Drop rows null (or NaN) in any/all of ``subset`` (all columns when None)."""
    return df.dropna(how=how, subset=list(subset) if subset is not None else None)


def distinct_rows(df: DataFrame) -> DataFrame:
    """Distinct whole rows."""
    return df.distinct()


def dedup_first(df: DataFrame, keys: Iterable[str], order_by: Iterable[str] | None = None,
                drop_null_keys: bool = False) -> DataFrame:
    """One row per key with a deterministic survivor.

    The survivor is the smallest row by ``order_by`` then by every remaining column in column
    order, nulls first. Written as ``row_number() = 1`` over the key, which Spark plans with a
    partial group limit *before* the shuffle (each task keeps one row per key, so a key holding
    a third of the rows leaves every task as one row) and a final one after it. The result does
    not depend on partitioning or task order.

    ``drop_null_keys=True`` first removes rows with a null key; otherwise all null-key rows
    share one group, as with ``dropDuplicates``.
    """
    keys = list(keys)
    order = [c for c in (order_by or []) if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order]
    if drop_null_keys:
        df = df.dropna(how="any", subset=keys)
    if not order and not rest:
        return df.select(*[F.col(_q(k)) for k in keys]).distinct()
    rank = "_dedup_rank"
    w = Window.partitionBy(*[F.col(_q(k)) for k in keys]).orderBy(
        *[F.col(_q(c)).asc_nulls_first() for c in order + rest])
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) == 1).drop(rank)


def dedup_any(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """One row per key where any survivor will do (``dropDuplicates``)."""
    return df.dropDuplicates(list(keys))


def _q(name: str) -> str:
    """Quote a column name so names with spaces or dots resolve literally."""
    return "`" + name.replace("`", "``") + "`"
