"""Grouped counts turned wide by a category, with a pair-level threshold.

The pivot is written as conditional aggregates over an explicit value list, so it needs no
extra job to discover the values and stays one hash aggregation. It is split in two phases:
``pivot_partial`` counts per (any grouping key) and ``pivot_finish`` adds those up per row key
and applies the threshold. Between them the partial counts can be joined to dimensions, which
lets a mart count a large fact per join key *before* the join (one row per key crosses the
join instead of one row per fact row, and a hot key collapses map-side).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _plain(v: str) -> str:
    """``v`` as part of a column name that needs no quoting: bytes other than letters and digits as hex."""
    return "".join(c if c.isalnum() and c.isascii() else f"_{ord(c):x}_" for c in v)


def _cnt(v: str) -> str:
    return f"_cnt_{_plain(v)}"


def _rows(v: str) -> str:
    return f"_rows_{_plain(v)}"


def needs_rows(count_col: str | None, threshold: int | None) -> bool:
    """Whether pair presence must be tracked apart from the count: only when a pair with a
    count of 0 can still be shown (counting a nullable column, no threshold at or above 0)."""
    return count_col is not None and (threshold is None or threshold < 0)


def pivot_partial(df: DataFrame, group_keys: Sequence["str | Column"], pivot_col: str,
                  values: Sequence[str], count_col: str | None = None, track_rows: bool = True) -> DataFrame:
    """Per group: for every pivot value, the count of non-null ``count_col`` (rows when None)
    and, with ``track_rows``, the number of rows (so that a value absent from a group stays
    distinguishable from a count of 0). Leave ``track_rows`` off when :func:`needs_rows` says
    so: it halves what crosses the shuffle."""
    pv = F.col(pivot_col)
    aggs = []
    for v in values:
        hit = pv == F.lit(v)
        target = F.lit(1) if count_col is None else F.col(count_col)
        aggs.append(F.count(F.when(hit, target)).alias(_cnt(v)))
        if track_rows and count_col is not None:
            aggs.append(F.count_if(hit).alias(_rows(v)))
    return df.filter(pv.isin(list(values))).groupBy(*group_keys).agg(*aggs)


def pivot_finish(partial: DataFrame, row_keys: Sequence[str], values: Sequence[str],
                 threshold: int | None = None, names: Sequence[str] | None = None,
                 grouped: bool = False) -> DataFrame:
    """Add partial counts up per ``row_keys``; a cell is null when its (row, value) pair has no
    rows or its count is at or under ``threshold``; rows with every cell null are dropped.
    ``grouped=True`` says ``partial`` already has one row per ``row_keys`` (it was counted by
    exactly those keys), so nothing is added up again."""
    names = list(names or values)
    # without a rows column the count itself tells whether the pair has rows
    presence = {v: (_rows(v) if _rows(v) in partial.columns else _cnt(v)) for v in values}
    if grouped:
        summed = partial
    else:
        summed = partial.groupBy(*row_keys).agg(
            *[F.sum(_cnt(v)).alias(_cnt(v)) for v in values],
            *[F.sum(presence[v]).alias(_rows(v)) for v in values if presence[v] != _cnt(v)])
    cells = []
    for v, name in zip(values, names):
        keep = F.col(_rows(v) if presence[v] != _cnt(v) else _cnt(v)) > 0
        if threshold is not None:
            keep = keep & (F.col(_cnt(v)) > F.lit(threshold))
        cells.append(F.when(keep, F.col(_cnt(v))).alias(name))
    out = summed.select(*row_keys, *cells)
    any_cell = None
    for name in names:
        c = F.col("`" + name.replace("`", "``") + "`").isNotNull()
        any_cell = c if any_cell is None else any_cell | c
    return out.filter(any_cell)


def pivot_counts(df: DataFrame, row_keys: Sequence[str], pivot_col: str, values: Sequence[str],
                 count_col: str | None = None, threshold: int | None = None,
                 names: Sequence[str] | None = None) -> DataFrame:
    """``SELECT count(count_col), row_keys, pivot_col ... WHERE pivot_col IN values GROUP BY``,
    minus (row, value) pairs with count <= threshold, unstacked into one column per value."""
    partial = pivot_partial(df, row_keys, pivot_col, values, count_col, needs_rows(count_col, threshold))
    return pivot_finish(partial, row_keys, values, threshold, names, grouped=True)
