"""Joins between the fact and its dimensions.

A side is broadcast only with a proven bound: first the optimizer's size estimate (file sizes
for scans, an upper bound after filters and aggregates; no job) must be small, then a counted
number of rows must come in under ``max_rows``. A side that fails either
test is joined plainly, so the optimizer and AQE pick a sort-merge join, or a broadcast once the
measured size at run time is small, and split skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Largest dimension we broadcast (rows, and estimated bytes on disk). Lookup tables
# (countries, ports, states, months) are far below it; facts and big dims are far above it.
DEFAULT_BROADCAST_ROWS = 2_000_000
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int | None:
    """The optimizer's size estimate of ``df`` (an upper bound for scans, filters and
    aggregates; what Spark's own broadcast threshold uses), or None where not available."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # e.g. a client without access to the plan
        return None


def has_at_most(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has no more than ``max_rows`` rows (bounded job)."""
    return df.limit(max_rows + 1).count() <= max_rows


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                       max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``F.broadcast(df)`` when ``df`` is proven small, else ``df`` as is (AQE decides).

    A large size estimate skips the counting job altogether, so a big table is never scanned
    just to learn that it is big."""
    est = estimated_bytes(df)
    if est is not None and est > max_bytes:
        return df
    return F.broadcast(df) if has_at_most(df, max_rows) else df


def equi_join(left: DataFrame, right: DataFrame, on: "str | Sequence[str] | Column",
              how: str = "inner", distinct: bool = False) -> DataFrame:
    """Plain equi-join (D1); ``distinct=True`` reproduces the distinct over the joined rows.

    When each side carries a unique id the distinct removes nothing but forces a shuffle over
    every column, so it is off by default.
    """
    out = left.join(right, on, how)
    return out.distinct() if distinct else out


def lookup_join(fact: DataFrame, dim: DataFrame, fact_key: "str | Column", dim_key: str,
                how: str = "left", max_dim_rows: int = DEFAULT_BROADCAST_ROWS,
                keep_dim_key: bool = False, unique: bool = False) -> DataFrame:
    """Fact left-joined to a lookup dimension on ``fact_key = dim_key``.

    The dimension's keys are counted whatever its size: a code that stands twice would double fact rows
    and raises. ``unique=True`` says that they are known to be unique (the dimension is grouped by them, or was
    checked by ``keychecks``), and no job is run for it. A dimension that is small by estimate and count is broadcast,
    so the fact is never shuffled for it; any other is joined plainly.
    Keys of different types are compared after casting the dimension key to the fact key's
    type by the caller (see ``code_text``).
    """
    from portmart.operators.keychecks import require_unique

    fk = F.col(fact_key) if isinstance(fact_key, str) else fact_key
    est = estimated_bytes(dim)
    small = est is None or est <= DEFAULT_BROADCAST_BYTES
    if unique:
        side = broadcast_if_small(dim, max_dim_rows)
    else:
        n = require_unique(dim, dim_key)
        side = F.broadcast(dim) if small and n <= max_dim_rows else dim
    out = fact.join(side, fk == side[dim_key], how)
    return out if keep_dim_key else out.drop(side[dim_key])


def code_text(c: "str | Column") -> Column:
    """Numeric code (e.g. 101.0) as the text code used by label lookups ('101')."""
    x = F.col(c) if isinstance(c, str) else c
    return F.when(~F.isnan(x.cast("double")), x.cast("double").try_cast("long").cast("string"))


def preaggregated_join(fact: DataFrame, detail: DataFrame, fact_key: str, detail_key: str,
                       aggs: Sequence[Column], how: str = "left") -> DataFrame:
    """Fact joined to a many-rows-per-key table after aggregating that table to the key.

    Aggregating first keeps one row per fact row (no fan-out); the aggregate's output is
    already hash-partitioned on the key, so the join adds only the fact-side shuffle.
    """
    rolled = detail.groupBy(F.col(detail_key).alias("_k")).agg(*aggs)
    return fact.join(rolled, fact[fact_key] == rolled["_k"], how).drop("_k")


def month_join(fact: DataFrame, readings: DataFrame, keys: Sequence[tuple[str, str]],
               how: str = "left", broadcast_readings: bool = False) -> DataFrame:
    """Fact joined to per-(place, year, month) readings on a composite key.

    ``keys`` pairs fact columns with reading columns. Readings must be unique on the key
    (aggregate them first), which keeps one output row per fact row. Readings are usually
    derived by an aggregation, whose size is only known once it ran: AQE measures it and turns
    the join into a broadcast when it is small, without computing the aggregate twice.
    ``broadcast_readings=True`` applies the proven-size check instead (for stored readings).
    """
    side = broadcast_if_small(readings) if broadcast_readings else readings
    cond = None
    for fcol, rcol in keys:
        c = fact[fcol] == side[rcol]
        cond = c if cond is None else cond & c
    out = fact.join(side, cond, how)
    for _, rcol in keys:
        out = out.drop(side[rcol])
    return out
