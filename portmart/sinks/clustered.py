"""Files clustered by several columns at once (A10), so that filters on any of them skip files and row groups.

Each column's values are ranked by its quantiles, the bits of the ranks are interleaved into one number, and rows
are range-partitioned and sorted by it: neighbouring rows are close in every column, so the minima
and maxima that Parquet keeps per file and row group are narrow in every column. Sorting by one
column only makes the first one's narrow. A month layout with states sorted inside keeps both narrow only
within a month's folder; this layout serves a filter on states over all months as well.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 6  # of a column's rank: 63 bounds
ACCURACY = 10_000


def _q(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def ordinal(c: Column, kind: str) -> Column:
    """A number in the order of the column's values: strings by their first seven bytes."""
    if kind == "string":
        return F.conv(F.rpad(F.hex(F.substring(F.encode(c, "UTF-8"), 1, 7)), 14, "0"), 16, 10).cast("long")
    if kind in ("date", "timestamp", "timestamp_ntz"):
        return F.unix_timestamp(c.cast("timestamp"))
    return c.cast("double")


def quantile_bounds(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> dict[str, list]:
    """Ascending distinct quantiles of each column's ordinals, by one aggregation over all of them."""
    kinds = dict(df.dtypes)
    steps = [i / (1 << bits) for i in range(1, 1 << bits)]
    row = df.agg(*[F.percentile_approx(ordinal(_q(c), kinds[c]), steps, ACCURACY).alias(f"b{i}") for i, c in enumerate(columns)]).first()
    return {c: sorted({b for b in (row[i] or []) if b is not None and b == b}) for i, c in enumerate(columns)}


def rank(c: Column, bounds: Sequence, below: int = 0) -> Column:
    """How many of the ascending bounds are at or below the value, by halving; 0 for null."""
    if not bounds:
        return F.lit(below)
    mid = len(bounds) // 2
    return F.when(c >= F.lit(bounds[mid]), rank(c, bounds[mid + 1:], below + mid + 1)).otherwise(rank(c, bounds[:mid], below))


def interleaved(ranks: Sequence[Column], bits: int = BITS) -> Column:
    """The bits of the ranks taken in turn, the highest first."""
    out = F.lit(0).cast("long")
    for bit in range(bits):
        for i, r in enumerate(ranks):
            out = out.bitwiseOR(F.shiftleft(F.shiftright(r, bit).bitwiseAND(F.lit(1)).cast("long"), bit * len(ranks) + i))
    return out


def write_clustered(df: DataFrame, path: str, columns: Sequence[str], files: int | None = None, bits: int = BITS, mode: str = "overwrite",
                    row_group_bytes: int | None = None) -> None:
    """Write ``df`` clustered by ``columns``, in ``files`` ranges (the session's shuffle partitions). Rows of one
    place in the order, such as a state's in one month, may be more than a range's share: ties are dealt on by
    the other columns."""
    kinds = dict(df.dtypes)
    bounds = quantile_bounds(df, columns, bits)
    ordinals = df.withColumns({f"_o{i}": ordinal(_q(c), kinds[c]) for i, c in enumerate(columns)})
    ranked = ordinals.withColumns({f"_r{i}": rank(F.col(f"_o{i}"), bounds[c]) for i, c in enumerate(columns)})
    z = interleaved([F.col(f"_r{i}") for i in range(len(columns))], bits)
    n = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tie = F.xxhash64(*[_q(c) for c in df.columns])
    ordered = ranked.select(*[_q(c) for c in df.columns], z.alias("_z"), tie.alias("_tie")).repartitionByRange(n, "_z", "_tie")
    out = ordered.sortWithinPartitions("_z", *[_q(c) for c in columns]).drop("_z", "_tie")
    writer = out.write.mode(mode)
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    writer.parquet(path)
