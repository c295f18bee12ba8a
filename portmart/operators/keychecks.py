"""Checks of keys and references between tables (G1-G3 over D2-D6).

Every table's keys are counted once (a hot key is summed up before the shuffle), and the counts, one
row per key, serve its uniqueness and every reference from and to it. Nothing depends on a table's
size, nothing is collected but the report.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portmart.operators.quality import REPORT_SCHEMA
from portmart.sinks.writers import stage


@dataclass(frozen=True)
class Key:
    """A key of ``df``: columns by name, or expressions with aliases."""

    table: str
    df: DataFrame
    columns: Sequence["str | Column"]
    unique: bool = True

    @property
    def name(self) -> str:
        return ", ".join(c if isinstance(c, str) else str(c._jc.toString()).split(" AS ")[-1] for c in self.columns)


@dataclass(frozen=True)
class Reference:
    """``child``'s key refers to ``parent``'s."""

    child: Key
    parent: Key


KEY_REPORT = "table_name string, check_name string, passed boolean, keys long, bad_keys long, bad_rows long, null_rows long"


def key_counts(key: Key) -> DataFrame:
    """(k0, k1, ..., n): rows per key, null keys included."""
    cols = [F.col("`" + c.replace("`", "``") + "`") if isinstance(c, str) else c for c in key.columns]
    named = key.df.select(*[c.alias(f"k{i}") for i, c in enumerate(cols)])
    return named.groupBy(*[f"k{i}" for i in range(len(cols))]).agg(F.count(F.lit(1)).alias("n"))


def _whole(n: int) -> Column:
    out = F.lit(True)
    for i in range(n):
        out = out & F.col(f"k{i}").isNotNull()
    return out


def _row(key: Key, check: str, counts: DataFrame, bad: Column, bad_rows: Column) -> DataFrame:
    whole = _whole(len(key.columns))
    count = counts.agg(F.count_if(whole).alias("keys"), F.count_if(whole & bad).alias("bad_keys"),
                       F.coalesce(F.sum(F.when(whole & bad, bad_rows)), F.lit(0)).cast("long").alias("bad_rows"),
                       F.coalesce(F.sum(F.when(~whole, F.col("n"))), F.lit(0)).cast("long").alias("null_rows"))
    return count.select(F.lit(key.table).alias("table_name"), F.lit(check).alias("check_name"), (F.col("bad_keys") == 0).alias("passed"),
                        "keys", "bad_keys", "bad_rows", "null_rows")


def key_report(keys: Sequence[Key], references: Sequence[Reference] = ()) -> DataFrame:
    """KEY_REPORT rows. ``unique``: bad keys stand more than once, bad rows are those beyond the first.
    ``refers``: bad keys have no row in the parent, bad rows are the child's rows of such keys. Rows with
    a null in the key are counted apart and are neither."""
    held: dict[int, DataFrame] = {}

    def counts(key: Key) -> DataFrame:
        if id(key) not in held:
            held[id(key)] = stage(key_counts(key))
        return held[id(key)]
    parts = [_row(k, f"unique({k.name})", counts(k), F.col("n") > 1, F.col("n") - 1) for k in keys if k.unique]
    for r in references:
        n = len(r.child.columns)
        if n != len(r.parent.columns):
            raise ValueError(f"{r.child.table} ({r.child.name}) and {r.parent.table} ({r.parent.name}) differ in length")
        there = counts(r.parent).select(*[F.col(f"k{i}").alias(f"p{i}") for i in range(n)], F.lit(True).alias("there"))
        on = F.lit(True)
        for i in range(n):
            on = on & (F.col(f"k{i}") == F.col(f"p{i}"))
        parts.append(_row(r.child, f"refers({r.child.name} -> {r.parent.table}.{r.parent.name})", counts(r.child).join(there, on, "left"),
                          F.col("there").isNull(), F.col("n")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def as_checks(report: DataFrame) -> DataFrame:
    """A key report as rows of ``quality.REPORT_SCHEMA``, for ``run_checks`` and ``enforce``."""
    detail = F.format_string("%d keys, %d bad in %d rows, %d rows without key", "keys", "bad_keys", "bad_rows", "null_rows")
    return report.select("table_name", "check_name", "passed", detail.alias("detail")).select(*REPORT_SCHEMA.names)


def require_unique(df: DataFrame, key: str) -> int:
    """The number of rows of ``df``, whatever its size; raises if a key stands twice (null keys may).

    One pass over the key column, summed up per key before the shuffle."""
    n, bad = (key_counts(Key("", df, [key])).agg(F.sum("n"), F.count_if(F.col("k0").isNotNull() & (F.col("n") > 1))).first())
    if bad:
        raise ValueError(f"{key} is not unique: {bad} codes are repeated")
    return int(n or 0)
