"""Run registered queries next to their DuckDB oracle and compare (row count, column names,
order-insensitive values). Usable from pytest and as a script:

    python tests/oracle_check.py [key ...]
"""

from __future__ import annotations

import datetime
import math
import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (0, "")
        return (1, float(f"{v:.10g}"))
    if isinstance(v, (pd.Timestamp, datetime.date)):
        # pandas turns DuckDB DATE into datetime64; compare dates and timestamps as timestamps
        return (1, pd.Timestamp(v).to_pydatetime().replace(tzinfo=None))
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except (ValueError, AttributeError):
            pass
    if isinstance(v, (list, tuple)):
        return (1, tuple(_norm(x) for x in v))
    return (1, v)


def rows_of(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    df = df[cols].astype(object).where(pd.notna(df[cols]), None)
    return sorted((tuple(_norm(v) for v in r) for r in df.itertuples(index=False, name=None)),
                  key=lambda r: repr(r))


# Spark type -> DuckDB type name, for the schema part of the comparison.
_DUCK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "double": "DOUBLE", "float": "FLOAT",
               "string": "VARCHAR", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
               "array<float>": "FLOAT[]"}


def spark_types(df) -> dict:
    return {f.name: _DUCK_TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}


def compare(spark, key: str, fn, sql: str | None, sf_dir: str, con=None) -> dict:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    got_types = spark_types(sdf)
    got = sdf.toPandas()
    spark_sec = time.time() - t0
    out = {"key": key, "spark_rows": len(got), "spark_sec": round(spark_sec, 2)}
    if sql is None:
        out["status"] = "no-oracle"
        return out
    con = con or duck(sf_dir)
    rel = con.sql(sql)
    want_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    want = rel.df()
    out["oracle_rows"] = len(want)
    if sorted(got.columns) != sorted(want.columns):
        out["status"] = f"columns differ: {sorted(got.columns)} vs {sorted(want.columns)}"
        return out
    if got_types != want_types:
        diff = {c: (got_types[c], want_types.get(c)) for c in got_types if got_types[c] != want_types.get(c)}
        out["status"] = f"types differ: {diff}"
        return out
    a, b = rows_of(got), rows_of(want)
    if len(a) != len(b):
        out["status"] = "row count differs"
    elif a != b:
        bad = next(i for i, (x, y) in enumerate(zip(a, b)) if x != y)
        out["status"] = f"values differ, first at {bad}: {a[bad]} vs {b[bad]}"
    else:
        out["status"] = "match"
    return out


def main(argv: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from portmart.session import build_session
    sf_dir = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
    spark = build_session("local[8]", 8)
    qs, sqls = queries(), oracle_sql()
    keys = argv or list(qs)
    con = duck(sf_dir)
    bad = 0
    for k in keys:
        try:
            r = compare(spark, k, qs[k], sqls.get(k), sf_dir, con)
        except Exception as e:  # report and continue
            r = {"key": k, "status": f"error: {type(e).__name__}: {str(e)[:300]}"}
        bad += r["status"] not in ("match", "no-oracle")
        print(r, flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
