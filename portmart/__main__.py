"""Command line: the jobs, the two mart questions and the missing-value profile.

    python -m portmart run --labels L --arrivals A --demographics D --temperature T --out O
    python -m portmart mart state-gender --tables O --out R [--threshold 20000]
    python -m portmart mart visa-gender --tables O --out R
    python -m portmart profile --input P --format sas|csv|csv;|parquet --out R [--limit 85]

``--out`` writes the whole result as Parquet; ``--show N`` prints its first N rows.

Run it with ``spark-submit`` on a cluster (the session comes from the submit settings); only
when no master is configured does it start a local one.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession


def _session() -> SparkSession:
    from portmart.session import DEFAULT_CONF, ensure_checkpoint_dir
    builder = SparkSession.builder.appName("portmart")
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def _deliver(df, order: str, args) -> int:
    if args.out is not None:
        df.write.mode("overwrite").parquet(args.out)
        df = df.sparkSession.read.parquet(args.out)
    if args.show is not None:
        df.orderBy(order).show(args.show, truncate=False)
    return 0


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    p = argparse.ArgumentParser(prog="portmart")
    sub = p.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("run", help="labels, arrivals, demographics, temperature -> checked tables")
    r.add_argument("--labels", required=True)
    r.add_argument("--arrivals", required=True)
    r.add_argument("--demographics", required=True)
    r.add_argument("--temperature", required=True)
    r.add_argument("--out", required=True)
    r.add_argument("--sas-format", default="sas7bdat", choices=["sas7bdat", "xport", "parquet", "csv"])
    r.add_argument("--on-fail", default="raise", choices=["raise", "warn"])
    m = sub.add_parser("mart", help="mart questions over the written tables")
    m.add_argument("question", choices=["state-gender", "visa-gender"])
    m.add_argument("--tables", required=True)
    m.add_argument("--threshold", type=int, default=None)
    f = sub.add_parser("profile", help="missing-value profile of a dataset, per file and total")
    f.add_argument("--input", required=True)
    f.add_argument("--format", default="parquet", choices=["sas", "xport", "csv", "csv;", "parquet"])
    f.add_argument("--limit", type=float, default=None)
    for q in (m, f):
        q.add_argument("--out", help="write the whole result here")
        q.add_argument("--show", type=int, help="print the first rows")
    args = p.parse_args(argv)
    if args.cmd != "run" and args.out is None and args.show is None:
        p.error("give --out, --show or both")
    spark = spark or _session()

    if args.cmd == "run":
        from portmart.plans.jobs import Inputs, run_all
        res = run_all(spark, Inputs(labels=args.labels, arrivals=args.arrivals, demographics=args.demographics,
                                    temperature=args.temperature, sas_format=args.sas_format),
                      args.out, on_fail=args.on_fail)
        print(json.dumps({job: {"tables": r.tables, "steps": r.steps,
                                "checks": [dict(c.asDict()) for c in r.checks]} for job, r in res.items()}))
        return 0 if all(c["passed"] for r in res.values() for c in r.checks) else 1

    if args.cmd == "mart":
        from portmart.plans import marts
        fact = spark.read.parquet(args.tables.rstrip("/") + "/fact_immigration")
        dim = spark.read.parquet(args.tables.rstrip("/") + "/dim_immigrant_demographics")
        if args.question == "state-gender":
            t = marts.STATE_THRESHOLD if args.threshold is None else args.threshold
            out = marts.arrivals_by_state_gender(fact, dim, threshold=t)
        else:
            out = marts.arrivals_by_visa_gender(fact, dim)
        return _deliver(out, out.columns[0], args)

    if args.cmd == "profile":
        from portmart import schemas
        from portmart.operators.profile import missing_profile_over_files
        from portmart.sources.files import read_csv
        from portmart.sources.sas import read_sas
        if args.format in ("sas", "xport"):
            from pyspark.sql import functions as F
            df = read_sas(spark, args.input, schemas.RAW_ARRIVALS, with_source_file=True,
                          sas_format="xport" if args.format == "xport" else "sas7bdat")
            prof = missing_profile_over_files(df, args.limit, file_col=F.col("source_file"),
                                              cols=schemas.RAW_ARRIVALS.fieldNames())
        elif args.format.startswith("csv"):
            df = read_csv(spark, args.input, sep=";" if args.format == "csv;" else ",")
            prof = missing_profile_over_files(df, args.limit)
        else:
            prof = missing_profile_over_files(spark.read.parquet(args.input), args.limit)
        return _deliver(prof, "field", args)
    return 2


if __name__ == "__main__":
    sys.exit(main())
