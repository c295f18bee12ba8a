"""Whole jobs: raw files -> published, checked tables.

Each job reads its raw input once, stages the cleaned rows (so both tables built from arrivals
see the same survivors and the lineage is cut), writes its tables, and checks them. Row counts
of the cleaning steps ride on the staging write (``Observation``), so they cost no extra scan.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from portmart import schemas
from portmart.operators.quality import CheckSpec, StepCounter, enforce, run_checks
from portmart.plans import tables as H
from portmart.sinks.writers import drop_staged, stage, write_parquet, write_partitioned
from portmart.sources.files import malformed_cells, read_csv_counted, read_parquet
from portmart.sources.labels import read_numbered_lines
from portmart.sources.quarantine import read_csv_split
from portmart.sources.sas import read_sas, skipped_files

log = logging.getLogger(__name__)


@dataclass
class JobResult:
    tables: dict[str, str] = field(default_factory=dict)
    checks: list = field(default_factory=list)
    steps: list = field(default_factory=list)
    malformed: dict[str, int] = field(default_factory=dict)  # CSV cells read as null, per column
    skipped: list[str] = field(default_factory=list)  # input files that were not read
    rejected: int = 0  # CSV records in quarantine


def _join(base: str, name: str) -> str:
    return base.rstrip("/") + "/" + name


def _publish_and_check(spark: SparkSession, built: dict[str, DataFrame], paths: dict[str, str],
                       on_fail: str, result: JobResult) -> None:
    """Check schemas on the frames as built (analysis only, no job; a Parquet read-back would
    report every column nullable) and completeness on the written copies (counted from the
    files, not by recomputing the build)."""
    specs = []
    for name, df in built.items():
        result.tables[name] = paths[name]
        specs.append(CheckSpec(name, df, schemas.PUBLISHED[name], completeness=False))
        # read with the declared types, or an all-digit partition value would come back as a number
        specs.append(CheckSpec(name, read_parquet(spark, paths[name], schema=schemas.PUBLISHED[name])))
    result.checks += enforce(run_checks(spark, specs), on_fail=on_fail)


def process_arrivals(spark: SparkSession, input_path: str, output_path: str, sas_format: str = "sas7bdat",
                     raw: DataFrame | None = None, fact_partition_by=("state_code",),
                     drop_null_keys: bool = False, on_fail: str = "warn") -> JobResult:
    """Arrivals SAS files -> ``fact_immigration`` (partitioned) + ``dim_immigrant_demographics``.

    ``sas_format`` ``parquet`` or ``csv`` takes arrivals already converted, through Spark's own
    splittable scan; a SAS7BDAT file is decoded by one task."""
    result, seen = JobResult(), None
    if raw is None and sas_format == "parquet":
        raw = read_parquet(spark, input_path, schema=schemas.RAW_ARRIVALS)
    elif raw is None and sas_format == "csv":
        raw, seen = read_csv_counted(spark, input_path, schemas.RAW_ARRIVALS)
    elif raw is None:
        raw = read_sas(spark, input_path, schemas.RAW_ARRIVALS, sas_format=sas_format)
        result.skipped = skipped_files(spark, input_path, sas_format)
    counter = StepCounter("arrivals")
    cleaned = stage(counter.run(raw, H.arrivals_steps(drop_null_keys=drop_null_keys)))
    result.steps = counter.counts()
    if seen is not None:
        result.malformed = malformed_cells(seen, input_path)
    fact = H.build_fact(cleaned)
    dim = H.build_immigrant_dim(cleaned)
    paths = {"fact_immigration": _join(output_path, "fact_immigration"),
             "dim_immigrant_demographics": _join(output_path, "dim_immigrant_demographics")}
    write_partitioned(fact, paths["fact_immigration"], list(fact_partition_by))
    write_parquet(dim, paths["dim_immigrant_demographics"])
    drop_staged(spark, cleaned)
    _publish_and_check(spark, {"fact_immigration": fact, "dim_immigrant_demographics": dim}, paths, on_fail, result)
    return result


@dataclass(frozen=True)
class Quarantine:
    """Where records that do not fit go, and how many a job bears."""

    path: str
    max_rejected: int | None = None
    max_share: float | None = None


def _read_csv(spark: SparkSession, input_path: str, schema, sep: str, quarantine: Quarantine | None, result: JobResult):
    """(records, counts of malformed cells or None). With ``quarantine`` records that do not fit are left out
    and kept there, else their bad cells are null and counted."""
    if quarantine is None:
        return read_csv_counted(spark, input_path, schema, sep=sep)
    split = read_csv_split(spark, input_path, schema, quarantine.path, sep, quarantine.max_rejected, quarantine.max_share)
    result.rejected = split.rejected_rows
    return split.good, None


def process_demographics(spark: SparkSession, input_path: str, output_path: str, on_fail: str = "warn",
                         quarantine: Quarantine | None = None, id_path: str | None = None) -> JobResult:
    """City demographics ';' CSV -> ``dim_city_demographics`` (H13). ``id_path``: a stored key registry, so
    that a row keeps its id over refreshes."""
    result = JobResult()
    raw, seen = _read_csv(spark, input_path, schemas.RAW_DEMOGRAPHICS, ";", quarantine, result)
    counter = StepCounter("demographics")
    cleaned = counter.run(raw, H.demographics_steps())
    registry = None
    if id_path is not None:
        cleaned, registry = stage(cleaned), H.city_demographics_ids(spark, id_path)
    dim = H.build_city_demographics(cleaned, registry=registry)
    path = _join(output_path, "dim_city_demographics")
    write_parquet(dim, path)
    result.steps = counter.counts()
    if seen is not None:
        result.malformed = malformed_cells(seen, input_path)
    _publish_and_check(spark, {"dim_city_demographics": dim}, {"dim_city_demographics": path}, on_fail, result)
    return result


def process_temperature(spark: SparkSession, input_path: str, output_path: str, on_fail: str = "warn",
                        quarantine: Quarantine | None = None) -> JobResult:
    """City temperature CSV -> ``dim_temperature``."""
    result = JobResult()
    raw, seen = _read_csv(spark, input_path, schemas.RAW_TEMPERATURE, ",", quarantine, result)
    counter = StepCounter("temperature")
    cleaned = counter.run(raw, H.temperature_steps())
    # the cleaning already left one row per (dt, City, Country): no second distinct needed
    dim = H.build_temperature(cleaned, distinct=False)
    path = _join(output_path, "dim_temperature")
    write_parquet(dim, path)
    result.steps = counter.counts()
    if seen is not None:
        result.malformed = malformed_cells(seen, input_path)
    _publish_and_check(spark, {"dim_temperature": dim}, {"dim_temperature": path}, on_fail, result)
    return result


def process_labels(spark: SparkSession, input_path: str, output_path: str, country_lines=H.COUNTRY_LINES,
                   city_lines=H.CITY_LINES, state_lines=H.STATE_LINES, on_fail: str = "warn",
                   blocks: dict | None = None) -> JobResult:
    """Label description file -> ``dim_country``, ``dim_city``, ``dim_state``.

    Blocks are taken by fixed line ranges, or by name when ``blocks`` maps ``country``,
    ``city``, ``state`` to format names (e.g. ``{'country': 'i94cntyl', 'city': '$i94prtl',
    'state': 'i94addrl'}``)."""
    result = JobResult()
    lines = read_numbered_lines(spark, input_path)
    blocks = blocks or {}
    built = {"dim_country": H.build_country_dim(lines, country_lines, blocks.get("country")),
             "dim_city": H.build_city_dim(lines, city_lines, blocks.get("city")),
             "dim_state": H.build_state_dim(lines, state_lines, blocks.get("state"))}
    paths = {k: _join(output_path, k) for k in built}
    for k, df in built.items():
        write_parquet(df, paths[k])
    drop_staged(spark, lines)
    _publish_and_check(spark, built, paths, on_fail, result)
    return result


@dataclass
class Inputs:
    labels: str
    arrivals: str
    demographics: str
    temperature: str
    sas_format: str = "sas7bdat"
    country_lines: tuple = H.COUNTRY_LINES
    city_lines: tuple = H.CITY_LINES
    state_lines: tuple = H.STATE_LINES
    label_blocks: dict | None = None  # find blocks by format name instead of line ranges


def run_all(spark: SparkSession, inputs: Inputs, output_path: str, on_fail: str = "warn") -> dict[str, JobResult]:
    """Labels, arrivals, demographics, temperature, in that order."""
    return {
        "labels": process_labels(spark, inputs.labels, output_path, inputs.country_lines, inputs.city_lines,
                                 inputs.state_lines, on_fail=on_fail, blocks=inputs.label_blocks),
        "arrivals": process_arrivals(spark, inputs.arrivals, output_path, sas_format=inputs.sas_format,
                                     on_fail=on_fail),
        "demographics": process_demographics(spark, inputs.demographics, output_path, on_fail=on_fail),
        "temperature": process_temperature(spark, inputs.temperature, output_path, on_fail=on_fail),
    }


MONTH_LAYOUT = ("year", "month")
MONTH_TABLES = ("fact_immigration", "dim_immigrant_demographics")


def _write_months(month_raw: DataFrame, output_path: str, dynamic: bool) -> dict[str, str]:
    spark = month_raw.sparkSession
    cleaned = stage(H.clean_month_arrivals(month_raw))
    paths = {name: _join(output_path, name) for name in MONTH_TABLES}
    for name, built in (("fact_immigration", H.build_month_fact(cleaned)),
                        ("dim_immigrant_demographics", H.build_month_immigrant_dim(cleaned))):
        sort = ["state_code"] if name == "fact_immigration" else []
        write_partitioned(built, paths[name], list(MONTH_LAYOUT), dynamic=dynamic, sort_within=sort)
    drop_staged(spark, cleaned)
    return paths


def publish_arrivals_months(raw: DataFrame, output_path: str) -> dict[str, str]:
    """Arrivals of any months -> fact and immigrant dimension stored by (year, month) (H12 in the
    layout that :func:`refresh_arrivals_months` keeps up to date)."""
    return _write_months(raw, output_path, dynamic=False)


def refresh_arrivals_months(month_raw: DataFrame, output_path: str) -> dict[str, str]:
    """Replace exactly the months of ``month_raw`` in the fact and the immigrant dimension.

    An arrival is identified by (cicid, year, month): rows are deduplicated within a month and ids
    derive from that key, so the tables are the same whether months come together or one by one,
    and ids stay unique over refreshes. Months are the partition leaves, so dynamic overwrite swaps
    a month as a whole. Rows are clustered by state inside the fact's files. A table stored in
    another layout is refused."""
    spark = month_raw.sparkSession
    for name in MONTH_TABLES:
        path = _join(output_path, name)
        try:
            files = spark.read.parquet(path).inputFiles()
        except AnalysisException:  # nothing published yet
            continue
        if any("/year=" not in f or "/month=" not in f for f in files):
            raise ValueError(f"{path} is not stored by (year, month); publish it with publish_arrivals_months")
    return _write_months(month_raw, output_path, dynamic=True)


def refresh_temperature_months(raw: DataFrame, path: str) -> None:
    """Replace the months of ``raw`` readings in a temperature table stored by (year, month)."""
    dim = H.build_temperature(H.clean_temperature(raw), distinct=False)
    write_partitioned(dim, path, list(MONTH_LAYOUT), dynamic=True)
