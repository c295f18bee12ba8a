"""File scans with declared schemas."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

log = logging.getLogger(__name__)
_RECORD = "_malformed_record"


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None, sep: str = ",",
             header: bool = True, infer: bool = False, date_format: str | None = None) -> DataFrame:
    """CSV scan (A2 comma, A3 ';', A4 inference).

    With ``schema`` the columns come typed straight from the scan (no inference pass, no
    all-string read), and a header that does not name them in this order fails the read; without
    one, ``infer=True`` reads the data once more to find types, else every column is text.
    Malformed cells become null (PERMISSIVE); ``read_csv_counted`` counts them.
    """
    reader = (spark.read.option("header", header).option("sep", sep).option("mode", "PERMISSIVE")
              .option("enforceSchema", not header))
    if date_format:
        reader = reader.option("dateFormat", date_format)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def read_csv_counted(spark: SparkSession, path: str, schema: StructType, sep: str = ",") -> tuple[DataFrame, Observation]:
    """``read_csv`` with a header and a declared schema, and the counts of what did not fit it.

    The counts ride on the first action over all rows of the frame (``malformed_cells`` reads
    them): per column the cells whose text is not of its type (they are null in the frame), and
    the records that have too few or too many cells."""
    marked = StructType([*schema.fields, StructField(_RECORD, StringType())])
    raw = (spark.read.option("header", True).option("sep", sep).option("mode", "PERMISSIVE").option("enforceSchema", False)
           .option("columnNameOfCorruptRecord", _RECORD).schema(marked).csv(path))
    names = schema.fieldNames()
    text = ", ".join(f"`{name}` string" for name in names)
    cells = F.from_csv(F.col(_RECORD), text, {"sep": sep})
    bad = [cells.getField(name).isNotNull() & F.col(f"`{name}`").isNull() for name in names]
    anywhere = bad[0]
    for b in bad[1:]:
        anywhere = anywhere | b
    counts = [F.count(F.when(b, 1)).alias(name) for name, b in zip(names, bad)]
    seen = Observation()
    return raw.observe(seen, *counts, F.count(F.when(F.col(_RECORD).isNotNull() & ~anywhere, 1)).alias(_RECORD)).drop(_RECORD), seen


def malformed_cells(seen: Observation, path: str) -> dict[str, int]:
    """Counts above zero per column (records of another length under ``(record)``), also logged."""
    found = {"(record)" if k == _RECORD else k: int(n) for k, n in seen.get.items() if n}
    if found:
        log.warning("%s: malformed cells read as null, per column: %s", path, found)
    return found


def read_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Parquet scan, partitioned or not (A5). A declared schema also types partition columns,
    so an all-digit partition value is not read back as a number."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Make ``df`` visible to ``spark.sql`` under ``name`` (A13); the view keeps the plan, not data."""
    df.createOrReplaceTempView(name)
    return df


def preview(df: DataFrame, n: int = 5):
    """First ``n`` rows to the driver as pandas (A14); callers decide when to collect."""
    return df.limit(n).toPandas()
