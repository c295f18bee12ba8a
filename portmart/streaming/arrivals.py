"""Arrivals as a stateful stream (H20): late and repeated rows, without rebuilding months.

An arrival's time is its day (else the first of its month). State holds the keys (cicid, i94yr, i94mon) of the last
``delay``: a row that comes again within it, in the same file or another one, is dropped; a row that
comes late, but within it, is taken. So state is bounded by the rows of ``delay``, whatever has come
before. Rows are added to ``<out>/arrivals`` by month; the file sink's log makes every batch count once.
What is later than ``delay`` cannot be told from a repeat: such rows are counted (``late_rows``), and a refresh of their
months from the landed files (``streaming.landed``) takes them in. Rows without any date have no time to
be late in; they go to ``<out>/undated`` as they come.

Of rows that share a key but differ, the stream keeps the one that came first; H1 keeps the smallest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, TimestampType

from portmart import schemas
from portmart.operators.clean import drop_columns
from portmart.plans.tables import ARRIVALS_SPARSE_COLUMNS
from portmart.session import stable_path

KEY = ["cicid", "i94yr", "i94mon"]
DELAY = "100 days"
_TIME = "arrival_time"


def arrival_time() -> Column:
    """The day of arrival, else the first day of its year and month, else null."""
    day = F.when(~F.isnan("arrdate") & F.col("arrdate").between(-100_000, 100_000), F.date_add(F.lit("1960-01-01").cast("date"), F.floor("arrdate").cast("int")))
    month = F.when(F.col("i94yr").between(1, 9999) & F.col("i94mon").between(1, 12), F.make_date(F.col("i94yr").cast("int"), F.col("i94mon").cast("int"), F.lit(1)))
    return F.coalesce(day, month).cast("timestamp")


def dated_and_undated(arrivals: DataFrame) -> tuple[DataFrame, DataFrame]:
    timed = drop_columns(arrivals, ARRIVALS_SPARSE_COLUMNS).withColumn(_TIME, arrival_time())
    return timed.filter(F.col(_TIME).isNotNull()), timed.filter(F.col(_TIME).isNull()).drop(_TIME)


def first_of_each(dated: DataFrame, delay: str = DELAY) -> DataFrame:
    """One row per key within ``delay`` of its time (streaming)."""
    return dated.withWatermark(_TIME, delay).dropDuplicatesWithinWatermark(KEY)


def run_arrival_stream(spark: SparkSession, landing: str, out: str, checkpoint: str | None = None, schema: StructType = schemas.RAW_ARRIVALS,
                       fmt: str = "parquet", delay: str = DELAY, max_files_per_trigger: int | None = None) -> dict[str, int]:
    """Process what has landed; ``rows``, ``late_rows`` (beyond ``delay``, not taken) and ``undated_rows`` of this run."""
    checkpoint = checkpoint or stable_path(spark, "arrival-stream-checkpoint", landing, out)
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("enforceSchema", False)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    dated, undated = dated_and_undated(reader.load(landing))
    done = {}
    for name, rows in (("arrivals", first_of_each(dated, delay).withColumns({"year": F.col("i94yr"), "month": F.col("i94mon")})), ("undated", undated)):
        writer = rows.writeStream.format("parquet").outputMode("append").option("path", f"{out}/{name}").option("checkpointLocation", f"{checkpoint}/{name}").trigger(availableNow=True)
        query = (writer.partitionBy("year", "month") if name == "arrivals" else writer).start()
        query.awaitTermination()
        if query.exception() is not None:
            raise query.exception()
        done[name] = query.recentProgress
    late = sum(op["numRowsDroppedByWatermark"] for p in done["arrivals"] for op in p["stateOperators"])
    rows = sum(p["numInputRows"] for p in done["arrivals"])
    return {"rows": rows, "late_rows": late, "undated_rows": max(0, sum(p["sink"].get("numOutputRows", 0) for p in done["undated"]))}


def read_arrivals(spark: SparkSession, out: str, schema: StructType = schemas.RAW_ARRIVALS) -> DataFrame:
    """What the stream has taken, dated and undated, with the columns of H1."""
    plain = StructType([f for f in schema.fields if f.name not in ARRIVALS_SPARSE_COLUMNS])
    names = [F.col(f"`{n}`") for n in plain.names]
    dated = spark.read.schema(StructType([*plain.fields, StructField(_TIME, TimestampType())])).parquet(f"{out}/arrivals").select(*names)
    return dated.unionByName(spark.read.schema(plain).parquet(f"{out}/undated").select(*names))
