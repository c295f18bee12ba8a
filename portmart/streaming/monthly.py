"""Monthly refresh as an incremental Structured Streaming job.

New raw arrival files (staged Parquet or CSV copies of the monthly SAS files) land in a
folder. A file-source stream picks up only files it has not seen (progress is kept in the
checkpoint, so a restarted or failed job resumes where it stopped). For each micro-batch the
months it touches are rebuilt from *all* landed files of those months and written with dynamic
partition overwrite, so a month split over several batches still ends up whole, and replaying a
batch rewrites the same partitions (idempotent).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from portmart import schemas
from portmart.plans.jobs import refresh_arrivals_months
from portmart.session import stable_path

MONTH_KEYS = ("i94yr", "i94mon")


def _read_landing(spark: SparkSession, landing: str, schema: StructType, fmt: str) -> DataFrame:
    reader = spark.read.schema(schema)
    return reader.option("header", True).csv(landing) if fmt == "csv" else reader.format(fmt).load(landing)


def start_monthly_refresh(spark: SparkSession, landing: str, tables_path: str, checkpoint: str | None = None,
                          schema: StructType = schemas.RAW_ARRIVALS, fmt: str = "parquet",
                          available_now: bool = True, max_files_per_trigger: int | None = None):
    """Start the stream; with ``available_now`` it processes what has landed and stops. Without
    ``checkpoint`` the progress is kept below the shared checkpoint folder at a path fixed by
    ``landing`` and ``tables_path``, so running the same job again resumes where it stopped."""
    checkpoint = checkpoint or stable_path(spark, "monthly-refresh-checkpoint", landing, tables_path)
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(landing)

    def rebuild_months(batch: DataFrame, epoch_id: int) -> None:
        # all landed rows of the months the batch touches; the months side is a few rows, which AQE
        # broadcasts, and a landing folder partitioned by them is pruned at run time
        months = batch.select(*MONTH_KEYS).distinct()
        landed = _read_landing(batch.sparkSession, landing, schema, fmt)
        refresh_arrivals_months(landed.join(months, list(MONTH_KEYS), "left_semi"), tables_path)

    writer = stream.writeStream.foreachBatch(rebuild_months).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def run_monthly_refresh(spark: SparkSession, landing: str, tables_path: str, **kw) -> None:
    """Process everything that has landed, then return."""
    q = start_monthly_refresh(spark, landing, tables_path, available_now=True, **kw)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
