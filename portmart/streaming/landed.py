"""Monthly refresh as a file stream over an index of landed files.

Every micro-batch first adds its files to the index: (file, i94yr, i94mon, rows), one small aggregate over two
columns. Months that the batch touches are then looked up in the index, and only the files that hold rows of
those months are read and refreshed, so a batch costs what its months hold, however much has landed before.
The index entries of a batch are stored under its number and written anew when the batch is replayed;
fact, dimension and mart counts of the months are published as one version (``plans.months``).
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from portmart import schemas
from portmart.plans.months import MonthReport, refresh_months
from portmart.session import stable_path
from portmart.sources.files import malformed_cells, read_csv_counted

MONTH = ("i94yr", "i94mon")
INDEX = StructType([StructField("file", StringType()), StructField("i94yr", DoubleType()), StructField("i94mon", DoubleType()),
                    StructField("rows", LongType()), StructField("epoch", LongType())])


def index_path(tables_path: str) -> str:
    return tables_path.rstrip("/") + "/_landed"


def read_index(spark: SparkSession, tables_path: str) -> DataFrame:
    """(file, i94yr, i94mon, rows, epoch): which months each landed file holds."""
    return spark.read.schema(INDEX).parquet(index_path(tables_path))


def index_files(batch: DataFrame, tables_path: str, epoch: int) -> None:
    """Add the files of ``batch`` (arrivals with their ``_file``) to the index, under ``epoch``."""
    own = batch.groupBy(F.col("_file").alias("file"), *MONTH).agg(F.count(F.lit(1)).alias("rows"))
    own.coalesce(1).write.mode("overwrite").parquet(f"{index_path(tables_path)}/epoch={epoch}")


def _same_month(left: DataFrame, right: DataFrame):
    cond = F.lit(True)
    for c in MONTH:
        cond = cond & left[c].eqNullSafe(right[c])
    return cond


def files_of_batch_months(spark: SparkSession, tables_path: str, epoch: int) -> tuple[DataFrame, list[str]]:
    """(months of the batch, all landed files that hold rows of them). The file names come to the
    driver, as those of any scan do."""
    index = read_index(spark, tables_path)
    months = index.filter(F.col("epoch") == epoch).select(*MONTH).distinct()
    held = index.join(months, _same_month(index, months), "left_semi").select("file").distinct()
    return months, sorted(unquote(r["file"]) for r in held.collect())


def _read(spark: SparkSession, files: list[str], schema: StructType, fmt: str):
    if fmt != "csv":
        return spark.read.schema(schema).format(fmt).load(files), None
    return read_csv_counted(spark, files, schema)


def start_month_stream(spark: SparkSession, landing: str, tables_path: str, checkpoint: str | None = None,
                       schema: StructType = schemas.RAW_ARRIVALS, fmt: str = "parquet", available_now: bool = True,
                       max_files_per_trigger: int | None = None, on_batch=None):
    """Start the stream; ``on_batch(epoch, files read, MonthReport, malformed cells)`` is called for each batch.
    CSV headers must name the columns of ``schema``; cells that do not fit are null and counted."""
    checkpoint = checkpoint or stable_path(spark, "month-stream-checkpoint", landing, tables_path)
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("enforceSchema", False)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(landing).select("*", F.col("_metadata.file_path").alias("_file"))

    def refresh(batch: DataFrame, epoch: int) -> None:
        session = batch.sparkSession
        index_files(batch, tables_path, epoch)
        months, files = files_of_batch_months(session, tables_path, epoch)
        if not files:
            return
        landed, seen = _read(session, files, schema, fmt)
        report: MonthReport = refresh_months(landed.join(F.broadcast(months), _same_month(landed, months), "left_semi"), tables_path)
        bad = malformed_cells(seen, landing) if seen is not None else {}
        if on_batch:
            on_batch(epoch, files, report, bad)

    writer = stream.writeStream.foreachBatch(refresh).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def run_month_stream(spark: SparkSession, landing: str, tables_path: str, **kw) -> None:
    """Process everything that has landed, then return."""
    q = start_month_stream(spark, landing, tables_path, available_now=True, **kw)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
