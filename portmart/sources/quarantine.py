"""CSV records that do not fit their schema, kept with file and reason.

One scan writes both: records that fit go to one folder of a staged copy, the others, with what is wrong
with them, to another. A job that sees more rejected records than it allows fails before anything is
published; the rejected records are in the sink by then, to be looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, StringType, StructField, StructType

from portmart.session import staging_path

_RECORD, _FILE, _REASONS, _REJECTED = "_malformed_record", "_source_file", "_reasons", "_rejected"
REJECTED = StructType([StructField("file", StringType()), StructField("record", StringType()), StructField("reasons", ArrayType(StringType()))])


class TooManyRejected(RuntimeError):
    """More records were rejected than the job allows."""


@dataclass(frozen=True)
class Split:
    good: DataFrame
    rejected: DataFrame
    rows: int
    rejected_rows: int


def reasons(schema: StructType, sep: str) -> Column:
    """What is wrong with a record: ``column: text`` of every cell whose text is not of its type, else
    ``cells`` for one with too few or too many."""
    text = ", ".join("`" + n.replace("`", "``") + "` string" for n in schema.names)
    cells = F.from_csv(F.col(_RECORD), text, {"sep": sep})
    wrong = [F.when(cells.getField(n).isNotNull() & F.col("`" + n.replace("`", "``") + "`").isNull(),
                    F.concat(F.lit(f"{n}: "), cells.getField(n))) for n in schema.names]
    found = F.array_compact(F.array(*wrong))
    return F.when(F.col(_RECORD).isNull(), F.array().cast("array<string>")).when(F.size(found) > 0, found).otherwise(F.array(F.lit("cells")))


def read_csv_split(spark: SparkSession, path: str, schema: StructType, sink: str, sep: str = ",", max_rejected: int | None = None,
                   max_share: float | None = None) -> Split:
    """The records of a CSV with a header: those that fit ``schema``, and the others, added to ``sink`` (REJECTED, as
    Parquet). Raises TooManyRejected beyond ``max_rejected`` records or ``max_share`` of all."""
    marked = StructType([*schema.fields, StructField(_RECORD, StringType())])
    raw = (spark.read.option("header", True).option("sep", sep).option("mode", "PERMISSIVE").option("enforceSchema", False)
           .option("columnNameOfCorruptRecord", _RECORD).schema(marked).csv(path))
    raw = raw.withColumn(_FILE, F.col("_metadata.file_path")).withColumn(_REASONS, reasons(schema, sep))
    seen = Observation()
    bad = F.col(_RECORD).isNotNull()
    place = staging_path(spark, "csv-split")
    (raw.withColumn(_REJECTED, bad).observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(bad).alias("rejected"))
     .write.partitionBy(_REJECTED).parquet(place))
    got = seen.get
    stored = StructType([*schema.fields, StructField(_RECORD, StringType()), StructField(_FILE, StringType()), StructField(_REASONS, ArrayType(StringType())),
                         StructField(_REJECTED, BooleanType())])
    both = spark.read.schema(stored).parquet(place)
    if got["rejected"]:
        (both.filter(F.col(_REJECTED)).select(F.col(_FILE).alias("file"), F.col(_RECORD).alias("record"), F.col(_REASONS).alias("reasons"))
         .write.mode("append").parquet(sink))
    rejected = spark.read.schema(REJECTED).parquet(sink) if got["rejected"] else spark.createDataFrame([], REJECTED)
    if (max_rejected is not None and got["rejected"] > max_rejected) or (max_share is not None and got["rejected"] > max_share * got["rows"]):
        raise TooManyRejected(f"{path}: {got['rejected']} of {got['rows']} records do not fit; see {sink}")
    good = both.filter(~F.col(_REJECTED)).select(*[F.col("`" + n.replace("`", "``") + "`") for n in schema.names])
    return Split(good, rejected, got["rows"], got["rejected"])
