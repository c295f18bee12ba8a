"""Written intermediate tables: they cut the lineage and survive the loss of an executor."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portmart.session import staging_path


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the shared checkpoint folder and read back."""
    path = staging_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_size(df: DataFrame, text: str) -> tuple[int, int]:
    """(rows, bytes of text) of ``df``; one aggregate row comes to the driver."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(text)).alias("b")).first()
    return int(row["n"]), int(row["b"] or 0)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def require_free(df: DataFrame, name: str) -> None:
    """Refuse to add a column that ``df`` has already (names match in any case)."""
    if name.lower() in (c.lower() for c in df.columns):
        raise ValueError(f"{name} is a column already; name the new one otherwise")
