"""Tables stored by hash of their join key, so that joins need no exchange.

Fact and dimension are written as bucketed, sorted tables with the same number of buckets (a power of
two, by size), one file a bucket: their join is a merge join straight from the files. A key that holds
much more than a bucket's share would make its bucket one task's work for ever, so such keys are found
when the fact is written and their rows go to a table of their own beside the buckets, without an order. There are at
most ``buckets / HOT_SHARE`` of them, so the dimension's rows for them are few and are broadcast.

The tables are external ones below ``root``; ``open_table`` names them again in another session.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portmart.operators.joins import estimated_bytes

BUCKET_BYTES = 512 << 20
MAX_BUCKETS = 1 << 16
HOT_SHARE = 4  # a key with more than so many average buckets' rows is hot
HOT_ROWS = 100_000  # and with more rows than this


def bucket_count(size: int, bucket_bytes: int = BUCKET_BYTES, least: int = 8) -> int:
    """A power of two of about ``size / bucket_bytes``: tables of different sizes stay compatible, as
    Spark reads several buckets as one."""
    n = least
    while n < MAX_BUCKETS and n * bucket_bytes < size:
        n *= 2
    return n


@dataclass(frozen=True)
class CoPartitioned:
    """A stored table: ``table`` holds the bucketed rows, ``hot_path`` those of ``hot_keys`` (fact side)."""

    spark: SparkSession
    root: str
    table: str
    key: str
    buckets: int

    def cold(self) -> DataFrame:
        return self.spark.table(self.table)

    def hot(self) -> DataFrame:
        return self.spark.read.schema(self.cold().schema).parquet(f"{self.root}/hot")

    def hot_keys(self) -> DataFrame:
        kind = dict(self.cold().dtypes)[self.key]
        return self.spark.read.schema(f"`{self.key}` {kind}").parquet(f"{self.root}/hot_keys")

    def rows(self) -> DataFrame:
        """All rows."""
        return self.cold().unionByName(self.hot())


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def write_copartitioned(df: DataFrame, root: str, table: str, key: str, buckets: int | None = None, hot_share: float = HOT_SHARE,
                        hot_rows: int = HOT_ROWS) -> CoPartitioned:
    """Store ``df`` below ``root`` by ``key``; null keys, which join nothing, are spread like hot ones."""
    spark = df.sparkSession
    buckets = buckets or bucket_count(estimated_bytes(df) or 0)
    own = F.col(_q(key))
    counts = df.filter(own.isNotNull()).groupBy(own).agg(F.count(F.lit(1)).alias("_n"))
    limit = max(hot_rows, hot_share * df.count() / buckets)
    root = root.rstrip("/")
    counts.filter(F.col("_n") > limit).select(key).coalesce(1).write.mode("overwrite").parquet(f"{root}/hot_keys")
    hot_keys = F.broadcast(spark.read.schema(df.select(key).schema).parquet(f"{root}/hot_keys"))  # at most buckets / hot_share rows
    (df.join(hot_keys, key, "left_semi").unionByName(df.filter(own.isNull())).write.mode("overwrite").parquet(f"{root}/hot"))
    cold = df.filter(own.isNotNull()).join(hot_keys, key, "left_anti").select(*[F.col(_q(c)) for c in df.columns])
    (cold.repartition(buckets, own).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
     .option("path", f"{root}/buckets").format("parquet").saveAsTable(table))
    return CoPartitioned(spark, root, table, key, buckets)


def open_table(spark: SparkSession, root: str, table: str, key: str, buckets: int) -> CoPartitioned:
    """Name a stored table in this session's catalog."""
    schema = spark.read.parquet(f"{root}/buckets").schema
    columns = ", ".join(f"{_q(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    place = f"{root}/buckets".replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_q(table)} ({columns}) USING parquet CLUSTERED BY ({_q(key)}) SORTED BY ({_q(key)}) "
              f"INTO {buckets} BUCKETS LOCATION '{place}'")
    return CoPartitioned(spark, root, table, key, buckets)


def copartitioned_join(fact: CoPartitioned, dim: CoPartitioned, fact_cols: list[str], dim_cols: list[str], how: str = "inner") -> DataFrame:
    """``fact`` joined to ``dim`` on their keys (inner or left), with these columns of each; ``dim`` is stored
    with its keys unique, so it has no hot ones.

    The bucketed rows are merged without an exchange on either side. Hot rows stay where they are and
    meet the dimension's rows of the hot keys, which are broadcast (at most one per hot key)."""
    if how not in ("inner", "left"):
        raise ValueError(f"how is inner or left, not {how}")
    left, right = [F.col(_q(c)) for c in dict.fromkeys([fact.key, *fact_cols])], [F.col(_q(c)) for c in dim_cols if c != dim.key]
    d = dim.cold().select(F.col(_q(dim.key)).alias("_dim_key"), *right)
    keep = [F.col(_q(c)) for c in fact_cols] + [F.col("_dim_key").alias(c) if c == dim.key else F.col(_q(c)) for c in dim_cols]
    on = F.col(_q(fact.key)) == F.col("_dim_key")
    cold = fact.cold().select(*left).join(d.hint("merge"), on, how).select(*keep)
    few = d.join(F.broadcast(fact.hot_keys().withColumnRenamed(fact.key, "_dim_key")), "_dim_key", "left_semi")
    hot = fact.hot().select(*left).join(F.broadcast(few), on, how).select(*keep)
    return cold.unionByName(hot)
