"""Surrogate keys.

``with_surrogate_key`` is the reference's unique-but-gapped id. Because it depends on the
partition layout, a frame holding it must be staged (written and read back) before the ids are
used twice, or a recomputation can hand out different ids.

``with_dense_key`` gives 1..n in natural-key order without a global window: the frame is
range-partitioned and sorted by the key, each row records its partition number and position
(both from ``monotonically_increasing_id``, whose upper bits are the partition and lower bits
the row index), the result is staged so those numbers are fixed, and each partition's offset
comes from a table with one row per partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from portmart.session import staging_path

_ROW_BITS = 33  # monotonically_increasing_id: partition id << 33 | row index


def with_surrogate_key(df: DataFrame, name: str) -> DataFrame:
    """Add a unique, non-null, long id column (not dense, not stable across recomputation)."""
    return df.withColumn(name, F.monotonically_increasing_id())


def with_dense_key(df: DataFrame, name: str, order_by: Sequence[str],
                   num_partitions: int | None = None, stage_to: str | None = None) -> DataFrame:
    """Add ``name`` = 1..n following ``order_by`` (ties broken by every other column)."""
    spark: SparkSession = df.sparkSession
    cols = list(df.columns)
    tie = [c for c in cols if c not in order_by]
    order = [F.col(c).asc_nulls_first() for c in list(order_by) + tie]
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
                .withColumn("_mid", F.monotonically_increasing_id()))
    path = stage_to or staging_path(spark, "dense-key")
    ranged.write.mode("overwrite").parquet(path)
    staged = spark.read.parquet(path)
    part = F.shiftright(F.col("_mid"), _ROW_BITS)
    pos = F.col("_mid") - F.shiftleft(part, _ROW_BITS)
    # One row per partition: the window below runs over at most n rows.
    sizes = staged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_off"))
    keyed = staged.join(F.broadcast(offsets), part == F.col("_part"))
    return keyed.select(*[F.col(f"`{c}`") for c in cols], (F.col("_off") + pos + 1).alias(name))
