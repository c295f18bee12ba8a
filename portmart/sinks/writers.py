"""Parquet and CSV sinks, staging and month refresh."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from portmart.session import ensure_checkpoint_dir, staging_path


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Parquet sink."""
    df.write.mode(mode).parquet(path)


def write_partitioned(df: DataFrame, path: str, partition_by: Sequence[str], mode: str = "overwrite",
                      max_records_per_file: int = 5_000_000, dynamic: bool = False,
                      sort_within: Sequence[str] = (), rebalance: bool = True) -> None:
    """Parquet sink split into ``partition_by`` directories (A10).

    ``rebalance`` shuffles by the partition columns so each directory gets few files, and lets
    AQE split a partition value holding a large share of the rows into several tasks (and
    coalesce small ones); ``maxRecordsPerFile`` caps file size. ``dynamic=True`` overwrites only
    the partitions present in ``df`` (H20). ``sort_within`` clusters rows inside each file, so
    Parquet min/max statistics let filters on those columns skip row groups. ``rebalance=False``
    leaves the shuffle out, for rows whose partitions fit the directories already.
    """
    out = df.hint("rebalance", *partition_by) if rebalance else df
    if sort_within:
        out = out.sortWithinPartitions(*partition_by, *sort_within)
    writer = (out.write.mode(mode)
                .option("maxRecordsPerFile", max_records_per_file)
                .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
                .partitionBy(*partition_by))
    writer.parquet(path)


def refresh_partitions(df: DataFrame, path: str, partition_by: Sequence[str], **kw) -> None:
    """Replace only the partitions (e.g. one year and month) present in ``df``."""
    write_partitioned(df, path, partition_by, mode="overwrite", dynamic=True, **kw)


def write_csv(df: DataFrame, path: str, sep: str = ",", header: bool = True, mode: str = "overwrite") -> None:
    """CSV sink (used to produce raw inputs in tests and round trips)."""
    df.write.mode(mode).option("header", header).option("sep", sep).csv(path)


def stage(df: DataFrame, path: str | None = None, mode: str = "errorifexists",
          schema: StructType | None = None) -> DataFrame:
    """Write ``df`` once and continue from the written copy.

    Everything downstream reads the same rows (ids, deduplication survivors) instead of
    recomputing the lineage, and the lineage is cut. Without ``path`` the copy goes below the
    shared checkpoint folder.
    """
    spark = df.sparkSession
    path = path or staging_path(spark, "stage")
    df.write.mode(mode).parquet(path)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def drop_staged(spark, staged: DataFrame) -> None:
    """Delete a staged copy that is no longer read. Only files below the shared checkpoint folder go."""
    base = ensure_checkpoint_dir(spark).split(":", 1)[-1].rstrip("/")
    for path in {f.rsplit("/", 1)[0] for f in staged.inputFiles()}:
        if "/portmart-stage/" in path and base.lstrip("/") in path:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
