"""Label-description text files as numbered lines.

The scan is splittable: no file goes whole into one task. A text split never cuts a line, rows of
one split are contiguous in their task, and ``monotonically_increasing_id`` numbers them
consecutively. So (file, start of the split, id) puts lines in file order with one scan and no
join. Exact 0-based numbers need the lines of the earlier splits counted: the tagged lines are staged
once, and ``position in split = id - first id of the split`` is taken from the staged copy (a second
scan of the text might be split in another way).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from portmart.operators.joins import estimated_bytes
from portmart.sinks.writers import stage

# Largest number of splits whose offset table (a few narrow columns per split) is broadcast.
MAX_BROADCAST_SPLITS = 1_000_000


def _split_bound(spark: SparkSession, text: DataFrame) -> int | None:
    """Upper bound on the number of text splits, from file count and total size (no job): a
    split is never smaller than min(maxPartitionBytes, openCostInBytes) unless it ends a file."""
    total = estimated_bytes(text)
    if total is None:
        return None
    smallest = min(conf_bytes(spark, "spark.sql.files.maxPartitionBytes", 128 << 20),
                   conf_bytes(spark, "spark.sql.files.openCostInBytes", 4 << 20))
    return len(text.inputFiles()) + total // max(smallest, 1) + 1


def conf_bytes(spark: SparkSession, key: str, default: int) -> int:
    """A byte-size setting ('134217728b', '128m', '128MB', '4194304') in bytes."""
    m = re.fullmatch(r"\s*(\d+)\s*([kmgtp]?)i?b?\s*", str(spark.conf.get(key, str(default))), re.I)
    if not m:
        return default
    return int(m.group(1)) << (10 * "_kmgtp".index(m.group(2).lower() or "_"))


LINE_ORDER = ("file_key", "block", "seq")


def _file_key(path: Column) -> Column:
    """A text key that sorts file names by the numbers in them (part-99999 before part-100000)."""
    pieces = F.regexp_extract_all(path, F.lit(r"(\d+|\D+)"), F.lit(1))
    wide = F.transform(pieces, lambda p: F.when(p.rlike(r"^\d{1,19}$"), F.lpad(p, 20, "0")).otherwise(p))
    return F.array_join(wide, "")


def _file_ranks(spark: SparkSession, files: list[str]) -> DataFrame:
    """(file, file_key): the rank of every file's name by its ``_file_key``. A name stands there in both spellings
    of an empty host (``file:///a``, ``file:/a``), as a listing and a scan may differ in it."""
    names = [(spelling, f) for f in files for spelling in sorted({f, re.sub("^([^:/]+):///", r"\1:/", f)})]
    rank = F.dense_rank().over(Window.orderBy(_file_key(F.col("name"))))
    return spark.createDataFrame(names, "file string, name string").select("file", rank.alias("file_key"))


def read_ordered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line, file, file_key, block, seq) of every line under ``path``; ``LINE_ORDER`` sorts them by file
    and place in it. ``file_key`` is the rank of the file's name among those that are read, so lines are sorted by
    three numbers. One scan."""
    text = spark.read.text(path)
    lines = text.select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"),
                        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("seq"))
    files = text.inputFiles()
    ranks = _file_ranks(spark, files)
    # one row per file: broadcast when the files are few, else a plain join
    side = F.broadcast(ranks) if len(files) <= MAX_BROADCAST_SPLITS else ranks
    unlisted = F.raise_error(F.concat(F.lit("not among the listed files: "), F.col("file"))).cast("int")
    return lines.join(side, "file", "left").select("line", "file", F.coalesce("file_key", unlisted).alias("file_key"), "block", "seq")


def read_numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, pos, line) for every line of every file under ``path`` (A6, A7). The lines are staged
    here; ``drop_staged`` removes the copy when the caller has done with them."""
    text = spark.read.text(path)
    raw = stage(text.select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_mid")))
    splits = raw.groupBy("file", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_mid0"))
    in_file = Window.partitionBy("file").orderBy("_block")
    splits = splits.withColumn("_off", F.sum("_n").over(in_file) - F.col("_n")).drop("_n")
    bound = _split_bound(spark, text)
    # one row per split: broadcast when the split count is proven small, else a plain join
    side = F.broadcast(splits) if bound is not None and bound <= MAX_BROADCAST_SPLITS else splits
    lines = raw.join(side, ["file", "_block"])
    return lines.select("file", (F.col("_off") + F.col("_mid") - F.col("_mid0")).alias("pos"), "line")


def line_range(lines: DataFrame, start: int, end: int) -> DataFrame:
    """Lines ``start`` (inclusive) to ``end`` (exclusive), 0-based, of each file."""
    return lines.filter((F.col("pos") >= start) & (F.col("pos") < end))


def named_block(lines: DataFrame, name: str) -> DataFrame:
    """Lines of the ``value <name>`` block of each file, up to the closing ';' (no line numbers
    needed). The header line itself is left out."""
    header = F.lower(F.trim(F.col("line"))).rlike(r"^value\s+\$?" + re.escape(name.lower().lstrip("$")) + r"\s*$")
    starts = lines.filter(header).groupBy("file").agg(F.min("pos").alias("_start"))
    tagged = lines.join(starts, "file").filter(F.col("pos") > F.col("_start"))
    ends = (tagged.filter(F.trim(F.col("line")).startswith(";"))
                  .groupBy("file").agg(F.min("pos").alias("_end")))
    block = tagged.join(ends, "file", "left")
    return (block.filter(F.col("_end").isNull() | (F.col("pos") < F.col("_end")))
                 .filter(F.trim(F.col("line")) != "")
                 .select("file", "pos", "line"))
