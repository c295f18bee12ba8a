"""Missing-value profile over files whose columns differ, kept per file.

Every file's null counts are a state of its own, stored with the file's time and size; a total adds the
states of the files that are there now. A refresh scans new and changed files only. A file without a
column adds its rows to that column's total and no nulls, as adding per-file counts up by name does; how many
rows had the column at all is told apart (``rows_with``), and so are the types it came in.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from portmart.functions import pct
from portmart.operators.profile import missing_counts_by_file

STATE = StructType([StructField("file", StringType()), StructField("mtime", TimestampType()), StructField("size", LongType()),
                    StructField("field", StringType()), StructField("type", StringType()), StructField("nulls", LongType()), StructField("rows", LongType())])
_NO_FIELD = ""  # the state of a file without columns, so that it is not scanned again


class FileProfiles:
    """The stored states at ``path``, of files read as ``fmt`` (``parquet``, or ``csv`` with a header)."""

    def __init__(self, spark: SparkSession, path: str, fmt: str = "parquet", sep: str = ",", threads: int = 16):
        if fmt not in ("parquet", "csv"):
            raise ValueError(f"fmt is parquet or csv, not {fmt}")
        self.spark, self.path, self.fmt, self.sep, self.threads = spark, path, fmt, sep, threads

    def states(self) -> DataFrame:
        try:
            return self.spark.read.schema(STATE).parquet(self.path)
        except AnalysisException:  # nothing stored yet
            return self.spark.createDataFrame([], STATE)

    def listing(self, data: str) -> DataFrame:
        """(file, mtime, size) of the files below ``data``; their contents are not read."""
        suffix = "*." + self.fmt
        found = (self.spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", suffix).load(data))
        return found.select(F.col("path").alias("file"), F.col("modificationTime").alias("mtime"), F.col("length").alias("size"))

    def _columns(self, file: str) -> StructType:
        if self.fmt == "csv":
            return self.spark.read.option("header", True).option("sep", self.sep).csv(file).schema
        return self.spark.read.parquet(file).schema

    def _read(self, schema: StructType, files: Sequence[str]) -> DataFrame:
        reader = self.spark.read.schema(schema)
        return reader.option("header", True).option("sep", self.sep).csv(list(files)) if self.fmt == "csv" else reader.parquet(*files)

    def refresh(self, data: str) -> list[str]:
        """Scan what is new or changed below ``data`` and store its states; the files scanned.

        The driver reads the footers (first lines) of those files only, to put files of one schema into one
        scan; the states of all are stored by one write, so a refresh that breaks stores none."""
        listed = self.listing(data)
        known = self.states().select("file", "mtime", "size").distinct()
        new = listed.join(known, ["file", "mtime", "size"], "left_anti")
        files = sorted(r["file"] for r in new.select("file").collect())
        if not files:
            return []
        with ThreadPoolExecutor(self.threads) as pool:
            schemas = list(pool.map(self._columns, files))
        groups: dict[str, tuple[StructType, list[str]]] = {}
        for file, schema in zip(files, schemas):
            groups.setdefault(schema.json(), (schema, []))[1].append(file)
        # every column of every new file, so that files without rows have a state too
        rows = [(_one_slash(file), name, kind, 0, 0) for file, schema in zip(files, schemas)
                for name, kind in [(f.name, f.dataType.simpleString()) for f in schema.fields] or [(_NO_FIELD, "")]]
        out = self.spark.createDataFrame(rows, "k string, field string, type string, nulls long, rows long")
        for schema, own in groups.values():
            if schema.fields:
                types = F.create_map(*[F.lit(x) for f in schema.fields for x in (f.name, f.dataType.simpleString())])
                counts = missing_counts_by_file(self._read(schema, own))
                uri = F.url_decode(F.replace(F.col("source_file"), F.lit("+"), F.lit("%2B")))
                out = out.unionByName(counts.select(F.regexp_replace(uri, "^file:/+", "file:/").alias("k"), "field", types[F.col("field")].alias("type"), "nulls", "rows"))
        out = out.groupBy("k", "field", "type").agg(F.sum("nulls").alias("nulls"), F.sum("rows").alias("rows"))
        out = out.join(new.withColumn("k", F.regexp_replace("file", "^file:/+", "file:/")), "k").select(*STATE.names)
        out.coalesce(1).write.mode("append").parquet(self.path)
        return files

    def total(self, data: str, limit: float | None = None) -> DataFrame:
        """(field, types, nulls, rows_with, rows, pct_missing) over the files below ``data``, from their states;
        with ``limit`` only fields whose share of missing values is above it."""
        now = self.states().join(self.listing(data), ["file", "mtime", "size"], "left_semi")
        rows = now.groupBy("file").agg(F.max("rows").alias("r")).agg(F.sum("r")).first()[0] or 0
        per = now.filter(F.col("field") != _NO_FIELD).groupBy("field").agg(F.array_sort(F.collect_set("type")).alias("types"), F.sum("nulls").alias("nulls"), F.sum("rows").alias("rows_with"))
        out = per.withColumn("rows", F.lit(rows).cast("long")).withColumn("pct_missing", pct("nulls", "rows"))
        if limit is not None:
            out = out.filter(F.col("pct_missing") > F.lit(float(limit)))
        return out.select("field", "types", "nulls", "rows_with", "rows", "pct_missing")


def _one_slash(uri: str) -> str:
    return "file:/" + uri[5:].lstrip("/") if uri.startswith("file:/") else uri
