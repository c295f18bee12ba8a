"""Tables that change together (H20): month folders that are never rewritten, and one list of them.

A refresh writes its months to folders of their own (``<table>/batch=<id>/year=…/month=…``), for all
tables; then the list of the folders that make up the tables is written beside the others and renamed
to the next version number. That rename is the only step that changes what readers see: a refresh that
breaks anywhere before it leaves every table as it was, and a reader that took a version reads the same
rows of all tables whatever is published meanwhile. Two refreshes that end at once cannot take the same
number: the rename refuses, and the later one puts its months on top of the other's list.

The driver handles one entry per month and table, no data.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from portmart.sinks.writers import write_partitioned

_BATCH = "batch"


class Conflict(RuntimeError):
    """Another refresh has published since the version that this one is built on."""


@dataclass(frozen=True)
class Version:
    """``months[table][folder]`` = batch and rows of a month's folder."""

    number: int = 0
    months: Mapping[str, Mapping[str, Mapping]] = field(default_factory=dict)

    def rows(self, table: str) -> int:
        return sum(m["rows"] for m in self.months.get(table, {}).values())


class VersionedTables:
    """Tables of ``schemas`` (name -> columns, those of ``layout`` included) below ``root``."""

    def __init__(self, spark: SparkSession, root: str, schemas: Mapping[str, StructType], layout: tuple[str, ...] = ("year", "month")):
        self.spark, self.root, self.layout = spark, root.rstrip("/"), tuple(layout)
        self.schemas = dict(schemas)

    # --- versions -----------------------------------------------------------------------------

    def _path(self, *parts: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.root, *parts)))
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        """Numbers of the published versions, ascending."""
        path, fs = self._path("_versions")
        if not fs.exists(path):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(path)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def version(self, number: int | None = None) -> Version:
        """The latest version, or that of ``number``."""
        if number is None:
            number = max(self.versions(), default=0)
        if not number:
            return Version()
        path, fs = self._path("_versions", f"{number:012d}.json")
        stream = fs.open(path)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return Version(number, json.loads(text))

    def _commit(self, version: Version) -> bool:
        """Publish ``version`` under its number; False if the number is taken."""
        tmp, fs = self._path("_versions", f"_{uuid.uuid4().hex}.tmp")
        final, _ = self._path("_versions", f"{version.number:012d}.json")
        out = fs.create(tmp, True)
        try:
            out.write(bytearray(json.dumps(version.months).encode()))
        finally:
            out.close()
        jvm = self.spark._jvm
        none = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark._jsc.hadoopConfiguration())
        try:
            context.rename(tmp, final, none)  # refuses a target that is there
        except Py4JJavaError as e:
            fs.delete(tmp, False)
            if "FileAlreadyExistsException" in str(e.java_exception):
                return False
            raise
        return True

    # --- tables -------------------------------------------------------------------------------

    def read(self, table: str, version: Version | None = None) -> DataFrame:
        """The table's rows in ``version`` (the latest). Filters on the layout prune folders."""
        version = version or self.version()
        schema = self.schemas[table]
        folders = [f"{self.root}/{table}/{_BATCH}={m['batch']}/{folder}" for folder, m in version.months.get(table, {}).items()]
        if not folders:
            return self.spark.createDataFrame([], schema)
        stored = StructType([*schema.fields, StructField(_BATCH, StringType())])
        out = self.spark.read.schema(stored).option("basePath", f"{self.root}/{table}").parquet(*folders)
        return out.select(*[F.col(f"`{n}`") for n in schema.fieldNames()])

    def _write(self, table: str, df: DataFrame, batch: str, sort: Iterable[str], rebalance: bool) -> dict[str, dict]:
        path = f"{self.root}/{table}/{_BATCH}={batch}"
        columns = [F.col(f"`{n}`") for n in self.schemas[table].fieldNames()]
        write_partitioned(df.select(*columns), path, list(self.layout), mode="errorifexists", sort_within=list(sort), rebalance=rebalance)
        # rows per file, and of these few per folder: a pattern over every row's path would cost more than the write
        files = self.spark.read.schema(self.schemas[table]).parquet(path).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("rows"))
        folder = F.regexp_extract("file", "/((?:[^/=]+=[^/]*/){%d})[^/]+$" % len(self.layout), 1)
        written = files.groupBy(folder.alias("folder")).agg(F.sum("rows").alias("rows")).collect()
        from urllib.parse import unquote
        return {unquote(r["folder"]).rstrip("/"): {"batch": batch, "rows": r["rows"]} for r in written}

    def publish(self, tables: Mapping[str, DataFrame], sort_within: Mapping[str, Iterable[str]] | None = None, attempts: int = 10,
                expect: Version | None = None, rebalance: bool = True) -> Version:
        """Replace the months of ``tables`` in all of them at once. A month that any of the frames
        holds is replaced as a whole in every table, also where the new rows are none. With ``expect`` the new
        version must follow that one: Conflict if another came between. ``rebalance=False`` writes the frames in the
        partitions they have (``writers.write_partitioned``)."""
        batch = uuid.uuid4().hex
        new = {name: self._write(name, df, batch, (sort_within or {}).get(name, ()), rebalance) for name, df in tables.items()}
        touched = {folder for months in new.values() for folder in months}
        for attempt in range(attempts):
            now = self.version()
            if expect is not None and now.number != expect.number:
                raise Conflict(f"{self.root}: version {now.number} came after {expect.number}")
            months = {name: {f: m for f, m in now.months.get(name, {}).items() if f not in touched} for name in {*now.months, *new}}
            for name, own in new.items():
                months[name].update(own)
            version = Version(now.number + 1, months)
            if self._commit(version):
                return version
            time.sleep(0.05 * (attempt + 1))
        raise RuntimeError(f"{self.root}: other refreshes took {attempts} version numbers in a row")

    def vacuum(self, keep: int = 2, older_than_s: float = 24 * 3600) -> list[str]:
        """Delete folders that none of the last ``keep`` versions names, and the lists before those.
        Folders younger than ``older_than_s`` stay: a refresh may still be writing them."""
        numbers = self.versions()
        kept = [self.version(n) for n in numbers[-keep:]]
        named = {(t, m["batch"]) for v in kept for t, months in v.months.items() for m in months.values()}
        gone = []
        for table in self.schemas:
            path, fs = self._path(table)
            for status in fs.listStatus(path) if fs.exists(path) else []:
                name = status.getPath().getName()
                old = status.getModificationTime() / 1000 < time.time() - older_than_s
                if name.startswith(f"{_BATCH}=") and (table, name.split("=", 1)[1]) not in named and old:
                    fs.delete(status.getPath(), True)
                    gone.append(f"{table}/{name}")
        for n in numbers[:-keep]:
            path, fs = self._path("_versions", f"{n:012d}.json")
            fs.delete(path, False)
        return gone
