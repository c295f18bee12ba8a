"""SAS file scan (A1) as a Spark Python data source.

Executors decode their input in chunks with pandas' SAS reader and hand Spark Arrow record
batches in the declared schema; memory per task is bounded by the chunk size.

XPORT files are split like Hadoop text files: the driver only knows file sizes and cuts each
file into byte ranges of ``splitBytes``; a task reads the file header, takes the rows whose
fixed-length record *starts* inside its range and seeks straight to the first of them. So a
file holding a third of all rows is decoded by many tasks, and no row is read twice or missed.
SAS7BDAT files stay one partition per file (pandas cannot start such a file in the middle).

XPORT is proven by tests on hand-made files; SAS7BDAT goes through the same pandas entry point
but no SAS7BDAT sample was available to test against.

Files are listed through Spark (any Hadoop file system) but opened by pandas inside the tasks,
so on a cluster every executor must be able to open the listed paths: a shared mount, or an
object-store URI whose fsspec file system is installed on the executors.
"""

from __future__ import annotations

import glob
import logging
import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

log = logging.getLogger(__name__)

FORMAT_NAME = "portmart_sas"
# A column of this name in the requested schema is filled with each row's file path (the scan
# has no ``_metadata`` column).
SOURCE_FILE_COLUMN = "source_file"


@dataclass
class SasFile(InputPartition):
    """A file, or the byte range [start, end) of one (rows whose record starts in it)."""
    path: str
    start: int = 0
    end: int | None = None


def byte_splits(path: str, length: int | None, split_bytes: int) -> list[SasFile]:
    """Cut one file of ``length`` bytes into ranges of ``split_bytes`` (whole file if unknown)."""
    if not length or split_bytes <= 0 or length <= split_bytes:
        return [SasFile(path)]
    return [SasFile(path, lo, min(lo + split_bytes, length)) for lo in range(0, length, split_bytes)]


def xport_row_range(record_start: int, record_length: int, nobs: int, start: int, end: int) -> tuple[int, int]:
    """Rows [lo, hi) of an XPORT file whose records start at a byte in [start, end)."""
    def first_at_or_after(offset: int) -> int:
        return max(0, -(-(offset - record_start) // record_length))
    return min(first_at_or_after(start), nobs), min(first_at_or_after(end), nobs)


def _local(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path


# Default file-name filters per format, in upper or lower case (None = every file).
DEFAULT_GLOBS = {"sas7bdat": "*.[sS][aA][sS]7[bB][dD][aA][tT]", "xport": "*.[xX][pP][tT]"}


def list_sas_files(spark: SparkSession, path: str, file_glob: str | None = None) -> list[tuple[str, int]]:
    """(path, size in bytes) of the files under ``path`` (a directory or glob, any Hadoop file
    system): the binaryFile scan lists files and reads no content when only metadata is selected."""
    reader = spark.read.format("binaryFile")
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    rows = reader.load(path).select("path", "length").collect()
    return sorted((r["path"], int(r["length"])) for r in rows)


def skipped_files(spark: SparkSession, path: str, sas_format: str = "sas7bdat", file_glob: str | None = "default") -> list[str]:
    """Files under ``path`` that ``read_sas`` leaves out, as their names do not match."""
    glob_ = DEFAULT_GLOBS.get(sas_format.lower()) if file_glob == "default" else file_glob
    taken = {name for name, _ in list_sas_files(spark, path, glob_)}
    return [name for name, _ in list_sas_files(spark, path) if name not in taken]


class _SasReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.schema = schema
        # option names arrive case-insensitively; keep them lower-case
        self.options = {k.lower(): v for k, v in options.items()}

    def partitions(self):
        listed = self.options.get("files")
        if listed:
            files = []
            for line in filter(None, listed.split("\n")):
                name, _, size = line.partition("\t")
                files.append((name, int(size) if size else None))
        else:
            root = _local(self.options["path"])
            names = sorted(glob.glob(os.path.join(root, "*")) if os.path.isdir(root) else glob.glob(root))
            files = [(f, os.path.getsize(f)) for f in names]
        split = int(self.options.get("splitbytes", "0"))
        if self.options.get("sasformat", "sas7bdat").lower() != "xport":
            split = 0
        return [part for name, size in files for part in byte_splits(name, size, split)]

    def _frames(self, partition: SasFile, fmt: str, encoding: str, chunk: int):
        """Decoded pandas frames of ``partition``, at most ``chunk`` rows each."""
        import pandas as pd

        if partition.end is None:
            with pd.read_sas(_local(partition.path), format=fmt, encoding=encoding, chunksize=chunk) as it:
                yield from it
            return
        with pd.read_sas(_local(partition.path), format="xport", encoding=encoding, chunksize=chunk) as rd:
            lo, hi = xport_row_range(rd.record_start, rd.record_length, rd.nobs, partition.start, partition.end)
            rd.filepath_or_buffer.seek(rd.record_start + lo * rd.record_length)
            while lo < hi:
                n = min(chunk, hi - lo)
                yield rd.read(n)
                lo += n

    def read(self, partition: SasFile):
        import numpy as np
        import pandas as pd
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        fmt = self.options.get("sasformat", "sas7bdat").lower()
        encoding = self.options.get("encoding", "ISO-8859-1")
        chunk = int(self.options.get("chunksize", "100000"))
        arrow_schema = to_arrow_schema(self.schema)
        kinds = {f.name: f.dataType.typeName() for f in self.schema.fields}
        for frame in self._frames(partition, fmt, encoding, chunk):
            frame.columns = [str(c) for c in frame.columns]
            cols = {}
            for name, kind in kinds.items():
                if name == SOURCE_FILE_COLUMN and name not in frame.columns:
                    cols[name] = pd.Series([partition.path] * len(frame), dtype=object)
                    continue
                src = frame[name] if name in frame.columns else pd.Series([None] * len(frame), dtype=object)
                if kind in ("double", "float", "integer", "long"):
                    vals = pd.to_numeric(src, errors="coerce").astype("float64")
                    if fmt == "xport":
                        # IBM-float zero decodes to a tiny positive number; snap it back.
                        vals = vals.where(~(np.abs(vals) < 1e-70), 0.0)
                    if kind in ("integer", "long"):
                        vals = vals.round().astype("Int64")
                    cols[name] = vals
                else:
                    cols[name] = src.map(lambda v: None if v is None or (isinstance(v, float) and np.isnan(v))
                                         else (v.decode(encoding) if isinstance(v, bytes) else str(v)))
            out = pd.DataFrame(cols)
            yield pa.RecordBatch.from_pandas(out, schema=arrow_schema, preserve_index=False)


class SasDataSource(DataSource):
    """``spark.read.format('portmart_sas').schema(s).option('sasFormat', 'xport').load(dir)``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT_NAME

    def schema(self):
        from portmart.schemas import RAW_ARRIVALS
        return RAW_ARRIVALS

    def reader(self, schema: StructType) -> DataSourceReader:
        return _SasReader(schema, dict(self.options))


def read_sas(spark: SparkSession, path: str, schema: StructType | None = None, sas_format: str = "sas7bdat",
             encoding: str = "ISO-8859-1", chunk_size: int = 100_000, with_source_file: bool = False,
             file_glob: str | None = "default", split_bytes: int | None = None) -> DataFrame:
    """Scan every SAS file under ``path`` as one table with the declared ``schema`` (A1);
    ``with_source_file`` adds the file path of each row (A12). Only files matching
    ``file_glob`` are read (by default ``*.sas7bdat`` or ``*.xpt`` by format, in any case; None =
    all); the others are logged (``skipped_files``).
    XPORT files are read in byte ranges of ``split_bytes`` (default: the session's
    ``spark.sql.files.maxPartitionBytes``), so one large file is decoded by many tasks."""
    from pyspark.sql.types import StringType, StructField

    from portmart.schemas import RAW_ARRIVALS
    from portmart.sources.labels import conf_bytes
    if split_bytes is None:
        split_bytes = conf_bytes(spark, "spark.sql.files.maxPartitionBytes", 128 << 20)
    spark.dataSource.register(SasDataSource)
    glob_ = DEFAULT_GLOBS.get(sas_format.lower()) if file_glob == "default" else file_glob
    files = list_sas_files(spark, path, glob_)
    if not files:
        raise FileNotFoundError(f"no {sas_format} files under {path} matching {glob_!r}")
    skipped = skipped_files(spark, path, sas_format, file_glob)
    if skipped:
        log.warning("%s: %d files do not match %r and are not read: %s", path, len(skipped), glob_, ", ".join(skipped))
    schema = schema or RAW_ARRIVALS
    if with_source_file and SOURCE_FILE_COLUMN not in schema.fieldNames():
        schema = StructType(schema.fields + [StructField(SOURCE_FILE_COLUMN, StringType())])
    return (spark.read.format(FORMAT_NAME).schema(schema)
            .option("files", "\n".join(f"{name}\t{size}" for name, size in files))
            .option("sasFormat", sas_format).option("splitBytes", str(split_bytes))
            .option("encoding", encoding).option("chunkSize", str(chunk_size)).load())
