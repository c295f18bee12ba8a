"""Token ids as Parquet list columns, laid out for selective reads.

``write_tokens`` deals texts by ranges of their id, orders them, encodes them and writes one row
per document: ``row`` (place in the file order), the id, ``n_tokens`` and ``ids``. Token ids are
dictionary encoded (a vocabulary fits one dictionary page), the narrow columns are delta encoded
(Parquet v2 pages), row groups and pages have set sizes and the writer adds page indexes. So
``read_metadata`` never touches the token column, and ``read_tokens`` with a range of ids skips
files, row groups and pages.

The byte-level BPE cuts a text before it merges, so the ids of a text are those of its units (``units``):
the units of a part of the texts are found and told apart by array operations, and only those that a
worker has not met go to the tokenizer.

The string of a special token in a text (``<|endoftext|>``) is ordinary text, or that token if
``special_tokens`` is set: then it is what the tokenizer's ``encode`` gives by default.

Defined cases: very long texts are parts of their own; null and empty texts have only the end id; a null id sorts first; rows repeated
with one id follow each other; an empty table gives an empty table; extra columns stay out.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from portmart.llm import text as X
from portmart.llm import units as U
from portmart.llm.staging import partitions, text_size

END_ID = 2
FILE_BYTES = 128 << 20
ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
CACHE_WORDS = 400_000
PART_BYTES = 2 << 20  # texts encoded at a time; a longer text is one part
_ROW_BITS = 33


class WordEncoder:
    """``encode`` of a ``tokenizers`` file, remembering the ids of units (``units``)."""

    def __init__(self, path: str, special_tokens: bool = False):
        self.model, self.lists = U.ByteBpe(path, special_tokens), U.Lists(np.int32)
        self.store = U.Store(self._work, self.lists.keep, CACHE_WORDS, self.model.closing())
        self.whole = self.model.whole

    def _work(self, units: list[bytes]) -> None:
        found = self.model.ids(units)
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        self.lists.add(np.fromiter(chain.from_iterable(found), np.int32, int(sizes.sum())), sizes)

    def encode_bytes(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts behind each other, their numbers) of texts that lie in ``data``."""
        which, first = self.store.numbers(data, offsets)
        ids, size = self.lists.take(which)
        return ids, np.diff(np.concatenate([[0], np.cumsum(size)])[first])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        raw = [t.encode() for t in texts]
        return self.encode_bytes(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw], dtype=np.int64)]))


_encoders: dict[tuple[str, bool], WordEncoder] = {}


def encoder(path: str, special_tokens: bool = False) -> WordEncoder:
    """One encoder per worker, file and setting; what it has met serves the worker's later tasks."""
    key = path, special_tokens
    return _encoders.setdefault(key, WordEncoder(*key)) if key not in _encoders else _encoders[key]


def encode_texts(df: DataFrame, id_col: str, text_col: str, tokenizer_path: str, end_id: int = END_ID,
                 special_tokens: bool = False) -> DataFrame:
    """``(id, n_tokens, ids)``; each list ends in ``end_id``."""
    kind = dict(df.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer_path, special_tokens)
        for batch in batches:
            data, offsets = X.column_bytes(batch.column(1))
            for at, end in X.blocks(offsets, PART_BYTES):
                part = batch.slice(at, end - at)
                ids, sizes = own.encode_bytes(data[offsets[at]:offsets[end]], offsets[at:end + 1] - offsets[at])
                ends = np.cumsum(sizes + 1)
                full = np.full(int(ends[-1]), end_id, np.int32)
                keep = np.ones(len(full), bool)
                keep[ends - 1] = False
                full[keep] = ids
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(full))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes + 1, pa.int64()), lists], names=[id_col, "n_tokens", "ids"])
    return df.select(id_col, F.col(text_col).cast("string")).mapInArrow(run, f"`{id_col}` {kind}, n_tokens long, ids array<int>")


def write_tokens(df: DataFrame, path: str, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 end_id: int = END_ID, special_tokens: bool = False) -> None:
    """Write the token ids of ``df``'s texts to ``path`` in ascending order of ``id_col``."""
    docs = df.select(id_col, text_col)
    n = max(partitions(df.sparkSession), -(-text_size(docs, text_col)[1] // FILE_BYTES))
    ordered = docs.repartitionByRange(n, F.col(id_col).asc_nulls_first()).sortWithinPartitions(F.col(id_col).asc_nulls_first())
    encoded = encode_texts(ordered, id_col, text_col, tokenizer_path, end_id, special_tokens)
    (encoded.select(F.monotonically_increasing_id().alias("row"), id_col, "n_tokens", "ids").write
     .option("compression", "zstd").option("parquet.writer.version", "PARQUET_2_0")
     .option("parquet.block.size", ROW_GROUP_BYTES).option("parquet.page.size", PAGE_BYTES)
     .option("parquet.enable.dictionary", "true").option(f"parquet.enable.dictionary#{id_col}", "false")
     .option("parquet.enable.dictionary#row", "false").option("parquet.enable.dictionary#n_tokens", "false")
     .parquet(path))


def read_metadata(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """``(row, id, n_tokens, start)`` without reading the token column; ``start`` is the number of
    ids of all documents before. Offsets are summed over one row per file."""
    return with_starts(spark.read.parquet(path).select("row", id_col, "n_tokens"), path)


def with_starts(rows: DataFrame, path: str) -> DataFrame:
    """``rows`` (with ``row`` and ``n_tokens``) of the files at ``path`` with ``start``."""
    part = F.shiftright("row", _ROW_BITS)
    files = rows.sparkSession.read.parquet(path).groupBy(part.alias("_part")).agg(F.sum("n_tokens").alias("_n"))
    offsets = files.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_off"))
    inside = F.sum("n_tokens").over(Window.partitionBy("_part").orderBy("row")) - F.col("n_tokens")
    placed = rows.withColumn("_part", part).withColumn("_in", inside).join(F.broadcast(offsets), "_part")
    return placed.withColumn("start", F.col("_off") + F.col("_in")).drop("_part", "_in", "_off")


def read_tokens(spark: SparkSession, path: str, low: int | None = None, high: int | None = None, id_col: str = "doc_id") -> DataFrame:
    """Rows with ids from ``low`` to ``high``; the filter reaches row groups and pages."""
    out = spark.read.parquet(path)
    if low is not None:
        out = out.filter(F.col(id_col) >= low)
    return out if high is None else out.filter(F.col(id_col) <= high)


def ids_crc32(tokens: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``(row, id, n_tokens, ids_crc32)``: unsigned CRC of the ids as little-endian unsigned 32-bit
    integers."""
    kind = dict(tokens.dtypes)[id_col]
    names = ["row", id_col, "n_tokens", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            flat = np.ascontiguousarray(lists.flatten().to_numpy(zero_copy_only=False), "<u4")
            ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
            crc = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(crc, pa.int64())], names=names)
    return tokens.select("row", id_col, "n_tokens", "ids").mapInArrow(run, f"row long, `{id_col}` {kind}, n_tokens long, ids_crc32 long")
