"""Exchange of hash lists between chunks of documents, for operators on word windows.

Documents are dealt into chunks by their id. A chunk's task looks at all windows of its
documents at once and sends, per bucket of the hash space, one packed list of its distinct
hashes (so a window that stands in a third of all documents is sent once per chunk). The task
of a bucket merges the chunks' lists and answers each chunk with the hashes that matter to it;
the chunk's documents meet the answer in a cogroup. Nothing is collected, no key is hot, and the
documents are shuffled once: every pass uses the same exchange.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portmart.llm import text as X
from portmart.llm.staging import partitions, text_size

CHUNK_BYTES = 4 << 20
BUCKET_HASHES = 400_000
WORD_BYTES = 5  # an average word is longer; only sizes of chunks and buckets follow from it


def pack(*columns: np.ndarray) -> bytes:
    """Columns of unsigned integers of equal length, by byte planes, compressed."""
    head = np.array([len(columns[0]), len(columns), *[c.itemsize for c in columns]], "<u4").tobytes()
    planes = [np.ascontiguousarray(c).view(np.uint8).reshape(len(c), c.itemsize).T.tobytes() for c in columns]
    return head + zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def unpack(data: bytes) -> list[np.ndarray]:
    n, count = np.frombuffer(data, "<u4", 2).tolist()
    sizes = np.frombuffer(data, "<u4", count, 8).tolist()
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[8 + 4 * count:], max_output_size=max(n * sum(sizes), 1)), np.uint8)
    out, at = [], 0
    for size in sizes:
        out.append(np.ascontiguousarray(raw[at:at + n * size].reshape(size, n).T).view(f"<u{size}").reshape(n))
        at += n * size
    return out


class Plan:
    """Numbers of chunks and buckets for documents of so many bytes, and the width of hashes."""

    def __init__(self, df: DataFrame, text_col: str):
        self.bytes = text_size(df, text_col)[1]
        self.partitions = partitions(df.sparkSession)
        self.chunks = max(self.partitions, -(-self.bytes // CHUNK_BYTES))
        hashes = self.bytes // WORD_BYTES + 1
        self.buckets = max(8, -(-hashes // BUCKET_HASHES))  # lists are chunks x buckets: by size alone
        # wide enough that few different windows share a value; what does is told apart later
        self.bits = min(56, max(24, hashes.bit_length() + 8))

    def deal(self, df: DataFrame, id_col: str) -> DataFrame:
        """``df`` with ``_chunk``, shuffled by it."""
        chunk = F.pmod(F.xxhash64(id_col), F.lit(self.chunks)).cast("int")
        return df.withColumn("_chunk", chunk).repartition(self.partitions, "_chunk")

    def split(self, values: np.ndarray, bits: int) -> Iterator[tuple[int, int, int, int]]:
        """(bucket, its first value, from, to) over sorted values of ``bits`` bits."""
        edges = np.array([(k << bits) // self.buckets for k in range(self.buckets)], np.uint64)
        cuts = [*np.searchsorted(values, edges).tolist(), len(values)]
        for k in range(self.buckets):
            if cuts[k] < cuts[k + 1]:
                yield k, int(edges[k]), cuts[k], cuts[k + 1]

    def first_value(self, bucket: int, bits: int) -> int:
        return (bucket << bits) // self.buckets


LIST = "bucket int, chunk int, data binary"
_ARROW = pa.schema([("bucket", pa.int32()), ("chunk", pa.int32()), ("data", pa.binary())])


def table(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    return pa.Table.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(_ARROW.types)], schema=_ARROW)


def listed(plan: Plan, chunk: int, values: np.ndarray, bits: int, *columns: np.ndarray, fine: bool = False) -> list[tuple[int, int, bytes]]:
    """The rows of a chunk's list: sorted ``values`` by bucket as differences, other columns as they are."""
    out = []
    for bucket, low, a, b in plan.split(values, bits):
        steps = np.diff(values[a:b], prepend=np.uint64(low))
        out.append((bucket, chunk, pack(steps if fine else steps.astype(np.uint32), *[c[a:b] for c in columns])))
    return out


def values_of(plan: Plan, bucket: int, data: bytes, bits: int) -> list[np.ndarray]:
    steps, *columns = unpack(data)
    return [np.cumsum(steps.astype(np.uint64)) + np.uint64(plan.first_value(bucket, bits)), *columns]


def merge(plan: Plan, bits: int, answer: Callable, fine: bool = False) -> Callable[[pa.Table], pa.Table]:
    """Group function of a bucket: ``answer(values, chunk numbers, columns)``, sorted by value, gives
    (rows to answer, answer columns); each chunk gets its rows back."""

    def run(rows: pa.Table) -> pa.Table:
        bucket = rows.column("bucket")[0].as_py()
        names = rows.column("chunk").to_numpy()
        lists = [values_of(plan, bucket, d, bits) for d in rows.column("data").to_pylist()]
        columns = [np.concatenate(c) for c in zip(*lists)]
        chunk = np.repeat(names, [len(x[0]) for x in lists])
        order = np.argsort(columns[0], kind="stable")
        columns = [c[order] for c in columns]
        keep, extra = answer(columns[0], columns[1:])
        chunk, value = chunk[order][keep], columns[0][keep]
        order = np.argsort(chunk, kind="stable")
        chunk, value, extra = chunk[order], value[order], [e[order] for e in extra]
        heads = np.flatnonzero(np.diff(chunk, prepend=-1))
        out = []
        for a, b in zip(heads, [*heads[1:], len(chunk)]):
            steps = np.diff(value[a:b], prepend=np.uint64(plan.first_value(bucket, bits)))
            out.append((bucket, int(chunk[a]), pack(steps if fine else steps.astype(np.uint32), *[e[a:b] for e in extra])))
        return table(out)
    return run


def answers(plan: Plan, rows: pa.Table, bits: int, width: int) -> list[np.ndarray]:
    """The answer to one chunk: its values in ascending order and ``width`` columns."""
    lists = [values_of(plan, k, d, bits) for k, d in sorted(zip(rows.column("bucket").to_pylist(), rows.column("data").to_pylist()))]
    if not lists:
        return [np.zeros(0, np.uint64) for _ in range(width + 1)]
    return [np.concatenate(c) for c in zip(*lists)]


def groups(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first index of each run of equal sorted values, run number of each index)."""
    head = np.ones(len(values), bool)
    head[1:] = values[1:] != values[:-1]
    return np.flatnonzero(head), np.cumsum(head) - 1


def lookup(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Index of each value in sorted ``known``, -1 where it is missing."""
    if not len(known):
        return np.full(len(values), -1)
    at = np.searchsorted(known, values)
    at[at == len(known)] = 0
    return np.where(known[at] == values, at, -1)


def texts(rows: pa.Table, name: str = "_text") -> tuple[np.ndarray, np.ndarray]:
    return X.column_bytes(rows.column(name))
