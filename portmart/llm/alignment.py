"""Cross-tokenizer alignment by pointer jumping.

Each text is encoded by two tokenizers, A (byte-level BPE, of a blank and the text) and B (a SentencePiece
BPE model, which puts the blank there itself); special tokens' strings are plain text. A token covers
a range of the bytes of blank + text. The byte offsets where a token of A and a token of B both end cut
the tokens into groups; every A token and every B token of a group are linked.

1. Pointer jumping: every token points to the farthest-right token that overlaps it (of two that end
   alike, the B token, which then points to itself). Successors are doubled, all at once, until nothing
   moves; the token reached labels the group. Both tokenizers cut a text where ``units`` does, so this
   runs on the distinct units that a worker has not met yet.
2. Counts. The documents that hold a pair of ids linked are summed up over a part of the texts (``PART_BYTES``
   of them) before they are shuffled by pair, so a pair that all documents hold is one row a part. An A
   id's highest count is found among its pairs (no more than B has ids).
3. Answers. The pairs of a part are joined to their counts and dealt to the part's documents.

Defined cases: null and empty texts, and texts whose bytes one of the tokenizers changes (a U+2581 is
a blank to B), have no tokens and count nothing: zeros and ''. Very long texts are a part of their
own; one unbroken run of bytes is one unit. Rows repeated with one id are documents of their own, as
are rows with a null id. An empty table gives an empty table; extra columns stay out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from portmart.llm import text as X
from portmart.llm import units as U
from portmart.llm.staging import staged

PART_BYTES = 16 << 20
BATCH_BYTES = 1 << 20
B_BITS = 24  # of a pair's number, below those of the A id
GROUP_PAIRS = 1 << 20  # a larger group's links are counted by distinct ids


def groups_of(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group numbers, from 0, of the A and the B tokens with these ends, both ascending and with the
    same last one."""
    na, nb = len(ends_a), len(ends_b)
    to_b = np.searchsorted(ends_b, ends_a)
    to_a = np.searchsorted(ends_a, ends_b)
    last = ends_a[to_a] == ends_b
    point = np.concatenate([na + to_b, np.where(last, na + np.arange(nb), to_a)])
    while True:
        far = point[point]
        if np.array_equal(far, point):
            break
        point = far
    number = np.cumsum(last) - 1
    label = number[point - na]
    return label[:na], label[na:]


def linked_pairs(a: np.ndarray, b: np.ndarray, in_a: np.ndarray, in_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, pair of ids, number of occurrences) of the links of tokens with these groups."""
    n = int(in_a[-1]) + 1 if len(in_a) else 0
    size_a, size_b = np.bincount(in_a, minlength=n), np.bincount(in_b, minlength=n)
    head_a, head_b = np.cumsum(size_a) - size_a, np.cumsum(size_b) - size_b
    big = size_a * size_b > GROUP_PAIRS
    of = np.flatnonzero(~big[in_a])
    wide = size_b[in_a[of]]
    end = np.cumsum(wide)
    step = np.arange(end[-1] if len(end) else 0) - np.repeat(end - wide, wide)
    pair = (np.repeat(a[of], wide).astype(np.int64) << B_BITS) | b[np.repeat(head_b[in_a[of]], wide) + step]
    found = [(np.repeat(in_a[of], wide), pair, np.ones(len(pair), np.int64))]
    for g in np.flatnonzero(big):
        x, m = np.unique(a[head_a[g]:head_a[g] + size_a[g]], return_counts=True)
        y, k = np.unique(b[head_b[g]:head_b[g] + size_b[g]], return_counts=True)
        pair = ((x.astype(np.int64) << B_BITS)[:, None] | y).ravel()
        found.append((np.full(len(pair), g), pair, (m[:, None] * k).ravel()))
    return tuple(np.concatenate(c) for c in zip(*found))


def summed(key: np.ndarray, *weights: np.ndarray) -> tuple[np.ndarray, ...]:
    """(distinct keys, sums of the weights)."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    head = np.flatnonzero(np.diff(key, prepend=-1)) if len(key) else np.zeros(0, np.int64)
    return key[head], *[np.add.reduceat(w[order], head) if len(head) else w[:0] for w in weights]


class Aligner:
    """Aligned units of two tokenizers, for batches of texts."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = U.ByteBpe(path_a), U.PieceBpe(path_b)
        self.bytes_a, self.bytes_b = U.Lists(np.uint8), U.Lists(np.uint8)
        for own, names in ((self.bytes_a, self.a.token_bytes()), (self.bytes_b, self.b.token_bytes())):
            own.add(np.frombuffer(b"".join(names), np.uint8), np.array([len(x) for x in names]))
        self.store = U.Store(self._align, self._forget)
        self.pairs, self.times = U.Lists(np.int64), U.Lists(np.int64)
        self.counts = np.zeros((0, 5), np.int64)  # A tokens, B tokens, groups, links, 1 if the bytes differ
        self.groups: list[str] = []

    def _forget(self, stay: np.ndarray) -> None:
        self.pairs.keep(stay)
        self.times.keep(stay)
        self.counts = self.counts[stay]
        self.groups = [self.groups[i] for i in stay.tolist()]

    def _align(self, units: list[bytes]) -> None:
        sides = []
        whole = np.frombuffer(b"".join(units), np.uint8)
        cuts = np.concatenate([[0], np.cumsum([len(u) for u in units])])
        same = np.ones(len(units), bool)
        for model, names in ((self.a, self.bytes_a), (self.b, self.bytes_b)):
            lists = model.ids(units)
            n = np.array([len(x) for x in lists])
            ids = np.fromiter((i for x in lists for i in x), np.int64, int(n.sum()))
            data, size = names.take(ids)
            first = np.cumsum(n) - n
            sizes = np.concatenate([[0], np.cumsum(size)])
            mine = sizes[first + n] - sizes[first]
            if not (np.array_equal(mine, np.diff(cuts)) and np.array_equal(data, whole)):
                for i, u in enumerate(units):
                    same[i] &= data[sizes[first[i]]:sizes[first[i] + n[i]]].tobytes() == u
            sides.append((lists, ids, n, size))
        ok = np.flatnonzero(same)
        counts = np.zeros((len(units), 5), np.int64)
        counts[:, 4] = ~same
        (lists_a, a, na, size_a), (lists_b, b, nb, size_b) = sides
        counts[ok, 0], counts[ok, 1] = na[ok], nb[ok]
        in_a, in_b = np.repeat(same, na), np.repeat(same, nb)
        a, b, size_a, size_b = a[in_a], b[in_b], size_a[in_a], size_b[in_b]
        group_a, group_b = groups_of(np.cumsum(size_a), np.cumsum(size_b))
        unit_of_group = np.zeros(int(group_b[-1]) + 1 if len(group_b) else 0, np.int64)
        unit_of_group[group_b] = np.repeat(np.arange(len(units)), counts[:, 1])
        counts[:, 2] = np.bincount(unit_of_group, minlength=len(units))
        group, pair, times = linked_pairs(a, b, group_a, group_b)
        unit = unit_of_group[group]
        counts[:, 3] = np.bincount(unit, weights=times, minlength=len(units)).astype(np.int64)
        order = np.lexsort((pair, unit))
        unit, pair, times = unit[order], pair[order], times[order]
        head = np.flatnonzero((np.diff(unit, prepend=-1) != 0) | (np.diff(pair, prepend=-1) != 0)) if len(unit) else unit
        per = np.bincount(unit[head], minlength=len(units))
        self.pairs.add(pair[head], per)
        self.times.add(np.add.reduceat(times, head) if len(head) else times, per)
        self.counts = np.concatenate([self.counts, counts])
        sizes_a, sizes_b = np.bincount(group_a).tolist(), np.bincount(group_b).tolist()
        at = 0
        for i, n in enumerate(counts[:, 2].tolist()):
            if n == 1:
                self.groups.append(f"{','.join(map(str, lists_a[i]))}|{','.join(map(str, lists_b[i]))}")
            else:
                p = q = 0
                said = []
                for g in range(at, at + n):
                    x, y = sizes_a[g], sizes_b[g]
                    said.append(f"{','.join(map(str, lists_a[i][p:p + x]))}|{','.join(map(str, lists_b[i][q:q + y]))}")
                    p, q = p + x, q + y
                self.groups.append(";".join(said))
            at += n

    def texts(self, column: pa.Array) -> dict[str, list | np.ndarray]:
        """For each text: counts of tokens, groups and links, the groups' digest, its linked pairs
        and how often each occurs."""
        column = pc.fill_null(column, "")
        lead = pc.binary_join_element_wise(pa.scalar(""), column, pa.scalar(" ")) if len(column) else column
        data, offsets = X.column_bytes(lead)
        rows = len(offsets) - 1
        which, first = self.store.numbers(data, offsets)
        sums = np.concatenate([np.zeros((1, 5), np.int64), np.cumsum(self.counts[which], axis=0)])
        counts = sums[first[1:]] - sums[first[:-1]]
        live = (counts[:, 4] == 0) & (np.diff(offsets) > 1)
        counts[~live] = 0
        said, digest = self.groups, []
        numbers, bounds = which.tolist(), first.tolist()
        for i, ok in enumerate(live.tolist()):
            digest.append(hashlib.sha256(";".join([said[k] for k in numbers[bounds[i]:bounds[i + 1]]]).encode()).hexdigest() if ok else "")
        # a row's distinct units, their pairs, the row's distinct pairs
        row = np.repeat(np.arange(rows), np.diff(first))
        mine = live[row]
        key, often = np.unique((row[mine] << 32) | which[mine], return_counts=True)
        unit, row = key & 0xFFFFFFFF, key >> 32
        pair, size = self.pairs.take(unit)
        times = self.times.take(unit)[0] * np.repeat(often, size)
        known, small = np.unique(pair, return_inverse=True)
        key, times = summed((np.repeat(row, size) << 32) | small, times)
        cuts = np.searchsorted(key >> 32, np.arange(rows + 1))
        return {"counts": counts[:, :4], "digest": digest, "pairs": known[key & 0xFFFFFFFF], "times": times, "cuts": cuts}


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """One per worker; the units it has met serve the worker's later tasks."""
    key = path_a, path_b
    if key not in _aligners:
        _aligners[key] = Aligner(*key)
    return _aligners[key]


DOCS = "part long, id {id}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, times binary"


def _encode(path_a: str, path_b: str):
    """Batches of (id, text) -> DOCS; a part is ``PART_BYTES`` of texts of one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(path_a, path_b)
        task = TaskContext.get().partitionId() << 24
        seen = 0
        for batch in batches:
            size = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(np.diff(np.cumsum(size, dtype=np.int64) // BATCH_BYTES, prepend=-1))
            for at, end in zip(cuts, [*cuts[1:], batch.num_rows]):
                rows = batch.slice(at, end - at)
                got = own.texts(rows.column(1))
                part = np.full(rows.num_rows, task + seen // PART_BYTES)
                seen += int(size[at:end].sum())
                ends = got["cuts"]
                # pairs ascend within a row: steps need fewer bytes
                step = np.diff(got["pairs"], prepend=0)
                heads = ends[:-1][np.diff(ends) > 0]
                step[heads] = got["pairs"][heads]
                packed = [pa.Array.from_buffers(pa.binary(), rows.num_rows, [None, pa.py_buffer((ends * 8).astype(np.int32).tobytes()), pa.py_buffer(x.astype("<i8").tobytes())])
                          for x in (step, got["times"])]
                yield pa.RecordBatch.from_arrays([pa.array(part), rows.column(0), *[pa.array(got["counts"][:, i]) for i in range(4)],
                                                  pa.array(got["digest"], pa.string()), *packed],
                                                 names=["part", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])
    return run


def _numbers(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(numbers of all rows, index of each row's first)."""
    data, offsets = X.column_bytes(column)
    return np.frombuffer(data.tobytes(), "<i8"), offsets // 8


def _pairs(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of all rows, from their steps."""
    step, first = _numbers(column)
    total = np.cumsum(step)
    before = np.concatenate([[0], total])[first[:-1]]
    return total - np.repeat(before, np.diff(first)), first


def _part_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, pair, documents) of the parts that lie in a task."""
    part, keys, counts = None, [], []

    def out() -> Iterator[pa.RecordBatch]:
        key, n = summed(np.concatenate(keys), np.concatenate(counts))
        for a in range(0, len(key), 100_000):
            b = min(a + 100_000, len(key))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(b - a, part)), pa.array(key[a:b]), pa.array(n[a:b])], names=["part", "pair", "n"])

    for batch in batches:
        parts = batch.column(0).to_numpy()
        pairs, first = _pairs(batch.column(1))
        cuts = np.flatnonzero(np.diff(parts, prepend=-1))
        for a, b in zip(cuts, [*cuts[1:], len(parts)]):
            if part is not None and part != parts[a]:
                yield from out()
                keys, counts = [], []
            part = int(parts[a])
            key, n = np.unique(pairs[first[a]:first[b]], return_counts=True)
            keys.append(key)
            counts.append(n)
            if len(keys) > 8:
                key, n = summed(np.concatenate(keys), np.concatenate(counts))
                keys, counts = [key], [n]
    if part is not None:
        yield from out()


def align(df: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)`` per row of ``df``."""
    kind = dict(df.dtypes)[id_col]
    texts = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    docs = staged(texts.mapInArrow(_encode(path_a, path_b), DOCS.format(id=kind)), "aligned")
    held = staged(docs.filter("n_links > 0").select("part", "pairs").mapInArrow(_part_counts, "part long, pair long, n long"), "pairs")
    counted = held.groupBy("pair").agg(F.sum("n").alias("count"))
    top = Window.partitionBy(F.shiftright("pair", B_BITS))
    counted = counted.withColumn("best", F.col("count") == F.max("count").over(top))
    answers = held.select("part", "pair").join(counted, "pair").select("part", "pair", "count", "best")

    def judged(rows: pa.Table, told: pa.Table) -> pa.Table:
        known, count = told.column("pair").to_numpy(), told.column("count").to_numpy()
        best = told.column("best").to_numpy()
        order = np.argsort(known, kind="stable")
        known, count, best = known[order], count[order], best[order]
        pairs, first = _pairs(rows.column("pairs"))
        times = _numbers(rows.column("times"))[0]
        at = np.searchsorted(known, pairs)
        value = [np.concatenate([[0], np.cumsum(x)]) for x in (best[at] * times, count[at] * times)]
        sums = [pa.array(v[first[1:]] - v[first[:-1]], pa.int64()) for v in value]
        return pa.Table.from_arrays([*[rows.column(c) for c in ("id", "n_a", "n_b", "n_groups", "n_links")], *sums, rows.column("groups_sha256")],
                                    names=[id_col, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    schema = f"`{id_col}` {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return docs.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(judged, schema)
