"""Substring deduplication with fixed-block anchors.

A window is WINDOW consecutive words of one document. A word goes if a window over it also starts
in a document with a smaller id; windows are judged on the input. Words are runs of bytes other
than \\x20\\x09-\\x0D.

1. Anchors. Every document is cut into non-overlapping reference blocks of BLOCK words, and all
   its rolling windows of BLOCK words are probes. Any WINDOW words hold a whole reference block,
   as WINDOW >= 2 * BLOCK - 1. A hash is a hit if it is a reference block of one document and
   stands in another.
2. Extension. Only windows over a hit can occur twice. For them the least document id is taken
   per 128-bit hash of the whole window.
3. Windows whose least id is smaller than their own document's are removed; windows that follow
   each other join to maximal repeats.

Lists go through ``chunks``: a window that a third of all documents share is one entry per chunk.

Defined cases: null and empty texts and those under WINDOW words lose nothing; kept words are
joined by one blank; rows repeated with one id don't remove each other's words (their ids are
equal); null ids count as smaller than all others, among themselves as equal; an empty table
gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portmart.llm import chunks as C
from portmart.llm import text as X

WINDOW = 13
BLOCK = 7
NO_ID = -(1 << 63)


def _scan(rows: pa.Table):
    """Per block of a chunk's documents: (rows, bytes, words, word hashes)."""
    data, offsets = C.texts(rows)
    for a, b in X.blocks(offsets):
        part, cuts = data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
        starts, ends, first = X.words(part, cuts)
        yield a, b, part, starts, ends, first, X.word_hashes(part, starts, ends)


def _probes(first: np.ndarray, h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, document, value) of rolling BLOCK-word windows of documents with a whole window."""
    at, value = X.window_hashes(h, first, BLOCK)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))[at]
    long = np.diff(first)[row] >= WINDOW
    return at[long], row[long], value[long] >> np.uint64(64 - bits)


def _windows(part, starts, ends, first, h, wanted=None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, two hashes) of the WINDOW-word windows, all or where ``wanted``."""
    at, one = X.window_hashes(h, first, WINDOW)
    if wanted is not None:
        keep = wanted[at]
        at, one = at[keep], one[keep]
    other = X.word_hashes(part, starts, ends, X.BASES[3])
    two = X.mix(X.between(X.running(other, X.BASES[1]), at, at + WINDOW, X.BASES[1]))
    return at, one, two


def _ids(rows: pa.Table) -> np.ndarray:
    return rows.column("_id").fill_null(NO_ID).to_numpy()


def dedup_substrings(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True) -> DataFrame:
    """``(id, n_words, n_removed, kept_sha256[, kept_text])`` per row of ``df``; ids are integers."""
    plan = C.Plan(df, text_col)
    docs = plan.deal(df.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text")), "_id")
    bits = plan.bits

    def anchors(rows: pa.Table) -> pa.Table:
        ids, found = _ids(rows), []
        for a, _, _, _, _, first, h in _scan(rows):
            at, row, value = _probes(first, h, bits)
            found.append((value, ids[a + row], (at - first[row]) % BLOCK == 0))
        value, ids, block = (np.concatenate(c) for c in zip(*found))
        order = np.lexsort((ids, value))
        value, ids, block = value[order], ids[order], block[order]
        head, _ = C.groups(value)
        if not len(head):
            return C.table([])
        last = np.append(head[1:], len(value)) - 1
        flag = np.logical_or.reduceat(block, head).astype(np.uint8) + 2 * (ids[head] != ids[last]).astype(np.uint8)
        return C.table(C.listed(plan, rows.column("_chunk")[0].as_py(), value[head], bits, flag))

    def hits(value, columns):
        head, run = C.groups(value)
        flag = np.bitwise_or.reduceat(columns[0], head)
        shared = (flag & 1 > 0) & ((flag & 2 > 0) | (np.diff(np.append(head, len(value))) > 1))
        return np.flatnonzero(shared[run]), []

    def extend(rows: pa.Table, hit: pa.Table) -> pa.Table:
        if not rows.num_rows or not hit.num_rows:
            return C.table([])
        known, = C.answers(plan, hit, bits, 0)
        ids, found = _ids(rows), []
        for a, _, part, starts, ends, first, h in _scan(rows):
            at, _, value = _probes(first, h, bits)
            mark = np.zeros(len(h) + WINDOW + 1, np.int32)
            mark[at[C.lookup(value, known) >= 0] + 1] = 1
            mark = np.cumsum(mark)
            spot = np.arange(len(h))
            wanted = mark[spot + WINDOW - BLOCK + 1] > mark[spot]
            at, one, two = _windows(part, starts, ends, first, h, wanted)
            found.append((one, two, ids[a + np.searchsorted(first, at, "right") - 1]))
        one, two, ids = (np.concatenate(c) for c in zip(*found))
        order = np.lexsort((ids, two, one))
        one, two, ids = one[order], two[order], ids[order]
        head = np.flatnonzero(np.concatenate([[True], (one[1:] != one[:-1]) | (two[1:] != two[:-1])])) if len(one) else np.zeros(0, np.int64)
        last = np.append(head[1:], len(one)) - 1
        many = (ids[head] != ids[last]).astype(np.uint8)
        return C.table(C.listed(plan, rows.column("_chunk")[0].as_py(), one[head], 64, two[head], ids[head].view(np.uint64), many, fine=True))

    def least(value, columns):
        two, ids, many = columns[0], columns[1].view(np.int64), columns[2]
        order = np.lexsort((ids, two, value))
        v, t, i = value[order], two[order], ids[order]
        head = np.concatenate([[True], (v[1:] != v[:-1]) | (t[1:] != t[:-1])])
        low = np.empty(len(v), np.int64)
        low[order] = i[np.flatnonzero(head)][np.cumsum(head) - 1]
        keep = np.flatnonzero((low < ids) | (many > 0))
        return keep, [two[keep], low[keep].view(np.uint64)]

    fields = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text

    def remove(rows: pa.Table, low: pa.Table) -> pa.Table:
        one, two, least_id = C.answers(plan, low, 64, 2)
        order = np.lexsort((two, one))
        one, two, least_id = one[order], two[order], least_id[order].view(np.int64)
        ids = _ids(rows)
        out: list[list] = [[], [], [], []]
        for a, b, part, starts, ends, first, h in _scan(rows):
            gone = np.zeros(len(h) + 1, np.int32)
            if len(one):
                at, mine, other = _windows(part, starts, ends, first, h)
                spot = np.searchsorted(one, mine)
                open_ = np.flatnonzero(spot < len(one))
                row = np.searchsorted(first, at, "right") - 1
                while len(open_):  # the few that share the first hash
                    same = one[spot[open_]] == mine[open_]
                    open_ = open_[same]
                    met = two[spot[open_]] == other[open_]
                    cut = open_[met][least_id[spot[open_[met]]] < ids[a + row[open_[met]]]]
                    np.add.at(gone, at[cut], 1)
                    np.add.at(gone, at[cut] + WINDOW, -1)
                    open_ = open_[~met]
                    spot[open_] += 1
                    open_ = open_[spot[open_] < len(one)]
            kept = np.cumsum(gone[:-1]) == 0
            n = np.concatenate([[0], np.cumsum(kept)])[first]
            s, size = starts[kept], (ends - starts)[kept] + 1
            stop = np.cumsum(size)
            joined = np.append(part, np.uint8(0x20))[np.repeat(s - (stop - size), size) + np.arange(stop[-1] if len(stop) else 0)]
            joined[stop - 1] = 0x20
            raw, bound = joined.tobytes(), np.concatenate([[0], stop])[n].tolist()
            pieces = [raw[c:d - 1] if d > c else b"" for c, d in zip(bound[:-1], bound[1:])]
            out[0] += np.diff(first).tolist()
            out[1] += (np.diff(first) - np.diff(n)).tolist()
            out[2] += [hashlib.sha256(p).hexdigest() for p in pieces]
            if with_text:
                out[3] += [p.decode("utf-8", "replace") for p in pieces]
        columns = [rows.column("_id").cast(pa.int64()), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string())]
        names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
        if with_text:
            columns, names = [*columns, pa.array(out[3], pa.string())], [*names, "kept_text"]
        return pa.Table.from_arrays(columns, names=names)

    by_chunk = docs.groupBy("_chunk")
    hit = by_chunk.applyInArrow(anchors, C.LIST).groupBy("bucket").applyInArrow(C.merge(plan, bits, hits), C.LIST)
    windows = by_chunk.cogroup(hit.withColumnRenamed("chunk", "_chunk").groupBy("_chunk")).applyInArrow(extend, C.LIST)
    low = windows.groupBy("bucket").applyInArrow(C.merge(plan, 64, least, fine=True), C.LIST)
    out = by_chunk.cogroup(low.withColumnRenamed("chunk", "_chunk").groupBy("_chunk")).applyInArrow(remove, fields)
    return out.withColumnRenamed("doc_id", id_col)
