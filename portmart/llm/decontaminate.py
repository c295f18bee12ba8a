"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

Texts are compared as bytes with Latin letters lower-cased and white space as blanks. An item of m bytes
that stands in a text with at most k = floor(RATE * m) edits keeps at least m + 1 - q * (k + 1)
of its q-grams, on diagonals (text position - item position) that differ by k at most. So:

1. every q-gram of every text is looked up among the items' q-grams (a bitmap, then the sorted
   list), each hit is counted in the two overlapping bands of 2 * (k + 1) diagonals around it;
2. bands with fewer hits than the bound can't hold the item and are left;
3. the rest is verified by an alignment over the band's diagonals and k beside them.

Regions: a text may hold a half of an item, or the item with words replaced, which is more than k edits. So the
same is asked of long regions of the items (REGION_SHARE of an item and at least REGION_BYTES, one beginning every
REGION_STEP of it), each with its own k, where the item as a whole is not found.

k is lowered for short items so that the bound stays above 0; items shorter than q must occur
as they are. The items go to the tasks in blocks of BLOCK_BYTES of text, one after the other, so
what is broadcast is bounded; texts are never shuffled.

Defined cases: null and empty texts hold nothing; null or empty items are in no text; repeated
items are all reported, repeated rows judged alike; empty tables give empty results; other
columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portmart.llm import text as X
from portmart.llm.staging import require_free, text_size

Q = 12
RATE = 0.05
REGION_BYTES = 48  # of an item, at least
REGION_SHARE, REGION_STEP = 0.4, 0.05  # of an item's length
BLOCK_BYTES = 8 << 20
_BITMAP = 22
_FOLD = X.LOWER.copy()
_FOLD[X.SPACE] = 0x20
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def fold(data: np.ndarray) -> np.ndarray:
    """A-Z and the capitals of Latin-1 (C3 80 to C3 9E in UTF-8) lower-cased, white space as blanks."""
    out = _FOLD[data]
    high = (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97) & (data[:-1] == 0xC3)
    out[1:][high] += 0x20
    return out


def folded(text: bytes) -> bytes:
    return fold(np.frombuffer(text, np.uint8)).tobytes()


def qgrams(data: np.ndarray) -> np.ndarray:
    """Hash of the Q bytes at each position (Q is 8 to 16: two eight-byte reads cover them)."""
    n = len(data) - Q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    at = np.ndarray((len(data) - 7,), "<u8", np.ascontiguousarray(data), strides=(1,))
    h = at[:n] * _A
    h ^= h >> np.uint64(29)
    h += at[Q - 8:Q - 8 + n]
    h *= _B
    return h


def regions(text: bytes) -> list[bytes]:
    """The overlapping long regions of an item, none if it is hardly longer than one. Any stretch of
    REGION_SHARE + REGION_STEP of a long item holds a whole one."""
    m = len(text)
    size, step = max(REGION_BYTES, -(-int(m * REGION_SHARE * 100) // 100)), max(1, int(m * REGION_STEP))
    if size + step > m:
        return []
    return [text[a:a + size] for a in [*range(0, m - size, step), m - size]]


class Items:
    """Q-gram index of a block of items, with ``parts`` of their long regions too: those are numbered behind the
    items, ``parent`` has the item of each."""

    def __init__(self, ids: list, texts: list[bytes], parts: bool = False):
        self.whole, self.parent = len(texts), list(range(len(texts)))
        ids, texts = list(ids), list(texts)
        for i, t in enumerate(texts[:self.whole] if parts else ()):
            for region in regions(t):
                ids.append(ids[i])
                texts.append(region)
                self.parent.append(i)
        self.ids, self.texts = ids, texts
        self.size = np.array([len(t) for t in texts], np.int64)
        self.edits = np.maximum(np.minimum(np.floor(self.size * RATE), (self.size - Q) // Q), 0).astype(np.int64)
        self.bound = self.size + 1 - Q * (self.edits + 1)
        self.short = [i for i, t in enumerate(texts) if 0 < len(t) < Q]
        grams = [qgrams(np.frombuffer(t, np.uint8)) for t in texts]
        h = np.concatenate([*grams, np.zeros(0, np.uint64)])
        item = np.repeat(np.arange(len(texts)), [len(g) for g in grams])
        at = np.concatenate([*[np.arange(len(g)) for g in grams], np.zeros(0, np.int64)])
        order = np.argsort(h, kind="stable")
        self.item, self.at = item[order], at[order].astype(np.int64)
        self.keys, self.first = np.unique(h[order], return_index=True)
        self.first = np.append(self.first, len(h))
        self.bitmap = np.zeros(1 << _BITMAP, bool)
        self.bitmap[(self.keys >> np.uint64(64 - _BITMAP)).astype(np.int64)] = True

    def find(self, data: np.ndarray, offsets: np.ndarray) -> dict[int, dict[int, int]]:
        """{row: {item: least number of edits found}} of folded texts; a region only where its item is not found."""
        found: dict[int, dict[int, int]] = {}
        for a, b in X.blocks(offsets):
            lo, part = offsets[a], data[offsets[a]:offsets[b]]
            h = qgrams(part)
            pos = np.flatnonzero(self.bitmap[(h >> np.uint64(64 - _BITMAP)).astype(np.int64)])
            if not len(pos) or not len(self.keys):
                continue
            slot = np.searchsorted(self.keys, h[pos])
            slot[slot == len(self.keys)] = 0
            ok = self.keys[slot] == h[pos]
            row = np.searchsorted(offsets[a:b + 1] - lo, pos, "right") - 1
            ok &= pos + Q <= (offsets[a:b + 1] - lo)[row + 1]
            pos, slot, row = pos[ok], slot[ok], row[ok]
            n = self.first[slot + 1] - self.first[slot]
            if not n.sum():
                continue
            which = np.repeat(self.first[slot] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            item, row = self.item[which], np.repeat(row, n)
            diagonal = np.repeat(pos - (offsets[a:b + 1] - lo)[row[np.cumsum(n) - n]] if len(pos) else pos, n) - self.at[which]
            band = (diagonal + self.size[item]) // (self.edits[item] + 1)
            key = ((row * len(self.ids) + item) << 31) + band
            keys, count = np.unique(np.concatenate([key, key - 1]), return_counts=True)
            good = count >= self.bound[(keys >> 31) % len(self.ids)]
            for key in keys[good].tolist():
                row, item, band = (key >> 31) // len(self.ids), (key >> 31) % len(self.ids), key & ((1 << 31) - 1)
                if band == (1 << 31) - 1:  # band -1 of the row's item reaches into the next key
                    continue
                if item >= self.whole and self.parent[item] in found.get(a + row, ()):
                    continue
                text = part[offsets[a + row] - lo:offsets[a + row + 1] - lo]
                k = int(self.edits[item])
                edits = align(self.texts[item], text.tobytes(), band * (k + 1) - int(self.size[item]), 2 * (k + 1), k)
                if edits is not None:
                    mine = found.setdefault(a + row, {})
                    if item < self.whole:
                        mine[item] = min(edits, mine.get(item, edits))
                    else:  # one region is enough
                        mine[~self.parent[item]] = 0
        for i in self.short:
            for row in range(len(offsets) - 1):
                if self.texts[i] in data[offsets[row]:offsets[row + 1]].tobytes():
                    found.setdefault(row, {})[i] = 0
        return found


def align(item: bytes, text: bytes, diagonal: int, width: int, k: int) -> int | None:
    """Least edits that turn ``item`` into a substring of ``text``, over the diagonals from
    ``diagonal`` on and ``k`` to each side; None above ``k``."""
    m, low, w = len(item), diagonal - k, width + 2 * k
    if item in text[max(0, diagonal):diagonal + width + m]:
        return 0
    far = m + w + 1
    t = np.full(m + w, -1, np.int16)  # the text from its position ``low`` on
    a, b = max(0, -low), min(m + w, len(text) - low)
    if a < b:
        t[a:b] = np.frombuffer(text, np.uint8)[low + a:low + b]
    start = np.arange(w) + low
    row = np.where((start >= 0) & (start <= len(text)), 0, far)
    step = np.arange(w)
    for i, c in enumerate(item):
        here = t[i:i + w]  # on a diagonal, the item's byte i meets the text's byte low + i + d
        new = row + (here != c)
        new[here < 0] = far
        new[:-1] = np.minimum(new[:-1], row[1:] + 1)  # item byte without counterpart
        new = np.minimum.accumulate(new - step) + step  # text bytes without counterpart
        row = new
    end = start + m
    row = row[(end >= 0) & (end <= len(text))]
    return int(row.min()) if len(row) and row.min() <= k else None


def find_leaks(df: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id",
               item_text: str = "text", found_col: str = "leaks", part_col: str | None = None) -> DataFrame:
    """``df`` with ``found_col``: the benchmark items its text holds, as (item_id, edits) by item. No column of
    ``df`` may have that name. ``part_col``: also the ids of items of which the text holds a long region only
    (``regions``), each with its own budget of edits."""
    require_free(df, found_col)
    if part_col is not None:
        require_free(df, part_col)
    items = benchmark.select(F.col(item_id).cast("long").alias("i"), F.coalesce(F.col(item_text).cast("string"), F.lit("")).alias("t"))
    count = max(1, -(-text_size(items, "t")[1] // BLOCK_BYTES))
    at = df.columns.index(text_col)
    found_type = T.ArrayType(T.StructType([T.StructField("item_id", T.LongType()), T.StructField("edits", T.IntegerType())]))
    arrow = pa.list_(pa.struct([("item_id", pa.int64()), ("edits", pa.int32())]))
    added = [T.StructField(found_col, found_type), *([T.StructField(part_col, T.ArrayType(T.LongType()))] if part_col is not None else [])]
    schema = T.StructType([*df.schema.fields, *added])
    place = len(df.columns)
    out = df
    for block in range(count):
        rows = items.filter(F.pmod(F.xxhash64("i", "t"), F.lit(count)) == block).orderBy("i", "t").collect()  # at most about BLOCK_BYTES
        texts = [folded(r["t"].encode()) for r in rows]
        shared = df.sparkSession.sparkContext.broadcast(Items([r["i"] for r in rows], texts, part_col is not None))

        def run(batches: Iterator[pa.RecordBatch], shared=shared, again=block > 0) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                data, offsets = X.column_bytes(batch.column(at))
                found = index.find(fold(data), offsets)
                old = batch.column(place).to_pylist() if again else [[]] * batch.num_rows
                new = [sorted(o + [{"item_id": index.ids[i], "edits": e} for i, e in found.get(r, {}).items() if i >= 0],
                              key=lambda x: (x["item_id"] is not None, x["item_id"] or 0, x["edits"])) for r, o in enumerate(old)]
                columns = [*batch.columns[:place], pa.array(new, arrow)]
                if part_col is not None:
                    old = batch.column(place + 1).to_pylist() if again else [[]] * batch.num_rows
                    parts = [sorted({*o, *(index.ids[~i] for i in found.get(r, {}) if i < 0 and ~i not in found[r])}, key=lambda x: (x is not None, x or 0)) for r, o in enumerate(old)]
                    columns.append(pa.array(parts, pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema.fields])
        out = out.mapInArrow(run, schema)
    return out
