"""Quality classifier: hashed word n-gram logistic regression, FTRL-proximal training.

Tokens are runs of letters, runs of digits and runs of one mark; white space parts them. Features
are token unigrams and bigrams hashed to 2**BITS slots; a token behind itself is one shared
bigram ("repeated"), as is each mark. A text's vector is its n-gram counts over their sum, times
SCALE, so a score is the sparse dot product with the weights plus a bias, put through the
logistic function.

Training makes one FTRL-proximal update per text over a sample of at most MAX_TRAIN labelled
rows (those with the smallest hash of their id), for EPOCHS passes, in one task: its input is
bounded by that parameter whatever the corpus. Scoring runs where the texts are read, with the
broadcast weights (2**BITS numbers at most).

Defined cases: null and empty texts have no features and score by the bias alone; labels without
a document, or null, are unused; several labels of one id are all used; without usable labels
every score is 0.5; repeated rows score alike; empty tables give empty tables.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portmart.llm import text as X
from portmart.llm.staging import require_free

BITS = 18
MAX_TRAIN = 6000
EPOCHS = 4
SCALE = 30.0
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.0005, 0.0005
THRESHOLD = 0.3

_CLASS = np.arange(256, dtype=np.int16) + 16
_CLASS[X.SPACE] = 0
_CLASS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_CLASS[48:58] = 2


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(slots of all n-grams behind each other, bounds of each text's)."""
    kind = _CLASS[data]
    edge = np.ones(len(data) + 1, bool)
    edge[1:-1] = kind[1:] != kind[:-1]
    edge[offsets] = True
    cuts = np.flatnonzero(edge)
    starts, ends = cuts[:-1], cuts[1:]
    real = kind[starts] > 0 if len(starts) else np.zeros(0, bool)
    starts, ends = starts[real], ends[real]
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    first = np.searchsorted(starts, offsets)
    h = X.word_hashes(data, starts, ends)
    mark = kind[starts] > 2  # a run of one mark counts the same whatever its length above two
    h[mark] = X.mix(kind[starts][mark].astype(np.uint64) * np.uint64(4) + np.minimum(ends - starts, 2)[mark].astype(np.uint64))
    at, pair = X.window_hashes(h, first, 2)
    pair[h[at] == h[at + 1]] = np.uint64(0xA5A5A5A5 << 32)
    slots = np.empty(len(h) + len(pair), np.int64)
    bounds = first + np.searchsorted(at, first)
    place = np.arange(len(h)) + np.searchsorted(at, np.arange(len(h)))
    slots[place] = (h >> np.uint64(64 - BITS)).astype(np.int64)
    slots[place[at] + 1] = (pair >> np.uint64(64 - BITS)).astype(np.int64)
    return slots, bounds


def in_training_fold(id_col: Column) -> Column:
    """crc32 of the id as text, mod 5, is not 0."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 != 0, F.lit(True))


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = X.column_bytes(batch.column(2))
        idx, val = [], []
        slots, bounds = features(data, offsets)
        for a, b in zip(bounds[:-1], bounds[1:]):
            s, c = np.unique(slots[a:b], return_counts=True)
            idx.append(s.astype("<i4").tobytes())
            val.append((c * (SCALE / max(b - a, 1))).astype("<f4").tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(idx, pa.binary()), pa.array(val, pa.binary())], names=["k", "y", "idx", "val"])


def _ftrl(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = [r for b in batches for r in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist())]
    rows.sort()
    z, n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)

    def weights(i):
        return np.where(np.abs(z[i]) <= L1, 0.0, (np.sign(z[i]) * L1 - z[i]) / ((BETA + np.sqrt(n[i])) / ALPHA + L2))
    data = [(y, np.append(np.frombuffer(i, "<i4"), 1 << BITS), np.append(np.frombuffer(v, "<f4"), 1.0)) for _, y, i, v in rows]
    for _ in range(EPOCHS):
        for y, i, x in data:
            w = weights(i)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - y) * x
            step = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / ALPHA
            z[i] += g - step * w
            n[i] += g * g
    used = np.flatnonzero(n > 0)
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(weights(used), pa.float64())], names=["slot", "weight"])


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text",
          max_train: int = MAX_TRAIN) -> np.ndarray:
    """Weights (the last one is the bias) learnt from labelled rows of the training folds."""
    usable = labels.filter(in_training_fold(F.col(id_col)) & F.col(id_col).isNotNull() & F.col(label).isNotNull())
    key = F.xxhash64(id_col)
    picked = usable.select(F.col(id_col).alias("_id"), F.col(label).cast("int").alias("y"), key.alias("k")).orderBy("k", "_id", "y").limit(max_train)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("t")).join(F.broadcast(picked), "_id").select("k", "y", "t")
    vectors = rows.mapInArrow(_vectors, "k long, y int, idx binary, val binary")
    out = np.zeros((1 << BITS) + 1)
    for r in vectors.repartition(1).mapInArrow(_ftrl, "slot int, weight double").toArrow().to_batches():
        out[r.column(0).to_numpy()] = r.column(1).to_numpy()
    return out


def score(df: DataFrame, weights: np.ndarray, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``df`` with ``score_col`` (0 to 1) put behind its columns, which must not have that name."""
    require_free(df, score_col)
    shared = df.sparkSession.sparkContext.broadcast(weights)
    at = df.columns.index(text_col)
    schema = T.StructType([*df.schema.fields, T.StructField(score_col, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for batch in batches:
            data, offsets = X.column_bytes(batch.column(at))
            z = np.full(batch.num_rows, w[-1])
            for a, b in X.blocks(offsets):
                slots, bounds = features(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                count = np.diff(bounds)
                full = np.flatnonzero(count)  # each text is summed up by itself, so its score is the same wherever it stands
                z[a + full] += SCALE * np.add.reduceat(w[slots], bounds[full]) / count[full] if len(full) else 0
            p = 1 / (1 + np.exp(-np.clip(z, -35, 35)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p)], names=[*batch.schema.names, score_col])
    return df.mapInArrow(run, schema)
