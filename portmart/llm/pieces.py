"""Sampled SentencePiece segmentation: forward filtering, backward sampling over the piece lattice.

The pieces of a SentencePiece model span a lattice over a text's bytes; each byte also has its
byte piece, so every text has a path. A segmentation's weight is the product of its pieces' weights:
a piece of rank r weighs 1 / (r + SHIFT), as in a rank-frequency law (the model orders its pieces by
rank and holds no probabilities), byte pieces weigh BYTE_SHARE of the rarest piece; TEMPERATURE
flattens all. The forward pass sums the weights of all paths to each position, the backward pass
draws the last piece of a position in proportion. The draws are hashes of (seed, row key, position),
so a row has the same segmentation wherever and whenever it is computed.

Pieces begin with a blank or hold none, and hold no line end, so the lattice falls apart before
each blank that follows another byte and around line ends: these segments are independent, and equal
segments of a batch share one forward pass. All passes are array operations over a batch.

The text is not normalised and gets no blank in front; blanks stand for the model's U+2581, while
a U+2581 in a text can only be written in byte pieces. So decoding gives back every text exactly.

Defined cases: null and empty texts have no pieces and decode to the empty text; rows repeated with
one key have one segmentation; empty tables give empty tables; extra columns stay out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portmart.llm import text as X
from portmart.llm.staging import require_free

SHIFT = 2.7
BYTE_SHARE = 0.01
TEMPERATURE = 1.0
SEED = 17
BLOCK = 1 << 20
_BITMAP = 20


class Pieces:
    """Vocabulary of a model, for ``encode`` and ``decode`` of batches."""

    def __init__(self, model_path: str, temperature: float = TEMPERATURE):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        n = model.get_piece_size()
        self.byte_id = np.zeros(256, np.int32)
        raw: list[bytes] = [b""] * n
        by_length: dict[int, list[int]] = {}
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                raw[i] = bytes([int(piece[3:5], 16)])
                self.byte_id[raw[i][0]] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                raw[i] = piece.replace("▁", " ").encode()
                if b" " in raw[i].lstrip(b" ") or b"\n" in raw[i]:
                    raise ValueError(f"piece {i} crosses a segment")
                by_length.setdefault(len(raw[i]), []).append(i)
        weight = -np.log(np.arange(n) + SHIFT) / temperature
        self.weight = weight
        self.byte_weight = weight[-1] + np.log(BYTE_SHARE)
        self.bytes = np.frombuffer(b"".join(raw), np.uint8)
        self.size = np.array([len(r) for r in raw], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.lengths: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []
        for length, ids in sorted(by_length.items()):
            data = np.frombuffer(b"".join(raw[i] for i in ids), np.uint8)
            h = self._hash(X.running(data.astype(np.uint64) + np.uint64(1), X.BASES[3]), np.arange(len(ids)) * length, length)
            order = np.argsort(h)
            seen = np.zeros(1 << _BITMAP, bool)
            seen[(h >> np.uint64(64 - _BITMAP)).astype(np.int64)] = True
            self.lengths.append((length, h[order], np.array(ids, np.int32)[order], seen))
        self.prefixes: dict[int, np.ndarray] = {}
        for length in (3, 6, 10):
            data = np.frombuffer(b"".join(raw[i][:length] for n, ids in by_length.items() if n > length for i in ids), np.uint8)
            h = self._hash(X.running(data.astype(np.uint64) + np.uint64(1), X.BASES[3]), np.arange(0, len(data), length), length)
            self.prefixes[length] = np.zeros(1 << _BITMAP, bool)
            self.prefixes[length][(h >> np.uint64(64 - _BITMAP)).astype(np.int64)] = True

    @staticmethod
    def _hash(sums: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
        return X.mix(X.between(sums, at, at + length, X.BASES[3]) + np.uint64(length))

    def _edges(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, id) of every piece in ``data``, long pieces first; ``ends``: for each byte,
        its segment's end."""
        sums = X.running(data.astype(np.uint64) + np.uint64(1), X.BASES[3])
        at = np.arange(len(data), dtype=np.int32)
        found = [(at, 1, self.byte_id[data])]
        for length, h, own, seen in self.lengths:
            if length - 1 in self.prefixes:  # only where a longer piece begins
                at = at[at + (length - 1) <= ends[at]]
                at = at[self.prefixes[length - 1][(self._hash(sums, at, length - 1) >> np.uint64(64 - _BITMAP)).astype(np.int64)]]
            at = at[at + length <= ends[at]]
            if not len(at):
                break
            mine = self._hash(sums, at, length)
            maybe = seen[(mine >> np.uint64(64 - _BITMAP)).astype(np.int64)]
            mine, here = mine[maybe], at[maybe]
            slot = np.searchsorted(h, mine)
            slot[slot == len(h)] = 0
            ok = h[slot] == mine
            found.append((here[ok], length, own[slot[ok]]))
        found.reverse()
        starts = np.concatenate([f[0] for f in found])
        sizes = np.repeat(np.array([f[1] for f in found], np.int32), [len(f[0]) for f in found])
        return starts, starts + sizes, np.concatenate([f[2] for f in found])

    def _lattice(self, data: np.ndarray, seg_start: np.ndarray, seg_end: np.ndarray) -> tuple[np.ndarray, ...]:
        """(first edge of each node, running share, start node, id), edges ordered by end node. The
        segments lie behind each other in ``data``; segment s has the nodes from
        ``seg_start[s] + s`` on."""
        number = np.repeat(np.arange(len(seg_start), dtype=np.int32), seg_end - seg_start)
        start, stop, ids = self._edges(data, seg_end.astype(np.int32)[number])
        seg = number[start]
        weight = self.weight[ids]
        weight[ids == self.byte_id[data[start]]] = self.byte_weight
        depth = stop - seg_start.astype(np.int32)[seg]
        start, stop = start + seg, stop + seg
        order = np.argsort(stop, kind="stable")  # merges the ascending runs of the lengths
        start, stop, ids, weight, depth = start[order], stop[order], ids[order], weight[order], depth[order]
        deepest = int(depth.max())
        if deepest < 1 << 16:
            depth = depth.astype(np.uint16)  # sorted by radix
        order = np.argsort(depth, kind="stable")
        cuts = np.searchsorted(depth[order], np.arange(1, deepest + 2))
        forward = np.zeros(len(data) + len(seg_start))
        share = np.empty(len(start))
        for a, b in zip(cuts[:-1], cuts[1:]):
            edge = order[a:b]
            value, node = forward[start[edge]] + weight[edge], stop[edge]
            head = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
            top = np.maximum.reduceat(value, head)
            count = np.diff(np.append(head, b - a))
            part = np.exp(value - np.repeat(top, count))
            total = np.add.reduceat(part, head)
            forward[node[head]] = top + np.log(total)
            share[edge] = part / np.repeat(total, count)
        first = np.searchsorted(stop, np.arange(len(forward) + 1, dtype=stop.dtype))
        run = np.cumsum(share)
        before = np.concatenate([[0.0], run])[first[:-1]]
        running = run - np.repeat(before, np.diff(first))
        last = first[1:][np.diff(first) > 0] - 1
        running[last] = 2.0  # a draw always ends within its node
        return first, running, start, ids

    def encode(self, data: np.ndarray, offsets: np.ndarray, keys: np.ndarray, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
        """(piece ids of all rows behind each other, their number in each row)."""
        n = len(data)
        if not n:
            return np.zeros(0, np.int32), np.zeros(len(offsets) - 1, np.int64)
        blank, line = data == 0x20, data == 0x0A
        edge = np.zeros(n + 1, bool)
        edge[1:-1] = (blank[1:] & ~blank[:-1]) | line[1:] | line[:-1]
        edge[offsets] = True
        cuts = np.flatnonzero(edge)
        a, b = cuts[:-1], cuts[1:]
        sums = X.running(data.astype(np.uint64) + np.uint64(1), X.BASES[1])
        h = X.mix(X.between(sums, a, b, X.BASES[1]) + (b - a).astype(np.uint64))
        _, first, which = np.unique(h, return_index=True, return_inverse=True)
        size = (b - a)[first]
        end = np.cumsum(size)
        begin = end - size
        own = data[np.repeat(a[first] - begin, size) + np.arange(end[-1])]
        head, running, source, ids = self._lattice(own, begin, end)
        # backward: every occurrence starts at its segment's last node
        row = np.searchsorted(offsets, a, "right") - 1
        salt = X.mix(keys.astype(np.int64).view(np.uint64) + np.uint64(seed))[row]
        shift = a - (begin[which] + which)  # node -> byte of the batch
        node, last = end[which] + which, begin[which] + which
        found = np.zeros(n, np.int32)
        while len(node):
            place = (node + shift - offsets[row]).astype(np.uint64)
            draw = (X.mix(salt ^ X.mix(place + np.uint64(1))) >> np.uint64(11)) * (1.0 / (1 << 53))
            pick = head[node]
            wide = np.flatnonzero(running[pick] <= draw)
            while len(wide):
                pick[wide] += 1
                wide = wide[running[pick[wide]] <= draw[wide]]
            went = source[pick]
            found[went + shift] = ids[pick] + 1
            live = went > last
            node, shift, row, salt, last = went[live], shift[live], row[live], salt[live], last[live]
        at = np.flatnonzero(found)
        return found[at] - 1, np.diff(np.searchsorted(at, offsets))

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of a sequence of pieces."""
        size = self.size[ids]
        end = np.cumsum(size)
        return self.bytes[np.repeat(self.start[ids] - (end - size), size) + np.arange(end[-1] if len(end) else 0)]


_models: dict[tuple, Pieces] = {}


def pieces(model_path: str, temperature: float = TEMPERATURE) -> Pieces:
    if (model_path, temperature) not in _models:
        _models[model_path, temperature] = Pieces(model_path, temperature)
    return _models[model_path, temperature]


def encode_pieces(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", key_col: str | None = None,
                  temperature: float = TEMPERATURE, seed: int = SEED) -> DataFrame:
    """``(id, n_pieces, ids, lossless)``; ``lossless``: the ids decode to the very text. The draws
    are seeded by ``key_col`` (the id by default)."""
    kind = dict(df.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(model_path, temperature)
        for batch in batches:
            data, offsets = X.column_bytes(batch.column(2))
            keys = batch.column(1).to_numpy(zero_copy_only=False)
            for a, b in X.blocks(offsets, BLOCK):
                part, cuts = data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
                ids, sizes = model.encode(part, cuts, keys[a:b], seed)
                ends = np.concatenate([[0], np.cumsum(sizes)])
                back = np.concatenate([[0], np.cumsum(model.size[ids])])[ends]
                whole = model.decode(ids)
                if np.array_equal(back, cuts) and np.array_equal(whole, part):
                    same = np.ones(b - a, bool)
                else:
                    same = np.array([np.array_equal(whole[p:q], part[c:d]) for p, q, c, d in zip(back[:-1], back[1:], cuts[:-1], cuts[1:])])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(sizes, pa.int64()),
                                                  pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32())), pa.array(same)],
                                                 names=[id_col, "n_pieces", "ids", "lossless"])
    rows = df.select(id_col, F.xxhash64(key_col or id_col).alias("_key"), F.col(text_col).cast("string").alias("_text"))
    return rows.mapInArrow(run, f"`{id_col}` {kind}, n_pieces long, ids array<int>, lossless boolean")


def decode_pieces(df: DataFrame, model_path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``df`` with ``text_col``: the text of the piece ids (null ids: the empty text). No column of ``df`` may
    have that name."""
    require_free(df, text_col)
    from pyspark.sql import types as T

    at = df.columns.index(ids_col)
    schema = T.StructType([*df.schema.fields, T.StructField(text_col, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(model_path)
        for batch in batches:
            texts = [model.decode(np.asarray(ids or [], np.int64)).tobytes().decode() for ids in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[f.name for f in schema.fields])
    return df.mapInArrow(run, schema)
