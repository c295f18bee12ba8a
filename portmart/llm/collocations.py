"""Phrase collocations by dynamic itemset counting.

Texts are lower-cased (A-Z) and split at ``[.,;:!?\\x0A-\\x0D]`` into pieces, those into words
``[^\\x20\\x09]+``; everything is counted per language (null: ``und``). A phrase of 2 to MAX_WORDS words that
stands MIN_COUNT times or more is a candidate. The score of a cut into a left and a right part is
floor(1000 * a * n / (l * r)), with the counts of the phrase, of all words and of the parts; the
lowest cut counts. Candidates that lie in a longer one with the same count are dropped.

1. Chunks. Texts become numbered words, CHUNK_BYTES of text a chunk, written once in rows of PIECE_BYTES; every
   chunk belongs to one of SHARDS shards.
2. Cyclic scans. Shard s starts at tick s with its words. At every later tick a chunk counts, of all lengths, the
   phrases that became active since: those both of whose subphrases (without the last and without the first
   word) have reached MIN_COUNT in what all shards have counted so far. So lengths are interleaved in
   one scan: the first shards count longer phrases from partial counts while later shards still count
   shorter ones, and phrases that reach the count late are made up for. A length has been through one full
   cycle SHARDS - 1 ticks after it could start; its counts are then complete.
3. Exchange. A chunk sends each phrase once, with its count, in packed lists by ranges of the hash (FAN
   of them). A node of the exchange sums up FAN lists; where there are more than FAN chunks,
   regions of FAN chunks are summed up first and dealt into finer ranges, level by level (a butterfly: every
   level has FAN lists per chunk and a node holds FAN lists, whatever the size of the text). Answers,
   the phrases that reached the count, go the same way back. No phrase is a hot key: it is one
   entry per chunk.
4. The least chunk that sent a phrase before it reached the count names it; scores, dropping and ranks are
   SQL over the named candidates.

Defined cases: null and empty texts have no words; very long texts are chunks of their own; repeated rows
count as often as they stand; ties are ordered by count and phrase (bytes); an empty table
gives an empty table; extra columns are ignored. 64-bit hashes decide equality of words and phrases.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from portmart.llm import text as X
from portmart.llm.chunks import lookup, pack, unpack
from portmart.llm.staging import staged

MAX_WORDS = 5
MIN_COUNT = 100
TOP = 2000
SHARDS = 2
CHUNK_BYTES = 4 << 20
PIECE_BYTES = 256 << 10  # a stored row of a chunk
FAN = 256
_NEVER = 99

_KIND = np.zeros(256, np.uint8)  # 1 blank, 2 end of a piece
_KIND[[0x20, 0x09]] = 1
_KIND[[ord(c) for c in ".,;:!?"] + [0x0A, 0x0B, 0x0C, 0x0D]] = 2


def phrase_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, piece) of every word; words of one piece have the same piece number."""
    kind = _KIND[data]
    word = kind == 0
    row_start = np.zeros(len(data) + 1, bool)
    row_start[offsets] = True
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = word[:-1], word[1:]
    start = np.flatnonzero(word & (~before | row_start[:-1]))
    end = np.flatnonzero(word & (~after | row_start[1:])) + 1
    piece = np.cumsum((kind == 2) + row_start[:-1].astype(np.int64))
    return start, end, piece[start]


class Chunk:
    """Numbered words: ``hashes``, ``lang`` and name of every distinct (language, word); ``seq``
    their numbers in the texts, 0 between pieces."""

    def __init__(self, langs: list[str]):
        self.langs = langs

    @classmethod
    def read(cls, langs: list[str], of_row: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> "Chunk":
        """From the bytes of texts, and the number of each one's language in ``langs``."""
        self = cls(langs)
        seeds = np.array([int.from_bytes(hashlib.sha256(lang.encode()).digest()[:8], "little") for lang in langs], np.uint64)
        found, seqs = [], []
        for a, b in X.blocks(offsets):
            part, cuts = X.LOWER[data[offsets[a]:offsets[b]]], offsets[a:b + 1] - offsets[a]
            start, end, piece = phrase_words(part, cuts)
            if not len(start):
                continue
            lang = of_row[a + np.searchsorted(cuts, start, "right") - 1]
            h = X.mix(X.word_hashes(part, start, end) ^ seeds[lang])
            own, at = np.unique(h, return_index=True)
            found.append((own, lang[at], start[at] + offsets[a], end[at] - start[at]))
            place = np.arange(len(h)) + np.cumsum(np.diff(piece, prepend=-1) != 0)
            seq = np.zeros(int(place[-1]) + 1, np.uint64)
            seq[place] = h
            seqs.append(seq)
        none = (np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3)
        own, lang, start, size = (np.concatenate(c) for c in zip(*found, none))
        self.hashes, at = np.unique(own, return_index=True)
        self.lang, start, size = lang[at], start[at], size[at]
        self.ends = np.cumsum(size)
        self.names = X.LOWER[data[np.repeat(start - (self.ends - size), size) + np.arange(self.ends[-1] if len(at) else 0)]]
        self.seq = np.concatenate([*[np.where(q == 0, 0, np.searchsorted(self.hashes, q) + 1).astype(np.uint32) for q in seqs], np.zeros(1, np.uint32)])
        return self

    def pack(self) -> bytes:
        parts = [pack(self.hashes, self.lang.astype(np.uint32), np.diff(self.ends, prepend=0).astype(np.uint32)), pack(self.names), pack(self.seq)]
        return np.array([len(p) for p in parts], "<u8").tobytes() + b"".join(parts)

    @classmethod
    def unpack(cls, langs: list[str], data: bytes, names: bool = False) -> "Chunk":
        self = cls(langs)
        a, b, _ = np.frombuffer(data, "<u8", 3).tolist()
        self.hashes, self.lang, size = unpack(data[24:24 + a])
        self.ends = np.cumsum(size.astype(np.int64))
        self.seq = unpack(data[24 + a + b:])[0]
        self.names = unpack(data[24 + a:24 + a + b])[0] if names else None
        return self

    def phrase(self, at: int, k: int) -> str:
        words = [int(i) - 1 for i in self.seq[at:at + k]]
        return b" ".join(self.names[self.ends[i - 1] if i else 0:self.ends[i]].tobytes() for i in words).decode("utf-8", "replace")

    def lang_counts(self) -> list[tuple[str, int]]:
        per = np.bincount(np.concatenate([[len(self.langs)], self.lang])[self.seq], minlength=len(self.langs) + 1)
        return [(lang, int(per[i])) for i, lang in enumerate(self.langs)]


def _keys(sums: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    return X.mix(X.between(sums, at, at + k, X.BASES[2]) + np.uint64(k))


class Scan:
    """The phrases of a chunk that are known to have reached the count: ``told[k]`` = (keys, ticks at
    which the chunk learnt it), sorted by key."""

    def __init__(self, chunk: Chunk, told: dict[int, tuple[np.ndarray, np.ndarray]]):
        self.chunk, self.told = chunk, told
        self.values = np.concatenate([np.zeros(1, np.uint64), chunk.hashes])[chunk.seq]
        self.sums = X.running(self.values, X.BASES[2])

    def _learnt(self, k: int, keys: np.ndarray) -> np.ndarray:
        known, tick = self.told.get(k, (np.zeros(0, np.uint64), np.zeros(0, np.int8)))
        at = lookup(keys, known)
        return np.where(at >= 0, np.append(tick, _NEVER)[at], _NEVER).astype(np.int8)

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """(key, count) of all words."""
        count = np.bincount(self.chunk.seq, minlength=len(self.chunk.hashes) + 1)[1:]
        key = X.mix(self.chunk.hashes + np.uint64(1))
        order = np.argsort(key)
        return key[order], count[order]

    def lengths(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(k, places, keys, ticks at which they became active) of the active phrases of k words."""
        own = self._learnt(1, X.mix(self.chunk.hashes + np.uint64(1)))
        learnt = np.concatenate([[_NEVER], own]).astype(np.int8)[self.chunk.seq]
        at = np.flatnonzero(learnt < _NEVER)
        yield 1, at, _keys(self.sums, at, 1), np.zeros(len(at), np.int8)
        for k in range(2, MAX_WORDS + 1):
            at = at[:-1][(np.diff(at) == 1)] if len(at) else at
            if not len(at):
                return
            active = np.maximum(learnt[at], learnt[at + 1])
            keys = _keys(self.sums, at, k)
            yield k, at, keys, active
            learnt = np.full(len(learnt), _NEVER, np.int8)
            learnt[at] = self._learnt(k, keys)
            at = at[learnt[at] < _NEVER]


def _split(keys: np.ndarray, depth: int, fan: int) -> Iterator[tuple[int, int, int]]:
    """(range, from, to) over sorted keys, dealt by the ``depth``-th digit of their place in the hash."""
    digit = _range_of(keys, depth, fan)
    heads = np.flatnonzero(np.diff(digit, prepend=-1)) if len(keys) else []
    for a, b in zip(heads, [*heads[1:], len(keys)]):
        yield int(digit[a]), int(a), int(b)


def _range_of(keys: np.ndarray, depth: int, fan: int) -> np.ndarray:
    """The range of each key among fan ** depth equal ones."""
    return ((keys >> np.uint64(32)) * np.uint64(fan ** depth) >> np.uint64(32)).astype(np.int64)


LIST = "node long, range long, child long, k int, tick int, data binary"
_ARROW = pa.schema([("node", pa.int64()), ("range", pa.int64()), ("child", pa.int64()), ("k", pa.int32()), ("tick", pa.int32()), ("data", pa.binary())])


def _table(rows: list[tuple]) -> pa.Table:
    return pa.Table.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(_ARROW.types)], schema=_ARROW)


def _lists(child: int, depth: int, fan: int, k: int, tick: int, keys: np.ndarray, count: np.ndarray) -> list[tuple]:
    """The packed lists of a child for its node."""
    return [(child // fan, r, child, k, tick, pack(np.diff(keys[a:b], prepend=np.uint64(0)), count[a:b].astype(np.uint64)))
            for r, a, b in _split(keys, depth, fan)]


def _entries(rows: pa.Table) -> dict[int, tuple[np.ndarray, ...]]:
    """k -> (keys, child, tick, counts) of all lists, sorted by key and child."""
    per: dict[int, list] = {}
    for child, k, tick, data in zip(*(rows.column(c).to_pylist() for c in ("child", "k", "tick", "data"))):
        step, count = unpack(data)
        per.setdefault(k, []).append((np.cumsum(step), np.full(len(step), child), np.full(len(step), tick, np.int8), count.astype(np.int64)))
    out = {}
    for k, lists in per.items():
        columns = [np.concatenate(c) for c in zip(*lists)]
        order = np.lexsort((columns[1], columns[0]))
        out[k] = tuple(c[order] for c in columns)
    return out


def _summed(depth: int, fan: int, tick: int):
    """A node below the top: what its children sent at ``tick``, summed up, in finer ranges."""

    def run(rows: pa.Table) -> pa.Table:
        out, node = [], rows.column("node")[0].as_py()
        for k, (keys, _, _, count) in _entries(rows).items():
            head = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            out += _lists(node, depth + 1, fan, k, tick, keys[head], np.add.reduceat(count, head))
        return _table(out)
    return run


def _answered(entries: tuple[np.ndarray, ...], reached: np.ndarray, first: np.ndarray, own: np.ndarray, tick: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(child, keys, flags) from, per entry: whether its phrase has reached the count, whether at this
    tick, whether this node is to name it. Flags: 1 reached now, 2 name it."""
    keys, child, sent, _ = entries
    tell = reached & (first | (sent == tick))
    head = np.concatenate([[True], keys[1:] != keys[:-1]])
    flag = np.where(first, 1, 0) + np.where(first & own & head, 2, 0)
    at = np.flatnonzero(tell)
    at = at[np.argsort(child[at], kind="stable")]
    cuts = np.flatnonzero(np.diff(child[at], prepend=-1)) if len(at) else []
    out = []
    for a, b in zip(cuts, [*cuts[1:], len(at)]):
        mine = at[a:b]
        key, place = np.unique(keys[mine], return_index=True)
        out.append((int(child[mine[0]]), key, np.bitwise_or.reduceat(flag[mine], place)))
    return out


def _top(tick: int, shards: int, min_count: int):
    """The top node of a range: answers to its children and, with k < 0 and child -1, the counts of
    candidates whose length is complete."""

    def run(rows: pa.Table) -> pa.Table:
        out, span = [], rows.column("range")[0].as_py()
        for k, entries in _entries(rows).items():
            keys, _, sent, count = entries
            head = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            size = np.diff(np.append(head, len(keys)))
            total, before = np.add.reduceat(count, head), np.add.reduceat(np.where(sent < tick, count, 0), head)
            reached, first = np.repeat(total >= min_count, size), np.repeat((total >= min_count) & (before < min_count), size)
            for child, key, flag in _answered(entries, reached, first, np.ones(len(keys), bool), tick):
                out.append((0, span, child, k, tick, pack(np.diff(key, prepend=np.uint64(0)), flag.astype(np.uint8))))
            if tick >= shards - 1 + k - 1:
                done = total >= min_count
                out.append((0, span, -1, -k, tick, pack(keys[head][done], total[done].astype(np.uint64))))
        return _table(out)
    return run


def _passed_on(tick: int):
    """A node below the top: its children's lists and the answers it got -> answers to the children."""

    def run(rows: pa.Table, told: pa.Table) -> pa.Table:
        out, answers = [], {}
        for k, data in zip(told.column("k").to_pylist(), told.column("data").to_pylist()):
            step, flag = unpack(data)
            answers.setdefault(k, []).append((np.cumsum(step), flag))
        for k, entries in _entries(rows).items() if rows.num_rows else []:
            if k not in answers:
                continue
            known, flag = (np.concatenate(c) for c in zip(*answers[k]))
            order = np.argsort(known, kind="stable")
            known, flag = known[order], flag[order]
            at = lookup(entries[0], known)
            mine = np.append(flag, 0)[at]
            node, span = rows.column("node")[0].as_py(), rows.column("range")[0].as_py()
            for child, key, said in _answered(entries, at >= 0, mine & 1 > 0, mine & 2 > 0, tick):
                out.append((node, span, child, k, tick, pack(np.diff(key, prepend=np.uint64(0)), said.astype(np.uint8))))
        return _table(out)
    return run


def _chunked(chunk_bytes: int):
    """(lang, text)s -> chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        for batch in batches:
            said = batch.column(0).dictionary_encode()
            langs, of_row = said.dictionary.to_pylist(), said.indices.to_numpy()
            data, offsets = X.column_bytes(batch.column(1))
            for a, b in X.blocks(offsets, chunk_bytes):
                chunk = Chunk.read(langs, of_row[a:b], data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                counts = [{"lang": lang, "n": n} for lang, n in chunk.lang_counts()]
                packed = chunk.pack()
                pieces = [packed[i:i + PIECE_BYTES] for i in range(0, len(packed), PIECE_BYTES)]
                rest = [None] * (len(pieces) - 1)
                yield pa.RecordBatch.from_arrays([pa.array([number] * len(pieces)), pa.array(range(len(pieces)), pa.int32()), pa.array([langs, *rest], pa.list_(pa.string())),
                                                  pa.array([counts, *rest], pa.list_(pa.struct([("lang", pa.string()), ("n", pa.int64())]))),
                                                  pa.array(pieces, pa.binary())], names=["name", "piece", "langs", "counts", "data"])
                number += 1
    return run


def _whole(chunks: pa.Table) -> tuple[int, list[str], bytes] | None:
    """(number, languages, data) of the chunk whose pieces these rows are."""
    if not chunks.num_rows:
        return None
    order = np.argsort(chunks.column("piece").to_numpy()).tolist()
    data = chunks.column("data")
    langs = chunks.column("langs")[order[0]].as_py() if "langs" in chunks.column_names else []
    return chunks.column("chunk")[0].as_py(), langs, b"".join(data[i].as_py() for i in order)


def _told(answers: pa.Table, flag: int = 0) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """k -> (keys, ticks) of the answers to one chunk, those with ``flag`` set only."""
    per: dict[int, list] = {}
    for k, tick, data in zip(*(answers.column(c).to_pylist() for c in ("k", "tick", "data"))):
        step, said = unpack(data)
        keep = (said & flag) == flag
        per.setdefault(k, []).append((np.cumsum(step)[keep], np.full(int(keep.sum()), tick, np.int8)))
    out = {}
    for k, lists in per.items():
        keys, tick = (np.concatenate(c) for c in zip(*lists))
        order = np.argsort(keys, kind="stable")
        out[k] = keys[order], tick[order]
    return out


def _count(tick: int, shards: int, fan: int):
    """A chunk and what it was told -> its new lists."""

    def run(chunks: pa.Table, told: pa.Table) -> pa.Table:
        out, whole = [], _whole(chunks)
        if whole is None:
            return _table(out)
        child, _, data = whole
        if child % shards > tick:
            return _table(out)
        scan = Scan(Chunk.unpack([], data), _told(told))
        if child % shards == tick:
            keys, count = scan.words()
            out += _lists(child, 1, fan, 1, tick, keys, count)
        else:
            for k, _, keys, active in scan.lengths():
                if k > 1:
                    keys, count = np.unique(keys[active == tick - 1], return_counts=True)
                    out += _lists(child, 1, fan, k, tick, keys, count)
        return _table(out)
    return run


_NAMED = "key long, k int, lang string, phrase string"


def _named(chunks: pa.Table, told: pa.Table) -> pa.Table:
    """The phrases that a chunk is to name."""
    rows, whole = [], _whole(chunks)
    if whole:
        _, langs, data = whole
        chunk = Chunk.unpack(langs, data, names=True)
        mine = _told(told, flag=2)
        for k, at, keys, _ in Scan(chunk, _told(told)).lengths():
            if k in mine:
                key, first = np.unique(keys, return_index=True)
                found = lookup(mine[k][0], key)
                for x, p in zip(mine[k][0].view(np.int64).tolist(), at[first[found]].tolist()):
                    rows.append((x, k, langs[chunk.lang[int(chunk.seq[p]) - 1]], chunk.phrase(int(p), k)))
    types = (pa.int64(), pa.int32(), pa.string(), pa.string())
    return pa.Table.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=["key", "k", "lang", "phrase"])


def _final(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(k, data) of complete counts -> (key, k, f)."""
    for batch in rows:
        for k, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            keys, total = unpack(data)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(np.full(len(keys), -k, np.int32)), pa.array(total.astype(np.int64))], names=["key", "k", "f"])


def phrase_counts(df: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT, shards: int = SHARDS,
                  fan: int = FAN, chunk_bytes: int = CHUNK_BYTES) -> tuple[DataFrame, DataFrame]:
    """``(lang, phrase, k, f)`` of all words and phrases that stand ``min_count`` times or more, and
    ``(lang, n)``: all words."""
    texts = df.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")), F.col(text_col).cast("string").cast("binary")).filter(F.octet_length(text_col) > 0)
    read = staged(texts.mapInArrow(_chunked(chunk_bytes), "name long, piece int, langs array<string>, counts array<struct<lang:string,n:long>>, data binary"), "chunk-texts")
    # dense numbers (shard = number mod shards), from the chunks of every task that wrote some
    parts = read.filter("piece = 0").groupBy(F.shiftright("name", 24).alias("task")).agg(F.count(F.lit(1)).alias("m"))
    before = parts.select("task", (F.sum("m").over(Window.orderBy("task")) - F.col("m")).alias("before"))
    number = F.col("before") + F.col("name").bitwiseAND(F.lit((1 << 24) - 1))
    before = F.broadcast(staged(before, "chunk-numbers"))  # one row per task
    chunks = read.withColumn("task", F.shiftright("name", 24)).join(before, "task").select(number.alias("chunk"), "piece", "langs", "counts", "data")
    levels, most = 1, int(parts.agg(F.sum("m")).first()[0] or 0)
    while fan ** levels < most:
        levels += 1
    spark = df.sparkSession
    none = spark.createDataFrame([], LIST)
    sent: list[list[DataFrame]] = []  # by tick, by level
    answers, complete = none, none
    by_chunk = chunks.select("chunk", "piece", "data").groupBy("chunk")
    for tick in range(shards - 1 + MAX_WORDS):
        up = [staged(by_chunk.cogroup(answers.withColumnRenamed("child", "chunk").groupBy("chunk")).applyInArrow(_count(tick, shards, fan), LIST), "lists")]
        for level in range(1, levels):
            up.append(staged(up[-1].groupBy("node", "range").applyInArrow(_summed(level, fan, tick), LIST), "lists"))
        sent.append(up)
        open_k = max(1, tick - shards + 2)  # shorter phrases were complete before this tick

        def current(level: int) -> DataFrame:
            out = sent[-1][level]
            for older in sent[max(0, tick - shards + 1):-1]:
                out = out.unionByName(older[level])
            return out.filter(F.col("k") >= open_k)
        told = staged(current(levels - 1).groupBy("range").applyInArrow(_top(tick, shards, min_count), LIST), "answers")
        complete = complete.unionByName(told.filter("child < 0"))
        told = told.filter("child >= 0")
        for level in range(levels - 2, -1, -1):
            # the answers of finer ranges go to the node and range that the lists came from
            back = told.select(F.col("child").alias("node"), F.floor(F.col("range") / fan).alias("range"), "k", "data")
            told = staged(current(level).groupBy("node", "range").cogroup(back.groupBy("node", "range")).applyInArrow(_passed_on(tick), LIST), "answers")
        answers = answers.unionByName(told)
    names = chunks.select("chunk", "piece", "langs", "data").groupBy("chunk").cogroup(answers.withColumnRenamed("child", "chunk").groupBy("chunk")).applyInArrow(_named, _NAMED)
    final = complete.select("k", "data").mapInArrow(_final, "key long, k int, f long")
    counts = chunks.select(F.explode("counts").alias("c")).groupBy("c.lang").agg(F.sum("c.n").alias("n"))
    return staged(names.join(final, ["key", "k"]).select("lang", "phrase", "k", "f"), "phrases"), counts


def collocations(df: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT, top: int = TOP, **kw) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's first ``top`` candidates."""
    phrases, words = phrase_counts(df, text_col, lang_col, min_count, **kw)
    part = phrases.select("lang", F.col("phrase").alias("part"), F.col("f"))
    j, k = F.col("j"), F.col("k")
    cut = phrases.filter("k > 1").withColumn("j", F.explode(F.sequence(F.lit(1), k - 1)))
    cut = cut.withColumns({"left": F.expr("substring_index(phrase, ' ', j)"), "right": F.expr("substring_index(phrase, ' ', j - k)")})
    cut = cut.join(part.withColumnsRenamed({"part": "left", "f": "l"}), ["lang", "left"]).join(part.withColumnsRenamed({"part": "right", "f": "r"}), ["lang", "right"])
    wide = "cast({} as decimal(17, 0))".format
    score = F.expr(f"cast((cast(1000 as decimal(4, 0)) * {wide('f')} * {wide('n')}) div ({wide('l')} * {wide('r')}) as bigint)")
    scored = cut.join(words, "lang").groupBy("lang", "phrase", F.col("f").alias("a"), "n").agg(F.min(F.struct(score.alias("score"), j, "l", "r")).alias("_s"))
    # a longer candidate with the same count implies one that is longer by a single word
    longer = phrases.filter("k > 2").select("lang", F.col("f").alias("a"), F.explode(F.array(
        F.expr("substring_index(phrase, ' ', k - 1)"), F.expr("substring_index(phrase, ' ', 1 - k)"))).alias("phrase")).distinct()
    kept = scored.join(longer, ["lang", "phrase", "a"], "left_anti").select("lang", "phrase", "a", "_s.l", "_s.r", "n", "_s.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
