"""Near-duplicate classes by SetSketch registers.

A document's set holds its distinct runs of SHINGLE words (A-Z lower-cased; words are runs of bytes
other than \\x20\\x09-\\x0D; a shorter text is one run; a text without words has none). Two sets link
when 100 * |A and B| >= PERCENT * |A or B|; a class is what links connect.

1. Registers. Every shingle has an exponential variable of rate RATE for each of M registers; they are drawn in
   ascending order, from the shingle's hash, and dealt to the registers in an order of the shingle's
   own, so a shingle is done with as soon as its next value exceeds all of the document's minima. A register is
   the truncated logarithm (base BASE) of the least value: floor(1 - log(minimum)), within two bytes. The
   registers of a union are the larger ones of both parts (``merged``).
2. Bands. Equal sets become one representative. Registers are banded by ROWS; two sets at the limit
   share none of the BANDS bands with a probability of (1 - 0.8 ** 4) ** 48 = 1e-11.
3. Estimate. What shares a band is estimated jointly, by the likelihood of the numbers of registers that are
   larger, equal and smaller, given both sizes. A pair is left out when the limit is exp(DOUBT) times less
   likely than the estimate, or excluded by the sizes. Documents that share a band have FAMILIES * M fine registers
   as well (a byte each), for the same test on the share of equal ones, which is sharper. Of two sets at the limit
   a test leaves out 1 pair in 10 ** 8.
4. Every member of a band is estimated against the band's least member, and verified on whole sets;
   links contract the members, so a group of copies of any size is few classes after as many checks as members.
5. Bands that still hold several classes are compared: members outside the band's largest class against all members of
   other classes, in blocks of BLOCK, within the task that holds a block. Bands with the same least member are one
   group, in which a document is one row. A pair is judged in its first common band only, and only pairs that pass the
   estimate leave the task, to be verified. First each member's BEST candidates of its own block are, which takes two
   rows a member in a group of any size, and what links contracts the classes; then all that are left, where a
   group of members that do not link takes a row for each block of the other side.

Defined cases: null and empty texts have no shingles and no links; repeated rows share a class, and so
do the texts of one id that is the least of their sets; a null id is a class of its own and links nothing; very long texts are sets as
others; ties do not matter (a class has the least id); an empty table gives an empty table; extra columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portmart.llm import text as X
from portmart.llm.components import components
from portmart.llm.ngram_join import sets
from portmart.llm.staging import partitions, staged
from portmart.operators.joins import broadcast_if_small

SHINGLE = 4
PERCENT = 80
M = 256  # registers; their number is one byte
BASE = 1.005
RATE = 20.0
BANDS, ROWS = 48, 4
DOUBT = 16.0
FAMILIES = 4  # of M fine registers each
BLOCK = 1024
BEST = 2
BATCH_BYTES = 4 << 20
TASK_ROWS = 20_000


def registers(hashes: list[np.ndarray], family: int = 0) -> np.ndarray:
    """The M registers of every set of hashes; those of an empty set are 0. Each ``family`` is independent."""
    rows = len(hashes)
    least = np.full((rows, M), np.inf)
    flat = least.reshape(-1)
    row = np.repeat(np.arange(rows), [len(h) for h in hashes])
    state = X.mix(np.concatenate([*hashes, np.zeros(0, np.uint64)]) ^ np.uint64(X.BASES[3] ^ (family * X.BASES[1] & X.M64)))
    keys = X.mix(state + np.uint64(1))
    value = np.zeros(len(row))
    for j in range(M):
        if not len(row):
            break
        state = X.mix(state + np.uint64(X.BASES[0]))
        value = value - np.log(((state >> np.uint64(11)) + 0.5) * 2.0 ** -53) / (RATE * (M - j))
        slot = np.full(len(row), j, np.uint8)  # a bijection of bytes by the shingle's keys
        for step in (0, 16, 32, 48):
            slot = slot * ((keys >> np.uint64(step)).astype(np.uint8) | np.uint8(1)) + (keys >> np.uint64(step + 8)).astype(np.uint8)
            slot ^= slot >> np.uint8(4)
        np.minimum.at(flat, row * M + slot, value)
        if j < 4 or j % 8 == 0:
            live = np.flatnonzero(value < least.max(axis=1)[row])
            row, state, keys, value = row[live], state[live], keys[live], value[live]
    with np.errstate(divide="ignore"):
        return np.clip(np.floor(1 - np.log(least) / np.log(BASE)), 0, 0xFFFF).astype(np.uint16)


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The registers of the union of two sets."""
    return np.maximum(a, b)


def _log_likelihood(j: np.ndarray, u: np.ndarray, v: np.ndarray, more: np.ndarray, less: np.ndarray, equal: np.ndarray) -> np.ndarray:
    scale = (BASE - 1) / BASE
    p = -np.log1p(-np.maximum(u - v * j, 1e-12) * scale) / np.log(BASE)
    q = -np.log1p(-np.maximum(v - u * j, 1e-12) * scale) / np.log(BASE)
    return more * np.log(p) + less * np.log(q) + equal * np.log(np.maximum(1 - p - q, 1e-12))


def estimate(na: np.ndarray, nb: np.ndarray, more: np.ndarray, less: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(likeliest similarity of sets of these sizes whose registers are larger and smaller so often,
    how much less the logarithm of the likelihood is at the limit; 0 for estimates above)."""
    u = na / (na + nb)
    v, equal = 1 - u, M - more - less
    top = np.minimum(u / v, v / u)
    low, high = np.zeros(len(top)), top.copy()
    for _ in range(24):  # the likelihood has one peak
        x, y = high - 0.618 * (high - low), low + 0.618 * (high - low)
        up = _log_likelihood(x, u, v, more, less, equal) < _log_likelihood(y, u, v, more, less, equal)
        low, high = np.where(up, x, low), np.where(up, high, y)
    best = (low + high) / 2
    limit = np.full(len(top), PERCENT / 100)
    gap = _log_likelihood(best, u, v, more, less, equal) - _log_likelihood(limit, u, v, more, less, equal)
    return best, np.where(best >= limit, 0.0, gap)


def likely(na: np.ndarray, nb: np.ndarray, more: np.ndarray, less: np.ndarray) -> np.ndarray:
    """Whether a link cannot be left out by sizes and registers."""
    keep = 100 * np.minimum(na, nb) >= PERCENT * np.maximum(na, nb)
    at = np.flatnonzero(keep)
    keep[at] = estimate(na[at], nb[at], more[at], less[at])[1] <= DOUBT
    return keep


def fine_registers(hashes: list[np.ndarray]) -> np.ndarray:
    """FAMILIES * M more registers of every set, of each the last byte: enough to count how many are equal."""
    return np.concatenate([registers(hashes, f).astype(np.uint8) for f in range(1, FAMILIES + 1)], axis=1)


def likely_by_fine(equal: np.ndarray) -> np.ndarray:
    """Whether so many equal fine registers leave a link: they are equal with the sets' similarity at least (bytes
    of different registers agree now and then, which only keeps more)."""
    n, limit = FAMILIES * M, PERCENT / 100
    p = np.clip(equal / n, 1e-9, 1 - 1e-9)
    gap = n * (p * np.log(p / limit) + (1 - p) * np.log((1 - p) / (1 - limit)))
    return (p >= limit) | (gap <= DOUBT)


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets link."""
    both = len(a) + len(b) - len(np.union1d(a, b))
    return 100 * both >= PERCENT * (len(a) + len(b) - both)


def _digest(s: np.ndarray) -> bytes:
    return X.mix(np.array([np.bitwise_xor.reduce(X.mix(s + np.uint64(j))) + np.uint64(len(s)) for j in (1, 2)])).tobytes()


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text) -> (doc_id, n, digest, registers); the last two are null without shingles or id."""
    for batch in batches:
        data, offsets = X.column_bytes(batch.column(1))
        ids = batch.column(0)
        for a, b in X.blocks(offsets, BATCH_BYTES):
            own = sets(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], SHINGLE)
            own_registers = registers(own).astype("<u2")
            live = [len(s) > 0 and i is not None for s, i in zip(own, ids.slice(a, b - a).to_pylist())]
            digest = [_digest(s) if ok else None for s, ok in zip(own, live)]
            kept = [r.tobytes() if ok else None for r, ok in zip(own_registers, live)]
            yield pa.RecordBatch.from_arrays([ids.slice(a, b - a), pa.array([len(s) for s in own], pa.int64()), pa.array(digest, pa.binary()), pa.array(kept, pa.binary())],
                                             names=["doc_id", "n", "digest", "registers"])


def _whole_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text) -> (rep, digest, hashes, fine)."""
    for batch in batches:
        data, offsets = X.column_bytes(batch.column(1))
        for a, b in X.blocks(offsets, BATCH_BYTES):
            own = sets(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], SHINGLE)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array([_digest(s) if len(s) else None for s in own], pa.binary()),
                                              pa.array([s.astype("<u8").tobytes() for s in own], pa.binary()),
                                              pa.array([f.tobytes() for f in fine_registers(own)], pa.binary())], names=["rep", "digest", "hashes", "fine"])


def _read_registers(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(X.column_bytes(column)[0].tobytes(), "<u2").reshape(-1, M)


def _read_fine(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(X.column_bytes(column)[0].tobytes(), np.uint8).reshape(-1, FAMILIES * M)


def _estimated(pairs: DataFrame, whole: DataFrame) -> DataFrame:
    """Those of ``pairs(a, b)`` that sizes and registers do not exclude."""
    for end in ("a", "b"):
        pairs = pairs.join(whole.select(F.col("rep").alias(end), *[F.col(c).alias(f"{c}{end}") for c in ("n", "registers", "fine")]), end)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = _read_registers(batch.column(4)), _read_registers(batch.column(5))
            keep = likely(batch.column(2).to_numpy(), batch.column(3).to_numpy(), (x > y).sum(axis=1), (x < y).sum(axis=1))
            keep &= likely_by_fine((_read_fine(batch.column(6)) == _read_fine(batch.column(7))).sum(axis=1))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep))
    return pairs.select("a", "b", "na", "nb", "registersa", "registersb", "finea", "fineb").mapInArrow(run, "a long, b long")


def _verified(pairs: DataFrame, whole: DataFrame) -> DataFrame:
    """Those of ``pairs(a, b)`` that link, by their whole sets."""
    for end in ("a", "b"):
        pairs = pairs.join(whole.select(F.col("rep").alias(end), F.col("hashes").alias(f"h{end}")), end)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [linked(np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")) for x, y in zip(batch.column(2), batch.column(3))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return pairs.select("a", "b", "ha", "hb").mapInArrow(run, "a long, b long")


def _compare(best: int | None):
    """Group function: pairs (a < b) of different classes that the estimate leaves, within the blocks of one
    task; of each query only the ``best`` likeliest in a block, if given."""

    def run(rows: pa.Table) -> pa.Table:
        # rows with registers come once a document, however many of its blocks are here; the others point to them
        sketched = rows.filter(rows.column("registers").is_valid())
        rows = rows.filter(rows.column("registers").is_null())
        by_rep = np.argsort(sketched.column("rep").to_numpy(), kind="stable")
        known = sketched.column("rep").to_numpy()[by_rep]
        own, fine, sizes = _read_registers(sketched.column("registers"))[by_rep], _read_fine(sketched.column("fine"))[by_rep], sketched.column("n").to_numpy()[by_rep]
        bands = np.ascontiguousarray(own[:, :BANDS * ROWS]).view(f"u{2 * ROWS}")  # one number a band
        rep = rows.column("rep").to_numpy()
        first, last = np.searchsorted(known, rep), np.searchsorted(known, rep, "right")
        at = np.repeat(np.arange(len(rep)), last - first)  # an id with several texts is there for each
        sketch = first[at] + np.arange(len(at)) - np.repeat(np.cumsum(last - first) - (last - first), last - first)
        rep = rep[at]
        pivot, block, part, query, mask, ask = (rows.column(c).to_numpy()[at] for c in ("pivot", "block", "component", "query", "mask", "ask"))
        if not len(rep):
            return pa.Table.from_arrays([pa.array([], pa.int64())] * 2, names=["a", "b"])
        order = np.lexsort((query, block, pivot))
        heads = np.flatnonzero(np.concatenate([[True], (np.diff(pivot[order]) != 0) | (np.diff(block[order]) != 0)]))
        found = [np.zeros((0, 2), np.int64)]
        for a, b in zip(heads, [*heads[1:], len(order)]):
            mine = order[a:b]
            points, queries = mine[~query[mine]], mine[query[mine]]
            for q in queries:
                common = mask[points] & ask[q]
                if best is None:  # of two that ask in a band the greater one is enough
                    common = np.where(rep[points] > rep[q], common & ~ask[points], common)
                near = points[(common != 0) & (part[points] != part[q])]
                if not len(near):
                    continue
                mate, me = sketch[near], sketch[q]
                shared = bands[mate] == bands[me]
                first = shared.argmax(axis=1)
                asks = ask[q] if best is not None else np.where(rep[near] > rep[q], ask[q] & ~ask[near], ask[q])
                at = np.flatnonzero(shared[np.arange(len(near)), first] & ((asks >> first) & 1 == 1))
                x, y = own[mate[at]], own[me]
                at = at[likely(sizes[mate[at]], np.full(len(at), sizes[me]), (x > y).sum(axis=1), (x < y).sum(axis=1))]
                equal = (fine[mate[at]] == fine[me]).sum(axis=1)
                left = likely_by_fine(equal)
                at, equal = at[left], equal[left]
                if best is not None and len(at) > best:
                    at = at[np.lexsort((rep[near[at]], -equal))[:best]]
                near = near[at]
                if len(near):
                    found.append(np.sort(np.stack([rep[near], np.full(len(near), rep[q])], axis=1), axis=1))
        pairs = np.unique(np.concatenate(found), axis=0)
        return pa.Table.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])
    return run


def _labelled(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    """``rows`` with the ``component`` of ``rep``."""
    if labels is None:
        return rows.withColumn("component", F.col("rep"))
    return rows.join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))


def _open_pairs(members: DataFrame, whole: DataFrame, labels: DataFrame | None, best: int | None) -> DataFrame | None:
    """Pairs of different classes in one band that the estimate leaves (of each member the ``best`` in its own block, if
    given); None if no band has two classes."""
    of = _labelled(members, labels)
    per = of.groupBy("band", "component").agg(F.count(F.lit(1)).alias("c"))
    main = per.groupBy("band").agg(F.max(F.struct("c", "component")).alias("_m"), F.count(F.lit(1)).alias("classes")).filter("classes > 1")
    opened = of.join(main.select("band", F.col("_m.component").alias("main")), "band")
    # bands of one group of copies have mostly the same least member: a document is there once, with the numbers of its
    # bands as bits, and of those it asks in
    bit = F.expr("shiftleft(1L, number)")
    asking = F.bit_or(F.when(F.col("component") != F.col("main"), bit).otherwise(F.lit(0).cast("long")))
    opened = staged(opened.groupBy("pivot", "rep", "component").agg(F.bit_or(bit).alias("mask"), asking.alias("ask")), "open")
    # few groups need several blocks, so their sizes are few as well
    count = lambda one: F.ceil(F.count(one) / BLOCK).cast("int")
    sizes = opened.groupBy("pivot").agg(count(F.lit(1)).alias("_points"), count(F.when(F.col("ask") != 0, 1)).alias("_askers")).filter("_points > 1")
    opened = opened.join(broadcast_if_small(staged(sizes, "sizes")), "pivot", "left").withColumns(
        {"_points": F.coalesce("_points", F.lit(1)), "_askers": F.greatest(F.coalesce("_askers", F.lit(1)), F.lit(1))})
    asks = F.col("ask") != 0
    point, asker = (F.pmod(F.xxhash64("rep"), F.col(c)).cast("int") for c in ("_points", "_askers"))
    place = lambda m, q, query: F.struct((m * F.col("_askers").cast("long") + q).alias("block"), F.lit(query).alias("query"))
    if best is None:  # every block of members meets every block of askers
        data = F.transform(F.sequence(F.lit(0), F.col("_askers") - 1), lambda q: place(point, q, False))
        queries = F.transform(F.sequence(F.lit(0), F.col("_points") - 1), lambda m: place(m, asker, True))
    else:  # a member asks in its own block
        data, queries = (F.array(place(point, F.lit(0), query)) for query in (False, True))
    places = opened.withColumn("_place", F.explode(F.concat(data, F.filter(queries, lambda _: asks))))
    places = staged(places.select("pivot", "_place.block", "rep", "component", "_place.query", "mask", "ask"), "places")
    rows = places.count()
    if not rows:
        return None
    tasks = max(partitions(members.sparkSession), -(-rows // TASK_ROWS))
    places = places.withColumn("task", F.pmod(F.xxhash64("pivot", "block"), F.lit(tasks)).cast("int"))
    sketches = places.select("task", "rep").distinct().join(whole.select("rep", "n", "registers", "fine"), "rep")
    both = places.unionByName(sketches, allowMissingColumns=True)
    return both.groupBy("task").applyInArrow(_compare(best), "a long, b long").distinct()


def near_classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` per row of ``df``; ids are integers."""
    docs = df.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text"))
    points = staged(docs.mapInArrow(_sketch, "doc_id long, n long, digest binary, registers binary"), "points")
    # equal sets have equal registers
    reps = staged(points.filter("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("registers").alias("registers")), "representatives")
    band = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.struct(
        i.alias("number"), F.xxhash64(i, F.substring(F.col("registers"), i * (2 * ROWS) + 1, F.lit(2 * ROWS))).alias("band")))
    dealt = reps.select("rep", F.explode(band).alias("_b")).select("rep", "_b.number", "_b.band")
    # of bands with the same members the one with the least number is enough: it is the first that any two share
    same = [F.sum(F.xxhash64(F.lit(i), "rep").cast("decimal(38, 0)")).alias(f"d{i}") for i in (1, 2)]
    shared = dealt.groupBy("band").agg(F.min("rep").alias("pivot"), F.count(F.lit(1)).alias("m"), F.min("number").alias("number"), *same).filter("m > 1")
    shared = shared.groupBy("pivot", "m", "d1", "d2").agg(F.min(F.struct("number", "band"))["band"].alias("band"))
    members = staged(dealt.join(shared.select("band", "pivot"), "band"), "bands")
    # a list of ids of a checked size is broadcast, so texts are not shuffled; a longer one is joined plainly
    shared_ids = broadcast_if_small(staged(members.select("rep").distinct(), "candidates"))
    texts = docs.withColumnRenamed("_id", "rep").join(shared_ids, "rep", "left_semi").mapInArrow(_whole_sets, "rep long, digest binary, hashes binary, fine binary")
    whole = texts.groupBy("rep", "digest").agg(F.first("hashes").alias("hashes"), F.first("fine").alias("fine"))  # repeated rows
    whole = staged(whole.join(reps, ["rep", "digest"]).select("rep", "n", "registers", "hashes", "fine"), "sets")
    near = members.filter("rep <> pivot").select(F.col("pivot").alias("a"), F.col("rep").alias("b")).distinct()
    asked = staged(_estimated(near, whole), "pairs")
    links = staged(_verified(asked, whole), "links")
    labels = components(links)
    for best in (BEST, None):
        pairs = _open_pairs(members.select("band", "number", "rep", "pivot"), whole, labels, best)
        if pairs is None:
            break
        pairs = staged(pairs.join(asked, ["a", "b"], "left_anti"), "pairs")  # what was verified before did not link
        more = staged(_verified(pairs, whole), "links")
        asked = asked.unionByName(pairs)
        if not more.isEmpty():
            links = links.unionByName(more)
            labels = components(links)
    named = _labelled(reps.select("digest", "rep"), labels).select("digest", "component")
    out = points.select("doc_id", "n", "digest").join(named, "digest", "left")
    one = F.coalesce("component", "doc_id")
    return out.select(F.col("doc_id").alias(id_col), F.col("n").alias("n_shingles"), one.alias("component_id"), F.col("doc_id").eqNullSafe(one).alias("kept"))
