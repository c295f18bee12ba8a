"""N-gram Jaccard join by a count-vector R-tree.

A document's set holds its distinct runs of SHINGLE words (A-Z lower-cased; words are runs of bytes
other than \\x20\\x09-\\x0D; a shorter text is one run; a text without words has none). Two sets link
when 100 * |A and B| >= PERCENT * |A or B|. The join returns classes: all documents that links connect.

1. Points. The hashes of a set are dealt into groups, FINE times as many as the set has members (a power of two);
   the counts per group are the set's point, stored sparse. A finer point folds into a coarser one by adding up
   halves, so sets of different sizes compare. Two sets share at most the sum over groups of the smaller
   count, which bounds their similarity. No pair is verified that this bound excludes.
2. Slabs. The outermost level of the tree is a directory of slabs "has shingle s": linked sets
   share one of the first n - need + 1 shingles of each (need: the least overlap a set of n can link
   with), in an order by the number of documents that hold the shingle. Documents with too many
   shingles of their own to reach ``need`` (nearly all that have no near copy) get no slab at all.
   How many documents hold a shingle is counted over all of them, through ``chunks``. Of slabs with the same
   members (told by two sums of hashes) one is kept.
3. Equal sets become one class representative (its least id).
4. Every slab member that the bound leaves is verified against the slab's least member. Links found so contract the
   members, so that a slab of near copies (of any size) is few classes after as many checks as members.
5. Slabs that still hold several classes become R-trees: blocks of at most TREE points, bulk-loaded
   along sorted coordinates, inner nodes with the largest counts (and the least size) below them.
   Points outside a slab's largest class query all blocks; nodes and points whose summed minima
   stay below the needed overlap are left. First each query has only its BEST points of other
   classes verified (those with the highest bound), and the links contract the classes: what
   links at all mostly links here, and its other pairs need no check any more.
6. The last pass verifies all surviving pairs of classes that are still apart, on their whole sets. A pair that was
   verified before is not verified again.

Every link between different classes is found: the last pass leaves out only pairs already connected
and pairs whose bound excludes a link; the pass before only saves it work.

Defined cases: null and empty texts have no shingles and no links; rows repeated with one id share its
class; a null id is a class of its own and links nothing; an empty table gives an empty table; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portmart.llm import chunks as C
from portmart.llm import text as X
from portmart.llm.components import components
from portmart.llm.staging import staged

SHINGLE = 5
PERCENT = 75
FINE = 16
TREE = 1024
BEST = 2
LEAF = 16
TASK_ROWS = 50_000

POINTS = "doc_id long, n_shingles long, digest binary, slabs array<long>, counts binary, hashes binary"


def needed(size, other):
    """Least overlap with which sets of these sizes link."""
    total = (size + other) * PERCENT
    return -(-total // (100 + PERCENT))


def sets(data: np.ndarray, offsets: np.ndarray, k: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    out: list[np.ndarray] = []
    for a, b in X.blocks(offsets):
        part, cuts = X.LOWER[data[offsets[a]:offsets[b]]], offsets[a:b + 1] - offsets[a]
        starts, ends, first = X.words(part, cuts)
        h = X.word_hashes(part, starts, ends)
        at, shingle = X.window_hashes(h, first, k)
        bound = np.searchsorted(at, first)
        sums = X.running(h, X.BASES[2])
        for i in range(b - a):
            words = first[i + 1] - first[i]
            if words >= k:
                out.append(np.unique(shingle[bound[i]:bound[i + 1]]))
            elif words:
                whole = X.between(sums, first[i:i + 1], first[i + 1:i + 2], X.BASES[2])
                out.append(X.mix(whole + np.uint64(words)))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def point(s: np.ndarray) -> bytes:
    """Counts of a set per group, sparse: the groups that are not empty (as steps) and their counts. The number
    of groups is the power of two from FINE times the set's size on."""
    group, count = np.unique(s & np.uint64(groups_for(len(s)) - 1), return_counts=True)
    return C.pack(np.diff(group, prepend=np.uint64(0)).astype(np.uint32), count.astype(np.uint32))


def groups_for(size: int) -> int:
    return 1 << max(4, (FINE * size - 1).bit_length())


class Points:
    """Sparse count vectors behind each other: the entries of vector i are ``group[at[i]:at[i + 1]]`` with their
    ``count``; its groups are numbered below ``1 << level[i]``. Fewer groups are had by leaving out the
    upper bits of the numbers and adding up."""

    def __init__(self, group: np.ndarray, count: np.ndarray, at: np.ndarray, level: np.ndarray, size: np.ndarray):
        self.group, self.count, self.at, self.level, self.size = group, count, at, level, size

    @classmethod
    def read(cls, data: list[bytes], size: np.ndarray) -> "Points":
        lists = [C.unpack(d) for d in data]
        at = np.concatenate([[0], np.cumsum([len(x[0]) for x in lists])]).astype(np.int64)
        none = np.zeros(0, np.int64)
        group = np.concatenate([none, *[np.cumsum(x[0], dtype=np.int64) for x in lists]])
        count = np.concatenate([none, *[x[1].astype(np.int64) for x in lists]])
        level = np.array([groups_for(int(n)).bit_length() - 1 for n in size], np.int64)
        return cls(group, count, at, level, np.asarray(size, np.int64))

    def take(self, which: np.ndarray) -> "Points":
        entry, sizes = self.entries(which)
        return Points(self.group[entry], self.count[entry], np.concatenate([[0], np.cumsum(sizes)]), self.level[which], self.size[which])

    def entries(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places of the entries of these vectors, their numbers)."""
        n = self.at[which + 1] - self.at[which]
        end = np.cumsum(n)
        return np.repeat(self.at[which] - (end - n), n) + np.arange(end[-1] if len(end) else 0), n

    def covers(self, parent: np.ndarray) -> "Points":
        """For every parent the largest count per group, in as many groups as its coarsest child has, and the least
        size; ``parent`` ascends from 0."""
        head = np.flatnonzero(np.diff(parent, prepend=-1))
        level = np.minimum.reduceat(self.level, head)
        child = np.repeat(np.arange(len(parent)), np.diff(self.at))
        group = self.group & ((np.int64(1) << level[parent[child]]) - 1)

        def folded(key: np.ndarray, count: np.ndarray, how) -> tuple[np.ndarray, ...]:
            order = np.lexsort((group, key))
            k, g = key[order], group[order]
            first = np.flatnonzero(np.concatenate([[True], (np.diff(k) != 0) | (np.diff(g) != 0)]))
            return k[first], g[first], how.reduceat(count[order], first)
        child, group, count = folded(child, self.count, np.add)
        own, group, count = folded(parent[child], count, np.maximum)
        return Points(group, count, np.searchsorted(own, np.arange(len(head) + 1)), level, np.minimum.reduceat(self.size, head))


class Query:
    """One vector, for its bounds against others."""

    def __init__(self, points: Points, i: int):
        group, count = points.group[points.at[i]:points.at[i + 1]], points.count[points.at[i]:points.at[i + 1]]
        self.level, self.size = int(points.level[i]), int(points.size[i])
        self.dense = np.zeros(2 << self.level, np.int64)  # 1 << k groups from place 1 << k on
        self.dense[(1 << self.level) + group] = count
        self.known = self.level

    def _fold_to(self, level: int) -> None:
        while self.known > level:
            n = 1 << (self.known - 1)
            self.dense[n:2 * n] = self.dense[2 * n:3 * n] + self.dense[3 * n:4 * n]
            self.known -= 1

    def bounds(self, points: Points, which: np.ndarray) -> np.ndarray:
        """Sums of the smaller counts: no set can share more with one of these points (or with what it covers)."""
        if not len(which):
            return np.zeros(0, np.int64)
        level = np.minimum(points.level[which], self.level)
        self._fold_to(int(level.min()))
        entry, n = points.entries(which)
        groups = np.repeat(np.int64(1) << level, n)
        least = np.minimum(points.count[entry], self.dense[groups + (points.group[entry] & (groups - 1))])
        total = np.concatenate([[0], np.cumsum(least)])
        end = np.cumsum(n)
        return total[end] - total[end - n]


def may_link(points: Points, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the bound leaves a link between the vectors ``a[i]`` and ``b[i]``."""
    keep = np.zeros(len(a), bool)
    order = np.argsort(a, kind="stable")
    cuts = np.flatnonzero(np.diff(a[order], prepend=-1))
    for x, y in zip(cuts, [*cuts[1:], len(order)]):
        query, mine = Query(points, int(a[order[x]])), order[x:y]
        keep[mine] = query.bounds(points, b[mine]) >= needed(query.size, points.size[b[mine]])
    return keep


def _all_sets(rows: pa.Table) -> list[np.ndarray]:
    return sets(*C.texts(rows))


def _points(plan: C.Plan, docs: DataFrame) -> DataFrame:
    """POINTS of every document; digest and the rest only where a link is possible, the last three
    once per chunk and set."""
    bits = plan.bits
    drop = np.uint64(64 - bits)

    def held(rows: pa.Table) -> pa.Table:
        values = np.concatenate([np.unique(s >> drop) for s in _all_sets(rows)] + [np.zeros(0, np.uint64)])
        values, count = np.unique(values, return_counts=True)
        return C.table(C.listed(plan, rows.column("_chunk")[0].as_py(), values, bits, np.minimum(count, 255).astype(np.uint8)))

    def shared(value, columns):
        head, run = C.groups(value)
        total = np.add.reduceat(columns[0].astype(np.uint32), head)
        keep = np.flatnonzero(total[run] > 1)
        return keep, [total[run][keep]]

    def points(rows: pa.Table, answer: pa.Table) -> pa.Table:
        known, count = C.answers(plan, answer, bits, 1)
        ids = rows.column("_id").to_pylist()
        out: list[tuple] = [()] * len(ids)
        seen = set()
        everything = _all_sets(rows)
        for i in sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i])):
            s = everything[i]
            n = len(s)
            need = int(needed(n, 0)) if not n else -(-n * PERCENT // 100)
            at = C.lookup(s >> drop, known)
            others = np.flatnonzero(at >= 0)
            if not n or ids[i] is None or len(others) < need:
                out[i] = (ids[i], n, None, None, None, None)
                continue
            raw = s.astype("<u8").tobytes()
            digest = X.mix(np.array([np.bitwise_xor.reduce(X.mix(s + np.uint64(j))) + np.uint64(n) for j in (1, 2)])).tobytes()
            if digest in seen:
                out[i] = (ids[i], n, digest, None, None, None)
                continue
            seen.add(digest)
            order = others[np.lexsort((s[others], count[at[others]]))]
            slabs = s[order[:len(others) - need + 1]].view(np.int64)
            out[i] = (ids[i], n, digest, slabs, point(s), raw)
        types = (pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.binary(), pa.binary())
        names = ("doc_id", "n_shingles", "digest", "slabs", "counts", "hashes")
        return pa.Table.from_arrays([pa.array([o[j] for o in out], t) for j, t in enumerate(types)], names=list(names))

    by_chunk = docs.groupBy("_chunk")
    held_by = by_chunk.applyInArrow(held, C.LIST).groupBy("bucket").applyInArrow(C.merge(plan, bits, shared), C.LIST)
    return by_chunk.cogroup(held_by.withColumnRenamed("chunk", "_chunk").groupBy("_chunk")).applyInArrow(points, POINTS)


def verified(pairs: DataFrame, points: DataFrame) -> DataFrame:
    """Those of ``pairs(a, b)`` that link, by their whole sets."""
    own = points.filter("hashes is not null").select("doc_id", "hashes")  # a repeated row has none
    joined = pairs.join(own.select(F.col("doc_id").alias("b"), F.col("hashes").alias("hb")), "b")
    joined = joined.join(own.select(F.col("doc_id").alias("a"), F.col("hashes").alias("ha")), "a").select("a", "b", "ha", "hb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                p, q = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
                both = len(p) + len(q) - len(np.union1d(p, q))
                keep.append(both >= needed(len(p), len(q)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return joined.mapInArrow(run, "a long, b long")


def bounded(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """Those of ``pairs(a, b)`` that the bound of their count vectors leaves."""
    for end in ("a", "b"):
        pairs = pairs.join(reps.select(F.col("rep").alias(end), F.col("n").alias(f"n{end}"), F.col("counts").alias(f"c{end}")), end)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.concatenate([batch.column(0).to_numpy(), batch.column(1).to_numpy()])
            _, first, which = np.unique(ids, return_index=True, return_inverse=True)
            data, size = pa.concat_arrays([batch.column(4), batch.column(5)]), np.concatenate([batch.column(2).to_numpy(), batch.column(3).to_numpy()])
            points = Points.read([data[i].as_py() for i in first.tolist()], size[first])
            keep = may_link(points, which[:batch.num_rows], which[batch.num_rows:])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep))
    return pairs.select("a", "b", "na", "nb", "ca", "cb").mapInArrow(run, "a long, b long")


class RTree:
    """Bulk-loaded R-tree over count vectors; a node keeps the largest count per group and the least
    size of what is below it."""

    def __init__(self, points: Points):
        first = np.append(points.group, 0)[points.at[:-1]]
        second = np.append(points.group, [0, 0])[points.at[:-1] + 1]
        # sort-tile: slices by size, ordered by the first groups that are not empty
        by_size = np.argsort(points.size, kind="stable")
        tile = np.empty(len(by_size), np.int64)
        tile[by_size] = np.arange(len(by_size)) // (LEAF * max(1, int(round((len(by_size) / LEAF) ** 0.5))))
        self.order = np.lexsort((points.size, second, first, tile))
        self.levels = [points.take(self.order)]
        while len(self.levels[-1].size) > LEAF:
            self.levels.append(self.levels[-1].covers(np.arange(len(self.levels[-1].size)) // LEAF))

    def probe(self, query: Query) -> tuple[np.ndarray, np.ndarray]:
        """(points that may link with the query, their bounds over the need)."""
        nodes = np.arange(len(self.levels[-1].size))
        for depth in range(len(self.levels) - 1, -1, -1):
            points = self.levels[depth]
            spare = query.bounds(points, nodes) - needed(query.size, points.size[nodes])
            nodes, spare = nodes[spare >= 0], spare[spare >= 0]
            if depth:
                nodes = (nodes[:, None] * LEAF + np.arange(LEAF)).ravel()
                nodes = nodes[nodes < len(self.levels[depth - 1].size)]
        return self.order[nodes], spare


def _probe_blocks(best: int | None):
    """Group function: surviving pairs (a < b) of different classes within the (slab, block)s of one
    task; of each query only the ``best`` ones, if given."""

    def run(rows: pa.Table) -> pa.Table:
        slab, block = rows.column("slab").to_numpy(), rows.column("block").to_numpy()
        rep, part = rows.column("rep").to_numpy(), rows.column("component").to_numpy()
        query = rows.column("query").to_numpy()
        # a representative's vector is read once, however many slabs it is in
        _, first, vector = np.unique(rep, return_index=True, return_inverse=True)
        data = rows.column("counts")
        vectors = Points.read([data[i].as_py() for i in first.tolist()], rows.column("n").to_numpy()[first])
        order = np.lexsort((query, block, slab))
        key = np.flatnonzero(np.concatenate([[True], (np.diff(slab[order]) != 0) | (np.diff(block[order]) != 0)]))
        pairs = [np.zeros((0, 2), np.int64)]
        for a, b in zip(key, [*key[1:], len(order)]):
            mine = order[a:b]
            points, queries = mine[~query[mine]], mine[query[mine]]
            if not len(points) or not len(queries):
                continue
            tree = RTree(vectors.take(vector[points]))
            for q in queries:
                near, spare = tree.probe(Query(vectors, int(vector[q])))
                near = points[near]
                apart = part[near] != part[q]
                near, spare = near[apart], spare[apart]
                if best is not None and len(near) > best:
                    near = near[np.lexsort((rep[near], -spare))[:best]]
                pairs.append(np.sort(np.stack([rep[near], np.full(len(near), rep[q])], axis=1), axis=1))
        found = np.unique(np.concatenate(pairs), axis=0)
        return pa.Table.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])
    return run


def _labelled(reps: DataFrame, labels: DataFrame | None) -> DataFrame:
    """(rep, component) of every representative."""
    if labels is None:
        return reps.select("rep", F.col("rep").alias("component"))
    return reps.select("rep").join(labels.withColumnRenamed("node", "rep"), "rep", "left").select("rep", F.coalesce("component", "rep").alias("component"))


def link_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` per row of ``df``; ids are integers."""
    plan = C.Plan(df, text_col)
    docs = plan.deal(df.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text")), "_id")
    points = staged(_points(plan, docs), "points")
    classes = points.filter("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("rep"))
    reps = staged(points.filter("hashes is not null").select("doc_id", "n_shingles", "digest", "slabs", "counts")
                  .join(classes, "digest").filter("doc_id = rep").select("rep", F.col("n_shingles").alias("n"), "slabs", "counts"), "representatives")
    members = reps.select("rep", F.explode("slabs").alias("slab"))
    # of slabs with the same members one is enough: near copies share most of their rare shingles
    same = [F.sum(F.xxhash64(F.lit(i), "rep").cast("decimal(38, 0)")).alias(f"d{i}") for i in (1, 2)]
    shared = members.groupBy("slab").agg(F.min("rep").alias("pivot"), F.count(F.lit(1)).alias("m"), *same).filter("m > 1")
    shared = shared.groupBy("pivot", "m", "d1", "d2").agg(F.min("slab").alias("slab"))
    slabs = staged(members.join(shared.select("slab", "pivot", "m"), "slab").select("slab", "rep", "pivot", "m"), "slabs")
    near = slabs.filter("rep <> pivot").select(F.col("pivot").alias("a"), F.col("rep").alias("b")).distinct()
    asked = staged(bounded(near, reps), "pairs")
    links = staged(verified(asked, points), "links")
    labels = components(links)
    for best in (BEST, None):
        pairs = _tree_pairs(plan, slabs, reps, labels, best)
        if pairs is None:
            break
        pairs = staged(pairs.join(asked, ["a", "b"], "left_anti"), "pairs")  # what was verified before did not link
        more = staged(verified(pairs, points), "links")
        asked = asked.unionByName(pairs)
        if not more.isEmpty():
            links = links.unionByName(more)
            labels = components(links)
    label = _labelled(reps, labels)
    named = classes.join(label, "rep").select("digest", "component")
    out = points.select("doc_id", "n_shingles", "digest").join(named, "digest", "left")
    return out.select(F.col("doc_id").alias(id_col), "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def _tree_pairs(plan: C.Plan, slabs: DataFrame, reps: DataFrame, labels: DataFrame | None, best: int | None) -> DataFrame | None:
    """Pairs of different classes that the R-trees of slabs with several classes leave; None if no
    slab has."""
    of = slabs.select("slab", "rep", "m").join(_labelled(reps, labels), "rep")
    per = of.groupBy("slab", "component").agg(F.count(F.lit(1)).alias("c"))
    main = per.groupBy("slab").agg(F.max(F.struct("c", "component")).alias("_m"), F.count(F.lit(1)).alias("classes")).filter("classes > 1")
    opened = staged(of.join(main.select("slab", F.col("_m.component").alias("main")), "slab"), "open")
    rows = opened.count()
    if not rows:
        return None
    blocks = F.ceil(F.col("m") / TREE).cast("int")
    data = opened.select("slab", F.pmod(F.xxhash64("rep"), blocks).cast("int").alias("block"), "rep", "component", F.lit(False).alias("query"))
    asks = opened.filter("component <> main").select("slab", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"), "rep", "component", F.lit(True).alias("query"))
    tasks = max(plan.partitions, -(-rows // TASK_ROWS))
    both = data.unionByName(asks).join(reps.select("rep", "n", "counts"), "rep")
    both = both.withColumn("task", F.pmod(F.xxhash64("slab", "block"), F.lit(tasks)).cast("int"))
    return both.groupBy("task").applyInArrow(_probe_blocks(best), "a long, b long").distinct()


def drop_near_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with one document of each class, the one with the least id; all columns are kept, and
    rows with a null id."""
    gone = link_components(df, id_col, text_col).filter(F.col(id_col) != F.col("component_id")).select(id_col).distinct()
    return df.join(gone, id_col, "left_anti")
