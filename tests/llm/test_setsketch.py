"""SetSketch near-duplicate classes against brute force, and the sketch's properties."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from portmart.session import ensure_importable

pytest.importorskip("public_tokenizers")
from portmart.llm import setsketch as S  # noqa: E402
from test_llm_operators import corpus  # noqa: E402


def shingles(text, k=S.SHINGLE):
    import re

    words = [w.lower() for w in re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())]
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else ({tuple(words)} if words else set())


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    label = {i: i for i, _ in sets}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x
    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and 100 * len(a & b) >= S.PERCENT * len(a | b):
                x, y = sorted((root(i), root(j)))
                label[y] = x
    return sorted(((i, len(shingles(t)), root(i) if i is not None else None, i is None or root(i) == i) for i, t in rows), key=str)


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 2 ** 63, 40_000).astype(np.uint64)
    for n in (1, 2, 40, 3000):
        a, b = np.unique(pool[:n]), np.unique(pool[n // 2:n // 2 + n])
        ra, rb, both = S.registers([a, b, np.union1d(a, b)])
        assert np.array_equal(S.merged(ra, rb), both)
        assert np.array_equal(S.registers([a])[0], ra)  # whatever stands beside it
    assert not S.registers([pool[:0]]).any()
    for share in (0.3, 0.6, 0.8, 0.95):
        estimates = []
        for i in range(30):
            pool = rng.integers(0, 2 ** 63, 4000).astype(np.uint64)
            cut = int(1000 * (1 - share) / (1 + share))  # of 1000 and 1000 with this similarity
            x, y = S.registers([pool[:1000], pool[cut:1000 + cut]])
            best, gap = S.estimate(np.array([1000]), np.array([1000]), np.array([(x > y).sum()]), np.array([(x < y).sum()]))
            estimates.append(best[0])
            assert share < 0.8 or gap[0] < S.DOUBT
        assert abs(np.mean(estimates) - share) < 0.03, share


def test_every_linked_pair_shares_a_band():
    rng = np.random.default_rng(4)
    missed = 0
    for i in range(400):
        n = int(rng.integers(9, 400))
        pool = rng.integers(0, 2 ** 63, 2 * n).astype(np.uint64)
        cut = n // 9  # (n - cut) / (n + cut) is 0.8
        x, y = S.registers([pool[:n], pool[cut:n + cut]])
        missed += not (x == y)[:S.BANDS * S.ROWS].reshape(S.BANDS, S.ROWS).all(axis=1).any()
    assert missed == 0


def test_sizes_alone_exclude():
    assert S.likely(np.array([79, 80]), np.array([100, 100]), np.array([0, 0]), np.array([40, 40])).tolist() == [False, True]


@pytest.mark.parametrize("seed", [3, 8])
def test_against_brute_force(spark, seed):
    ensure_importable(spark)
    rows = corpus(seed)
    rows += [(rows[20][0], rows[20][1]), (5000, rows[20][1]), (None, "null id a b c d"), (None, None), (6000, "x y " * 4000), (6001, "x y " * 4000 + "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"band": F.lit(1), "n": F.lit("x"), "rep": F.lit(2), "component": F.lit(3), "kept": F.lit("y")})
    assert as_rows(S.near_classes(df.repartition(3))) == brute(rows)


def test_chains_and_bands_of_several_classes(spark, monkeypatch):
    """A group of variants that do not all link to the least one: links between others are found,
    across blocks too."""
    ensure_importable(spark)
    monkeypatch.setattr(S, "BLOCK", 4)
    monkeypatch.setattr(S, "TASK_ROWS", 10)
    rng = random.Random(6)
    base = [f"w{rng.randrange(10 ** 6)}" for _ in range(150)]
    rows = []
    for i in range(40):
        words = list(base)
        for at in rng.sample(range(150), rng.randrange(3, 11)):
            words[at] = f"v{rng.randrange(10 ** 6)}"
        rows.append((i, " ".join(words)))
    want = brute(rows)
    assert len({r[2] for r in want}) > 3  # the case it is made for
    assert as_rows(S.near_classes(spark.createDataFrame(rows, "doc_id long, text string"))) == want


def test_empty_table(spark):
    ensure_importable(spark)
    out = S.near_classes(spark.createDataFrame([], "doc_id long, text string"))
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"] and not out.collect()


def test_fine_registers_tell_near_misses():
    """Pairs at the limit stay, most of those at 0.7 are told apart without their sets."""
    rng = np.random.default_rng(9)

    def kept(share, n=400):
        out = 0
        for _ in range(60):
            pool = rng.integers(0, 2 ** 63, 2 * n).astype(np.uint64)
            cut = int(n * (1 - share) / (1 + share))
            x, y = S.fine_registers([pool[:n], pool[cut:n + cut]])
            out += int(S.likely_by_fine(np.array([(x == y).sum()]))[0])
        return out
    assert kept(0.8) == 60 and kept(0.9) == 60 and kept(0.68) < 6
    assert S.likely_by_fine(np.array([0, S.FAMILIES * S.M])).tolist() == [False, True]


def test_rows_of_a_group_follow_its_size(spark, monkeypatch):
    """A group of members that do not link, in many bands: a document is one row of it, and asks in its own block
    first; only the last comparison takes a row for each block of the other side."""
    def counted(best):
        def run(rows):
            import pyarrow as pa
            placed = rows.filter(rows.column("registers").is_null())
            return pa.table({"a": pa.array([placed.num_rows], pa.int64()), "b": pa.array([rows.column("task")[0].as_py()], pa.int64())})
        return run

    ensure_importable(spark)
    monkeypatch.setattr(S, "BLOCK", 10)
    monkeypatch.setattr(S, "_compare", counted)

    def placed(n, best):
        members = spark.range(n).selectExpr("id AS rep", "explode(sequence(0, 47)) AS number").selectExpr("CAST(number AS bigint) AS band", "number", "rep", "0L AS pivot")
        whole = spark.range(n).selectExpr("id AS rep", "7L AS n", "CAST('x' AS binary) AS registers", "CAST('x' AS binary) AS fine")
        return S._open_pairs(members, whole, None, best).agg(F.sum("a")).first()[0]
    assert placed(40, 2) == 40 + 39 and placed(80, 2) == 80 + 79
    assert placed(40, None) == 4 * (40 + 39)
