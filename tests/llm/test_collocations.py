"""Phrase collocations against a plain count, over one and several levels of the exchange."""

import collections
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from portmart.session import ensure_importable

pytest.importorskip("public_tokenizers")
from portmart.llm import collocations as C  # noqa: E402


def brute(rows, least, top=C.TOP):
    f, n = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(rb"[.,;:!?\x0A-\x0D]", (text or "").encode()):
            words = re.findall(rb"[^\x20\x09]+", bytes(b + 32 if 65 <= b <= 90 else b for b in piece))
            n[lang] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i:i + k])] += 1
    f = {p: c for p, c in f.items() if c >= least}
    out = collections.defaultdict(list)
    for (lang, p), a in f.items():
        if len(p) == 1 or any((x == lang and len(q) > len(p) and c >= a and any(q[i:i + len(p)] == p for i in range(len(q)))) for (x, q), c in f.items()):
            continue
        score, _, left, right = min((1000 * a * n[lang] // (f[lang, p[:j]] * f[lang, p[j:]]), j, f[lang, p[:j]], f[lang, p[j:]]) for j in range(1, len(p)))
        out[lang].append((-score, -a, b" ".join(p), left, right))
    return sorted((lang, rank, p.decode(), -a, left, right, n[lang], -s) for lang, got in out.items()
                  for rank, (s, a, p, left, right) in enumerate(sorted(got)[:top], 1))


def made(seed=1, n=300):
    rng = random.Random(seed)
    vocabulary = [f"w{int(rng.paretovariate(1))}" for _ in range(60)] + ["É", "The", "naïve", "日本", "x-y", "\x1f", "a\x00"]
    fixed = [[rng.choice(vocabulary) for _ in range(rng.randrange(2, 9))] for _ in range(8)]
    rows = [(None, None), ("en", ""), ("en", " \t.\n"), ("", "lone words here. lone words here"), ("en", "Solo")]
    for _ in range(n):
        words = []
        while len(words) < rng.randrange(1, 60):
            words += rng.choice(fixed) if rng.random() < 0.5 else [rng.choice(vocabulary)]
            if rng.random() < 0.2:
                words[-1] += rng.choice([".", ",", ";", ":", "!", "?", "\n", "\x0b", "\r"])
        rows.append((rng.choice(["en", "en", "fr", None, "und"]), rng.choice([" ", "\t", "  "]).join(words)))
    rows += [("en", " ".join(fixed[0] * 400))] + rows[10:14] * 3
    return rows


def as_rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("least, shards, fan, chunk", [(6, 2, 256, 1 << 20), (6, 2, 3, 800), (9, 1, 256, 500), (5, 3, 2, 2500), (6, 2, 256, 800)])
def test_against_brute_force(spark, least, shards, fan, chunk):
    ensure_importable(spark)
    rows = made()
    df = spark.createDataFrame(rows, "lang string, text string").withColumns({"k": F.lit("x"), "phrase": F.lit(1), "n": F.lit(2), "data": F.lit(0), "chunk": F.lit(5)})
    got = as_rows(C.collocations(df.repartition(3), min_count=least, shards=shards, fan=fan, chunk_bytes=chunk))
    want = brute(rows, least)
    assert len(want) > 20 and got == want


def test_rank_cut_and_ties(spark):
    ensure_importable(spark)
    rows = [("en", "a b. c d. e f. g h")] * 4
    got = as_rows(C.collocations(spark.createDataFrame(rows, "lang string, text string"), min_count=4, top=3))
    assert got == brute(rows, 4, 3) and [r[2] for r in got] == ["a b", "c d", "e f"]


def test_exact_arithmetic_beyond_64_bits(spark):
    """The score's product of counts as Spark computes it for counts near 10 ** 15."""
    a, n, left, right = 123456789012345, 987654321098765, 223456789012345, 323456789012345
    wide = "cast({} as decimal(17, 0))".format
    got = spark.sql(f"select cast((cast(1000 as decimal(4, 0)) * {wide(a)} * {wide(n)}) div ({wide(left)} * {wide(right)}) as bigint) as s").first().s
    assert got == 1000 * a * n // (left * right)


def test_list_rows_follow_the_text():
    """Every level of the exchange has at most FAN lists a chunk."""
    rng = np.random.default_rng(2)
    keys = np.sort(rng.integers(0, 2 ** 63, 50_000).astype(np.uint64) * np.uint64(2))
    for depth in (1, 2, 3):
        digits = C._range_of(keys, depth, 8)
        assert digits.max() < 8 ** depth and (np.diff(digits) >= 0).all()
        if depth > 1:
            assert np.array_equal(digits // 8, C._range_of(keys, depth - 1, 8))
    assert len(C._lists(5, 1, 8, 1, 0, keys, np.ones(len(keys), np.int64))) <= 8


def test_empty_table(spark):
    ensure_importable(spark)
    out = C.collocations(spark.createDataFrame([], "lang string, text string"))
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and not out.collect()
