"""The training-data operators against brute force on small tables, and their edge cases."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SF0001, SF001
from portmart.session import ensure_importable, staging_path

pt = pytest.importorskip("public_tokenizers")
from portmart.llm import chat_format, decontaminate, exact_dedup, license_scan, ngram_join, pieces, quality, queries  # noqa: E402
from portmart.llm import substring_dedup, token_files, url_filter  # noqa: E402

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


@pytest.fixture(autouse=True)
def importable(spark):
    ensure_importable(spark)


def corpus(seed=3, n=90):
    """Texts with exact and near copies, shared passages, nulls, empty and long texts, odd bytes."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["É", "the", "The", "naïve", "\x01", "日本"]
    passage = [rng.choice(vocabulary) for _ in range(40)]
    texts = [None, "", " \t\n", "one", "One two", "one two", "a b c d", "\x0b x \x0c y", "a  b\n\nc"]
    while len(texts) < n:
        kind = rng.randrange(5)
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(3, 120))]
        if kind == 0 and len(texts) > 12:
            texts.append(rng.choice(texts[6:]))
            continue
        if kind == 1 and len(texts) > 12:
            words = (rng.choice([t for t in texts[8:] if t]) or "x").split(" ")
            for _ in range(rng.randrange(1, 4)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
        elif kind == 2:
            at = rng.randrange(len(words))
            words[at:at] = passage[rng.randrange(20):]
        texts.append(" ".join(words))
    texts += [" ".join(passage * 60), "z" * 5000]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    return list(zip(ids, texts))


def table(spark, rows, extra=True):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    if extra:  # columns with clashing names
        df = df.withColumns({"_id": F.lit("x"), "_chunk": F.lit(1), "score": F.lit(2.0), "kept": F.lit(True), "_n": F.lit(3), "leaks": F.lit("y")})
    return df.repartition(3)


def found(df, *names):
    return {r["doc_id"]: tuple(r[n] for n in names) for r in df.collect()}


# --- 1 exact dedup

def test_exact_groups(spark):
    rows = corpus()
    got = found(exact_dedup.exact_groups(table(spark, rows), salts=4), "keep_id", "group_size", "kept", "text_sha256")
    by_text = {}
    for i, t in rows:
        by_text.setdefault(t or "", []).append(i)
    for i, t in rows:
        same = by_text[t or ""]
        assert got[i] == (max(same), len(same), i == max(same), hashlib.sha256((t or "").encode()).hexdigest())


def test_exact_dedup_drops_copies_and_repeated_rows(spark):
    rows = [(1, "a"), (2, "a"), (2, "a"), (3, None), (4, ""), (None, "b"), (5, "c")]
    df = table(spark, rows)
    out = exact_dedup.drop_copies(df)
    assert out.columns == df.columns
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in out.collect()) == [(False, 2), (False, 4), (False, 5), (True, 0)]
    assert exact_dedup.exact_groups(df).count() == 7
    assert exact_dedup.drop_copies(df.limit(0)).count() == exact_dedup.exact_groups(df.limit(0)).count() == 0


def test_exact_dedup_of_ids_that_stand_with_several_texts(spark):
    rows = [(5, "A"), (9, "A"), (5, "B"), (None, "A"), (None, "C")]
    out = exact_dedup.drop_copies(table(spark, rows)).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in out) == [(0, "C"), (5, "B"), (9, "A")]


# --- 2 n-gram join

def shingles(text, k=5):
    words = WORD.findall((text or "").encode().translate(bytes(ngram_join.X.LOWER)))
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else ({tuple(words)} if words else set())


def linked_classes(rows):
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 75 * len(sets[a] | sets[b]):
                p, q = root(a), root(b)
                parent[max(p, q)] = min(p, q)
    return {i: (len(s), root(i)) for i, s in sets.items()}


@pytest.mark.parametrize("seed,tree", [(3, 4096), (4, 8)])
def test_ngram_join(spark, seed, tree, monkeypatch):
    monkeypatch.setattr(ngram_join, "TREE", tree)  # small blocks: slabs are split
    rows = corpus(seed)
    got = found(ngram_join.link_components(table(spark, rows)), "n_shingles", "component_id")
    assert got == linked_classes(rows)
    kept = ngram_join.drop_near_copies(table(spark, rows))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, (_, c) in got.items() if i == c)


def test_ngram_join_empty(spark):
    assert ngram_join.link_components(table(spark, [(1, "a")]).limit(0)).count() == 0
    assert found(ngram_join.link_components(table(spark, [(None, "a b c d e f"), (7, "a b c d e f")])), "n_shingles") == {None: (2,), 7: (2,)}


def test_ngram_join_of_repeated_rows_with_a_near_copy(spark):
    words = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join(words)), (1, " ".join(words)), (2, " ".join([*words[:-1], "other"])), (2, " ".join([*words[:-1], "other"])), (3, "a b c")]
    got = ngram_join.link_components(table(spark, rows)).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in got) == [(1, 1), (1, 1), (2, 1), (2, 1), (3, 3)]


def test_tree_bound_loses_nothing():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 300).astype(np.uint64)
    sets = [np.unique(np.where(rng.random(300) < e, rng.integers(0, 1 << 63, 300).astype(np.uint64), base)) for e in np.linspace(0, 0.6, 120)]
    sets += [np.unique(s[:n]) for n in (1, 3, 200, 260, 290) for s in sets[:6]] + [np.unique(np.concatenate([sets[0], sets[i][:60]])) for i in (50, 90)]
    size = np.array([len(s) for s in sets])
    points = ngram_join.Points.read([ngram_join.point(s) for s in sets], size)
    tree = ngram_join.RTree(points)
    assert len(tree.levels) > 1
    excluded = 0
    for i, s in enumerate(sets):
        query = ngram_join.Query(points, i)
        near = set(tree.probe(query)[0].tolist())
        bounds = query.bounds(points, np.arange(len(sets)))
        for j, t in enumerate(sets):
            both = len(np.intersect1d(s, t))
            assert both <= bounds[j]
            if 100 * both >= 75 * (len(s) + len(t) - both):
                assert j in near
            else:
                excluded += j not in near
    assert excluded > 0.8 * sum(100 * (n := len(np.intersect1d(s, t))) < 75 * (len(s) + len(t) - n) for s in sets for t in sets)


@pytest.mark.parametrize("size", [2_000, 8_000, 20_000])
def test_bound_excludes_large_strangers(size):
    """The number of groups follows the set: sets without a common member are told apart at any size."""
    rng = np.random.default_rng(size)
    sets = [np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64)) for _ in range(6)]
    points = ngram_join.Points.read([ngram_join.point(s) for s in sets], np.array([len(s) for s in sets]))
    pairs = [(i, j) for i in range(6) for j in range(i)]
    assert not ngram_join.may_link(points, *np.array(pairs).T).any()


def test_links_that_only_the_trees_find(spark, monkeypatch):
    """Variants of one text that do not all link to the least one: the pivot's links are not enough."""
    found_by = []
    plain = ngram_join._tree_pairs
    monkeypatch.setattr(ngram_join, "_tree_pairs", lambda *a: (found_by.append(a[3]), plain(*a))[1])
    rng = random.Random(6)
    base = [f"w{rng.randrange(10 ** 6)}" for _ in range(150)]
    rows = []
    for i in range(40):
        words = list(base)
        for at in rng.sample(range(150), rng.randrange(2, 9)):
            words[at] = f"v{rng.randrange(10 ** 6)}"
        rows.append((i, " ".join(words)))
    want = linked_classes(rows)
    assert found(ngram_join.link_components(table(spark, rows)), "n_shingles", "component_id") == want
    before = {r["node"]: r["component"] for r in found_by[0].collect()}
    assert len(set(before.get(i, i) for i in range(40))) > len({c for _, c in want.values()}) > 1


# --- 3 substring dedup

def removed(rows):
    words = {i: WORD.findall((t or "").encode()) for i, t in rows}
    first = {}
    for i in sorted(words):
        for k in range(len(words[i]) - 12):
            first.setdefault(tuple(words[i][k:k + 13]), i)
    out = {}
    for i, w in words.items():
        gone = [False] * len(w)
        for k in range(len(w) - 12):
            if first[tuple(w[k:k + 13])] < i:
                gone[k:k + 13] = [True] * 13
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out[i] = (len(w), sum(gone), hashlib.sha256(kept).hexdigest(), kept.decode())
    return out


@pytest.mark.parametrize("seed", [3, 8])
def test_substring_dedup(spark, seed):
    rows = corpus(seed)
    got = found(substring_dedup.dedup_substrings(table(spark, rows)), "n_words", "n_removed", "kept_sha256", "kept_text")
    assert got == removed(rows)
    assert sum(v[1] for v in got.values()) > 100


def test_substring_dedup_edges(spark):
    long = " ".join(map(str, range(30)))
    got = substring_dedup.dedup_substrings(table(spark, [(1, long), (1, long), (2, long), (None, "a")])).collect()
    assert sorted((r["doc_id"] or 0, r["n_removed"]) for r in got) == [(0, 0), (1, 0), (1, 0), (2, 30)]
    assert substring_dedup.dedup_substrings(table(spark, [(1, "a")]).limit(0)).count() == 0


# --- 4 pieces

def test_pieces_round_trip_and_seed(spark):
    rows = corpus() + [(900, "▁literal ▁ marks\r\n\ttabs   blanks"), (901, "🙂 emoji \u2028 x")]
    df = table(spark, rows)
    a = pieces.encode_pieces(df, queries.PIECE_MODEL)
    first = found(a, "n_pieces", "ids", "lossless")
    assert all(v[2] and len(v[1]) == v[0] for v in first.values())
    assert first == found(pieces.encode_pieces(df.repartition(7), queries.PIECE_MODEL), "n_pieces", "ids", "lossless")
    other = found(pieces.encode_pieces(df, queries.PIECE_MODEL, seed=99), "ids")
    assert any(other[i][0] != v[1] for i, v in first.items())
    back = found(pieces.decode_pieces(a, queries.PIECE_MODEL), "decoded")
    assert back == {i: (t or "",) for i, t in rows}
    assert pieces.encode_pieces(df.limit(0), queries.PIECE_MODEL).count() == 0


def test_piece_frequencies_match_the_lattice():
    """Segmentations of one word, drawn under many keys, follow the weights of all its paths."""
    model = pieces.Pieces(queries.PIECE_MODEL)
    word = b" then"
    table_ = {model.bytes[s:s + n].tobytes(): i for i, (s, n) in enumerate(zip(model.start, model.size)) if n and i > 258}

    def paths(at):
        if at == len(word):
            return [((), 0.0)]
        out = []
        for end in range(at + 1, len(word) + 1):
            choices = [(table_[word[at:end]], model.weight[table_[word[at:end]]])] if word[at:end] in table_ else []
            if end == at + 1:
                choices.append((int(model.byte_id[word[at]]), model.byte_weight))
            out += [((i, *rest), w + v) for i, w in choices for rest, v in paths(end)]
        return out
    every = paths(0)
    total = sum(np.exp(w) for _, w in every)
    n = 20000
    data, offsets = np.frombuffer(word * n, np.uint8), np.arange(n + 1) * len(word)
    ids, sizes = model.encode(data, offsets, np.arange(n))
    ends = np.cumsum(sizes)
    seen = {}
    for a, b in zip(ends - sizes, ends):
        seen[tuple(ids[a:b].tolist())] = seen.get(tuple(ids[a:b].tolist()), 0) + 1
    assert set(seen) <= {p for p, _ in every}
    for p, w in every:
        share = np.exp(w) / total
        assert abs(seen.get(p, 0) / n - share) < 5 * (share / n) ** 0.5 + 2e-4


# --- 5 token files

def test_token_files(spark):
    from tokenizers import Tokenizer
    rows = corpus() + [(902, "it's <|endoftext|> don't  \n x"), (903, "\x01 a \x02b"), (904, " lead"), (905, "trail "), (906, "a\nb\n")]
    path = staging_path(spark, "tokens-test")
    token_files.write_tokens(table(spark, rows), path, queries.BYTE_BPE)
    plain = Tokenizer.from_file(queries.BYTE_BPE)
    plain.encode_special_tokens = True
    meta = found(token_files.read_metadata(spark, path), "n_tokens", "start", "row")
    tokens = {r["row"]: r["ids"] for r in token_files.read_tokens(spark, path).collect()}
    crc = {r["row"]: r["ids_crc32"] for r in token_files.ids_crc32(token_files.read_tokens(spark, path)).collect()}
    start = 0
    for i, t in sorted(rows, key=lambda r: r[0]):
        ids = plain.encode(t or "", add_special_tokens=False).ids + [2]
        assert meta[i][:2] == (len(ids), start) and tokens[meta[i][2]] == ids
        assert crc[meta[i][2]] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    some = token_files.read_tokens(spark, path, 10, 12)
    assert sorted(r["doc_id"] for r in some.collect()) == [10, 11, 12]
    assert "doc_id" in some._jdf.queryExecution().executedPlan().toString().split("PushedFilters")[1]
    empty = staging_path(spark, "tokens-test")
    token_files.write_tokens(table(spark, rows).limit(0), empty, queries.BYTE_BPE)
    assert token_files.read_metadata(spark, empty).count() == 0


def test_registered_token_files_give_the_ids_of_the_unchanged_tokenizer(spark, tmp_path):
    from tokenizers import Tokenizer
    rows = corpus(9, 40) + [(902, "a <|endoftext|> b"), (903, "<|endoftext|>"), (904, "x<|endoftext|>y\n\n<|endoftext|> z"), (905, "<|endoftext"), (906, "a b")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = found(queries.op5_token_files(spark, str(tmp_path)), "start", "n_tokens", "ids_crc32")
    plain, start = Tokenizer.from_file(queries.BYTE_BPE), 0
    for i, t in sorted(rows, key=lambda r: r[0]):
        ids = plain.encode(t or "", add_special_tokens=False).ids + [2]
        assert got[i] == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())), t
        start += len(ids)


# --- 6 quality

def test_quality_held_out(spark):
    got = queries.op6_quality_classifier(spark, SF001)
    rows = got.join(spark.read.parquet(f"{SF001}/labels.parquet"), "doc_id").filter("held_out").collect()
    assert sum(r["predicted"] == r["quality"] for r in rows) >= 0.97 * len(rows) > 40
    assert got.count() == spark.read.parquet(f"{SF001}/documents.parquet").count()


def test_quality_edges(spark):
    docs = table(spark, [(1, None), (2, ""), (3, "x " * 30000)], extra=False)
    none = quality.train(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert [r["score"] for r in quality.score(docs, none).collect()] == [0.5] * 3
    labels = spark.createDataFrame([(1, 1), (3, None), (None, 0), (77, 1)], "doc_id long, quality int")
    assert all(0 <= r["score"] <= 1 for r in quality.score(docs, quality.train(docs, labels)).collect())
    assert quality.score(docs.limit(0), none).count() == 0


# --- 7 decontamination

def least_edits(item, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def test_decontamination(spark):
    rng = random.Random(6)
    words = ["the", "of", "thing", "ering", "onble", "and", "thre", "été"]
    items = [(i, " ".join(rng.choice(words) for _ in range(n))) for i, n in enumerate((14, 30, 50, 18, 2))] + [(9, None), (10, "")]
    docs = [(100, None), (101, "")]
    for i in range(60):
        text = [rng.choice(words) for _ in range(rng.randrange(0, 120))]
        if i % 2:
            item = list(rng.choice(items[:4])[1])
            for _ in range(rng.randrange(0, 8)):
                at = rng.randrange(len(item))
                item[at:at + rng.randrange(2)] = rng.choice(["", "x", "yz"])
            text.insert(rng.randrange(len(text) + 1), "".join(item).upper() if i % 4 == 1 else "".join(item))
        docs.append((i, rng.choice([" ", "\n"]).join(text)))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r["doc_id"]: [tuple(x) for x in r["found"]] for r in decontaminate.find_leaks(table(spark, docs), bench, found_col="found").collect()}
    index = decontaminate.Items([i for i, _ in items], [decontaminate.folded((t or "").encode()) for _, t in items])
    hits = 0
    for i, text in docs:
        want = []
        for k, (item, _) in enumerate(items):
            if index.size[k]:
                edits = least_edits(index.texts[k], decontaminate.folded((text or "").encode()))
                if edits <= index.edits[k]:
                    want.append((item, edits))
        assert got[i] == want, i
        hits += len(want)
    assert hits > 15
    assert decontaminate.find_leaks(table(spark, docs).limit(0), bench, found_col="f").count() == 0
    none = decontaminate.find_leaks(table(spark, docs), bench.limit(0), found_col="f")
    assert none.filter("size(f) > 0").count() == 0


def test_decontamination_in_blocks(spark, monkeypatch):
    whole = queries.op7_decontamination(spark, SF0001).collect()
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 2000)
    assert sorted(queries.op7_decontamination(spark, SF0001).collect()) == sorted(whole)


# --- 8 licenses

def test_license_scan(spark):
    rows = [(1, "src/a/LICENSE", "Released under the MIT License."), (2, "src/a/x.txt", "plain words"), (3, "src/a/b/y.txt", None),
            (4, "src/b/z.txt", "code\nLicensed under the Apache License, Version 2.0.\ncode " + "word " * 50), (5, "src/b/q.txt", "words"),
            (6, None, "words"), (7, "src/a/b/COPYING", "x " * 40 + "\nLicensed under CC BY-NC 4.0."), (8, "src/a/b/c/d/e.txt", "the license of the park"),
            (9, "top.txt", "This work is licensed under the GNU General Public License, version 3.")]
    df = spark.createDataFrame(rows, "doc_id long, path string, text string")
    scanned = license_scan.scan_texts(df, "doc_id", "text", "path")
    got = found(license_scan.inherit(scanned, "doc_id"), "license", "via", "from_dir")
    assert got == {1: ("MIT", "own", None), 2: ("MIT", "inherited", "src/a"), 3: ("CC-BY-NC-4.0", "inherited", "src/a/b"), 4: ("Apache-2.0", "own", None),
                   5: ("GPL-3.0", "inherited", ""), 6: (None, "none", None), 7: ("CC-BY-NC-4.0", "own", None), 8: ("CC-BY-NC-4.0", "inherited", "src/a/b"), 9: ("GPL-3.0", "own", None)}
    assert license_scan.inherit(license_scan.scan_texts(df.limit(0), "doc_id", "text", "path"), "doc_id").count() == 0


def test_license_lines_need_an_anchor():
    """Scoring every line finds what scoring the lines with an anchor word finds."""
    rng = random.Random(2)
    words = [w for _, t in license_scan.TEMPLATES for w in license_scan.tokens(t)] + ["foo", "bar"]
    m = license_scan.Matcher(license_scan.TEMPLATES, {"the": 90, "under": 40, "of": 80, "license": 6}, 100)
    for _ in range(3000):
        line = " ".join(rng.choice(words) for _ in range(rng.randrange(1, 10)))
        if m.best(line)[1]:
            assert line in list(m.lines(line))


def license_matcher():
    counts = {"the": 9000, "of": 8000, "and": 8500, "to": 8000, "in": 7000, "a": 8000, "is": 6000, "it": 5000, "or": 4000, "this": 4000, "by": 4000,
              "license": 60, "general": 500, "public": 700, "version": 300}
    return license_scan.Matcher(license_scan.TEMPLATES, counts, 10000, license_scan.full_templates())


@pytest.mark.parametrize("text,want", [
    ("MIT License", "MIT"), ("Apache License", "Apache"), ("GNU GENERAL PUBLIC LICENSE", "GPL"), ("Redistribution and use in source and binary forms, with or without", "BSD"),
    ("it under the terms of the GNU General Public License as published by", "GPL"), ("SPDX-License-Identifier: BSD-3-Clause", "BSD-3-Clause"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy", "MIT"), ("GNU GENERAL PUBLIC LICENSE\n   Version 2, June 1991", "GPL-2.0"),
    ("This work is licensed under the GNU General Public License, version 2.", "GPL-2.0"), ("SPDX-License-Identifier: GPL-2.0-only", "GPL-2.0"),
    ("This work is licensed under the GNU Lesser General Public License, version 3.", "LGPL-3.0"), ("Licensed under the Apache License, Version 1.1.", "Apache"),
    ("SPDX-License-Identifier: GPL-1.0-only", None), ("Licensed under CC BY-SA 4.0.", "CC-BY-SA-4.0"), ("Licensed under CC BY 3.0.", None),
    ("Licensed under CC BY-NC-SA 4.0.", "CC-BY-NC-SA-4.0"), ("SPDX-License-Identifier: Foo-2.0", None), ("the license of the park", None),
    ("# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU Lesser General Public License as published by\n"
     "# the Free Software Foundation, either version 2.1 of the License, or\n# (at your option) any later version.\nimport os\nprint(os)", "LGPL-2.1"),
    ("/* Licensed under the Apache License, Version 2.0 (the \"License\");\n you may not use this file except in compliance with the License. */\nint x;", "Apache-2.0")])
def test_license_headers_and_near_miss_versions(text, want):
    assert license_matcher().scan(text + "\n\n" + "code " * 60)[0] == want


def test_license_files():
    m = license_matcher()
    for name, text in license_scan.full_templates():
        assert m.scan("Copyright (c) 2020 Jo Doe\n\n" + text)[::2] == (name, True)
    body = "\n".join("# " + line for line in dict(license_scan.full_templates())["BSD-2-Clause"].split("\n"))
    assert m.scan(body + "\n\n" + "x = compute(y)\n" * 400)[::2] == ("BSD-2-Clause", False)


# --- 9 chat

def test_chat_events(spark):
    e = [(1, 0, 0, "delta", "user", "he"), (1, 1, 0, "delta", "user", "llo"), (1, 2, 1, "delta", "assistant", "bad"), (1, 3, 2, "delta", "user", "why?"),
         (1, 4, 1, "regenerate", "assistant", "go"), (1, 5, 1, "delta", "assistant", "od"), (1, 6, 0, "edit", "user", "hi"), (1, 7, 2, "delta", "user", "ok"),
         (2, 0, 0, "delta", None, None), (None, 0, 0, "delta", "user", "\\### x </turn>\n: \\0\\1")]
    df = spark.createDataFrame(e, "conv_id long, seq long, message long, kind string, role string, text string").repartition(4)
    final = sorted((r["conv_id"] or 0, r["message"], r["role"], r["text"]) for r in chat_format.fold_events(df).collect())
    assert final == [(0, 0, "user", "\\### x </turn>\n: \\0\\1"), (1, 0, "user", "hi"), (1, 1, "assistant", "good"), (1, 2, "user", "ok"), (2, 0, "", "")]
    out = {r["conv_id"]: r for r in chat_format.parse(chat_format.render(chat_format.fold_events(df))).withColumn("loss", chat_format.loss_texts()).collect()}
    assert [tuple(t) for t in out[1]["turns"]] == [("user", "hi"), ("assistant", "good"), ("user", "ok")] and out[1]["loss"] == ["good"]
    assert [tuple(t) for t in out[None]["turns"]] == [("user", "\\### x </turn>\n: \\0\\1")]
    assert "### x" not in out[None]["formatted"][5:]
    assert chat_format.render(chat_format.fold_events(df.limit(0))).count() == 0


def test_chat_round_trip_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(chat_format, "BLOCK", 4)
    rng = random.Random(1)
    bits = ["\\", "###", "#", "</turn>", "\n", ": ", "\\0", "a", "é", " ", "</turn", ">"]
    said = [(i % 3, i, rng.choice(["user", "assistant", "a: b", "###", ""]), "".join(rng.choice(bits) for _ in range(rng.randrange(9)))) for i in range(60)]
    df = spark.createDataFrame(said, "conv_id long, message long, role string, text string")
    out = chat_format.parse(chat_format.render(df)).withColumn("loss", chat_format.loss_texts()).collect()
    for r in out:
        mine = [(x[2], x[3]) for x in said if x[0] == r["conv_id"]]
        assert [tuple(t) for t in r["turns"]] == mine
        assert r["loss"] == [t for role, t in mine if role == "assistant"]


# --- 10 urls

def test_shift_and_against_regular_expressions():
    rng = random.Random(9)
    globs = ["a*", "+.b/*", "a+b/*c*", "*ab*", "+/x*/+y*", "abc/" + "d" * 70 + "*"] + ["".join(rng.choice("ab/*+") for _ in range(6)) + "a*" for _ in range(60)]
    engine = url_filter.ShiftAnd(globs)
    urls = ["".join(rng.choice("ab/.cxy") for _ in range(rng.randrange(14))) for _ in range(800)] + ["", "abc/" + "d" * 75]
    data, offsets = url_filter.column_bytes(pa.array(urls))
    hit = engine.run(data, offsets)
    for j, g in enumerate(globs):
        want = re.compile("".join(".*" if c == "*" else "[^/]*" if c == "+" else re.escape(c) for c in g[:-1]), re.S)
        if re.search(r"[*+]{2}", g):
            continue  # two wildcards side by side count as the wider one
        assert engine.matched(hit, j).tolist() == [want.match(u) is not None for u in urls], g


def test_url_filter_edges(spark):
    rows = [(1, None), (2, "no host"), (3, "http://EXAMPLE.org/es/x?q"), (4, "x://sub.example.org/en/12"), (5, "x://a.com/fr/"), (6, "x://notcom/de/"),
            (7, "http://spam-farm.net/x"), (8, "http://a.org"), (9, "a://b://c/d"), (9, "a://b://c/d")]
    df = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit("x"))
    got = sorted((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.filter_urls(df).collect())
    assert got == [(1, "", "", None, "allow"), (2, "", "", None, "allow"), (3, "example.org", "/es/x", "example.org/es/", "block"),
                   (4, "sub.example.org", "/en/12", "example.org/en/1", "block"), (5, "a.com", "/fr/", "com/fr/", "allow"), (6, "notcom", "/de/", None, "allow"),
                   (7, "spam-farm.net", "/x", None, "block"), (8, "a.org", "", None, "allow"), (9, "b:", "//c/d", None, "allow"), (9, "b:", "//c/d", None, "allow")]
    assert url_filter.filter_urls(df.limit(0)).count() == 0


# --- registered queries and the pipeline

def test_queries_match_their_sql(spark):
    from oracle_check import compare, duck
    con = duck(SF001)
    for name, sql in queries.ORACLE_SQL.items():
        r = compare(spark, name, queries.QUERIES[name], sql, SF001, con)
        assert r["status"] == "match", r


def test_pipeline_stages(spark):
    import corpus_pipeline as P
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    columns = docs.columns
    bench = [decontaminate.folded(r["text"].encode()) for r in spark.read.parquet(f"{SF0001}/benchmark.parquet").collect()]
    for name, stage in P.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        path = staging_path(spark, f"test-{name}")
        stage(spark, docs, SF0001).write.parquet(path)
        docs = spark.read.parquet(path)
        after = {r["doc_id"] for r in docs.collect()}
        assert after <= set(before)
        if name != P.STAGES[-1][0]:
            assert docs.columns == columns
        if name == "exact_dedup":
            assert after == {max(i for i, u in before.items() if u == t) for t in set(before.values())}
        elif name == "near_dedup":
            assert after == {i for i, (_, c) in linked_classes(list(before.items())).items() if i == c}
        elif name == "decontaminate":
            assert after == {i for i, t in before.items() if not any(b in decontaminate.folded((t or "").encode()) for b in bench)}
        elif name == "sentencepiece":
            assert after == set(before) and docs.filter("not lossless").count() == 0
    assert docs.count() > 50
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF0001}/labels.parquet").collect()}
    assert sum(labels.get(i) == 0 for i in after) <= 0.25 * sum(q == 0 for q in labels.values())  # learnt from some 60 rows here


def test_pipeline_on_odd_tables(spark):
    import corpus_pipeline as P
    docs = table(spark, corpus(5, 40) + [(None, "x y z"), (7000, "q"), (7000, "q")])
    for name, stage in P.STAGES[:-1]:
        for d in (docs, docs.limit(0)):
            out = stage(spark, d, SF0001)
            assert out.columns == docs.columns and out.count() <= d.count()


def test_token_files_encode_runs_of_line_ends_as_the_tokenizer_does():
    import random

    import public_tokenizers
    own = token_files.WordEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(3)
    texts = ["a\n\n\nb", "x\n\n", "a\n\n b", "\n", "\n\n", "a\n\nb", "", " a", "a b\n", "\x01 a"]
    texts += ["".join(rng.choice("ab 'é\n\t. 1 ") for _ in range(rng.randint(0, 25))) for _ in range(3000)]
    for at in range(0, len(texts), 50):
        part = texts[at:at + 50]
        ids, sizes = own.encode(part)
        assert [ids[e - n:e].tolist() for e, n in zip(sizes.cumsum(), sizes)] == [own.whole(t) for t in part]


def test_word_store_forgets_without_changing_ids(monkeypatch):
    monkeypatch.setattr(token_files, "CACHE_WORDS", 50)
    own, rng = token_files.WordEncoder(queries.BYTE_BPE), random.Random(7)
    bits = ["a", "The", "word", "Ünï", "é", "中", "文字", "1", "٣", "²", "'s", "'ll", "!", "...", "-", "_", " ", " ", "  ", "\n", "\n\n",
            "\t", "\r", "　", "​", "\x01", "\x02", "<|endoftext|>", "\U0001F600"]
    for _ in range(1500):
        part = ["".join(rng.choice(bits) for _ in range(rng.randrange(14))) for _ in range(rng.randrange(1, 4))]
        ids, sizes = own.encode(part)
        assert [ids[e - n:e].tolist() for e, n in zip(sizes.cumsum(), sizes)] == [own.whole(t) for t in part]


def test_scores_do_not_depend_on_the_batch(spark):
    """The same text has the very same score wherever it stands, and as a plain sum gives it."""
    import math

    rows = corpus(6, 120)
    rows = [(i, t) for i, (_, t) in enumerate(rows)] + [(10_000 + i, t) for i, (_, t) in enumerate(rows)]
    rng = np.random.default_rng(2)
    weights = rng.normal(size=(1 << quality.BITS) + 1)
    whole = spark.createDataFrame(rows, "doc_id long, text string")
    one = {r["doc_id"]: r["score"] for r in quality.score(whole.coalesce(1), weights).collect()}
    many = {r["doc_id"]: r["score"] for r in quality.score(whole.repartition(17), weights).collect()}
    assert one == many and all(one[i] == one[10_000 + i] for i in range(len(rows) // 2))
    for i, t in rows[:40]:
        data, offsets = quality.X.column_bytes(pa.array([t or ""]))
        slots, bounds = quality.features(data, offsets)
        z = weights[-1] + quality.SCALE * sum(weights[slots].tolist()) / max(len(slots), 1)
        assert math.isclose(one[i], 1 / (1 + math.exp(-max(-35, min(35, z)))), rel_tol=1e-9, abs_tol=1e-12)


def test_classifier_learns_as_a_plain_loop_does(spark):
    """Weights against follow-the-regularised-leader updates written out one coordinate at a time."""
    import math

    rng = random.Random(4)
    good, bad = [f"g{i}" for i in range(30)], [f"b{i}" for i in range(30)]
    rows = [(i, " ".join(rng.choice(good if i % 3 else bad) for _ in range(12))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(60)], "doc_id long, quality int")
    got = quality.train(docs, labels)
    keyed = docs.select("doc_id", F.xxhash64("doc_id").alias("k")).filter(quality.in_training_fold(F.col("doc_id"))).collect()
    vectors = {r["k"]: r for r in docs.join(labels, "doc_id").select(F.xxhash64("doc_id").alias("k"), F.col("quality").alias("y"), F.col("text").alias("t"))
               .mapInArrow(quality._vectors, "k long, y int, idx binary, val binary").collect()}
    z, n = {}, {}

    def weight(i):
        n.setdefault(i, 0.0)
        if abs(z.get(i, 0.0)) <= quality.L1:
            return 0.0
        return -(z[i] - math.copysign(quality.L1, z[i])) / ((quality.BETA + math.sqrt(n[i])) / quality.ALPHA + quality.L2)
    order = sorted(r["k"] for r in keyed)
    for _ in range(quality.EPOCHS):
        for k in order:
            idx = [*np.frombuffer(vectors[k]["idx"], "<i4").tolist(), 1 << quality.BITS]  # the bias comes last
            val = [*np.frombuffer(vectors[k]["val"], "<f4").tolist(), 1.0]
            w = {i: weight(i) for i in idx}
            p = 1 / (1 + math.exp(-sum(w[i] * x for i, x in zip(idx, val))))
            for i, x in zip(idx, val):
                g = (p - vectors[k]["y"]) * x
                step = (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / quality.ALPHA
                z[i] = z.get(i, 0.0) + g - step * w[i]
                n[i] = n.get(i, 0.0) + g * g
    for i in z:
        assert math.isclose(got[i], weight(i), rel_tol=1e-6, abs_tol=1e-9)


@pytest.mark.parametrize("before", [0, 12, 300])
def test_a_renamed_license_is_told_wherever_its_title_stands(before):
    """The title counts, not the first words of the file."""
    m, texts = license_matcher(), dict(license_scan.full_templates())
    lines = "".join(f"Copyright (c) {1990 + i % 30} Holder {i}\n" for i in range(before))
    whole = {n: m.scan(lines + texts[n])[0] for n in ("LGPL-2.1", "GPL-3.0", "Apache-2.0")}
    if before < 300:  # beyond that the lines of names are most of the words
        assert whole == {n: n for n in whole}
    other = texts["LGPL-2.1"].replace("LESSER", "LIBRARY").replace("Lesser", "Library").replace("2.1", "2.0")
    assert m.scan(lines + other)[0] != "LGPL-2.1"


def test_clashing_names_are_refused(spark):
    df = table(spark, [(1, "a")])
    benchmark = spark.createDataFrame([(1, "x y z")], "item_id long, text string")
    for add in (lambda: quality.score(df, np.zeros((1 << quality.BITS) + 1)), lambda: decontaminate.find_leaks(df, benchmark, found_col="Leaks"),
                lambda: pieces.decode_pieces(df.withColumn("ids", F.array(F.lit(1))), queries.PIECE_MODEL, text_col="KEPT")):
        with pytest.raises(ValueError, match="column already"):
            add()


def test_long_regions_of_items_are_found(spark):
    """Recall on halves of items and on items with words replaced, and nothing found in other texts."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 10)))
    items = [(i, " ".join(word() for _ in range(rng.randrange(15, 60)))) for i in range(60)]
    filler = [word() for _ in range(3000)]

    def half(w):
        a = rng.randrange(len(w) - len(w) // 2 + 1)
        return w[a:a + len(w) // 2]

    def replaced(w):
        w = list(w)
        w[rng.randrange(len(w))] = word()
        return w
    docs, wanted = [], {}
    for i, text in items:
        for n, change in enumerate((half, replaced, list)):
            host = rng.sample(filler, 40)
            at = rng.randrange(40)
            host[at:at] = change(text.split(" "))
            docs.append((10 * i + n, " ".join(host)))
            wanted[10 * i + n] = i
    docs += [(5000 + i, " ".join(rng.sample(filler, 60))) for i in range(60)] + [(9000, None), (9001, ""), (9002, " ".join(filler * 40))]
    bench = spark.createDataFrame([*items, (500, None), (501, ""), (502, "short")], "item_id long, text string")
    out = decontaminate.find_leaks(table(spark, docs), bench, found_col="whole", part_col="part")
    got = {r["doc_id"]: ([x["item_id"] for x in r["whole"]], list(r["part"])) for r in out.collect()}
    assert all(not set(a) & set(b) for a, b in got.values())
    for n in range(3):
        mine = [d for d in wanted if d % 10 == n]
        assert sum(wanted[d] in got[d][0] + got[d][1] for d in mine) >= 0.9 * len(mine), n
    assert all(got[d][0] == [wanted[d]] for d in wanted if d % 10 == 2)
    assert all(got[d] == ([], []) for d in got if d >= 5000)


def test_regions_cover_every_stretch():
    for m in (60, 110, 130, 200, 394, 5000):
        text = bytes(rng % 251 for rng in range(m))
        parts = decontaminate.regions(text)
        if not parts:
            assert m < 60
            continue
        size = len(parts[0])
        assert all(len(p) == size >= decontaminate.REGION_BYTES for p in parts)
        step = max(1, int(m * decontaminate.REGION_STEP))
        for a in range(m - size - step + 1):
            assert any(p in text[a:a + size + step] for p in parts)
