"""Cross-tokenizer alignment against a plain walk over both tokenizations."""

import collections
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from portmart.session import ensure_importable

pt = pytest.importorskip("public_tokenizers")
from portmart.llm import alignment, units  # noqa: E402

A_PATH, B_PATH = pt.path("byte_bpe_50k.json"), pt.path("piece_bpe_32k.model")


def models():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B_PATH)


def odd_texts(n=4000, seed=5):
    rng = random.Random(seed)
    parts = [" ", " ", " ", "\n", "  ", "\n\n", "\t", "\xa0", "　", "\x85", "a", "bc", "The", "é", "日本", "ねこ", "'s", "'ll", "12", "x3", "!", "...",
             "<|endoftext|>", "<s>", "</s>", "<0x41>", "\x00", "\x1c", "\x0b", "\r", "º", "é", "🙂", "ﬁ", "​", "_", "ａ"]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 16))) for _ in range(n)]


@pytest.mark.parametrize("special", [False, True])
def test_units_give_the_ids_of_whole_texts(special):
    a, b = models()
    a.encode_special_tokens = not special
    texts = odd_texts()
    raw = [(" " + t).encode() for t in texts]
    data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    start = units.unit_starts(data, offsets)
    end, first = np.append(start[1:], len(data)), np.searchsorted(start, offsets)
    cut = [data[i:j].tobytes() for i, j in zip(start, end)]
    assert len(cut) > 1.3 * len(texts)
    ids_a, ids_b = units.ByteBpe(A_PATH, special).ids(cut), units.PieceBpe(B_PATH).ids(cut)
    for i, t in enumerate(texts):
        mine = range(first[i], first[i + 1])
        assert [x for k in mine for x in ids_a[k]] == a.encode(" " + t, add_special_tokens=False).ids, t
        assert [x for k in mine for x in ids_b[k]] == b.encode(t), t


def test_store_forgets_and_gives_the_same():
    made = []

    def work(new):
        made.extend(new)
    own = []
    store = units.Store(lambda new: (work(new), own.extend(new)), lambda stay: own.__setitem__(slice(None), [own[i] for i in stay]), limit=3)
    for text in (b"a b c d e", b"e f g", b"a b c d e", b"e"):
        data = np.frombuffer(text, np.uint8)
        which, first = store.numbers(data, np.array([0, len(text)]))
        assert b"".join(own[i] for i in which) == text and first.tolist() == [0, len(which)]
    assert len(made) > len(set(made))


def test_pointer_jumping_groups():
    rng = np.random.default_rng(1)
    for _ in range(300):
        n = int(rng.integers(1, 60))
        ends = [np.unique(np.append(rng.integers(1, n + 1, int(rng.integers(1, 40))), n)) for _ in range(2)]
        common = np.intersect1d(*ends)
        a, b = alignment.groups_of(*ends)
        assert a.tolist() == np.searchsorted(common, ends[0]).tolist() and b.tolist() == np.searchsorted(common, ends[1]).tolist()
    none = np.zeros(0, np.int64)
    assert [len(x) for x in alignment.groups_of(none, none)] == [0, 0]


def test_large_groups_count_distinct_ids(monkeypatch):
    a, b = np.array([5, 5, 7, 1, 2]), np.array([3, 4, 3, 9])
    in_a, in_b = np.array([0, 0, 0, 1, 1]), np.array([0, 0, 0, 1])

    def links():
        g, p, n = alignment.linked_pairs(a, b, in_a, in_b)
        out = collections.Counter()
        for x, y, z in zip(g.tolist(), p.tolist(), n.tolist()):
            out[x, y] += z
        return out
    plain = links()
    monkeypatch.setattr(alignment, "GROUP_PAIRS", 1)
    assert links() == plain and plain[0, (5 << 24) | 3] == 4


def brute(rows):
    a_model, b_model = models()
    names = {i: bytes(units.LETTER_BYTES[c] for c in s) if i != 50256 else s.encode() for s, i in a_model.get_vocab().items()}
    per, count = [], collections.Counter()
    for doc, t in rows:
        whole = (" " + (t or "")).encode()
        a, b = a_model.encode(" " + (t or ""), add_special_tokens=False).ids, b_model.encode(t or "")
        bytes_a = [names[i] for i in a]
        bytes_b = [bytes([int(b_model.id_to_piece(i)[3:5], 16)]) if b_model.is_byte(i) else b_model.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not t or b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            per.append((doc, None))
            continue
        ends = [set(np.cumsum([len(x) for x in side]).tolist()) for side in (bytes_a, bytes_b)]
        groups, at = [], [0, 0]
        left = [0, 0]
        for cut in sorted(ends[0] & ends[1]):
            said = []
            for s, (ids, side) in enumerate(((a, bytes_a), (b, bytes_b))):
                mine = []
                while left[s] < cut:
                    mine.append(ids[at[s]])
                    left[s] += len(side[at[s]])
                    at[s] += 1
                said.append(mine)
            groups.append(said)
        links = [(x, y) for p, q in groups for x in p for y in q]
        count.update(set(links))
        per.append((doc, (len(a), len(b), groups, links)))
    best = collections.Counter()
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    out = []
    for doc, got in per:
        if got is None:
            out.append((doc, 0, 0, 0, 0, 0, 0, ""))
            continue
        na, nb, groups, links = got
        said = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in groups)
        out.append((doc, na, nb, len(groups), len(links), sum(count[x] == best[x[0]] for x in links), sum(count[x] for x in links),
                    hashlib.sha256(said.encode()).hexdigest()))
    return out


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_against_brute_force(spark, monkeypatch):
    ensure_importable(spark)
    rng = random.Random(2)
    words = ["the", "Straße", "tokenization", "naïve", "日本語", "42", "x" * 70, "re-use", "<|endoftext|>", "▁"]
    rows = list(enumerate([None, "", " ", "\n", "▁", "a▁b", "one", "one", *odd_texts(300, 9), "z" * 20000, "word " * 3000]))
    rows += [(1000 + i, " ".join(rng.choice(words[:9] if i % 5 else words) for _ in range(40))) for i in range(60)]
    rows += [(7, "again"), (7, "again"), (None, "no id")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"part": F.lit("x"), "id": F.lit(0), "pairs": F.lit(1.0)}).repartition(3)
    assert as_rows(alignment.align(df, A_PATH, B_PATH)) == sorted(brute(rows), key=str)


def test_empty_table(spark):
    ensure_importable(spark)
    out = alignment.align(spark.createDataFrame([], "doc_id long, text string"), A_PATH, B_PATH)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"] and not out.collect()


@pytest.mark.parametrize("special", [False, True])
def test_units_that_end_before_marks_give_the_ids_of_whole_texts(special):
    """The cuts that only the byte-level tokenizer allows, through the store that forgets."""
    from portmart.llm import token_files

    a, _ = models()
    a.encode_special_tokens = not special
    own = token_files.WordEncoder(A_PATH, special)
    own.store.limit = 200
    rng = random.Random(11)
    parts = ["word", "It", "x", "é", "'s", "'", "''ll", ",", ".", "!?", "|", "<", ">", "<|endoftext|>", "<|endoftext", "|>", "-", "_", "1", " ", " ", "\n", "\n\n", "\xa0"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(14))) for _ in range(4000)] + odd_texts(2000, 3)
    for at in range(0, len(texts), 250):
        part = texts[at:at + 250]
        ids, sizes = own.encode(part)
        for t, end, n in zip(part, sizes.cumsum(), sizes):
            assert ids[end - n:end].tolist() == a.encode(t, add_special_tokens=False).ids, t


def test_files_are_laid_out_for_selective_reads(spark):
    """Encodings, row groups and page indexes as the footers tell them."""
    import glob

    import pyarrow.parquet as pq

    from portmart.llm import token_files
    from portmart.session import staging_path

    ensure_importable(spark)
    path = staging_path(spark, "token-layout")
    rows = spark.range(20000).select(F.col("id").alias("doc_id"), F.concat(F.lit("the word "), F.col("id").cast("string"), F.repeat(F.lit(" and more"), 20)).alias("text"))
    plain = token_files.ROW_GROUP_BYTES
    try:
        token_files.ROW_GROUP_BYTES = 64 << 10
        token_files.write_tokens(rows, path, A_PATH)
    finally:
        token_files.ROW_GROUP_BYTES = plain
    files = glob.glob(f"{path.removeprefix('file:')}/part-*.parquet")
    groups = 0
    for file in files:
        meta = pq.ParquetFile(file).metadata
        groups += meta.num_row_groups
        for g in range(meta.num_row_groups):
            columns = {meta.row_group(g).column(i).path_in_schema.split(".")[0]: meta.row_group(g).column(i) for i in range(meta.num_columns)}
            for name in ("row", "doc_id", "n_tokens"):
                assert "DELTA_BINARY_PACKED" in columns[name].encodings and not columns[name].has_dictionary_page
            assert "RLE_DICTIONARY" in columns["ids"].encodings
            assert all(c.has_column_index and c.has_offset_index for c in columns.values())
    assert groups > len(files)
