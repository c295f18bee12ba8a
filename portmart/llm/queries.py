"""The operators' registered queries over whole tables, and their DuckDB SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portmart.llm import chat_format as chat
from portmart.llm import alignment, collocations, decontaminate, exact_dedup, license_scan, ngram_join, pieces, quality, setsketch, substring_dedup, token_files, url_filter
from portmart.llm.staging import staged
from portmart.session import staging_path

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(_table(spark, sf_dir, "documents"))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link_components(_table(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup_substrings(_table(spark, sf_dir, "documents"), with_text=False)


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_pieces(_table(spark, sf_dir, "documents"), PIECE_MODEL)


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staging_path(spark, "tokens")
    token_files.write_tokens(_table(spark, sf_dir, "documents"), path, BYTE_BPE, special_tokens=True)  # as ``encode`` by default
    read = token_files.ids_crc32(token_files.read_tokens(spark, path))
    return token_files.with_starts(read, path).select("doc_id", "start", "n_tokens", "ids_crc32")


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    weights = quality.train(docs, _table(spark, sf_dir, "labels"))
    return quality.score(docs, weights).select(
        "doc_id", (~quality.in_training_fold(F.col("doc_id"))).alias("held_out"), "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: doc_id, contaminated, n_items, item_ids (ascending), min_edits, part_item_ids (items of
    which it holds a long region only)."""
    found = decontaminate.find_leaks(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "benchmark"), part_col="parts")
    n = F.size("leaks")
    return found.select("doc_id", ((n > 0) | (F.size("parts") > 0)).alias("contaminated"), n.cast("long").alias("n_items"),
                        F.col("leaks.item_id").alias("item_ids"), F.array_min("leaks.edits").alias("min_edits"), F.col("parts").alias("part_item_ids"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files ``<source>/<lang>/<thousand of ids>/<doc_id>.txt``."""
    docs = _table(spark, sf_dir, "documents")
    path = F.concat_ws("/", "source", "lang", F.floor(F.col("doc_id") / 1000), F.concat("doc_id", F.lit(".txt")))
    scanned = license_scan.scan_texts(docs.select("doc_id", "text", path.alias("path")), "doc_id", "text", "path")
    return license_scan.inherit(staged(scanned, "licenses"), "doc_id")


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat.conversation_digests(chat.turns_as_events(rows.unionByName(extra)))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(_table(spark, sf_dir, "pages"))


def op11_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(_table(spark, sf_dir, "documents"), BYTE_BPE, PIECE_MODEL)


def op12_setsketch_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_classes(_table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_exact_dedup, op2_ngram_jaccard_join, op3_substring_dedup, op4_sentencepiece, op5_token_files, op6_quality_classifier,
    op7_decontamination, op8_license_scan, op9_chat_format, op10_url_filter,
    op11_cross_tokenizer_alignment, op12_setsketch_near_dedup, op13_collocations)}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

def _links_sql(shingle: int, percent: int) -> str:
    """(doc_id, n_shingles, component_id) of documents that links of their shingle sets connect."""
    return f"""
        WITH RECURSIVE docs AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
        w AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM docs),
        g AS (SELECT doc_id, list(word) OVER next AS run FROM w
              WINDOW next AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND {shingle - 1} FOLLOWING)),
        s AS (SELECT DISTINCT doc_id, array_to_string(run, ' ') AS s FROM g WHERE len(run) = {shingle}
              UNION SELECT doc_id, array_to_string(ws, ' ') FROM docs WHERE len(ws) BETWEEN 1 AND {shingle - 1}),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (s) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
        e AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= {percent} * (x.n + y.n - c)),
        r AS (SELECT doc_id, doc_id AS to_id FROM documents UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.to_id = e.a)
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id
        FROM documents d LEFT JOIN n USING (doc_id)
        JOIN (SELECT doc_id, min(to_id) AS component_id FROM r GROUP BY doc_id) m USING (doc_id)"""


ORACLE_SQL = {
    "op1_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    "op2_ngram_jaccard_join": _links_sql(5, 75),
    "op3_substring_dedup": """
        WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
        w AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM docs),
        g AS (SELECT doc_id, i, word, list(word) OVER run AS run FROM w
              WINDOW run AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING)),
        m AS (SELECT doc_id, i, word, len(run) = 13 AND min(doc_id) OVER (PARTITION BY run) < doc_id AS again FROM g),
        k AS (SELECT doc_id, i, word, bool_or(again) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 12 PRECEDING AND CURRENT ROW) AS gone FROM m),
        t AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept FROM k GROUP BY doc_id)
        SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM docs LEFT JOIN t USING (doc_id)""",
    "op9_chat_format": r"""
        WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, t, r, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r)),
        f AS (SELECT *, role || chr(10) || text || chr(10) AS said,
                length(replace(replace(replace(replace(role, '\', '\0'), '###', '\1'), '</turn>', '\2'), ': ', '\3'))
                + length(replace(replace(replace(text, '\', '\0'), '###', '\1'), '</turn>', '\2')) + 14 AS chars FROM c)
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(said, '' ORDER BY turn, role, text)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(chars) AS BIGINT) AS formatted_chars
        FROM f GROUP BY conv_id""",
    "op12_setsketch_near_dedup": f"SELECT *, doc_id = component_id AS kept FROM ({_links_sql(4, 80)})",
    "op13_collocations": f"""
        WITH p AS (SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS row,
                          regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\\x0A-\\x0D]') AS pieces FROM documents),
        q AS (SELECT lang, row, generate_subscripts(pieces, 1) AS piece, unnest(pieces) AS said FROM p),
        v AS (SELECT lang, row, piece, regexp_extract_all(said, '[^\\x20\\x09]+') AS ws FROM q),
        w AS (SELECT lang, row, piece, generate_subscripts(ws, 1) AS i, unnest(ws) AS w1 FROM v),
        g AS (SELECT lang, w1, lead(w1, 1) OVER o AS w2, lead(w1, 2) OVER o AS w3, lead(w1, 3) OVER o AS w4, lead(w1, 4) OVER o AS w5
              FROM w WINDOW o AS (PARTITION BY row, piece ORDER BY i)),
        s AS (SELECT lang, 1 AS k, w1 AS phrase FROM g
              UNION ALL SELECT lang, 2, w1 || ' ' || w2 FROM g WHERE w2 IS NOT NULL
              UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3 FROM g WHERE w3 IS NOT NULL
              UNION ALL SELECT lang, 4, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 FROM g WHERE w4 IS NOT NULL
              UNION ALL SELECT lang, 5, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 || ' ' || w5 FROM g WHERE w5 IS NOT NULL),
        f AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS ws, count(*) AS f FROM s GROUP BY lang, k, phrase HAVING count(*) >= 100),
        n AS (SELECT lang, count(*) AS n FROM w GROUP BY lang),
        c AS (SELECT *, unnest(range(1, k)) AS j FROM f WHERE k > 1),
        d AS (SELECT c.lang, c.phrase, c.ws, c.f AS a, x.f AS l, y.f AS r, n.n, j,
                     (1000::HUGEINT * c.f * n.n) // (x.f::HUGEINT * y.f) AS score
              FROM c JOIN n USING (lang) JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.ws[:j], ' ')
              JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.ws[j + 1:], ' ')),
        e AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
        z AS (SELECT * FROM e WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.lang = e.lang AND len(f.ws) > len(e.ws) AND f.f >= e.a
                                                AND contains(' ' || f.phrase || ' ', ' ' || e.phrase || ' '))),
        o AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n,
                     CAST(score AS BIGINT) AS score FROM z)
        SELECT * FROM o WHERE rank <= 2000""",
    "op10_url_filter": f"""
        WITH r AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
        h AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
                     regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
        j AS (SELECT *, '.' || host AS dotted, host || path AS whole FROM h),
        k AS (SELECT *, CASE WHEN ends_with(dotted, '.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
                             WHEN ends_with(dotted, '.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
                             WHEN ends_with(dotted, '.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
                             WHEN ends_with(dotted, '.com') AND starts_with(path, '/de/') THEN 'com/de/'
                             WHEN ends_with(dotted, '.org') AND starts_with(path, '/') THEN 'org/' END AS rule FROM j)
        SELECT page_id, host, path, rule,
               CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
                    WHEN regexp_matches(whole, '(?s)^(spam-[^/]*/|[^/]*\\.spam-[^/]*/|[^/]*/.*/tracker/|[^/]*/.*\\.exe)') THEN 'block'
                    ELSE 'allow' END AS verdict
        FROM k""",
}
