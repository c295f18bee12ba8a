"""Corpus pipeline: quality, exact copies, near copies, benchmark leaks, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet below
the shared checkpoint folder and the next stage reads that. All but the last return the columns
of ``documents``:

1. ``quality``: the classifier learns from the labelled training folds; rejected documents go.
2. ``exact_dedup``: of equal texts the document with the largest id stays.
3. ``near_dedup``: of documents that Jaccard links connect, the one with the least id stays.
4. ``decontaminate``: documents that hold a benchmark passage, or a long region of one, go.
5. ``sentencepiece``: sampled piece ids of what is left, with the check that they decode to the text.

Null, empty, very long and repeated texts, ties and empty tables: as each operator states; an empty
text is judged by the classifier's bias, is a text as others for exact copies, links with nothing
and has no pieces. Extra columns pass through all stages but the last.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portmart.llm import decontaminate as leaks
from portmart.llm import exact_dedup, ngram_join, pieces, quality
from portmart.session import ensure_checkpoint_dir, ensure_importable, staging_path

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def _free(docs: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column has it."""
    while name.lower() in (c.lower() for c in docs.columns):
        name = "_" + name
    return name


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ensure_importable(spark)
    weights = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = _free(docs, "score")
    return quality.score(docs, weights, score_col=score).filter(F.col(score) >= quality.THRESHOLD).drop(score)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ensure_importable(spark)
    return ngram_join.drop_near_copies(docs)


def leak_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ensure_importable(spark)
    found, parts = _free(docs, "leaks"), _free(docs, "parts")
    out = leaks.find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), found_col=found, part_col=parts)
    return out.filter((F.size(found) == 0) & (F.size(parts) == 0)).drop(found, parts)


def piece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ensure_importable(spark)
    return pieces.encode_pieces(docs, PIECE_MODEL)


STAGES = [
    ("quality", quality_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("decontaminate", leak_stage),
    ("sentencepiece", piece_stage),
]

# Learnt weights, sampled segmentations and alignments are not SQL; the stages are tested against
# brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last."""
    ensure_checkpoint_dir(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = staging_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
