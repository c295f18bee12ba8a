"""Exact deduplication (native): local combine, salted digest groups, global salt winners.

1. Rows are combined where they are read: the aggregate on (salt, digest, text) sums copies
   within a task before anything is shuffled.
2. The same aggregate's final step merges the combined rows of one (salt, digest) group. The
   salt comes from the row's id, so a text held by a third of all rows is dealt over
   ``salts`` groups, and each of them leaves one row.
3. The salt winners of a digest (``salts`` rows at most) are combined into the global winner.

The text itself is a grouping key in each step, so rows are merged only where their whole
contents are equal; the digest only deals them out. Rows find their winner over (digest, salt),
so no join key holds more than 1 / ``salts`` of a hot group. Two different texts with one
SHA-256 digest would make that last lookup ambiguous; the job then fails instead of guessing.

Defined cases: null text counts as empty; empty texts form one group; a null id sorts below all
others; rows repeated with the same id and text count as copies and all carry the result of
their id (``drop_copies`` keeps one of them); an empty table gives an empty table; extra columns
are ignored here and kept by ``drop_copies``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 32


def exact_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """One row per row of ``df``: ``id_col``, keep_id (largest id of equal texts), group_size,
    kept, text_sha256."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = df.select(F.col(f"`{id_col}`").alias("_id"), text.alias("_text")).select(
        "_id", "_text", F.sha2("_text", 256).alias("_digest"),
        F.pmod(F.xxhash64("_id"), F.lit(salts)).cast("int").alias("_salt"))
    salted = rows.groupBy("_salt", "_digest", "_text").agg(F.max("_id").alias("_max"), F.count(F.lit(1)).alias("_n"))
    winners = salted.groupBy("_digest", "_text").agg(F.max("_max").alias("_max"), F.sum("_n").alias("_n"))
    by_digest = winners.groupBy("_digest").agg(F.max("_max").alias("keep_id"), F.sum("_n").alias("group_size"),
                                               F.count(F.lit(1)).alias("_texts"))
    safe = by_digest.filter(F.assert_true(F.col("_texts") == 1, F.lit("two texts share a digest")).isNull()).drop("_texts")
    # one row per (digest, salt) carries the winner, and the rows meet it there
    spread = rows.select("_digest", "_salt").distinct().join(safe, "_digest")
    out = rows.select("_id", "_digest", "_salt").join(spread, ["_digest", "_salt"])
    return out.select(F.col("_id").alias(id_col), "keep_id", "group_size",
                      F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("_digest").alias("text_sha256"))


def drop_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """``df`` without the rows whose text stays in another row; all columns are kept.

    Rows are found by id and digest together, as an id (or null) may stand with several texts. Of
    rows repeated with the same id and text one stays."""
    kept = exact_groups(df, id_col, text_col, salts).filter("kept").groupBy(id_col, "text_sha256").agg(F.count(F.lit(1)).alias("_n"))
    digest = F.sha2(F.coalesce(df[text_col].cast("string"), F.lit("")), 256)
    same = df[id_col].eqNullSafe(kept[id_col]) & (digest == kept["text_sha256"])
    once = df.join(kept.filter("_n = 1"), same, "left_semi")
    repeated = df.join(kept.filter("_n > 1"), same, "left_semi").dropDuplicates([id_col, text_col])
    return once.unionByName(repeated)
