"""Code -> label lookups parsed from ``code = 'label'`` text lines.

Input is a frame of numbered lines (``sources.labels.read_numbered_lines``). Every step is a
native expression; the last line of a code wins (file order), as assignment into a dict would.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from portmart.functions import before_first, py_title, split_part, strip_chain


@dataclass(frozen=True)
class LabelRule:
    """How one block of the label file is cleaned.

    ``code_strip`` / ``label_strip`` are strip steps applied in order (None = whitespace).
    """
    code_strip: Sequence
    label_strip: Sequence
    title: bool = False
    first_comma: bool = False


# Cleaning rules per block of the label file.
COUNTRY_RULE = LabelRule(code_strip=[None], label_strip=[None, "'"])
CITY_RULE = LabelRule(code_strip=["\t", None, "'"], label_strip=["\t", None, "'"], title=True, first_comma=True)
STATE_RULE = LabelRule(code_strip=["\t", "'"], label_strip=[None, "'"], title=True)


def last_per_key(df: DataFrame, key: str, value: str, order: Sequence[str]) -> DataFrame:
    """(key, value of the row that is last by ``order``) per key (C9), as assignment into a dict
    in file order would leave it. ``row_number() = 1`` over the key, newest first: Spark keeps
    one row per key and task before the shuffle (partial group limit)."""
    w = Window.partitionBy(key).orderBy(*[F.col(c).desc() for c in order])
    return (df.select(key, value, *order).withColumn("_last", F.row_number().over(w))
              .filter(F.col("_last") == 1).select(key, value))


def parse_label_lines(lines: DataFrame, rule: LabelRule, line_col: str = "line") -> DataFrame:
    """Add ``code``, ``label`` and ``ok`` (the line has an '=') columns to numbered lines."""
    line = F.col(line_col)
    code = strip_chain(split_part(line, "=", 0), rule.code_strip)
    label: Column = strip_chain(split_part(line, "=", 1), rule.label_strip)
    if rule.first_comma:
        label = before_first(label, ",")
    if rule.title:
        label = py_title(label)
    return lines.withColumns({"code": code, "label": label, "ok": F.instr(line, "=") > 0})


def label_table(lines: DataFrame, rule: LabelRule, code_name: str, label_name: str,
                order: Sequence[str] = ("file", "pos")) -> DataFrame:
    """Lookup table (code_name, label_name), last line per code wins."""
    parsed = parse_label_lines(lines, rule).filter("ok")
    return (last_per_key(parsed, "code", "label", list(order))
            .select(F.col("code").alias(code_name), F.col("label").alias(label_name)))


def label_rejects(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """Lines in a block that carry no '=' and so give no (code, label) pair."""
    return lines.filter(F.instr(F.col(line_col), "=") == 0)
