"""Column functions."""

from portmart.functions.scalar import (SAS_EPOCH, after_first, before_first, is_missing, month_of,
                                       parse_date, pct, py_title, sas_day_of, sas_day_to_iso,
                                       split_part, strip_chain, strip_chars, year_of)

__all__ = ["SAS_EPOCH", "after_first", "before_first", "is_missing", "month_of", "parse_date", "pct",
           "py_title", "sas_day_of", "sas_day_to_iso", "split_part", "strip_chain", "strip_chars",
           "year_of"]
