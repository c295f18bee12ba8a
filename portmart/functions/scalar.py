"""Scalar column functions. All are built-in Spark expressions: they stay inside whole-stage
codegen and need no Python worker.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# SAS counts days from this origin.
SAS_EPOCH = _dt.date(1960, 1, 1)
_MICROS_PER_DAY = 86_400_000_000.0

# Characters Python's str.strip() removes: every character Python calls whitespace
# (all of them lie below U+3100).
_WHITESPACE = "".join(chr(c) for c in range(0x3100) if chr(c).isspace())

# Runs of cased characters or runs of anything else. Python's str.title() upper-cases the
# first cased character after an uncased one and lower-cases the rest, which is initcap applied
# to each run of cased characters. "Cased" is the Unicode Lowercase/Uppercase/Titlecase
# properties (so also e.g. ª, ʰ, ⓐ), as in Python, not only the Lu/Ll/Lt categories.
_CASED = r"\p{IsLowercase}\p{IsUppercase}\p{IsTitlecase}"
_CASED_RUNS = f"([{_CASED}]+|[^{_CASED}]+)"


def _col(c: "Column | str") -> Column:
    return F.col(c) if isinstance(c, str) else c


def sas_day_to_iso(c: "Column | str", zero_is_null: bool = True) -> Column:
    """SAS day number (days since 1960-01-01, double) -> ISO date string ``yyyy-MM-dd``.

    Fractions floor (1.9 -> 1960-01-02, -0.5 -> 1959-12-31) after rounding to the microsecond
    (half-even), exactly as adding ``timedelta(days=x)`` to a date does, so values within half a
    microsecond of a day boundary land where Python puts them. Null and NaN give null; day 0
    gives null unless ``zero_is_null=False`` (then 1960-01-01).
    """
    x = _col(c).cast("double")
    ok = x.isNotNull() & ~F.isnan(x)
    if zero_is_null:
        ok = ok & (x != F.lit(0.0))
    # whole days stay exact; only the fraction is rounded to microseconds (as timedelta does)
    whole = F.when(x >= 0, F.floor(x)).otherwise(F.ceil(x))
    frac_micros = F.rint((x - whole) * F.lit(_MICROS_PER_DAY))  # half-even, no BigDecimal
    days = (whole + F.floor(frac_micros / F.lit(_MICROS_PER_DAY))).try_cast("int")
    return F.when(ok, F.date_add(F.lit(SAS_EPOCH), days).cast("string"))


def sas_day_of(date_col: "Column | str") -> Column:
    """Date or timestamp -> SAS day number as double (inverse of :func:`sas_day_to_iso`)."""
    return F.datediff(_col(date_col).cast("date"), F.lit(SAS_EPOCH)).cast("double")


def parse_date(c: "Column | str", fmt: str | None = None) -> Column:
    """String -> date; malformed text gives null instead of failing the job under ANSI mode."""
    return F.try_to_date(_col(c), F.lit(fmt)) if fmt else F.try_to_date(_col(c))


def year_of(c: "Column | str") -> Column:
    return F.year(_col(c))


def month_of(c: "Column | str") -> Column:
    return F.month(_col(c))


def split_part(c: "Column | str", sep: str, index: int) -> Column:
    """0-based piece ``index`` of ``c`` split on the literal ``sep``; null when missing."""
    return F.get(F.split(_col(c), _regex_quote(sep)), index)


def strip_chars(c: "Column | str", chars: str | None = None) -> Column:
    """Strip ``chars`` from both ends (whitespace when None, as Python's ``str.strip()``)."""
    return F.btrim(_col(c), F.lit(_WHITESPACE if chars is None else chars))


def strip_chain(c: "Column | str", steps: list) -> Column:
    """Apply several strips in order, e.g. ``['\\t', None, "'"]`` = tabs, whitespace, quotes."""
    out = _col(c)
    for chars in steps:
        out = F.btrim(out, F.lit(_WHITESPACE if chars is None else chars))
    return out


def before_first(c: "Column | str", sep: str = ",") -> Column:
    """Text before the first ``sep`` (the whole text when there is none)."""
    return F.get(F.split(_col(c), _regex_quote(sep), 2), 0)


def after_first(c: "Column | str", sep: str = ",") -> Column:
    """Text after the first ``sep``; null when there is none."""
    return F.get(F.split(_col(c), _regex_quote(sep), 2), 1)


def py_title(c: "Column | str") -> Column:
    """Title case with Python ``str.title()`` rules, as a native expression.

    Spark's ``initcap`` only splits on spaces (``o'hare`` -> ``O'hare``); Python capitalises
    after any uncased character (``O'Hare``, ``Winston-Salem``, ``2Nd``).
    """
    parts = F.regexp_extract_all(_col(c), F.lit(_CASED_RUNS), 1)
    return F.when(_col(c).isNotNull(), F.array_join(F.transform(parts, F.initcap), ""))


def pct(part: "Column | str", whole: "Column | str") -> Column:
    """100 * part / whole as double (null when whole is 0)."""
    return F.lit(100.0) * _col(part).cast("double") / F.nullif(_col(whole).cast("double"), F.lit(0.0))


def is_missing(c: "Column | str", dtype: str | None = None) -> Column:
    """Null, or NaN for float/double columns (pandas ``isnull`` semantics)."""
    x = _col(c)
    if dtype in ("double", "float"):
        return x.isNull() | F.isnan(x)
    return x.isNull()


def _regex_quote(s: str) -> str:
    return "".join("\\" + ch if ch in r".^$*+?()[]{}|\\" else ch for ch in s)
