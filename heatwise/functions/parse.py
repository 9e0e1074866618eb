"""Column expressions that type the raw (string) trace.

All of them are built-in expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings that mark a failed task.
FAILED_TRUE = ["true", "1", "yes"]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def number_or_zero(c) -> Column:
    """Missing or empty number → 0; anything else parsed as double (null if unparseable)."""
    col = _c(c)
    return F.coalesce(F.nullif(col, F.lit("")).try_cast("double"), F.lit(0.0))


def is_bad_number(c) -> Column:
    """True when the raw text is present and non-empty but does not parse as a number."""
    col = _c(c)
    return (F.coalesce(col, F.lit("")) != "") & col.try_cast("double").isNull()


def all_good(cols) -> Column:
    """No listed number is malformed: one small conjunct per column."""
    return reduce(lambda a, b: a & b, [~is_bad_number(c) for c in cols])


def any_bad(cols) -> Column:
    return ~all_good(cols)


def clean_key(c) -> Column:
    """Trimmed key; blank or absent → null (the row is not emitted for that key)."""
    return F.nullif(F.trim(_c(c)), F.lit(""))


def failed_flag(c) -> Column:
    """1 when the flag text, trimmed and lower-cased, is a 'true' spelling; else 0."""
    return F.coalesce(F.lower(F.trim(_c(c))).isin(FAILED_TRUE).cast("int"), F.lit(0))


def strict_int(c) -> Column:
    """ANSI integer cast: malformed text fails the job, as a strict parse does."""
    return _c(c).cast("bigint")
