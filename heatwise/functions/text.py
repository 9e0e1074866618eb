"""Number extraction from metric text lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a signed decimal with a fraction, or else a run of digits.
NUMBER_PATTERN = r"[-+]?\d*\.\d+|\d+"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def numbers(line) -> Column:
    """All numbers of a line, left to right, as strings."""
    return F.regexp_extract_all(_c(line), F.lit(NUMBER_PATTERN), 0)


def last_number(line) -> Column:
    """The last number of a line as double; null when the line holds none."""
    arr = numbers(line)
    return F.when(F.size(arr) > 0, F.element_at(arr, -1).cast("double"))


def number_pair(line) -> tuple[Column, Column]:
    """First and second number of a line; both null when there are fewer than two."""
    arr = numbers(line)
    ok = F.size(arr) >= 2
    return (F.when(ok, F.element_at(arr, 1).cast("double")),
            F.when(ok, F.element_at(arr, 2).cast("double")))
