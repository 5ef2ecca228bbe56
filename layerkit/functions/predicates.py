"""Row predicates that are true for failing rows; null means the row passes."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from layerkit.functions.text import canonical, to_number


def missing(column: str, blank: bool = False) -> Column:
    """Null, or also the empty string when blank counts as missing."""
    value = F.col(column)
    return value.isNull() | (value == "") if blank else value.isNull()


def any_missing(columns: Iterable[str], blank: bool = False) -> Column:
    return reduce(or_, [missing(c, blank) for c in columns])


def not_castable(column: str, to: str = "double") -> Column:
    """Non-empty text that does not parse."""
    value = F.col(column)
    return value.isNotNull() & (value != "") & value.try_cast(to).isNull()


def out_of_range(column: str, low: float | None = None, high: float | None = None) -> Column:
    """Parsed value below low or above high; NaN counts as above every bound."""
    value = to_number(column)
    tests = ([value < low] if low is not None else []) + ([value > high] if high is not None else [])
    return reduce(or_, tests)


def not_in_set(column: str, allowed: Iterable[str]) -> Column:
    return ~F.col(column).isin(list(allowed))


def not_canonical(column: str, form: str) -> Column:
    return F.col(column) != canonical(F.col(column), form)
