"""Declarative data-quality rules.

A row rule gives a predicate that is true for a failing row. A key rule looks
at groups of rows, a table rule at the columns or the size of the whole table.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from layerkit.functions import predicates


@dataclass(frozen=True)
class Rule:
    name: str


@dataclass(frozen=True)
class RowRule(Rule):
    """`needs` names the columns it reads; `evidence` adds columns to its error records."""

    @property
    def needs(self) -> tuple[str, ...]:
        raise NotImplementedError

    def fails(self) -> Column:
        raise NotImplementedError

    def evidence(self) -> dict[str, Column]:
        return {}


@dataclass(frozen=True)
class NotMissing(RowRule):
    """None of the columns is null, or blank where blank counts as missing."""

    columns: tuple[str, ...]
    blank: bool = False

    @property
    def needs(self):
        return self.columns

    def fails(self):
        return predicates.any_missing(self.columns, self.blank)


@dataclass(frozen=True)
class Castable(RowRule):
    """Non-empty text of the columns parses as the type."""

    columns: tuple[str, ...]
    to: str = "double"
    shown_as: Mapping[str, str] = field(default_factory=dict)

    @property
    def needs(self):
        return self.columns

    def fails(self):
        return reduce(or_, [predicates.not_castable(c, self.to) for c in self.columns])

    def evidence(self):
        return {new: F.col(c).try_cast(self.to) for c, new in self.shown_as.items()}


@dataclass(frozen=True)
class InRange(RowRule):
    """Parsed values lie within (low, high); either end may be None."""

    bounds: Mapping[str, tuple[float | None, float | None]]
    shown_as: Mapping[str, str] = field(default_factory=dict)

    @property
    def needs(self):
        return tuple(self.bounds)

    def fails(self):
        return reduce(or_, [predicates.out_of_range(c, *ends) for c, ends in self.bounds.items()])

    def evidence(self):
        return {new: F.col(c).try_cast("double") for c, new in self.shown_as.items()}


@dataclass(frozen=True)
class InSet(RowRule):
    """The value is one of the allowed ones; null passes."""

    column: str
    allowed: tuple[str, ...]

    @property
    def needs(self):
        return (self.column,)

    def fails(self):
        return predicates.not_in_set(self.column, self.allowed)


@dataclass(frozen=True)
class Canonical(RowRule):
    """The value is already written in its standard form; null passes."""

    column: str
    form: str

    @property
    def needs(self):
        return (self.column,)

    def fails(self):
        return predicates.not_canonical(self.column, self.form)


@dataclass(frozen=True)
class Expression(RowRule):
    """An SQL predicate that is true for a failing row; null counts as passing.

    `columns` are those it reads: without one of them the check fails as a whole.
    """

    sql: str
    columns: tuple[str, ...] = ()

    @property
    def needs(self):
        return self.columns

    def fails(self):
        return F.coalesce(F.expr(self.sql), F.lit(False))


@dataclass(frozen=True)
class Unique(Rule):
    """No key value on more than one row; null keys count as equal."""

    keys: tuple[str, ...]


@dataclass(frozen=True)
class MinRows(Rule):
    """The table, or each batch when evaluated by batch, holds at least this many rows."""

    rows: int = 1


@dataclass(frozen=True)
class Fresh(Rule):
    """The newest date in the column is at most max_age days before as_of."""

    column: str
    as_of: date
    max_age: int


@dataclass(frozen=True)
class NoExtraColumns(Rule):
    """Every column of the table is an expected one."""

    expected: tuple[str, ...]

    def offending(self, columns: Iterable[str]) -> list[str]:
        return sorted(set(columns) - set(self.expected))

    reported_as = "unexpected_column"


@dataclass(frozen=True)
class HasColumns(Rule):
    """Every required column is there."""

    required: tuple[str, ...]

    def offending(self, columns: Iterable[str]) -> list[str]:
        return [c for c in self.required if c not in set(columns)]

    reported_as = "missing_column"
