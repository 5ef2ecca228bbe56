"""Column standardisation and tolerant parsing."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FORMS = {
    "upper": F.upper,
    "lower": F.lower,
    "title": F.initcap,
    "string": lambda c: c.cast("string"),
}


def canonical(column: Column, form: str) -> Column:
    """The column written in one of FORMS."""
    return FORMS[form](column)


def standardize(df: DataFrame, forms: Mapping[str, str]) -> DataFrame:
    """Rewrite each named column in its form, as one projection."""
    return df.withColumns({name: canonical(F.col(name), form) for name, form in forms.items()})


def to_number(column: str) -> Column:
    """Text as double, null where it is not a number."""
    return F.col(column).try_cast("double")
