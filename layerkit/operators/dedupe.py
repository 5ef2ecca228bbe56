"""One row per key, duplicate keys and distinct batches."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def latest_per_key(
    df: DataFrame,
    keys: Iterable[str],
    order: Iterable[str],
    settle: Iterable[str] | None = None,
) -> DataFrame:
    """The newest row of each key; null keys form one group.

    Rows that tie on the order columns are settled by the `settle` columns, by
    default all the others, so the answer does not depend on how the rows were
    split or merged. Pass settle=() where the order columns never tie: columns
    nobody uses are then not read. Spark cuts each task to one row per key
    before the shuffle (WindowGroupLimit), so a hot key costs one row per task.
    """
    keys = list(keys)
    ranking = Window.partitionBy(*keys).orderBy(*newest_order(df, keys, order, settle))
    ranked = df.withColumn("_rank", F.row_number().over(ranking))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def newest_order(
    df: DataFrame,
    keys: Iterable[str],
    order: Iterable[str],
    settle: Iterable[str] | None = None,
) -> list[Column]:
    """Newest rows first; ties by `settle`, by default every other column that can be ordered."""
    known = [*keys, *order]
    if settle is None:
        settle = orderable(df, [c for c in df.columns if c not in known])
    return [F.desc(c) for c in [*order, *settle]]


def orderable(df: DataFrame, columns: Iterable[str]) -> list[str]:
    return [c for c in columns if can_order(df.schema[c].dataType)]


def can_order(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return can_order(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(can_order(f.dataType) for f in kind.fields)
    return not isinstance(kind, (T.MapType, T.VariantType))


def duplicate_keys(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Key values on more than one row, with their row count."""
    return df.groupBy(*keys).count().filter(F.col("count") > 1)


def distinct_batches(df: DataFrame, column: str, limit: int | None = None) -> DataFrame:
    """The batch values in order, or the first of them where only a look is wanted."""
    values = df.select(column).distinct().orderBy(column)
    return values if limit is None else values.limit(limit)
