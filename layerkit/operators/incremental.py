"""Watermarks and the rows past them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def max_watermark(df: DataFrame, column: str) -> DataFrame:
    """One row: the largest value of the column, null for an empty frame."""
    return df.agg(F.max(column).alias("watermark"))


def read_watermark(df: DataFrame, column: str):
    """The watermark as a value; one row reaches the driver."""
    return max_watermark(df, column).first()["watermark"]


def new_rows(df: DataFrame, column: str, watermark, strict_day: bool = False) -> DataFrame:
    """Rows at or after the watermark; all rows when there is none yet.

    Rows of the watermark batch are taken again because the upsert that follows
    is idempotent and a second load on the same day must not be lost.
    strict_day=True keeps only later batches.
    """
    if watermark is None:
        return df
    bound = F.lit(watermark)
    return df.filter(F.col(column) > bound if strict_day else F.col(column) >= bound)


def load_mark(df: DataFrame, batch: str, moment: str) -> tuple | None:
    """Newest batch and the newest moment in it; one row reaches the driver.

    A timestamp comes as microseconds, free of the driver's time zone.
    """
    newest = df.filter(F.col(batch).isNotNull()).agg(F.max(F.struct(batch, moment)).alias("mark"))
    value = F.col(f"mark.{moment}")
    if _is_timestamp(df, moment):
        value = F.unix_micros(value)
    row = newest.select(F.col(f"mark.{batch}"), value).first()
    return None if row[0] is None else tuple(row)


def _is_timestamp(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.TimestampType)


def loads_after(df: DataFrame, batch: str, moment: str, mark: tuple | None) -> DataFrame:
    """Rows loaded after the mark, a second load of the same batch included.

    Two scans that share no row: later batches, found by folder, and the marked
    batch, where row groups of loads already seen are skipped by their moment.
    """
    if mark is None:
        return df
    day, last = (F.lit(value) for value in mark)
    if _is_timestamp(df, moment):
        last = F.timestamp_micros(last)
    later = df.filter(F.col(batch) > day)
    return later.unionByName(df.filter((F.col(batch) == day) & (F.col(moment) > last)))


def latest_batch(df: DataFrame, column: str) -> DataFrame:
    """Rows of the newest batch; on a partition column only that partition is read."""
    return df.filter(F.col(column) == max_watermark(df, column).scalar())
