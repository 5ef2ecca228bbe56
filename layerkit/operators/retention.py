"""Age-based retention. Rows without a readable date are kept and reported."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def expired(column: str, as_of: date, days: int) -> Column:
    """True for rows dated before as_of minus days; null where the date is unreadable."""
    return F.try_to_date(F.col(column), "yyyy-MM-dd") < F.date_sub(F.lit(as_of), days)


def keep_recent(df: DataFrame, column: str, as_of: date, days: int) -> DataFrame:
    return df.filter(~F.coalesce(expired(column, as_of, days), F.lit(False)))


def retention_report(df: DataFrame, column: str, as_of: date, days: int) -> DataFrame:
    """Rows per batch with what retention does to them: expired, kept or undated."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))
    late = expired(column, as_of, days)
    fate = F.when(late, "expired").when(late.isNull(), "undated").otherwise("kept")
    return counts.withColumn("fate", fate)
