"""Questions asked of the audit and error tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_failures(audit: DataFrame) -> DataFrame:
    """Failed checks, newest first."""
    return audit.filter(~F.col("status")).orderBy(F.desc("timestamp"), "layer", "check_name")


def newest_errors(errors: DataFrame, limit: int = 100) -> DataFrame:
    """The newest error records."""
    columns = ["layer", "check_name", "error_record", "timestamp"]
    return errors.select(*columns).orderBy(F.desc("timestamp"), *columns[:3]).limit(limit)


def check_trend(audit: DataFrame) -> DataFrame:
    """Share of passed runs per check and day."""
    return audit.groupBy("layer", "check_name", F.to_date("timestamp").alias("day")).agg(
        F.avg(F.col("status").cast("int")).alias("pass_rate"),
        F.count(F.lit(1)).alias("runs"),
    )


def failures_with_samples(audit: DataFrame, errors: DataFrame) -> DataFrame:
    """Failed checks with the error records of the same run; checks without any stay."""
    run = ["layer", "check_name", "timestamp"]
    return audit.filter(~F.col("status")).join(errors, run, "left")
