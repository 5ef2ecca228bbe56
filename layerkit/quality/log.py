"""Audit and error tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerkit.sources.tables import append, ensure_schema, ensure_table

# Columns of the two log tables.
AUDIT = T.StructType(
    [
        T.StructField("layer", T.StringType()),
        T.StructField("check_name", T.StringType()),
        T.StructField("status", T.BooleanType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("details", T.StringType()),
    ]
)
ERRORS = T.StructType(
    [
        T.StructField("layer", T.StringType()),
        T.StructField("check_name", T.StringType()),
        T.StructField("error_record", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)


def ensure_log_tables(spark: SparkSession, schema: str) -> tuple[str, str]:
    ensure_schema(spark, schema)
    audit, errors = f"{schema}.dq_audit", f"{schema}.dq_errors"
    ensure_table(spark, audit, AUDIT)
    ensure_table(spark, errors, ERRORS)
    return audit, errors


def audit_rows(status: DataFrame, at: datetime | Column, sample: int | None = None) -> DataFrame:
    """Status rows in the audit layout; details hold the two counts as JSON.

    Where only `sample` failing rows are logged, and there are more, the details
    say so as logged_rows.
    """
    cut = F.when(F.col("failed_rows") > F.lit(sample), F.lit(sample)).cast("bigint")
    counts = ["failed_rows", "total_rows", *([cut.alias("logged_rows")] if sample is not None else [])]
    return status.select(
        "layer",
        "check_name",
        "status",
        _moment(at).alias("timestamp"),
        F.to_json(F.struct(*counts)).alias("details"),
    )


def error_rows(errors: DataFrame, at: datetime | Column) -> DataFrame:
    return errors.select("layer", "check_name", "error_record", _moment(at).alias("timestamp"))


def _moment(at: datetime | Column) -> Column:
    return at if isinstance(at, Column) else F.lit(at)


def log(rows: DataFrame, table: str) -> None:
    """Append a run's rows, a bounded handful, as one file."""
    append(rows.repartition(1), table)


RUN = "_run"


def ensure_run_table(spark: SparkSession, schema: str) -> str:
    """An audit table whose rows belong to numbered runs, such as the micro-batches of a stream."""
    ensure_schema(spark, schema)
    name = f"{schema}.dq_audit_runs"
    ensure_table(spark, name, T.StructType([*AUDIT.fields, T.StructField(RUN, T.StringType())]), [RUN])
    return name


def log_once(rows: DataFrame, table: str, run: str) -> None:
    """Write a run's rows in place of those it has written before, so a run that is repeated adds none."""
    append(rows.repartition(1).withColumn(RUN, F.lit(run)), table, replace_partitions=True)
