"""Counts of checks per batch, kept as rows, from which the status of a table is put together.

A daily run counts what failed in the batches that are new; the status of all
the others is read off their rows.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerkit.quality.evaluate import check_status
from layerkit.quality.rules import Fresh, HasColumns, MinRows, NoExtraColumns, Rule, Unique
from layerkit.sources.tables import append, batches, drop_batches, ensure_table


def state_schema(by: str) -> T.StructType:
    return T.StructType(
        [
            T.StructField("layer", T.StringType()),
            T.StructField("check_name", T.StringType()),
            T.StructField("failed_rows", T.LongType()),
            T.StructField("total_rows", T.LongType()),
            T.StructField(by, T.StringType()),
        ]
    )


def check_states(df: DataFrame, rules: Iterable[Rule], layer: str, by: str) -> DataFrame:
    """What each check counts in each batch; one scan, as in check_status.

    Keys that are unique inside a batch have to name the batch, else equal keys
    of two batches would be missed; freshness has to be that of the batches.
    """
    rules = list(rules)
    for rule in rules:
        if isinstance(rule, Unique) and by not in rule.keys:
            raise ValueError(f"{rule.name} spans batches: its keys need {by}")
        if isinstance(rule, Fresh) and rule.column != by:
            raise ValueError(f"{rule.name} has to look at {by}")
    return check_status(df, rules, layer, by=by).select(*state_schema(by).names)


def merged_status(states: DataFrame, rules: Iterable[Rule], layer: str, by: str) -> DataFrame:
    """Status of every check over all batches: layer, check_name, status, failed_rows, total_rows."""
    rules = list(rules)
    sums = states.filter(F.col("layer") == layer).groupBy("check_name").agg(
        F.sum("failed_rows").alias("summed"),
        F.max("failed_rows").alias("most"),
        F.sum("total_rows").alias("total_rows"),
        F.max(F.try_to_date(F.col(by), "yyyy-MM-dd")).alias("newest"),
    )
    # Checks that no batch has counted yet stand on an empty table.
    names = states.sparkSession.range(1).select(F.explode(F.array(*[F.lit(r.name) for r in rules])).alias("check_name"))
    met = names.join(sums, "check_name", "left").withColumn("total_rows", F.coalesce("total_rows", F.lit(0).cast("bigint")))
    failed = F.coalesce("summed", F.lit(0).cast("bigint"))
    for rule in rules:
        named = F.col("check_name") == rule.name
        if isinstance(rule, MinRows):
            failed = F.when(named, F.when(F.col("total_rows") < rule.rows, 1).otherwise(0)).otherwise(failed)
        elif isinstance(rule, Fresh):
            bound = F.date_sub(F.lit(rule.as_of), rule.max_age)
            failed = F.when(named, F.when(F.col("newest") >= bound, 0).otherwise(1)).otherwise(failed)
        elif isinstance(rule, (NoExtraColumns, HasColumns)):
            failed = F.when(named, F.coalesce("most", F.lit(0).cast("bigint"))).otherwise(failed)
    failed = failed.cast("bigint")
    return met.select(
        F.lit(layer).alias("layer"), "check_name", (failed == 0).alias("status"), failed.alias("failed_rows"), "total_rows"
    )


def refresh_states(
    spark: SparkSession, states: str, source: str, df: DataFrame, rules: Iterable[Rule], layer: str, by: str, fresh: set
) -> None:
    """Count the batches of `fresh` (null among them for rows without one) in place of what is known of them.

    `source` is the table behind df, partitioned by batch; what is known of
    batches that it no longer has goes.
    """
    ensure_table(spark, states, state_schema(by), [by])
    held = {r[by] for r in batches(spark, source, by).collect()}
    drop_batches(spark, states, by, lambda b: b.filter(~F.col(by).isin(sorted(held))) if held else b)
    if fresh:
        named = F.col(by).isin(sorted(b for b in fresh if b is not None))
        rows = df.filter(named | (F.lit(None in fresh) & F.col(by).isNull()))
        append(check_states(rows, rules, layer, by).coalesce(1), states, replace_partitions=True)
