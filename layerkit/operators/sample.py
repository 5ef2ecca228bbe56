"""The first rows of each group."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_per_group(df: DataFrame, group: Iterable[str], order: Iterable, n: int) -> DataFrame:
    """The first n rows of each group in the given order.

    Up to Spark's limit for it, rows are cut to n per task and group before they
    are shuffled, and 64 slices of tasks cut once more. For a larger n there
    are up to 4096 slices, a sixteenth as many at each step, so that a hot group
    is cut by many tasks before its rows meet in one.
    """
    group, order = list(group), list(order)
    threshold = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    slices = 64 if n <= threshold else 4096
    cut = df.withColumn("_slice", F.spark_partition_id() % slices)
    while True:
        rank = F.row_number().over(Window.partitionBy(*group, "_slice").orderBy(*order))
        cut = cut.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")
        if slices == 1:
            return cut.drop("_slice")
        slices = 1 if n <= threshold else slices // 16
        cut = cut.withColumn("_slice", F.col("_slice") % slices)
