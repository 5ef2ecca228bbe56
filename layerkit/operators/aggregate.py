"""Counts per group: full, for the latest batch, and kept up to date by signed deltas."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerkit.operators.incremental import latest_batch
from layerkit.operators.upsert import upsert


def group_count(df: DataFrame, groups: Iterable[str], measure: str) -> DataFrame:
    """Rows per group; null group values form groups of their own."""
    return df.groupBy(*groups).agg(F.count(F.lit(1)).alias(measure))


def latest_batch_count(df: DataFrame, batch: str, groups: Iterable[str], measure: str) -> DataFrame:
    return group_count(latest_batch(df, batch), groups, measure)


def replace_latest(totals: DataFrame, latest: DataFrame, groups: Iterable[str]) -> DataFrame:
    """Totals with the groups of the latest batch replaced by that batch's counts.

    Right only when every load is a full snapshot; count_delta is right always.
    """
    return upsert(totals, latest, groups)


def count_delta(
    before: DataFrame, after: DataFrame, groups: Iterable[str], measure: str
) -> DataFrame:
    """Change of each group's count when the rows `before` turn into `after`."""
    groups = list(groups)
    minus = before.select(*groups, F.lit(-1).cast("bigint").alias(measure))
    plus = after.select(*groups, F.lit(1).cast("bigint").alias(measure))
    return sum_delta(minus.unionByName(plus), groups, measure)


def tracked_delta(
    merged: DataFrame, groups: Iterable[str], measure: str, delete_missing: bool = False
) -> DataFrame:
    """Change of each group's count, read off an upsert that tracked the groups.

    Rows that kept their group give nothing. With delete_missing the rows whose
    key the source lacked count as gone.
    """
    groups = list(groups)
    after = F.struct(*groups)
    stays = F.col("_sighted") if delete_missing else F.lit(True)

    def signed(group: Column, sign: int) -> Column:
        members = [group.getField(g).alias(g) for g in groups]
        return F.struct(*members, F.lit(sign).cast("bigint").alias(measure))

    moved = merged.filter(~(stays & F.col("_before").eqNullSafe(after)))
    signs = F.array(
        F.when(F.col("_before").isNotNull(), signed(F.col("_before"), -1)),
        F.when(stays, signed(after, 1)),
    )
    rows = moved.select(F.explode(F.array_compact(signs)).alias("change")).select("change.*")
    return sum_delta(rows, groups, measure)


def sum_delta(signed: DataFrame, groups: Iterable[str], measure: str) -> DataFrame:
    """Signed rows summed per group, without the groups that did not change."""
    total = signed.groupBy(*groups).agg(F.sum(measure).alias(measure))
    return total.filter(F.col(measure) != 0)


def apply_delta(
    totals: DataFrame, delta: DataFrame, groups: Iterable[str], measure: str
) -> DataFrame:
    """Totals after the delta; groups that reach zero are dropped."""
    return sum_delta(totals.unionByName(delta), groups, measure)


def row_counts(df: DataFrame, batch: str) -> DataFrame:
    """Rows per batch."""
    return df.groupBy(batch).agg(F.count(F.lit(1)).alias("row_count"))
