"""Row upserts, deletes of missing rows and change reports, all null-safe on the keys."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerkit.operators.dedupe import latest_per_key, newest_order


def same_key(keys: Iterable[str], left: str = "t", right: str = "s") -> Column:
    return reduce(and_, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Iterable[str],
    order: Iterable[str] | None = None,
    settle: Iterable[str] | None = None,
) -> DataFrame:
    """Target with the source rows updated or inserted by key.

    With order the newest row of either side wins, so late and replayed batches
    are harmless. Without it the source always wins and must hold a key once.
    """
    keys = list(keys)
    if order is not None:
        return latest_per_key(target.unionByName(source), keys, order, settle)
    untouched = target.alias("t").join(source.alias("s"), same_key(keys), "left_anti")
    return untouched.unionByName(source)


def upsert_tracking(
    target: DataFrame,
    source: DataFrame,
    keys: Iterable[str],
    order: Iterable[str],
    track: Iterable[str],
    settle: Iterable[str] | None = None,
    cluster_by: str | None = None,
) -> DataFrame:
    """The ordered upsert, with what each key's row was before.

    Both sides must hold a key once. Adds `_before`, a struct of the tracked
    columns in the target (null for a new key), and `_sighted`, whether the
    source holds the key. With cluster_by, one of the keys, the rows meet in a
    single shuffle on that column and stay clustered by it.
    """
    keys, track = list(keys), list(track)
    tracked = target.select(F.struct(*track).alias("_before")).schema["_before"].dataType
    both = target.withColumns(
        {"_before": F.struct(*track), "_sighted": F.lit(False)}
    ).unionByName(
        source.withColumns({"_before": F.lit(None).cast(tracked), "_sighted": F.lit(True)})
    )
    if cluster_by is not None:
        both = both.repartition(cluster_by)
    newest_first = Window.partitionBy(*keys).orderBy(*newest_order(target, keys, order, settle))
    other = {c: F.lead(c).over(newest_first) for c in ("_before", "_sighted")}
    met = both.withColumns(
        {
            "_rank": F.row_number().over(newest_first),
            "_before": F.coalesce("_before", other["_before"]),
            "_sighted": F.col("_sighted") | F.coalesce(other["_sighted"], F.lit(False)),
        }
    )
    return met.filter(F.col("_rank") == 1).drop("_rank")


def split_by_source(
    target: DataFrame, source: DataFrame, keys: Iterable[str]
) -> tuple[DataFrame, DataFrame]:
    """Target rows whose key the source holds, and all others; Spark picks the joins by the source's size."""
    keys = list(keys)
    present = source.select(*keys).alias("s")
    rows = target.alias("t")
    return rows.join(present, same_key(keys), "left_semi"), rows.join(present, same_key(keys), "left_anti")


def delete_missing(target: DataFrame, source: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Target rows whose key is still in the source, a full snapshot.

    The source is reduced to distinct keys first, so a hot key reaches the join once.
    """
    keys = list(keys)
    present = source.select(*keys).distinct()
    return target.alias("t").join(present.alias("s"), same_key(keys), "left_semi")


def change_report(before: DataFrame, after: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Each key as inserted, updated, unchanged or deleted.

    Both sides must hold a key once. Only keys and a fingerprint of the row are
    shuffled; the null flags keep (null, 'a') and ('a', null) apart.
    """
    keys = list(keys)
    print_of = _print_of(after, keys)

    def narrow(df: DataFrame, side: str) -> DataFrame:
        other = "_after" if side == "_before" else "_before"
        return df.select(*keys, print_of.alias(side), F.lit(None).cast("bigint").alias(other))

    both = narrow(before, "_before").unionByName(narrow(after, "_after"))
    change = (
        F.when(F.col("_before").isNull(), "inserted")
        .when(F.col("_after").isNull(), "deleted")
        .when(F.col("_before") == F.col("_after"), "unchanged")
        .otherwise("updated")
    )
    merged = both.groupBy(*keys).agg(F.max("_before").alias("_before"), F.max("_after").alias("_after"))
    return merged.select(*keys, change.alias("change"))


def upsert_report(
    target: DataFrame, source: DataFrame, keys: Iterable[str], order: Iterable[str]
) -> DataFrame:
    """What the ordered upsert does to each key: inserted, updated or unchanged.

    Both sides must hold a key once, and its rows differ in the order columns.
    The upsert isn't built: keys, order columns and a fingerprint are shuffled
    once, and one aggregate finds the newer row of a key and what it replaces.
    """
    keys = list(keys)
    row = F.struct(*order, _print_of(target, keys).alias("_print"))
    both = target.select(*keys, row.alias("_row"), F.lit(True).alias("_old")).unionByName(
        source.select(*keys, row.alias("_row"), F.lit(False).alias("_old"))
    )
    met = both.groupBy(*keys).agg(
        F.max("_row").getField("_print").alias("_after"),
        F.max(F.when(F.col("_old"), F.col("_row").getField("_print"))).alias("_before"),
    )
    change = (
        F.when(F.col("_before").isNull(), "inserted")
        .when(F.col("_before") == F.col("_after"), "unchanged")
        .otherwise("updated")
    )
    return met.select(*keys, change.alias("change"))


def _print_of(df: DataFrame, keys: list[str]) -> Column:
    """Fingerprint of a row beside its keys; the null flags keep (null, 'a') and ('a', null) apart."""
    parts = [p for c in df.columns if c not in keys for p in (F.col(c), F.col(c).isNull())]
    return F.xxhash64(*parts) if parts else F.lit(0).cast("bigint")
