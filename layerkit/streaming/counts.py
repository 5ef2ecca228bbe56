"""Counts per group kept up to date by a stream whose state is each key's place and group.

A row that is newer than what its key had gives minus one for the old group and
plus one for the new: the state that the micro-batch before left is read beside
the new one, and both meet in a join, so no key costs a call of its own. Each micro-batch writes its changes, summed, as a
partition of its own number; one that is replayed puts the same rows there
again. The total is the sum of all.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerkit.operators.aggregate import sum_delta, tracked_delta
from layerkit.operators.upsert import same_key
from layerkit.sources.tables import append, ensure_table, full_refresh

NUMBER = "_batch"
PLACE, BEFORE = "_place", "_place_before"


def newest_places(
    stream: DataFrame, keys: Iterable[str], order: Iterable[str], groups: Iterable[str]
) -> DataFrame:
    """The newest place (order and groups) of each key, as a streaming aggregate; null keys are one key.

    Its state is each key's place, and a micro-batch gives the keys it holds. A
    task cuts its rows to one per key before they are shuffled.
    """
    place = F.struct(*order, *[F.col(g).alias(f"_group_{g}") for g in groups])
    return stream.groupBy(*keys).agg(F.max(place).alias(PLACE))


def places_before(spark: SparkSession, checkpoint: str, number: int, keys: Iterable[str]) -> DataFrame | None:
    """Each key's place in the state that the micro-batch before this one left; none before the first."""
    if number == 0:
        return None
    state = spark.read.format("statestore").option("batchId", number - 1).load(checkpoint)
    (place,) = state.schema["value"].dataType.names  # of its only aggregate
    return state.select(*[F.col("key")[k].alias(k) for k in keys], F.col("value")[place].alias(BEFORE))


def group_changes(
    newest: DataFrame, before: DataFrame | None, keys: Iterable[str], groups: Iterable[str], measure: str
) -> DataFrame:
    """Signed rows (groups, measure) as the newest row of a key comes or moves."""
    groups = list(groups)
    if before is None:
        met = newest.withColumn(BEFORE, F.lit(None).cast(newest.schema[PLACE].dataType))
    else:
        met = newest.alias("t").join(before.alias("s"), same_key(keys), "left").select(PLACE, BEFORE)

    def group(place: str) -> Column:
        return F.when(F.col(place).isNotNull(), F.struct(*[F.col(place)[f"_group_{g}"].alias(g) for g in groups]))

    slim = met.select(group(PLACE).alias("_after"), group(BEFORE).alias("_before"))
    return tracked_delta(slim.select("_after.*", "_before"), groups, measure)


def stream_counts(
    spark: SparkSession,
    stream: DataFrame,
    table: str,
    checkpoint: str,
    keys: Iterable[str],
    order: Iterable[str],
    groups: Iterable[str],
    measure: str,
    timeout: int | None = None,
) -> None:
    """Take all that the stream has, then stop; counts(table) is what a recount of the newest rows would give."""
    keys, groups = list(keys), list(groups)
    schema = [T.StructField(g, T.StringType()) for g in groups] + [T.StructField(measure, T.LongType()), T.StructField(NUMBER, T.LongType())]
    ensure_table(spark, table, T.StructType(schema), [NUMBER])

    def write(newest: DataFrame, number: int) -> None:
        before = places_before(newest.sparkSession, checkpoint, number, keys)
        summed = group_changes(newest, before, keys, groups, measure).withColumn(NUMBER, F.lit(number).cast("bigint"))
        append(summed.coalesce(1), table, replace_partitions=True)

    query = (
        newest_places(stream, keys, order, groups).writeStream.outputMode("update").foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    try:
        if not query.awaitTermination(timeout) and timeout is not None:
            raise TimeoutError("the stream did not finish in time")
    finally:
        query.stop()


def counts(spark: SparkSession, table: str, groups: Iterable[str], measure: str) -> DataFrame:
    """Rows per group; groups without any are left out."""
    spark.catalog.refreshTable(table)
    return sum_delta(spark.table(table), groups, measure)


def fold_counts(spark: SparkSession, table: str, groups: Iterable[str], measure: str) -> None:
    """Sum up the changes of all micro-batches but the last, which may still be replayed."""
    rows = spark.table(table)
    last = rows.agg(F.max(NUMBER)).first()[0]
    if last is not None:
        old = sum_delta(rows.filter(F.col(NUMBER) < last), groups, measure).withColumn(NUMBER, F.lit(-1).cast("bigint"))
        full_refresh(old.unionByName(rows.filter(F.col(NUMBER) == last)), table, [NUMBER])
