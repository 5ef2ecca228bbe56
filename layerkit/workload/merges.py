"""Upserts, change reports and aggregate maintenance over the whole raw log."""

from __future__ import annotations

from pyspark.sql import DataFrame

from layerkit import presets
from layerkit.operators.aggregate import (
    apply_delta,
    count_delta,
    group_count,
    latest_batch_count,
    replace_latest,
    tracked_delta,
)
from layerkit.operators.incremental import new_rows
from layerkit.operators.upsert import change_report, delete_missing, upsert, upsert_report, upsert_tracking
from layerkit.workload.inputs import BATCH, CUT, curated, plain, raw, written
from layerkit.workload.oracle import CLEAN, COUNTS, FIELDS, GROUPS, OLD_NEW, RAW_COLUMNS
from layerkit.workload.oracle import curated as curated_sql
from layerkit.workload.registry import query

KEYS = presets.CONTRACT.keys
ORDER = presets.CONTRACT.order
SAME_GROUP = " AND ".join(f"t.{g} IS NOT DISTINCT FROM s.{g}" for g in presets.GROUPS)


def old_and_new(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Clean rows of the log up to the cut, and of the batches after it."""
    rows = raw(spark, sf)
    late = rows[BATCH] > CUT
    return curated(rows.filter(rows[BATCH].isNull() | ~late)), curated(new_rows(rows, BATCH, CUT, True))


@query(f"WITH {CLEAN} SELECT {RAW_COLUMNS} FROM clean")
def merge_upsert_rows(spark, sf):
    old, new = old_and_new(spark, sf)
    return plain(upsert(old, new, KEYS, ORDER, settle=()))


@query(
    f"""WITH {OLD_NEW} SELECT {RAW_COLUMNS} FROM (
      SELECT * FROM old UNION ALL
      SELECT * FROM new t WHERE NOT EXISTS (SELECT 1 FROM old s WHERE t.id IS NOT DISTINCT FROM s.id))"""
)
def merge_source_wins(spark, sf):
    old, new = old_and_new(spark, sf)
    return plain(upsert(new, old, KEYS))


@query(
    f"""WITH {CLEAN}, agg AS ({COUNTS} FROM clean GROUP BY ALL),
    late AS ({COUNTS} FROM clean WHERE _ingestion_date = (SELECT max(_ingestion_date) FROM clean) GROUP BY ALL)
    SELECT * FROM late UNION ALL
    SELECT * FROM agg t WHERE NOT EXISTS (SELECT 1 FROM late s WHERE {SAME_GROUP})"""
)
def merge_upsert_groups(spark, sf):
    rows = written(curated(raw(spark, sf)).select(BATCH, *presets.GROUPS), "groups")
    totals = group_count(rows, presets.GROUPS, presets.MEASURE)
    late = latest_batch_count(rows, BATCH, presets.GROUPS, presets.MEASURE)
    return replace_latest(totals, late, presets.GROUPS)


@query(
    f"""WITH {OLD_NEW} SELECT {RAW_COLUMNS} FROM old t
    WHERE EXISTS (SELECT 1 FROM new s WHERE t.id IS NOT DISTINCT FROM s.id)"""
)
def merge_delete_missing(spark, sf):
    old, new = old_and_new(spark, sf)
    return plain(delete_missing(old, new, KEYS))


def _row(side: str) -> str:
    columns = [*FIELDS[1:], "_source", "_ingestion_ts", "_ingestion_date"]
    return f"row({', '.join(f'{side}.{c}' for c in columns)})"


@query(
    f"""WITH {OLD_NEW} SELECT CASE WHEN t._source IS NULL THEN s.id ELSE t.id END AS id,
      CASE WHEN t._source IS NULL THEN 'inserted' WHEN s._source IS NULL THEN 'deleted'
           WHEN {_row('t')} IS NOT DISTINCT FROM {_row('s')} THEN 'unchanged' ELSE 'updated' END AS change
    FROM old t FULL JOIN new s ON t.id IS NOT DISTINCT FROM s.id"""
)
def snapshot_change_report(spark, sf):
    old, new = old_and_new(spark, sf)
    return change_report(old, new, KEYS)


@query(
    f"""WITH {OLD_NEW},{curated_sql('clean', 'raw')}
    SELECT s.id, CASE WHEN t._source IS NULL THEN 'inserted'
           WHEN {_row('t')} IS NOT DISTINCT FROM {_row('s')} THEN 'unchanged' ELSE 'updated' END AS change
    FROM clean s LEFT JOIN old t ON t.id IS NOT DISTINCT FROM s.id"""
)
def merge_change_report(spark, sf):
    old, new = old_and_new(spark, sf)
    return upsert_report(old, new, KEYS, ORDER)


@query(f"WITH {CLEAN} {COUNTS} FROM clean GROUP BY ALL")
def agg_incremental_delta(spark, sf):
    old, new = [df.select(*KEYS, *ORDER, *presets.GROUPS) for df in old_and_new(spark, sf)]
    totals = group_count(old, presets.GROUPS, presets.MEASURE)
    merged = upsert_tracking(old, new, KEYS, ORDER, presets.GROUPS)
    delta = tracked_delta(merged, presets.GROUPS, presets.MEASURE)
    return apply_delta(totals, delta, presets.GROUPS, presets.MEASURE)


@query(
    f"""WITH {OLD_NEW}, d AS (
      SELECT {GROUPS}, 1 AS n FROM new UNION ALL SELECT {GROUPS}, -1 FROM old)
    SELECT {GROUPS}, CAST(sum(n) AS BIGINT) AS total_breweries FROM d GROUP BY ALL HAVING sum(n) <> 0"""
)
def agg_count_delta(spark, sf):
    old, new = old_and_new(spark, sf)
    return count_delta(old, new, presets.GROUPS, presets.MEASURE)


@query(f"WITH {OLD_NEW} {COUNTS} FROM new GROUP BY ALL")
def agg_delta_full_snapshot(spark, sf):
    old, new = [df.select(*KEYS, *ORDER, *presets.GROUPS) for df in old_and_new(spark, sf)]
    totals = group_count(old, presets.GROUPS, presets.MEASURE)
    merged = upsert_tracking(old, new, KEYS, ORDER, presets.GROUPS)
    delta = tracked_delta(merged, presets.GROUPS, presets.MEASURE, delete_missing=True)
    return apply_delta(totals, delta, presets.GROUPS, presets.MEASURE)
