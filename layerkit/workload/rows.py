"""Projections, filters, dedupe, batches and column drift over the whole tables."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from layerkit import presets
from layerkit.contract import Contract, drift_report, missing_report
from layerkit.functions import predicates
from layerkit.functions.text import standardize, to_number
from layerkit.operators.aggregate import group_count, latest_batch_count, row_counts
from layerkit.operators.dedupe import distinct_batches, duplicate_keys, latest_per_key
from layerkit.operators.incremental import latest_batch, load_mark, loads_after, max_watermark, new_rows
from layerkit.operators.retention import keep_recent, retention_report
from layerkit.sources.pages import add_lineage
from layerkit.workload.inputs import BATCH, CUT, agg, clean, curated, plain, raw, table
from layerkit.workload.oracle import (
    AGG,
    CLEAN,
    COUNTS,
    IS_NEW,
    IS_OLD,
    RAW,
    RAW_COLUMNS,
    STANDARD,
    STAMP,
    GROUPS,
)
from layerkit.workload.oracle import curated as curated_sql
from layerkit.workload.registry import query

LOADED = datetime(2024, 1, 1, 6, 30)
RETAINED_FROM = date(2001, 8, 15)
VISIT = Contract.of_strings(["event_id", "user_id", "event_type", "props", "country"], ["event_id"])


@query(
    """SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id,
    event_type, props, CAST(NULL AS VARCHAR) AS country FROM events"""
)
def contract_project(spark, sf):
    return VISIT.project(table(spark, sf, "events"))


@query(
    """SELECT c_custkey, c_name, c_nationkey, c_mktsegment, 'crm' AS _source,
    '2024-01-01 06:30:00.000000' AS _ingestion_ts, '2024-01-01' AS _ingestion_date FROM customer""",
    name="add_lineage",
)
def add_lineage_columns(spark, sf):
    customer = table(spark, sf, "customer").drop("c_acctbal")
    return plain(add_lineage(customer, "crm", LOADED))


@query(f"WITH {RAW} SELECT {STANDARD.replace(', _ingestion_ts', ', ' + STAMP)} FROM raw")
def standardize_text(spark, sf):
    return plain(standardize(raw(spark, sf), presets.TEXT_FORMS))


@query(
    f"""WITH {RAW} SELECT id, latitude, try_cast(latitude AS DOUBLE) AS lat_num,
    longitude, try_cast(longitude AS DOUBLE) AS lon_num FROM raw"""
)
def parse_coordinates(spark, sf):
    parsed = {"lat_num": to_number("latitude"), "lon_num": to_number("longitude")}
    return raw(spark, sf).withColumns(parsed).select("id", "latitude", "lat_num", "longitude", "lon_num")


def _raw_filter(where: str) -> str:
    return f"WITH {RAW} SELECT {RAW_COLUMNS} FROM raw WHERE {where}"


def _clean_filter(where: str) -> str:
    return f"WITH {CLEAN} SELECT {RAW_COLUMNS} FROM clean WHERE {where}"


@query(_raw_filter("id IS NULL OR id = ''"))
def filter_null_or_blank(spark, sf):
    return plain(raw(spark, sf).filter(predicates.missing("id", blank=True)))


@query(_raw_filter("_ingestion_date IS NULL"))
def filter_null(spark, sf):
    return plain(raw(spark, sf).filter(predicates.missing(BATCH)))


@query(_clean_filter("latitude IS NOT NULL AND latitude <> '' AND try_cast(latitude AS DOUBLE) IS NULL"))
def filter_bad_cast(spark, sf):
    return plain(clean(spark, sf).filter(predicates.not_castable("latitude")))


@query(
    _clean_filter(
        """try_cast(latitude AS DOUBLE) < -90 OR try_cast(latitude AS DOUBLE) > 90
        OR try_cast(longitude AS DOUBLE) < -180 OR try_cast(longitude AS DOUBLE) > 180"""
    )
)
def filter_out_of_range(spark, sf):
    off = predicates.out_of_range("latitude", -90, 90) | predicates.out_of_range("longitude", -180, 180)
    return plain(clean(spark, sf).filter(off))


TYPE_LIST = ", ".join(f"'{t}'" for t in presets.TYPES)


@query(_clean_filter(f"brewery_type NOT IN ({TYPE_LIST})"))
def filter_not_in_set(spark, sf):
    return plain(clean(spark, sf).filter(predicates.not_in_set("brewery_type", presets.TYPES)))


@query(_raw_filter("country <> upper(country)"))
def filter_not_canonical(spark, sf):
    return plain(raw(spark, sf).filter(predicates.not_canonical("country", "upper")))


@query("SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal < 0")
def filter_negative(spark, sf):
    customer = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    return customer.filter(predicates.out_of_range("c_acctbal", low=0))


@query(
    f"""WITH {AGG} SELECT {GROUPS}, total_breweries FROM agg
    WHERE country IS NULL OR city IS NULL OR brewery_type IS NULL"""
)
def filter_any_key_null(spark, sf):
    return agg(spark, sf).filter(predicates.any_missing(["country", "city", "brewery_type"]))


@query(
    """SELECT l_orderkey, l_linenumber, count(*) AS "count" FROM lineitem
    GROUP BY ALL HAVING count(*) > 1""",
    name="duplicate_keys",
)
def duplicate_key_groups(spark, sf):
    return duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(f"WITH {CLEAN} SELECT {RAW_COLUMNS} FROM clean")
def dedup_latest(spark, sf):
    return plain(clean(spark, sf))


@query(
    """SELECT user_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, event_id, event_type, value, props
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS _n
          FROM events) WHERE _n = 1"""
)
def dedup_latest_event(spark, sf):
    events = table(spark, sf, "events")
    return plain(latest_per_key(events, ["user_id"], ["ts", "event_id"], settle=()))


@query(f"WITH {RAW},{curated_sql('clean', 'raw', IS_NEW)} SELECT {RAW_COLUMNS} FROM clean")
def dedup_batch(spark, sf):
    return plain(curated(new_rows(raw(spark, sf), BATCH, CUT, strict_day=True)))


@query(f"WITH {RAW} SELECT DISTINCT _ingestion_date FROM raw", name="distinct_batches")
def first_batches(spark, sf):
    return distinct_batches(raw(spark, sf), BATCH)


@query(f"WITH {RAW} SELECT _ingestion_date, count(*) AS row_count FROM raw GROUP BY ALL", name="row_counts")
def batch_row_counts(spark, sf):
    return row_counts(raw(spark, sf), BATCH)


@query(f"WITH {RAW} SELECT max(_ingestion_date) AS watermark FROM raw", name="max_watermark")
def watermark(spark, sf):
    return max_watermark(raw(spark, sf), BATCH)


@query(_raw_filter(f"_ingestion_date >= '{CUT}'"))
def incremental_new_rows(spark, sf):
    return plain(new_rows(raw(spark, sf), BATCH, CUT))


@query(_raw_filter(f"_ingestion_date > '{CUT}'"))
def incremental_new_rows_strict(spark, sf):
    return plain(new_rows(raw(spark, sf), BATCH, CUT, strict_day=True))


@query(
    f"""WITH {RAW}, seen AS (SELECT * FROM raw WHERE {IS_OLD}),
    mark AS (SELECT _ingestion_date AS day, max(_ingestion_ts) AS moment FROM seen
             WHERE _ingestion_date = (SELECT max(_ingestion_date) FROM seen) GROUP BY 1)
    SELECT {RAW_COLUMNS} FROM raw, mark
    WHERE _ingestion_date > day OR (_ingestion_date = day AND _ingestion_ts > moment)"""
)
def incremental_loads_after(spark, sf):
    """Rows past the newest load of the batches up to the cut."""
    rows = raw(spark, sf)
    mark = load_mark(rows.filter(F.col(BATCH) <= CUT), BATCH, "_ingestion_ts")
    return plain(loads_after(rows, BATCH, "_ingestion_ts", mark))


@query(_raw_filter("_ingestion_date = (SELECT max(_ingestion_date) FROM raw)"))
def latest_batch_rows(spark, sf):
    return plain(latest_batch(raw(spark, sf), BATCH))


@query(f"WITH {CLEAN} {COUNTS} FROM clean GROUP BY ALL")
def agg_full(spark, sf):
    return group_count(clean(spark, sf), presets.GROUPS, presets.MEASURE)


@query(
    f"""WITH {CLEAN} {COUNTS} FROM clean
    WHERE _ingestion_date = (SELECT max(_ingestion_date) FROM clean) GROUP BY ALL"""
)
def agg_latest_batch(spark, sf):
    return latest_batch_count(clean(spark, sf), BATCH, presets.GROUPS, presets.MEASURE)


@query(_raw_filter("coalesce(_ingestion_date >= '2001-06-16', true)"))
def retention_delete(spark, sf):
    return plain(keep_recent(raw(spark, sf), BATCH, RETAINED_FROM, presets.RETENTION_DAYS))


@query(
    f"""WITH {RAW} SELECT _ingestion_date, count(*) AS row_count,
    CASE WHEN _ingestion_date < '2001-06-16' THEN 'expired'
         WHEN _ingestion_date IS NULL THEN 'undated' ELSE 'kept' END AS fate
    FROM raw GROUP BY ALL""",
    name="retention_report",
)
def retention_counts(spark, sf):
    return retention_report(raw(spark, sf), BATCH, RETAINED_FROM, presets.RETENTION_DAYS)


@query(
    """SELECT 'ts' AS unexpected_column, count(ts) AS filled_rows FROM events
    UNION ALL SELECT 'value', count(value) FROM events"""
)
def schema_drift(spark, sf):
    return drift_report(table(spark, sf, "events"), VISIT)


@query("SELECT 'country' AS missing_column, count(*) AS affected_rows FROM events")
def schema_missing(spark, sf):
    return missing_report(table(spark, sf, "events"), VISIT.columns)


@query(f"WITH {CLEAN} SELECT {RAW_COLUMNS} FROM clean ORDER BY id NULLS FIRST LIMIT 20")
def preview_rows(spark, sf):
    return plain(clean(spark, sf).orderBy("id").limit(20))
