"""Quality checks, their logs and the monitoring questions, over the whole tables."""

from __future__ import annotations

from datetime import date, datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerkit import presets
from layerkit.operators.aggregate import group_count
from layerkit.quality.evaluate import check_status, error_records, failing_rows, verdict, verdicts
from layerkit.plans.layers import Layers, append_load, run_raw_checks
from layerkit.quality.log import audit_rows, ensure_log_tables, error_rows, log, log_once
from layerkit.quality.monitor import (
    check_trend as trend_of,
    failures_with_samples,
    latest_failures as failures_of,
    newest_errors,
)
from layerkit.quality.rules import Expression, Fresh
from layerkit.session import scratch_dir, scratch_schema
from layerkit.streaming.upsert import run_stream
from layerkit.workload.inputs import BATCH, CUT, agg, clean, curated, plain, raw, table, written
from layerkit.workload.oracle import AGG, CLEAN, RAW, RAW_COLUMNS
from layerkit.workload.registry import query

CHECKED_AT = datetime(2024, 1, 8, tzinfo=timezone.utc)
KEY_ORDER = ("id", BATCH)

CAST = """(latitude IS NOT NULL AND latitude <> '' AND try_cast(latitude AS DOUBLE) IS NULL)
 OR (longitude IS NOT NULL AND longitude <> '' AND try_cast(longitude AS DOUBLE) IS NULL)"""
RANGE = """try_cast(latitude AS DOUBLE) < -90 OR try_cast(latitude AS DOUBLE) > 90
 OR try_cast(longitude AS DOUBLE) < -180 OR try_cast(longitude AS DOUBLE) > 180"""
TYPE_LIST = ", ".join(f"'{t}'" for t in presets.TYPES)

RAW_TESTS = {
    "completeness_id": "id IS NULL OR id = ''",
    "completeness_name": "name IS NULL OR name = ''",
    "freshness_ingestion_date": "_ingestion_date IS NULL",
    "schema_drift": "false",
}
CLEAN_TESTS = {
    "completeness_name": "name IS NULL",
    "completeness_city": "city IS NULL",
    "completeness_country": "country IS NULL",
    "valid_geolocation_cast": CAST,
    "valid_geolocation_range": RANGE,
    "valid_brewery_type": f"brewery_type NOT IN ({TYPE_LIST})",
    "standardized_country_format": "country <> upper(country)",
}
AGG_TESTS = {
    "valid_positive_counts": "total_breweries < 0",
    "completeness_grouping_keys": "country IS NULL OR city IS NULL OR brewery_type IS NULL",
    "standardized_country_format": "country <> upper(country)",
    "structural_keys_present": "false",
}


def _counts(layer: str, tests: dict[str, str], source: str, by: str = "") -> list[str]:
    lead, group = (f"{by}, ", f" GROUP BY {by}") if by else ("", "")
    return [
        f"SELECT {lead}'{layer}' AS layer, '{name}' AS check_name, "
        f"count(*) FILTER (WHERE {test}) = 0 AS status, count(*) FILTER (WHERE {test}) AS failed_rows, "
        f"count(*) AS total_rows FROM {source}{group}"
        for name, test in tests.items()
    ]


def _repeats(layer: str, name: str, keys: str, source: str, by: str = "") -> str:
    lead, group = (f"{by}, ", f" GROUP BY {by}") if by else ("", "")
    return (
        f"SELECT {lead}'{layer}' AS layer, '{name}' AS check_name, "
        "count(*) FILTER (WHERE n > 1) = 0 AS status, count(*) FILTER (WHERE n > 1) AS failed_rows, "
        f"CAST(sum(n) AS BIGINT) AS total_rows FROM (SELECT {keys}, count(*) AS n FROM {source} "
        f"GROUP BY ALL){group}"
    )


def _raw_status(by: str = "") -> list[str]:
    lead, group = (f"{by}, ", f" GROUP BY {by}") if by else ("", "")
    return [
        *_counts("raw", RAW_TESTS, "raw", by),
        _repeats("raw", "uniqueness_id_snapshot", "id, _ingestion_date", "raw", by),
        f"SELECT {lead}'raw' AS layer, 'non_empty_batch' AS check_name, count(*) > 0 AS status, "
        f"CAST(CASE WHEN count(*) > 0 THEN 0 ELSE 1 END AS BIGINT) AS failed_rows, "
        f"count(*) AS total_rows FROM raw{group}",
    ]


RAW_STATUS = " UNION ALL ".join(_raw_status())
CLEAN_STATUS = " UNION ALL ".join(
    [*_counts("clean", CLEAN_TESTS, "clean"), _repeats("clean", "uniqueness_id", "id", "clean")]
)
AGG_STATUS = " UNION ALL ".join(_counts("agg", AGG_TESTS, "agg"))
ALL_STATUS = f"status AS ({RAW_STATUS} UNION ALL {CLEAN_STATUS} UNION ALL {AGG_STATUS})"


@query(f"WITH {RAW} {RAW_STATUS}")
def dq_status_raw(spark, sf):
    return check_status(raw(spark, sf), presets.raw_rules(), "raw")


@query(f"WITH {RAW} {RAW_STATUS}")
def dq_status_incremental(spark, sf):
    """The same from counts kept per batch: a first run over the early loads, a second over the late ones alone."""
    layers = Layers(schema=scratch_schema(spark, "states"), source="orders")
    rows = raw(spark, sf)
    late = F.coalesce(F.col(BATCH) > CUT, F.lit(False))
    for part in (rows.filter(~late), rows.filter(late)):
        append_load(layers, part)
        status = run_raw_checks(spark, layers)
    return status


@query(
    f"WITH {RAW}, s AS ({' UNION ALL '.join(_counts('raw', RAW_TESTS, 'raw'))}) "
    "SELECT check_name, failed_rows, total_rows FROM s"
)
def stream_audit(spark, sf):
    """Checks of every micro-batch of a stream, logged once also where a micro-batch is repeated, and summed up."""
    layers = Layers(schema=scratch_schema(spark, "audit"), source="orders")
    append_load(layers, raw(spark, sf))
    run_stream(spark, layers, scratch_dir(spark, "stream"), files_per_batch=40, audit_as="raw")
    log_rows = spark.table(f"{layers.schema}.dq_audit_runs")
    again = log_rows.filter("_run = 'raw-0'").drop("_run")
    log_once(again, f"{layers.schema}.dq_audit_runs", "raw-0")  # what a replay of the first one does
    counts = F.from_json("details", "failed_rows long, total_rows long")
    named = spark.table(f"{layers.schema}.dq_audit_runs").filter(F.col("check_name").isin(list(RAW_TESTS)))
    return named.select("check_name", counts.alias("c")).groupBy("check_name").agg(
        F.sum("c.failed_rows").alias("failed_rows"), F.sum("c.total_rows").alias("total_rows")
    )


@query(f"WITH {CLEAN} {CLEAN_STATUS}")
def dq_status_clean(spark, sf):
    return check_status(clean(spark, sf), presets.clean_rules(), "clean")


@query(f"WITH {AGG} {AGG_STATUS}")
def dq_status_agg(spark, sf):
    return check_status(agg(spark, sf), presets.agg_rules(), "agg")


def all_status(spark, sf) -> DataFrame:
    rows = written(raw(spark, sf), "raw")
    cleaned = written(curated(rows), "clean")
    counts = group_count(cleaned, presets.GROUPS, presets.MEASURE)
    parts = [
        check_status(rows, presets.raw_rules(), "raw"),
        check_status(cleaned, presets.clean_rules(), "clean"),
        check_status(counts, presets.agg_rules(), "agg"),
    ]
    return reduce(DataFrame.unionByName, parts)


@query(f"WITH {AGG}, {ALL_STATUS} SELECT bool_and(status) AS passed FROM status")
def dq_verdict(spark, sf):
    return verdict(all_status(spark, sf))


@query(
    f"""WITH {AGG}, {ALL_STATUS}
    SELECT coalesce(layer, 'all') AS layer, bool_and(status) AS passed FROM status GROUP BY ROLLUP (layer)"""
)
def dq_layer_verdicts(spark, sf):
    return verdicts(all_status(spark, sf))


@query(
    f"""WITH {AGG}, {ALL_STATUS}
    SELECT layer, check_name, status, '2024-01-08 00:00:00.000000' AS "timestamp",
    '{{"failed_rows":' || failed_rows || ',"total_rows":' || total_rows || '}}' AS details FROM status"""
)
def dq_audit_log(spark, sf):
    audit, _ = ensure_log_tables(spark, scratch_schema(spark, "audit"))
    log(audit_rows(all_status(spark, sf), CHECKED_AT), audit)
    return plain(spark.table(audit))


def _json(columns: list[str], extra: str = "") -> str:
    def value(column: str) -> str:
        if column == "_ingestion_ts":
            return "strftime(_ingestion_ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z'"
        return column

    pairs = ", ".join(f"'{c}', {value(c)}" for c in columns)
    return f"CAST(json_object({pairs}{extra}) AS VARCHAR)"


def _all_columns() -> list[str]:
    return presets.CONTRACT.raw_schema.names


PARSED = ", 'lat_num', try_cast(latitude AS DOUBLE), 'lon_num', try_cast(longitude AS DOUBLE)"


def _samples(layer: str, tests: dict[str, str], source: str, by: str = "") -> list[str]:
    lead = f"{by}, " if by else ""
    order = ", ".join(f"{c} NULLS FIRST" for c in [*KEY_ORDER, *_all_columns()])
    part = f"PARTITION BY {by} " if by else ""
    return [
        f"SELECT {lead}'{layer}' AS layer, '{name}' AS check_name, "
        f"{_json(_all_columns(), PARSED if name.startswith('valid_geo') else '')} AS error_record "
        f"FROM (SELECT *, row_number() OVER ({part}ORDER BY {order}) AS _n FROM {source} WHERE {test}) "
        "WHERE _n <= 50"
        for name, test in tests.items()
    ]


def _repeat_samples(layer: str, name: str, keys: list[str], source: str, by: str = "") -> str:
    lead, part = (f"{by}, ", f"PARTITION BY {by} ") if by else ("", "")
    order = ", ".join(f"{k} NULLS FIRST" for k in keys)
    pairs = ", ".join(f"'{k}', {k}" for k in [*keys, "count"])
    return (
        f"SELECT {lead}'{layer}' AS layer, '{name}' AS check_name, "
        f"CAST(json_object({pairs}) AS VARCHAR) AS error_record FROM ("
        f"SELECT *, row_number() OVER ({part}ORDER BY {order}) AS _n FROM ("
        f"""SELECT {', '.join(keys)}, count(*) AS "count" FROM {source} GROUP BY ALL HAVING count(*) > 1))"""
        " WHERE _n <= 50"
    )


def _raw_samples(by: str = "") -> str:
    keys = ["id", "_ingestion_date"]
    repeats = _repeat_samples("raw", "uniqueness_id_snapshot", keys, "raw", by)
    return " UNION ALL ".join([*_samples("raw", RAW_TESTS, "raw", by), repeats])


@query(f"WITH {CLEAN} " + " UNION ALL ".join(_samples("clean", CLEAN_TESTS, "clean")))
def dq_error_records(spark, sf):
    return error_records(clean(spark, sf), presets.clean_rules(), "clean", KEY_ORDER)


@query(
    f"""WITH {CLEAN} SELECT {RAW_COLUMNS}, try_cast(latitude AS DOUBLE) AS lat_num,
    try_cast(longitude AS DOUBLE) AS lon_num FROM clean WHERE {RANGE}"""
)
def dq_failing_rows(spark, sf):
    """Every row outside the coordinate range, whole and with its parsed values."""
    rule = next(r for r in presets.clean_rules() if r.name == "valid_geolocation_range")
    return plain(failing_rows(clean(spark, sf), rule))


@query(
    f"""WITH {RAW} SELECT id, _ingestion_date, count(*) AS "count" FROM raw
    GROUP BY ALL HAVING count(*) > 1"""
)
def dq_repeated_keys(spark, sf):
    rule = next(r for r in presets.raw_rules() if r.name == "uniqueness_id_snapshot")
    return failing_rows(raw(spark, sf), rule)


@query(f"WITH {RAW} {_raw_samples()}")
def dq_error_records_raw(spark, sf):
    return error_records(raw(spark, sf), presets.raw_rules(), "raw", KEY_ORDER)


# Every month of the raw log is one audited run; its load date is the moment of the run.
MOMENT = "_ingestion_date || ' 00:00:00.000000'"
AUDIT = f"""audit AS (
  SELECT layer, check_name, status, {MOMENT} AS "timestamp",
  '{{"failed_rows":' || failed_rows || ',"total_rows":' || total_rows || '}}' AS details
  FROM ({" UNION ALL ".join(_raw_status("_ingestion_date"))}))"""
ERRORS = f"""errors AS (
  SELECT layer, check_name, error_record, {MOMENT} AS "timestamp" FROM ({_raw_samples("_ingestion_date")}))"""


def audit_by_batch(spark, sf) -> DataFrame:
    status = check_status(raw(spark, sf), presets.raw_rules(), "raw", by=BATCH)
    return audit_rows(status, F.to_timestamp(BATCH))


def errors_by_batch(spark, sf) -> DataFrame:
    found = error_records(raw(spark, sf), presets.raw_rules(), "raw", KEY_ORDER, by=BATCH)
    return error_rows(found, F.to_timestamp(BATCH))


@query(f"WITH {RAW}, {AUDIT} SELECT * FROM audit")
def dq_status_by_batch(spark, sf):
    return plain(audit_by_batch(spark, sf))


@query(f"WITH {RAW}, {AUDIT} SELECT * FROM audit WHERE NOT status")
def latest_failures(spark, sf):
    return plain(failures_of(audit_by_batch(spark, sf)))


@query(
    f"""WITH {RAW}, {ERRORS} SELECT layer, check_name, error_record, "timestamp" FROM errors
    ORDER BY "timestamp" DESC NULLS LAST, layer, check_name, error_record LIMIT 100"""
)
def error_samples(spark, sf):
    return plain(newest_errors(errors_by_batch(spark, sf)))


@query(
    f"""WITH {RAW}, {AUDIT} SELECT layer, check_name, substr("timestamp", 1, 10) AS day,
    avg(CAST(status AS INTEGER)) AS pass_rate, count(*) AS runs FROM audit GROUP BY 1, 2, 3"""
)
def check_trend(spark, sf):
    return trend_of(audit_by_batch(spark, sf)).withColumn("day", F.col("day").cast("string"))


@query(
    f"""WITH {RAW}, {AUDIT}, {ERRORS}
    SELECT a.layer, a.check_name, a."timestamp", a.status, a.details, e.error_record
    FROM audit a LEFT JOIN errors e
      ON a.layer = e.layer AND a.check_name = e.check_name AND a."timestamp" = e."timestamp"
    WHERE NOT a.status"""
)
def failure_samples_join(spark, sf):
    return plain(failures_with_samples(audit_by_batch(spark, sf), errors_by_batch(spark, sf)))


LONG = "length(name) > 25 AND brewery_type IS NOT NULL"


@query(f"WITH {RAW} SELECT 'long_name' AS check_name, count(*) FILTER ({LONG}) = 0 AS status, count(*) FILTER ({LONG}) AS failed_rows FROM raw")
def dq_rule_expression(spark, sf):
    """A rule written as an SQL predicate."""
    rule = Expression("long_name", LONG, ("name", "brewery_type"))
    return check_status(raw(spark, sf), [rule], "raw").select("check_name", "status", "failed_rows")


@query(
    """WITH newest AS (SELECT max(strftime(o_orderdate, '%Y-%m-%d')) AS day, count(*) AS n FROM orders)
    SELECT 'fresh_' || age AS check_name,
           CAST(day AS DATE) >= DATE '2001-09-01' - CAST(age AS INTEGER) AS status FROM newest, (VALUES (1), (30), (36500)) v(age)"""
)
def dq_fresh(spark, sf):
    """Is the newest order at most so many days old?"""
    days = table(spark, sf, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))
    rules = [Fresh(f"fresh_{age}", "day", date(2001, 9, 1), age) for age in (1, 30, 36500)]
    return check_status(days, rules, "orders").select("check_name", "status")


@query(
    "SELECT layer, check_name, false AS status FROM (VALUES "
    + ", ".join(
        f"('{layer}', '{rule.name}')"
        for layer, rules in (("raw", presets.raw_rules()), ("clean", presets.clean_rules()), ("agg", presets.agg_rules()))
        for rule in rules
    )
    + ") v(layer, check_name) WHERE (SELECT count(*) FROM orders) > 0"
)
def dq_status_all_failing(spark, sf):
    """Every built-in check over the log, spoilt so that it fails."""
    rows = raw(spark, sf)
    twice = rows.unionByName(rows).withColumn("odd", F.lit(1))
    spoilt = clean(spark, sf).withColumns(
        {
            "country": F.when(F.col("country") == "ASIA", None).otherwise(F.lower("country")),
            "latitude": F.when(F.col("state") > "M", "x").otherwise("91"),
            "brewery_type": F.lit("other"),
            "city": F.lit(None).cast("string"),
        }
    )
    counts = agg(spark, sf).withColumns({"total_breweries": F.lit(-1).cast("long"), "country": F.lower("country")})
    none = rows.limit(0)
    empty = [r for r in presets.raw_rules() if r.name == "non_empty_batch"]
    others = [r for r in presets.raw_rules() if r.name != "non_empty_batch"]
    parts = [
        check_status(twice, others, "raw"),
        check_status(none, empty, "raw"),
        check_status(spoilt.unionByName(spoilt), presets.clean_rules(), "clean"),
        check_status(counts.drop("state_province"), presets.agg_rules(), "agg"),
    ]
    return reduce(DataFrame.unionByName, parts).select("layer", "check_name", "status")
