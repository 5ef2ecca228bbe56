"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once to warm up and three times for its median. Results go to
the noop sink, so every row and column is computed. Next to the one-pass
operators stand the plain ways of doing the same (names ending in _plain):
one count per check, a recount instead of a delta, a rewrite instead of an
upsert. They are reported but not part of the total.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerkit import presets
from layerkit.operators.aggregate import group_count
from layerkit.operators.retention import expired
from layerkit.plans.layers import BATCH, Layers, append_load, create, expire_raw, merge_rows, rebuild_agg, rebuild_clean
from layerkit.quality.evaluate import check_status, error_records
from layerkit.quality.rules import RowRule, Unique
from layerkit.session import local_session, scratch_schema
from layerkit.sources.tables import batches
from layerkit.workload import QUERIES
from layerkit.workload.inputs import CUT, raw

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
ROUNDS = int(os.environ.get("BENCH_ROUNDS", "3"))

FROM_TABLES = [
    "agg_full",
    "dedup_latest",
    "standardize_text",
    "duplicate_keys",
    "merge_upsert_rows",
    "merge_change_report",
    "agg_incremental_delta",
    "dq_status_raw",
    "dq_status_clean",
    "dq_error_records",
    "dq_status_by_batch",
    "retention_delete",
    "load_json_pages",
]


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def median_of(run) -> float:
    run()
    times = []
    for _ in range(ROUNDS):
        start = time.perf_counter()
        run()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 3)


def status_plain(df: DataFrame, rules) -> None:
    """One count per check."""
    for rule in rules:
        if isinstance(rule, RowRule):
            df.filter(rule.fails()).count()
        elif isinstance(rule, Unique):
            df.groupBy(*rule.keys).count().filter("count > 1").count()
        else:
            df.count()


def merge_median(spark, early: DataFrame, late: DataFrame) -> float:
    """A merge of late rows into clean and agg built from the early ones, each time into a fresh copy."""
    times = []
    for _ in range(ROUNDS + 1):
        layers = Layers(schema=scratch_schema(spark, "merge"), clean_buckets=8, agg_buckets=2)
        create(spark, layers)
        append_load(layers, early)
        rebuild_clean(spark, layers)
        rebuild_agg(spark, layers)
        start = time.perf_counter()
        merge_rows(spark, layers, late)
        times.append(time.perf_counter() - start)
    return round(statistics.median(times[1:]), 3)


def main() -> None:
    spark = local_session("bench", CPUS)
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in FROM_TABLES:
        seconds[name] = median_of(lambda: consume(QUERIES[name](spark, SF_DIR)))

    layers = Layers(schema=scratch_schema(spark, "bench"), clean_buckets=8, agg_buckets=2)
    create(spark, layers)
    append_load(layers, raw(spark, SF_DIR))
    log = spark.table(layers.raw)
    late = F.coalesce(F.col(BATCH) > CUT, F.lit(False))
    newest = F.coalesce(F.col(BATCH) == batches(spark, layers.raw, BATCH).agg(F.max(BATCH)).first()[0], F.lit(False))

    seconds["table_rebuild_clean"] = median_of(lambda: rebuild_clean(spark, layers))
    seconds["table_rebuild_agg"] = median_of(lambda: rebuild_agg(spark, layers))
    seconds["table_merge_batches"] = merge_median(spark, log.filter(~late), log.filter(late))
    seconds["table_merge_one_batch"] = merge_median(spark, log.filter(~newest), log.filter(newest))
    clean = layers.clean.read(spark)
    raw_rules, clean_rules = presets.raw_rules(), presets.clean_rules()
    seconds["table_status_raw"] = median_of(lambda: consume(check_status(log, raw_rules, "raw")))
    seconds["table_status_clean"] = median_of(lambda: consume(check_status(clean, clean_rules, "clean")))
    seconds["table_errors_raw"] = median_of(lambda: consume(error_records(log, raw_rules, "raw", ["id", BATCH])))
    plain = {
        "table_status_raw_plain": median_of(lambda: status_plain(log, raw_rules)),
        "table_status_clean_plain": median_of(lambda: status_plain(clean, clean_rules)),
        "table_recount_plain": median_of(
            lambda: consume(group_count(clean, presets.GROUPS, presets.MEASURE))
        ),
        "table_retention_rewrite_plain": median_of(
            lambda: consume(log.filter(~F.coalesce(expired(BATCH, _newest(log), 60), F.lit(False))))
        ),
    }
    start = time.perf_counter()
    expire_raw(spark, layers, _newest_moment(log))
    seconds["table_retention"] = round(time.perf_counter() - start, 3)

    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {**seconds, **plain},
                "machine": f"{os.cpu_count()} CPUs, local[{CPUS}]",
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


def _newest_moment(log: DataFrame):
    return log.agg(F.max("_ingestion_ts")).first()[0]


def _newest(log: DataFrame):
    return _newest_moment(log).date()


if __name__ == "__main__":
    main()
