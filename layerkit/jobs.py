"""Each task of a layered pipeline as a command, for any scheduler to run.

    spark-submit layerkit/jobs.py daily --schema lake --landing s3://in/2024-01-01
    python -m layerkit.jobs weekly --schema lake --landing ... --as-of 2024-01-08T00:00:00
"""

from __future__ import annotations

import argparse
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from layerkit.plans import layers as plans
from layerkit.session import configure
from layerkit.streaming.upsert import run_stream

TASKS = {
    "ingest": lambda s, l, a: plans.ingest(s, l, a.landing, a.as_of, replace_day=a.replace_day),
    "rebuild-clean": lambda s, l, a: plans.rebuild_clean(s, l),
    "rebuild-agg": lambda s, l, a: plans.rebuild_agg(s, l),
    "refresh": lambda s, l, a: plans.refresh(s, l, delete_missing=a.full_snapshots),
    "fold": lambda s, l, a: plans.fold_clean(s, l),
    "quality": lambda s, l, a: plans.run_quality(s, l, a.as_of, a.must_pass),
    "expire": lambda s, l, a: plans.expire_raw(s, l, a.as_of),
    "daily": lambda s, l, a: plans.run_daily(
        s, l, a.landing, a.as_of, a.replace_day, delete_missing=a.full_snapshots
    ),
    "weekly": lambda s, l, a: plans.run_weekly(s, l, a.landing, a.as_of, a.must_pass, a.replace_day),
    "stream": lambda s, l, a: run_stream(s, l, a.checkpoint),
}


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="layerkit")
    parser.add_argument("task", choices=sorted(TASKS))
    parser.add_argument("--schema", required=True)
    parser.add_argument("--landing", help="folder of landed pages")
    parser.add_argument("--source", default="pages")
    parser.add_argument("--checkpoint", help="stream checkpoint folder")
    parser.add_argument("--as-of", type=datetime.fromisoformat, default=datetime.now(timezone.utc))
    parser.add_argument("--clean-buckets", type=int, default=16)
    parser.add_argument("--agg-buckets", type=int, default=4)
    parser.add_argument("--full-snapshots", action="store_true", help="drop keys a load no longer has")
    parser.add_argument("--replace-day", action="store_true", help="put the load in place of its day's loads")
    parser.add_argument("--must-pass", action="store_true", help="fail the task when a check fails")
    args = parser.parse_args(argv)
    if args.task in ("ingest", "daily", "weekly") and not args.landing:
        parser.error(f"{args.task} needs --landing")
    if args.task == "stream" and not args.checkpoint:
        parser.error("stream needs --checkpoint")
    return args


def main(argv: list[str] | None = None, spark: SparkSession | None = None):
    args = parse(argv)
    spark = configure(spark or SparkSession.builder.appName(f"layerkit-{args.task}").getOrCreate())
    layers = plans.Layers(
        schema=args.schema,
        source=args.source,
        clean_buckets=args.clean_buckets,
        agg_buckets=args.agg_buckets,
        full_snapshots=args.full_snapshots,
    )
    return TASKS[args.task](spark, layers, args)


if __name__ == "__main__":
    main()
