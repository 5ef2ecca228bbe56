from pyspark.sql import functions as F

from layerkit.operators.incremental import (
    latest_batch,
    load_mark,
    loads_after,
    max_watermark,
    new_rows,
    read_watermark,
)
from layerkit.sources.tables import append_snapshot, scan_snapshot
from tests.conftest import plan_of, rows


def test_watermark_of_an_empty_table_takes_everything(edge):
    empty = edge.filter("false")
    assert rows(max_watermark(empty, "day")) == [(None,)]
    assert new_rows(edge, "day", read_watermark(empty, "day")).count() == edge.count()


def test_same_day_reload_is_taken_unless_strict(edge):
    assert new_rows(edge, "day", "2024-01-02").filter("day <> 'junk'").count() == 3
    assert new_rows(edge, "day", "2024-01-02", strict_day=True).filter("day <> 'junk'").count() == 0


def test_loads_after_the_mark(spark, edge, folder):
    dated = edge.filter("day LIKE '2%'")
    mark = load_mark(dated.filter("ts = 1"), "day", "ts")
    assert mark == ("2024-01-02", 1)
    assert [r["name"] for r in loads_after(dated, "day", "ts", mark).collect()] == ["newest"]
    assert loads_after(dated, "day", "ts", ("2024-01-01", 5)).count() == 3
    assert loads_after(dated, "day", "ts", load_mark(dated.filter("false"), "day", "ts")).count() == 7
    stamped = dated.withColumn("ts", F.timestamp_seconds("ts"))
    assert load_mark(stamped, "day", "ts") == ("2024-01-02", 2_000_000)
    assert loads_after(stamped, "day", "ts", ("2024-01-02", 1_000_000)).count() == 1
    append_snapshot(dated, folder, "day")
    plan = plan_of(loads_after(scan_snapshot(spark, folder, edge.schema), "day", "ts", mark))
    assert plan.count("FileScan") == 2 and "GreaterThan(ts,1)" in plan
    assert plan.count("PartitionFilters: [isnotnull(day") == 2


def test_latest_batch(edge):
    dated = edge.filter("day LIKE '2%'")
    assert {r["day"] for r in latest_batch(dated, "day").collect()} == {"2024-01-02"}
    assert latest_batch(edge.filter("false"), "day").count() == 0


def test_new_rows_prune_folders(spark, edge, folder):
    append_snapshot(edge, folder, "day")
    log = scan_snapshot(spark, folder, edge.schema)
    plan = plan_of(new_rows(log, "day", "2024-01-02"))
    assert "PartitionFilters: [isnotnull(day" in plan and "PushedFilters: []" in plan
    assert rows(log) == rows(edge.select(log.columns))
