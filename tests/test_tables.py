import pytest
from pyspark.sql import functions as F

from layerkit.operators.aggregate import row_counts
from layerkit.operators.retention import expired, keep_recent, retention_report
from layerkit.quality.evaluate import check_status
from layerkit.quality.rules import InRange, NotMissing, Unique
from layerkit.session import scratch_dir
from layerkit.sources import tables
from layerkit.sources.tables import (
    BUCKET,
    KeyedTable,
    append,
    append_snapshot,
    batches,
    drop_batches,
    ensure_schema,
    ensure_table,
    full_refresh,
    gather,
    require_table,
    scan_snapshot,
)
from tests.conftest import at, plan_of, rows

DAY = at(31).date()


def test_ensure_is_idempotent_and_keeps_rows(spark, schema, edge):
    ensure_schema(spark, schema)
    for _ in range(2):
        ensure_table(spark, f"{schema}.t", edge.schema, ["day"])
        append(edge, f"{schema}.t")
    assert spark.table(f"{schema}.t").count() == 2 * edge.count()


def test_missing_table_says_what_to_run(spark, schema):
    with pytest.raises(LookupError, match="build it first"):
        require_table(spark, f"{schema}.nope", "build it first")


def test_append_goes_by_name_and_can_replace_a_batch(spark, schema, edge):
    name = f"{schema}.t"
    ensure_table(spark, name, edge.schema, ["day"])
    append(edge.select("day", *[c for c in edge.columns if c != "day"]), name)
    append(edge.filter("day = '2024-01-02' AND ts = 1"), name, replace_partitions=True)
    counts = dict(rows(row_counts(spark.table(name), "day")))
    assert counts == {"2024-01-01": 3, "2024-01-02": 2, "2023-01-01": 1, None: 1, "junk": 1}


def test_overwrite_is_refused_where_it_would_wipe_other_partitions(spark, schema, edge):
    name = f"{schema}.foreign"
    edge.write.partitionBy("day").saveAsTable(name)
    with pytest.raises(ValueError, match="partitionOverwriteMode"):
        append(edge.filter("day = 'junk'"), name, replace_partitions=True)
    with pytest.raises(ValueError, match="partitionOverwriteMode"):
        KeyedTable(name, ("id",), 4).write_buckets(KeyedTable(name, ("id",), 4).with_bucket(edge), [0])
    assert spark.table(name).count() == edge.count()


def test_rerun_of_a_day_replaces_its_folder_only(spark, edge, folder):
    append_snapshot(gather(edge, "day"), folder, "day")
    append_snapshot(edge.filter("day = '2024-01-02'").limit(1), folder, "day", replace_batch=True)
    assert scan_snapshot(spark, folder, edge.schema).count() == edge.count() - 2


def test_full_refresh_may_read_the_table_it_replaces(spark, schema, edge):
    name = f"{schema}.t"
    full_refresh(edge, name)
    full_refresh(spark.table(name).filter("id = 'a'"), name)
    assert spark.table(name).count() == 3


def test_full_refresh_replaces_the_schema(spark, schema, edge):
    name = f"{schema}.t"
    full_refresh(edge, name)
    full_refresh(spark.table(name).groupBy("id").count(), name, ["id"])
    assert spark.table(name).columns == ["count", "id"]
    assert not spark.catalog.tableExists(f"{name}__staged")


def test_failed_refresh_leaves_the_old_table(spark, schema, edge):
    name = f"{schema}.t"
    full_refresh(edge, name)
    with pytest.raises(Exception, match="boom"):
        full_refresh(edge.withColumn("ts", F.raise_error(F.lit("boom")).cast("int")), name)
    assert spark.table(name).count() == edge.count()


@pytest.fixture
def keyed(schema):
    return KeyedTable(f"{schema}.keyed", ("id",), 4)


def test_rebuild_replaces_all_rows_and_drops_emptied_buckets(spark, keyed):
    keyed.rebuild(spark.range(100).select(F.col("id").cast("string"), F.lit(1).alias("v")))
    assert keyed.read(spark).columns == ["id", "v"] and keyed.read(spark).count() == 100
    keyed.rebuild(keyed.read(spark).filter("id = '7'"))
    assert rows(keyed.read(spark)) == [("7", 1)]
    assert spark.sql(f"SHOW PARTITIONS {keyed.name}").count() == 1
    keyed.rebuild(keyed.read(spark).filter("false"))
    assert keyed.read(spark).count() == 0


def test_rebuild_takes_a_new_schema(spark, keyed):
    keyed.rebuild(spark.range(10).select(F.col("id").cast("string")))
    keyed.rebuild(keyed.read(spark).withColumn("extra", F.lit("x")))
    assert keyed.read(spark).columns == ["id", "extra"] and keyed.read(spark).count() == 10
    keyed.rebuild(keyed.read(spark).filter("id < '5'"))  # still replaceable in place
    assert keyed.read(spark).count() == 5


def test_only_touched_buckets_are_read_and_rewritten(spark, keyed):
    keyed.rebuild(spark.range(100).select(F.col("id").cast("string"), F.lit(1).alias("v")))
    one = keyed.slice(spark, [2])
    assert "PartitionFilters: [isnotnull(_bucket" in plan_of(one)
    size = one.count()
    before = {r["f"] for r in spark.table(keyed.name).select(F.input_file_name().alias("f")).distinct().collect()}
    keyed.write_buckets(one.withColumn("v", F.lit(2)).repartition(BUCKET), [2])
    after = {r["f"] for r in spark.table(keyed.name).select(F.input_file_name().alias("f")).distinct().collect()}
    assert len(before & after) == 3
    assert keyed.read(spark).filter("v = 2").count() == size


def test_null_keys_have_a_bucket(spark, keyed):
    keyed.rebuild(spark.createDataFrame([(None, 1), ("a", 2)], "id string, v int"))
    assert rows(keyed.read(spark)) == [("a", 2), (None, 1)]


def test_retention_keeps_undated_rows(edge):
    kept = keep_recent(edge, "day", DAY, 60)
    assert kept.count() == edge.count() - 1
    fate = {r["day"]: r["fate"] for r in retention_report(edge, "day", DAY, 60).collect()}
    assert fate == {
        "2023-01-01": "expired", "2024-01-01": "kept", "2024-01-02": "kept", None: "undated", "junk": "undated",
    }


def test_retention_drops_whole_batches(spark, schema, edge):
    name = f"{schema}.log"
    ensure_table(spark, name, edge.schema, ["day"])
    append(edge, name)
    gone = drop_batches(spark, name, "day", lambda b: b.filter(expired("day", DAY, 60)))
    assert gone == ["2023-01-01"]
    left = spark.table(name)
    assert rows(left) == rows(keep_recent(edge, "day", DAY, 60).select(left.columns))


def test_scratch_lies_in_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    place = scratch_dir(spark, "x")
    assert place.startswith(root if root else "/tmp/run-") and place != scratch_dir(spark, "x")


def test_checks_after_retention_equal_checks_on_the_kept_rows(spark, schema, edge):
    rules = [NotMissing("name", ("name",)), Unique("u", ("id", "day")), InRange("lat", {"lat": (-90, 90)})]
    name = f"{schema}.log"
    ensure_table(spark, name, edge.schema, ["day"])
    append(edge, name)
    drop_batches(spark, name, "day", lambda b: b.filter(expired("day", DAY, 60)))
    kept = keep_recent(edge, "day", DAY, 60)
    assert rows(check_status(spark.table(name), rules, "x")) == rows(check_status(kept, rules, "x"))


def test_a_refresh_that_cannot_write_leaves_the_old_table(spark, schema, edge):
    name = f"{schema}.t"
    full_refresh(edge, name)
    with pytest.raises(Exception, match="nowhere"):
        full_refresh(edge.limit(1), name, ["nowhere"])
    assert spark.table(name).count() == edge.count()


def test_a_refresh_that_broke_off_in_the_catalog_is_finished(spark, schema, edge, monkeypatch):
    name = f"{schema}.t"
    full_refresh(edge, name)
    with monkeypatch.context() as m:
        m.setattr(tables, "_point", lambda spark, name, *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            full_refresh(edge.filter("id = 'a'"), name, ["id"])
    spark.sql(f"DROP TABLE {name}")  # the worst moment
    assert require_table(spark, name, "").count() == 3
    assert spark.table(name).columns[-1] == "id"
    assert not spark.catalog.tableExists(f"{name}__next")


def test_batches_with_odd_names_are_dropped(spark, schema, edge):
    name = f"{schema}.odd"
    days = ["2024-01-01 10:00", "it's", "a+b%20c", "back\\slash", "keep"]
    frame = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "v int, day string")
    ensure_table(spark, name, frame.schema, ["day"])
    append(frame, name)
    assert {r["day"] for r in batches(spark, name, "day").collect()} == set(days)
    assert drop_batches(spark, name, "day", lambda b: b.filter("day != 'keep'")) == sorted(days[:-1])
    assert rows(spark.table(name)) == [(4, "keep")]
