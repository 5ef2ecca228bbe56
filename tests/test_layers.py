import json
from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from layerkit import presets
from layerkit.contract import Contract
from layerkit.operators.aggregate import group_count
from layerkit.plans import layers as plans
from layerkit.plans.layers import (
    BATCH,
    Layers,
    create,
    curate,
    ingest,
    ingest_frame,
    rebuild_agg,
    rebuild_clean,
    refresh,
    run_daily,
    run_quality,
    run_weekly,
)
from layerkit.quality.rules import MinRows, NotMissing
from layerkit.sources.tables import BUCKET, KeyedTable, append
from layerkit.streaming.upsert import run_stream
from tests.conftest import at, plan_of, rows

LOADS = [
    [{"id": "1", "name": "ann", "brewery_type": "MICRO", "city": "a b", "country": "x"},
     {"id": "2", "name": "bob", "brewery_type": "large", "city": "a b", "country": "x"},
     {"id": None, "name": "nobody", "country": "x"}],
    [{"id": "1", "name": "ann", "brewery_type": "closed", "city": "a b", "country": "x"},
     {"id": "3", "name": "cat", "brewery_type": "micro", "country": None},
     {"id": None, "name": "still nobody", "country": "x"}],
    [{"id": "2", "name": "bob", "brewery_type": "large", "city": "c", "country": "y", "odd": 1}],
]


@pytest.fixture
def layers(schema):
    return Layers(schema=schema, clean_buckets=4, agg_buckets=2)


@pytest.fixture
def landings(tmp_path):
    folders = []
    for i, load in enumerate(LOADS):
        folder = tmp_path / f"load{i}"
        folder.mkdir()
        (folder / "pages.json").write_text("\n".join(json.dumps([r]) for r in load))
        folders.append(str(folder))
    return folders


def state(spark, layers):
    return rows(layers.clean.read(spark)), rows(layers.agg.read(spark))


def recount(spark, layers):
    return rows(group_count(layers.clean.read(spark), layers.groups, layers.measure).select(layers.agg.read(spark).columns))


def test_daily_runs_equal_a_rebuild(spark, layers, landings):
    for i, folder in enumerate(landings):
        run_daily(spark, layers, folder, at(i + 1))
    daily = state(spark, layers)
    names = {r["id"]: r["name"] for r in layers.clean.read(spark).collect()}
    assert names == {"1": "Ann", "2": "Bob", "3": "Cat", None: "Still Nobody"}
    assert daily[1] == recount(spark, layers)
    rebuild_clean(spark, layers)
    rebuild_agg(spark, layers)
    assert state(spark, layers) == daily


def test_rerun_of_a_day_changes_nothing(spark, layers, landings):
    for i, folder in enumerate(landings[:2]):
        run_daily(spark, layers, folder, at(i + 1))
    before = state(spark, layers)
    for since in ("load", "day", "next_day"):
        refresh(spark, layers, since=since)
        assert state(spark, layers) == before
    with pytest.raises(ValueError, match="since"):
        refresh(spark, layers, since="ever")
    ingest(spark, layers, landings[1], at(2), replace_day=True)
    refresh(spark, layers, since="day")
    assert state(spark, layers) == before
    assert spark.table(layers.raw).count() == 6


def test_second_load_on_the_same_day_is_merged(spark, layers, landings):
    run_daily(spark, layers, landings[0], at(1, 1))
    run_daily(spark, layers, landings[1], at(1, 2))
    assert layers.clean.read(spark).filter("id = '1'").first()["brewery_type"] == "closed"
    run_daily(spark, layers, landings[2], at(1, 3), since="next_day")  # not a later day: not taken
    assert layers.clean.read(spark).filter("id = '2'").first()["country"] == "X"


def test_full_snapshots_can_delete(spark, layers, landings):
    run_daily(spark, layers, landings[0], at(1))
    run_daily(spark, layers, landings[1], at(2), delete_missing=True)
    assert {r["id"] for r in layers.clean.read(spark).collect()} == {"1", "3", None}
    assert state(spark, layers)[1] == recount(spark, layers)


def test_broken_pages_do_not_stop_the_load(spark, layers, landings, tmp_path):
    (tmp_path / "load0" / "more.json").write_text('[{"id": "9", "na')
    run_daily(spark, layers, landings[0], at(1))
    assert spark.table(layers.raw).count() == 3
    assert [r["_corrupt_record"] for r in spark.table(layers.quarantine).collect()] == ['[{"id": "9", "na']


def test_crash_between_the_two_writes_is_repaired(spark, layers, landings, monkeypatch):
    run_daily(spark, layers, landings[0], at(1))

    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(plans, "_apply", crash)
        with pytest.raises(RuntimeError, match="lost"):
            run_daily(spark, layers, landings[1], at(2))
    assert state(spark, layers)[1] != recount(spark, layers)
    refresh(spark, layers)
    assert state(spark, layers)[1] == recount(spark, layers)


def test_crash_before_the_first_write_is_harmless(spark, layers, landings, monkeypatch):
    run_daily(spark, layers, landings[0], at(1))
    with monkeypatch.context() as m:
        m.setattr(plans, "tracked_delta", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            run_daily(spark, layers, landings[1], at(2))
    refresh(spark, layers)
    assert state(spark, layers)[1] == recount(spark, layers)
    assert layers.clean.read(spark).filter("id = '1'").first()["brewery_type"] == "closed"


def test_crash_while_clean_is_moved_rebuilds_it(spark, layers, landings, monkeypatch):
    layers = replace(layers, fold_after=1)  # every merge is folded in at once
    run_daily(spark, layers, landings[0], at(1))
    moves = KeyedTable._overwrite

    def crash(table, placed, replaced):
        if table == layers.clean and replaced is not None:
            spark.sql(f"ALTER TABLE {table.name} DROP PARTITION ({BUCKET} = {min(replaced)})")
            raise RuntimeError("lost")
        return moves(table, placed, replaced)

    with monkeypatch.context() as m:
        m.setattr(KeyedTable, "_overwrite", crash)
        with pytest.raises(RuntimeError, match="lost"):
            run_daily(spark, layers, landings[1], at(2))
    assert not layers.clean.is_whole(spark)
    refresh(spark, layers)
    assert layers.clean.is_whole(spark) and layers.agg.is_whole(spark)
    assert rows(layers.clean.read(spark)) == rows(curate(spark.table(layers.raw), layers).select(layers.clean.read(spark).columns))
    assert state(spark, layers)[1] == recount(spark, layers)


def test_changed_bucket_number_asks_for_a_rebuild(spark, layers, landings):
    run_daily(spark, layers, landings[0], at(1))
    wider = replace(layers, clean_buckets=7)
    with pytest.raises(ValueError, match="rebuild it"):
        run_daily(spark, wider, landings[1], at(2))
    before = rows(layers.clean.read(spark).select("id"))
    rebuild_clean(spark, wider)
    rebuild_agg(spark, wider)
    assert len(rows(wider.clean.read(spark))) == len(before) + 1
    run_daily(spark, wider, landings[2], at(3))
    assert state(spark, wider)[1] == recount(spark, wider)


def test_null_keys_can_be_dropped(spark, layers, landings):
    strict = replace(layers, drop_null_keys=True)
    run_daily(spark, strict, landings[0], at(1))
    assert {r["id"] for r in strict.clean.read(spark).collect()} == {"1", "2"}


def test_any_frame_can_be_ingested(spark, layers):
    df = spark.createDataFrame([(1, "ann", 2.5, "z")], "id int, name string, latitude double, odd string")
    for _ in range(2):
        ingest_frame(layers, df, at(1), replace_day=True)
    row = spark.table(layers.raw).first()
    assert spark.table(layers.raw).count() == 1
    assert (row["id"], row["latitude"], row["city"], row[BATCH]) == ("1", "2.5", None, "2024-01-01")
    refresh(spark, layers)
    assert layers.clean.read(spark).first()["name"] == "Ann"


def test_agg_needs_clean(spark, layers):
    create(spark, layers)
    with pytest.raises(LookupError, match="rebuild_clean"):
        rebuild_agg(spark, layers)


def test_weekly_run_checks_and_expires(spark, layers, landings):
    for i, folder in enumerate(landings[:2]):
        ingest(spark, layers, folder, at(i + 1))
    assert run_weekly(spark, layers, landings[2], datetime(2024, 3, 2)) is False
    kept = {r[BATCH] for r in spark.table(layers.raw).select(BATCH).distinct().collect()}
    assert kept == {"2024-01-02", "2024-03-02"}
    audit = spark.table(f"{layers.schema}.dq_audit")
    assert audit.count() == 18
    status = {(r["layer"], r["check_name"]): r["status"] for r in audit.collect()}
    assert not status[("raw", "completeness_id")] and status[("clean", "uniqueness_id")]
    assert not status[("agg", "completeness_grouping_keys")]
    errors = spark.table(f"{layers.schema}.dq_errors")
    logged = {(r["layer"], r["check_name"]) for r in errors.collect()}
    assert logged == {key for key, ok in status.items() if not ok}


def test_failed_checks_can_stop_the_run(spark, layers, landings):
    run_daily(spark, layers, landings[0], at(1))
    with pytest.raises(RuntimeError, match="completeness_id"):
        run_quality(spark, layers, at(1), must_pass=True)
    easy = replace(layers, raw_rules=lambda: [MinRows("r")], clean_rules=lambda: [MinRows("c")], agg_rules=lambda: [MinRows("a")])
    assert run_quality(spark, easy, at(1), must_pass=True) is True


def test_stream_equals_batch_in_any_order(spark, layers, landings, folder):
    for i in (2, 0, 1):
        ingest(spark, layers, landings[i], at(i + 1))
        run_stream(spark, layers, folder, files_per_batch=1)
    streamed = state(spark, layers)
    assert streamed[1] == recount(spark, layers)
    rebuild_clean(spark, layers)
    rebuild_agg(spark, layers)
    assert state(spark, layers) == streamed


def test_stream_with_a_lost_checkpoint_replays_harmlessly(spark, layers, landings, folder):
    for i, landing in enumerate(landings):
        ingest(spark, layers, landing, at(i + 1))
    run_stream(spark, layers, f"{folder}/a")
    before = state(spark, layers)
    run_stream(spark, layers, f"{folder}/b")
    assert state(spark, layers) == before


def test_other_contracts_work_too(spark, schema):
    contract = Contract.of_strings(["a", "b", "v"], ["a", "b"])
    other = Layers(
        schema=schema, contract=contract, text_forms={"v": "upper"}, groups=("v",), measure="n",
        raw_rules=lambda: [NotMissing("a", ("a",))], clean_rules=lambda: [], agg_rules=lambda: [],
        clean_buckets=3, agg_buckets=1,
    )
    create(spark, other)
    data = [("1", "x", "p", 1), ("1", "x", "q", 2), ("1", "y", "p", 1)]
    for day in (1, 2):
        part = spark.createDataFrame([r[:3] for r in data if r[3] == day], contract.schema)
        append(part.withColumns({"_source": F.lit("s"), "_ingestion_ts": F.lit(at(day)), BATCH: F.lit(f"2024-01-0{day}")}), other.raw)
        refresh(spark, other)
    assert rows(other.agg.read(spark).select("v", "n")) == [("P", 1), ("Q", 1)]
    assert rows(curate(spark.table(other.raw), other).select("a", "b", "v")) == [("1", "x", "Q"), ("1", "y", "P")]
    assert presets.MEASURE != other.measure


def put(spark, layers, day, records, **options):
    """One load of (id, name) records, merged."""
    frame = spark.createDataFrame(records, "id string, name string")
    ingest_frame(layers, frame, at(day), **options)
    refresh(spark, layers)


def names(spark, layers):
    return {r["id"]: r["name"] for r in layers.clean.read(spark).collect()}


def test_ties_inside_a_load_are_settled_alike_by_stream_and_rebuild(spark, layers, folder):
    ingest_frame(layers, spark.createDataFrame([("1", "aaa", "B")], "id string, name string, city string"), at(1))
    more = spark.createDataFrame([("1", "bbb", "A")], "id string, name string, city string")
    append(plans.add_lineage(layers.contract.project(more), layers.source, at(1)), layers.raw)
    run_stream(spark, layers, folder, files_per_batch=1)
    streamed = state(spark, layers)
    rebuild_clean(spark, layers)
    rebuild_agg(spark, layers)
    assert state(spark, layers) == streamed


def test_agg_is_recounted_after_clean_alone_was_rebuilt(spark, layers, landings):
    run_daily(spark, layers, landings[0], at(1))
    ingest(spark, layers, landings[1], at(2))
    rebuild_clean(spark, layers)
    assert not layers.agg.is_whole(spark)
    refresh(spark, layers)
    assert state(spark, layers)[1] == recount(spark, layers)


def test_crash_while_clean_is_rebuilt_is_repaired(spark, layers, monkeypatch):
    put(spark, layers, 1, [(str(i), "a") for i in range(9)])
    before = state(spark, layers)

    def crash(table, placed, replaced):
        spark.sql(f"ALTER TABLE {table.name} DROP PARTITION ({BUCKET} = 1)")
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(KeyedTable, "_overwrite", crash)
        with pytest.raises(RuntimeError, match="lost"):
            rebuild_clean(spark, layers)
    assert not layers.clean.is_whole(spark)
    refresh(spark, layers)
    assert state(spark, layers) == before


def test_an_older_load_that_comes_late_is_merged(spark, layers):
    put(spark, layers, 5, [("1", "new")])
    put(spark, layers, 3, [("1", "old"), ("2", "old")])
    assert names(spark, layers) == {"1": "New", "2": "Old"}
    assert not plans.unmerged(spark, layers)


def test_a_load_is_taken_once_and_its_day_can_be_replaced(spark, layers):
    put(spark, layers, 1, [("1", "a"), ("2", "a")])
    put(spark, layers, 2, [("9", "wrong"), ("2", "b")])
    with pytest.raises(ValueError, match="replace_day"):
        put(spark, layers, 2, [("8", "right")])
    put(spark, layers, 2, [("8", "right")], replace_day=True)
    assert names(spark, layers) == {"1": "A", "2": "A", "8": "Right"}
    assert state(spark, layers)[1] == recount(spark, layers)
    assert spark.table(layers.raw).count() == 3


def test_keys_of_expired_loads_survive(spark, layers, monkeypatch):
    layers = replace(layers, fold_after=1)
    put(spark, layers, 1, [("1", "a"), ("2", "a")])
    put(spark, layers, 31, [("2", "b")])
    assert plans.expire_raw(spark, layers, datetime(2024, 3, 5)) == {"2024-01-01": 2}
    rebuild_clean(spark, layers)
    refresh(spark, layers)
    assert names(spark, layers) == {"1": "A", "2": "B"}
    # A merge that breaks off is finished from the rows written down before it.
    moves = KeyedTable._overwrite

    def crash(table, placed, replaced):
        if table == layers.clean:
            for bucket in sorted(replaced):
                spark.sql(f"ALTER TABLE {table.name} DROP IF EXISTS PARTITION ({BUCKET} = {bucket})")
            raise RuntimeError("lost")
        return moves(table, placed, replaced)

    ingest_frame(layers, spark.createDataFrame([("1", "c"), ("3", "c")], "id string, name string"), datetime(2024, 2, 2))
    with monkeypatch.context() as m:
        m.setattr(KeyedTable, "_overwrite", crash)
        with pytest.raises(RuntimeError, match="lost"):
            refresh(spark, layers)
    refresh(spark, layers)
    assert names(spark, layers) == {"1": "C", "2": "B", "3": "C"}
    assert state(spark, layers)[1] == recount(spark, layers)
    # Without rows to take over, a cut log is not enough, unless every load is a full snapshot.
    layers.clean.mark_whole(spark, False)
    with pytest.raises(RuntimeError, match="not whole"):
        refresh(spark, layers)
    refresh(spark, replace(layers, full_snapshots=True))
    assert names(spark, layers) == {"1": "C", "2": "B", "3": "C"}


def test_nothing_is_left_beside_the_tables(spark, layers):
    put(spark, layers, 1, [("1", "a")])
    put(spark, layers, 2, [("1", "b")])
    found = {t.name for t in spark.catalog.listTables(layers.schema)}
    assert found == {"raw", "raw_quarantine", "raw_drift", "raw_loads", "clean", "agg", "clean__loads", "clean__parts"}


def test_fields_outside_the_contract_fail_the_drift_check(spark, layers, landings):
    for i, folder in enumerate(landings[:2]):
        run_daily(spark, layers, folder, at(i + 1))
    run_quality(spark, layers, at(2))
    run_daily(spark, layers, landings[2], at(3))  # a field named odd
    run_quality(spark, layers, at(3))
    audit = spark.table(f"{layers.schema}.dq_audit").filter("check_name = 'schema_drift'")
    assert [r["status"] for r in audit.orderBy("timestamp").collect()] == [True, False]
    shown = spark.table(f"{layers.schema}.dq_errors").filter("check_name = 'schema_drift'").first()["error_record"]
    assert json.loads(shown) == {"unexpected_column": "odd"}
    assert [(r["unexpected_column"], r["filled_rows"]) for r in spark.table(layers.drift).collect()] == [("odd", "1")]


def test_the_audit_says_when_samples_were_cut(spark, layers):
    few = replace(layers, sample_rows=2)
    put(spark, few, 1, [(None, None), ("", "a"), (None, "b")])
    run_quality(spark, few, at(1))
    details = {r["check_name"]: json.loads(r["details"]) for r in spark.table(f"{layers.schema}.dq_audit").filter("layer = 'raw'").collect()}
    assert details["completeness_id"] == {"failed_rows": 3, "total_rows": 3, "logged_rows": 2}
    assert "logged_rows" not in details["completeness_name"]
    errors = spark.table(f"{layers.schema}.dq_errors").filter("layer = 'raw' and check_name = 'completeness_id'")
    assert errors.count() == 2


def files_of(spark, name):
    return {r["f"] for r in spark.table(name).select(F.input_file_name().alias("f")).distinct().collect()}


def many(n, name="a", city="x"):
    return [(str(i), name, city) for i in range(n)]


def put_cities(spark, layers, day, records):
    ingest_frame(layers, spark.createDataFrame(records, "id string, name string, city string"), at(day))
    refresh(spark, layers)


def test_a_merge_leaves_the_base_alone(spark, layers):
    put_cities(spark, layers, 1, many(3000))
    before, all_rows = files_of(spark, layers.clean.name), state(spark, layers)
    put_cities(spark, layers, 2, [(str(30 * i), "b", "y" if i % 2 else "x") for i in range(100)])
    assert files_of(spark, layers.clean.name) == before
    assert spark.table(layers.clean.parts).count() == 100
    merged = state(spark, layers)
    assert merged != all_rows and len(merged[0]) == 3000 and merged[1] == recount(spark, layers)
    plans.fold_clean(spark, layers)
    assert layers.clean.part_numbers(spark) == [] and files_of(spark, layers.clean.name) != before
    assert state(spark, layers) == merged
    rebuild_clean(spark, layers)
    rebuild_agg(spark, layers)
    assert state(spark, layers) == merged


def test_rows_that_change_nothing_are_not_written(spark, layers):
    put_cities(spark, layers, 2, many(20))
    put_cities(spark, layers, 1, many(20, "older", "z"))  # late, and beaten by what is there
    assert not layers.clean.part_numbers(spark)
    plans.merge_rows(spark, layers, spark.table(layers.raw))  # a replay
    assert rows(layers.clean.changed(spark)) == []
    assert state(spark, layers)[1] == recount(spark, layers)


def test_many_merges_are_folded_in(spark, layers):
    few = replace(layers, fold_after=2)
    put_cities(spark, few, 1, many(40))
    for day in range(2, 6):
        put_cities(spark, few, day, [(str(i), f"n{day}", f"c{day}") for i in range(day, 40, day)] + [(None, "x", "y")])
        assert len(few.clean.part_numbers(spark)) < 2
        assert state(spark, few)[1] == recount(spark, few)
    daily = state(spark, few)
    rebuild_clean(spark, few)
    rebuild_agg(spark, few)
    assert state(spark, few) == daily


def test_a_refresh_reads_the_batches_it_merges_alone(spark, layers, monkeypatch):
    for day in (1, 2, 3):
        put_cities(spark, layers, day, many(30, f"n{day}"))
    ingest_frame(layers, spark.createDataFrame(many(3, "late"), "id string, name string, city string"), at(4))
    seen = []
    merge = plans.merge_rows
    monkeypatch.setattr(plans, "merge_rows", lambda s, l, r, d=False: (seen.append(r), merge(s, l, r, d)))
    monkeypatch.setattr(plans, "row_counts", lambda *_: 1 / 0)
    refresh(spark, layers)
    assert {f.split("_ingestion_date=")[1][:10] for f in seen[0].inputFiles()} == {"2024-01-04"}
    assert "PartitionFilters: [isnotnull(_ingestion_date" in plan_of(seen[0])
    seen.clear()
    refresh(spark, layers)
    assert not seen


def test_loads_that_broke_off_are_not_lost(spark, layers, monkeypatch):
    put(spark, layers, 1, [("1", "a")])
    note = plans._note

    def crash(spark, layers, entries):
        if entries[0][1] == "done":
            raise RuntimeError("lost")
        note(spark, layers, entries)

    with monkeypatch.context() as m:
        m.setattr(plans, "_note", crash)
        with pytest.raises(RuntimeError, match="lost"):
            ingest_frame(layers, spark.createDataFrame([("2", "b")], "id string, name string"), at(1, 5))
    refresh(spark, layers)  # the same day as a load merged before, and in raw
    assert names(spark, layers) == {"1": "A", "2": "B"}
    assert plans.expire_raw(spark, layers, datetime(2024, 5, 1)) == {"2024-01-01": 2}


def test_expired_rows_are_told_without_reading_them(spark, layers, monkeypatch):
    for day in (1, 2):
        put(spark, layers, day, [("1", "a"), ("2", "a")])
    monkeypatch.setattr(plans, "row_counts", lambda *_: 1 / 0)
    assert plans.expire_raw(spark, layers, datetime(2024, 3, 2)) == {"2024-01-01": 2}
    put(spark, layers, 1, [("3", "a")])  # the day comes back, later
    assert plans.expire_raw(spark, layers, datetime(2024, 3, 3)) == {"2024-01-01": 1, "2024-01-02": 2}


def test_a_load_that_comes_while_a_crashed_rebuild_waits_is_merged(spark, layers, monkeypatch):
    put(spark, layers, 1, [("1", "a")])
    put(spark, layers, 31, [("2", "a")])
    plans.expire_raw(spark, layers, datetime(2024, 3, 5))

    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(type(layers.clean), "rebuild", crash)
        with pytest.raises(RuntimeError, match="lost"):
            rebuild_clean(spark, layers)
    layers.clean.mark_whole(spark, False)
    ingest_frame(layers, spark.createDataFrame([("3", "b")], "id string, name string"), datetime(2024, 2, 5))
    refresh(spark, layers)
    refresh(spark, layers)
    assert names(spark, layers) == {"1": "A", "2": "A", "3": "B"}
    assert not plans.unmerged(spark, layers) and state(spark, layers)[1] == recount(spark, layers)


def test_parts_are_read_by_their_numbers(spark, layers):
    """A part holds newer rows than those before it, so no other column is read to tell the newest."""
    columns = "id string, name string, country string, phone string"
    for day, row in enumerate([("1", "a", "x", "9"), ("1", "b", "y", "8"), ("1", "c", "y", "1")], 1):
        plans.ingest_frame(layers, spark.createDataFrame([row, (str(day + 1), "n", "z", None)], columns), at(day))
        plans.refresh(spark, layers)
    assert layers.clean.part_numbers(spark) == [1, 2]
    plan = plan_of(layers.clean.changed(spark).select("id", "country"))
    assert "phone" not in plan and "website_url" not in plan
    assert {r["id"]: r["name"] for r in layers.clean.read(spark).collect()} == {"1": "C", "2": "N", "3": "N", "4": "N"}


def test_rows_that_tie_are_settled_by_the_other_columns(spark, layers):
    """Loads of one moment whose rows agree in order and groups: the larger rest wins, null is the smallest."""
    columns = "id string, name string, phone string"
    data = [[("1", "a", None), ("2", "b", "5"), ("3", "c", "5"), (None, "d", None)],
            [("1", "a", "1"), ("2", "b", "4"), ("3", "c", "5"), (None, "d", "2")],
            [("1", "a", None), ("2", "b", "6"), ("3", None, "9"), (None, "c", "3")]]
    create(spark, layers)
    plans.refresh(spark, layers)
    for load in data:
        rows_ = plans.add_lineage(layers.contract.project(spark.createDataFrame(load, columns)), "s", at(1))
        plans.append_load(layers, rows_)
        plans.refresh(spark, layers)
    found = {r["id"]: (r["name"], r["phone"]) for r in layers.clean.read(spark).collect()}
    assert found == {"1": ("A", "1"), "2": ("B", "6"), "3": ("C", "5"), None: ("D", "2")}
    assert rows(layers.clean.read(spark)) == rows(plans.curate(spark.table(layers.raw), layers))
