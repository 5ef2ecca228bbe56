"""Pages record by record, streams of pages, counts in stream state, and what is kept per batch or run."""

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from layerkit.contract import Contract
from layerkit.operators.aggregate import group_count
from layerkit.operators.dedupe import latest_per_key
from layerkit.plans import layers as plans
from layerkit.plans.layers import BATCH, Layers, create, ingest_batch, run_raw_checks
from layerkit.quality.evaluate import check_status
from layerkit.quality.log import audit_rows, ensure_run_table, log_once
from layerkit.quality.rules import Fresh, HasColumns, MinRows, NotMissing, Unique
from layerkit.quality.states import check_states, merged_status
from layerkit.sources.pages import CORRUPT, load_pages, split_records
from layerkit.sources.tables import append, ensure_table, expire_rows
from layerkit.streaming.counts import counts, fold_counts, stream_counts
from layerkit.streaming.upsert import audit_batch, stream_pages
from tests.conftest import at, plan_of, rows
from tests.test_layers import files_of, recount, state

AB = Contract.of_strings(["id", "b"], ["id"])


def split(spark, *pages):
    lines = spark.createDataFrame([(p,) for p in pages], "value string")
    return rows(split_records(lines, AB))


def test_a_broken_record_leaves_the_others(spark):
    good = [json.dumps({"id": str(i), "b": "}, {"}) for i in range(4)]
    page = f'[{good[0]}, {good[1]}, {{"id": "x",,}},\n {good[2]},{good[3]}]'
    found = split(spark, page)
    assert [r for r in found if r[2] is None] == [(str(i), "}, {", None) for i in range(4)]
    assert [r[2] for r in found if r[2] is not None] == ['{"id": "x",,}']


@pytest.mark.parametrize("page,expected", [
    ('[{"id": "9", "na', [(None, None, '[{"id": "9", "na')]),
    ('[{"id": 1.50, "b": -1e5}, {"id": "a 1, 2", "b": {"c": 1.50}}]', [("1.50", "-1e5", None), ("a 1, 2", '{"c":1.5}', None)]),
    ('[{"id": 12345678901234567890.12, "b": "x: 7,8"}, {"id": 1, "b": {"c": "}"}}, oops]', [(None, None, "[, , oops]"), ("1", '{"c":"}"}', None), ("12345678901234567890.12", "x: 7,8", None)]),
    ('{"id": 7, "odd": 1}', [("7", None, None)]),
    ("[1, null, \"x\", [2]]", [(None, None, "1"), (None, None, "[2]"), (None, None, "x")]),
    ("[]", []), ("  ", []), ("", []), (None, []),
    ("free text", [(None, None, "free text")]),
    ('{"id": 3', [(None, None, '{"id": 3')]),
    ('[{"id":"a"}{"id":"b"}]', [("a", None, None), ("b", None, None)]),
])
def test_pages_of_all_kinds(spark, page, expected):
    assert split(spark, page) == sorted(expected, key=repr)


def test_long_garbage_is_set_aside(spark):
    for text in ('[{"' * 50_000, '[{' + '"a",' * 200_000, "[" + '{"id":1,"b":"' + "\\\\" * 300_000, "[" + "{" * 100_000):
        found = split(spark, text)
        assert found and all(r[2] is not None for r in found)
    many = "[" + ",".join(['{"id":1}'] * 20_000) + ",{]"
    found = split(spark, many)
    assert len(found) == 20_001 and found.count(("1", None, None)) == 20_000


@pytest.fixture
def layers(schema):
    return Layers(schema=schema, clean_buckets=2, agg_buckets=1)


def test_pages_are_streamed_once(spark, layers, tmp_path, folder):
    landing = tmp_path / "in"
    landing.mkdir()
    (landing / "a.json").write_text('[{"id": "1", "name": "ann", "odd": 2}]\nbroken\n[{"id": "2", "name": "bob"},{]\n')
    stream_pages(spark, layers, str(landing), folder, clock=lambda: at(1))
    (landing / "b.json").write_text('[{"id": "1", "name": "zoe"}]')
    for _ in range(2):
        stream_pages(spark, layers, str(landing), folder, clock=lambda: at(2))
    assert {r["id"]: r["name"] for r in layers.clean.read(spark).collect()} == {"1": "Zoe", "2": "Bob"}
    assert state(spark, layers)[1] == recount(spark, layers)
    assert spark.table(layers.raw).count() == 3 and not plans.unmerged(spark, layers)
    assert {r[CORRUPT] for r in spark.table(layers.quarantine).collect()} == {"broken", "[,{]"}
    assert [r["unexpected_column"] for r in spark.table(layers.drift).collect()] == ["odd"]


def test_a_replayed_load_of_pages_is_not_appended_again(spark, layers, monkeypatch, tmp_path):
    (tmp_path / "a.json").write_text('[{"id": "1"}, {"id": 2,,}]')
    pages = load_pages(spark, str(tmp_path), layers.contract).persist()
    note = plans._note

    def crash(spark, layers, entries):
        if entries and entries[0][1] == "done":
            raise RuntimeError("lost")
        note(spark, layers, entries)

    with monkeypatch.context() as m:
        m.setattr(plans, "_note", crash)
        with pytest.raises(RuntimeError, match="lost"):
            ingest_batch(layers, pages, [str(tmp_path)], at(1), "s#0")
    for hour in (1, 2):
        ingest_batch(layers, pages, [str(tmp_path)], at(2, hour), "s#0")
    assert [r["_ingestion_ts"] for r in spark.table(layers.raw).collect()] == [spark.table(layers.raw).first()["_ingestion_ts"]]
    assert spark.table(layers.raw).first()[BATCH] == "2024-01-01"
    assert spark.table(layers.quarantine).count() == 1
    assert [r["row_count"] for r in plans.loads(spark, layers).collect()] == [1]


def test_rows_expire_inside_a_batch(spark, schema):
    name = f"{schema}.months"
    data = [(1, "2024-01-01", date(2024, 1, 5)), (2, "2024-02-01", date(2024, 2, 9)), (3, "2024-02-01", date(2024, 2, 10)),
            (4, "2024-03-01", date(2024, 3, 1)), (5, None, date(2020, 1, 1)), (6, "junk", date(2020, 1, 1)), (7, "2024-02-01", None)]
    frame = spark.createDataFrame(data, "id int, month string, day date")
    ensure_table(spark, name, frame.select("id", "day", "month").schema, ["month"])
    append(frame.coalesce(1), name)
    before = files_of(spark, name)
    assert expire_rows(spark, name, "month", F.col("day"), date(2024, 2, 10)) == {"dropped": ["2024-01-01"], "rewritten": ["2024-02-01"]}
    assert sorted(r["id"] for r in spark.table(name).collect()) == [3, 4, 5, 6, 7]
    assert {f for f in before if "2024-03" in f or "junk" in f or "DEFAULT" in f} <= files_of(spark, name)
    assert expire_rows(spark, name, "month", F.col("day"), date(2024, 2, 1)) == {"dropped": [], "rewritten": []}
    append(frame.filter("id = 4"), name)
    assert expire_rows(spark, name, "month", F.lit(date(2024, 3, 2)), date(2024, 3, 20))["rewritten"] == ["2024-03-01"]
    assert "2024-03-01" not in {r["month"] for r in spark.table(name).collect()}


RULES = [NotMissing("name", ("name",)), Unique("once", ("id", "day")), MinRows("some", 4), HasColumns("has", ("id", "gone")), NotMissing("gone", ("gone",))]


def test_states_merge_to_the_status_of_the_table(edge):
    states = check_states(edge, RULES, "x", "day")
    found = merged_status(states, RULES, "x", "day")
    assert rows(found) == rows(check_status(edge, RULES, "x"))
    none = merged_status(states.filter("false"), RULES[:3], "x", "day")
    assert {(r["check_name"], r["status"]) for r in none.collect()} == {("name", True), ("once", True), ("some", False)}
    fresh = [Fresh("new", "day", date(2024, 1, 5), 3)]
    assert rows(merged_status(check_states(edge, fresh, "x", "day"), fresh, "x", "day").select("status", "failed_rows")) == [(True, 0)]


def test_checks_that_span_batches_are_refused(edge):
    with pytest.raises(ValueError, match="spans batches"):
        check_states(edge, [Unique("u", ("id",))], "x", "day")
    with pytest.raises(ValueError, match="look at day"):
        check_states(edge, [Fresh("f", "ts", date(2024, 1, 5), 3)], "x", "day")


def test_a_run_of_checks_reads_new_batches_alone(spark, layers, monkeypatch):
    for day in (1, 2):
        plans.ingest_frame(layers, spark.createDataFrame([("1", "a"), (None, None)], "id string, name string"), at(day))
        run_raw_checks(spark, layers)
    plans.ingest_frame(layers, spark.createDataFrame([("1", None)], "id string, name string"), at(3))
    seen = []
    refresh = plans.refresh_states
    monkeypatch.setattr(plans, "refresh_states", lambda *a: (seen.append((a[3].filter(F.col(BATCH).isin(list(a[7]))), a[7])), refresh(*a)))
    status = run_raw_checks(spark, layers)
    assert seen[0][1] == {"2024-01-03"}
    assert {f.split("_ingestion_date=")[1][:10] for f in seen[0][0].inputFiles()} == {"2024-01-03"}
    assert rows(status) == rows(check_status(spark.table(layers.raw), layers.raw_rules(), "raw"))
    plans.expire_raw(spark, layers, at(31).replace(month=3))
    assert {r["total_rows"] for r in run_raw_checks(spark, layers).collect()} == {1} or spark.table(layers.raw).count() == 0


def test_a_repeated_run_adds_no_audit_row(spark, layers):
    create(spark, layers)
    table = ensure_run_table(spark, layers.schema)
    frame = plans.add_lineage(layers.contract.project(spark.createDataFrame([("1",)], "id string")), "s", at(1))
    for run in ("s-0", "s-1", "s-0"):
        audit_batch(layers, frame, run)
    found = spark.table(table)
    assert found.count() == 2 * len(layers.raw_rules()) and found.select("_run").distinct().count() == 2
    log_once(audit_rows(check_status(frame, layers.raw_rules()[:1], "raw"), at(1)), table, "s-1")
    assert spark.table(table).filter("_run = 's-1'").count() == 1


@pytest.mark.parametrize("per_batch", [1, 2, 50])
def test_counts_in_state_equal_a_recount(spark, schema, folder, edge, per_batch):
    """Any split into micro-batches, a restart between them, and sums folded in the meantime."""
    source, table = f"{folder}/in", f"{schema}.counts"
    groups = ["type", "state"]
    stamped = edge.withColumn("moment", F.timestamp_seconds("ts"))
    stamped = stamped.unionByName(stamped.filter("id = 'a'")).unionByName(
        stamped.filter("id = 'b'").withColumns({"state": F.lit("z"), "day": F.lit("2024-02-01")}))
    stamped = stamped.select("id", "day", "moment", *groups)

    def run():
        stream = spark.readStream.schema(stamped.schema).option("maxFilesPerTrigger", per_batch).parquet(source)
        stream_counts(spark, stream, table, f"{folder}/state", ["id"], ["day", "moment"], groups, "n")

    early = stamped.filter("day <= '2024-01-01' or day is null")
    early.repartition(3).write.parquet(source)
    run()
    if per_batch == 2:
        fold_counts(spark, table, groups, "n")
    stamped.filter("day > '2024-01-01'").repartition(2).write.mode("append").parquet(source)
    run()
    run()
    newest = latest_per_key(stamped, ["id"], ["day", "moment"], groups)
    assert rows(counts(spark, table, groups, "n")) == rows(group_count(newest, groups, "n"))
    if per_batch == 1:
        last = spark.table(table).agg(F.max("_batch")).first()[0]
        replay = spark.table(table).filter(F.col("_batch") == last)
        append(spark.createDataFrame(replay.collect(), replay.schema), table, True)
        assert rows(counts(spark, table, groups, "n")) == rows(group_count(newest, groups, "n"))


def test_counts_in_state_take_no_call_per_key(spark, schema, folder, monkeypatch):
    """Keys that come, move, go back, and stay: the state is Spark's own and a micro-batch writes what moved."""
    from pyspark.sql.group import GroupedData

    def refuse(*_, **__):
        raise AssertionError("a Python call per key")

    monkeypatch.setattr(GroupedData, "applyInPandasWithState", refuse)
    source, table = f"{folder}/in", f"{schema}.counts"
    loads = [
        [("a", "1", "x"), ("a", "0", "y"), ("b", "1", "x"), (None, "1", None), ("c", None, "y")],
        [("a", "2", "y"), ("b", "0", "y"), (None, "1", "x"), ("c", None, "y")],
        [("a", "3", "x"), ("d", "9", "z")],
    ]
    changes = [[(None, 1), ("x", 2), ("y", 1)], [(None, -1), ("y", 1)], [("x", 1), ("y", -1), ("z", 1)]]
    for number, load in enumerate(loads):
        frame = spark.createDataFrame(load, "id string, day string, kind string")
        frame.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(frame.schema).parquet(source)
        stream_counts(spark, stream, table, f"{folder}/state", ["id"], ["day"], ["kind"], "n")
        written = spark.table(table).filter(F.col("_batch") == number).select("kind", "n")
        assert rows(written) == sorted(changes[number], key=repr)
    assert rows(counts(spark, table, ["kind"], "n")) == [("x", 3), ("y", 1), ("z", 1)]


def test_a_stream_of_pages_merges_each_load_alone(spark, layers, monkeypatch, tmp_path, folder):
    """Loads of one day and moment: a micro-batch merges the rows it brought, not what the day has."""
    landing = tmp_path / "in"
    landing.mkdir()
    for n in range(4):
        page = json.dumps([{"id": str(10 * n + k), "name": "x"} for k in range(3)] + [{"id": "1", "name": f"n{n}"}])
        (landing / f"{n}.json").write_text(f"{page}\nbroken {n}\n")
    merged, merge = [], plans.merge_rows

    def watch(spark, layers, rows, *rest):
        merged.append(rows.count())
        merge(spark, layers, rows, *rest)

    monkeypatch.setattr(plans, "merge_rows", watch)
    stream_pages(spark, layers, str(landing), folder, files_per_batch=1, clock=lambda: at(1))
    assert merged == [4, 4, 4]  # the first builds clean
    assert not plans.unmerged(spark, layers)
    assert state(spark, layers)[1] == recount(spark, layers)
    assert rows(layers.clean.read(spark)) == rows(plans.curate(spark.table(layers.raw), layers))
    assert spark.table(layers.quarantine).count() == 4


def test_a_load_of_pages_that_broke_off_before_its_merge_is_merged(spark, layers, monkeypatch, tmp_path, folder):
    landing = tmp_path / "in"
    landing.mkdir()
    (landing / "a.json").write_text('[{"id": "1", "name": "ann"}]')
    stream_pages(spark, layers, str(landing), folder, clock=lambda: at(1))
    (landing / "b.json").write_text('[{"id": "1", "name": "zoe"}]\n[{"id": "2", "name": "bob"},{]')

    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(plans, "merge_rows", crash)
        with pytest.raises(Exception, match="lost"):
            stream_pages(spark, layers, str(landing), folder, clock=lambda: at(2))
    stream_pages(spark, layers, str(landing), folder, clock=lambda: at(3))
    assert {r["id"]: (r["name"], r[BATCH]) for r in layers.clean.read(spark).collect()} == {"1": ("Zoe", "2024-01-02"), "2": ("Bob", "2024-01-02")}
    assert spark.table(layers.raw).count() == 3 and not plans.unmerged(spark, layers)
    assert spark.table(layers.quarantine).count() == 1


def test_pages_are_landed_in_files_of_bounded_size(spark, tmp_path, folder, monkeypatch):
    from layerkit.workload import runs

    tables = {
        "region": [(1, "ASIA")], "nation": [(1, "CHINA", 1)], "customer": [(7, "c", 1, 1.0, "AUTO")],
        "orders": [(k * runs.PAGE, 7, "O", 2000.0, datetime(1995, 1, 1), "1-URGENT") for k in range(60)],
        "documents": [(k, f"free\ntext {k}", "en", "s", 5) for k in range(4)],
    }
    for name, data in tables.items():
        spark.createDataFrame(data, runs_schema(name)).repartition(2).write.parquet(f"{tmp_path}/{name}.parquet")
    monkeypatch.setattr(runs, "FILE_ROWS", 10)
    runs.land_in_files(spark, str(tmp_path), folder)
    lines = spark.read.text(folder).withColumn("file", F.input_file_name())
    counts = {r["file"]: r["count"] for r in lines.filter("value like '[%'").groupBy("file").count().collect()}
    assert len(counts) > 2 and sum(counts.values()) == 60
    assert lines.filter("value like 'free %'").count() == 4


def runs_schema(name):
    from layerkit.workload.inputs import SCHEMAS

    return SCHEMAS[name]
