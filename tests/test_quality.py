import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from layerkit import presets
from layerkit.operators.sample import first_per_group
from layerkit.quality.evaluate import (
    check_layer,
    check_status,
    error_records,
    failing_rows,
    repeated_keys,
    verdict,
    verdicts,
)
from layerkit.quality.log import audit_rows, ensure_log_tables, error_rows, log
from layerkit.quality.monitor import check_trend, failures_with_samples, latest_failures, newest_errors
from layerkit.quality.rules import (
    Canonical,
    Castable,
    Expression,
    Fresh,
    HasColumns,
    InRange,
    InSet,
    MinRows,
    NoExtraColumns,
    NotMissing,
    Unique,
)
from tests.conftest import at, plan_of, rows

ROW_RULES = [
    NotMissing("has_id", ("id",), blank=True),
    NotMissing("has_name", ("name",)),
    Castable("numeric", ("lat",), shown_as={"lat": "lat_num"}),
    InRange("in_range", {"lat": (-90, 90)}),
    InSet("known", "type", ("micro", "large")),
    Canonical("lower", "type", "lower"),
]


def failed(df, rules, **kwargs):
    return {r["check_name"]: r["failed_rows"] for r in check_status(df, rules, "x", **kwargs).collect()}


def test_row_rules(edge):
    assert failed(edge, ROW_RULES) == {
        "has_id": 3, "has_name": 1, "numeric": 1, "in_range": 2, "known": 2, "lower": 1,
    }


def test_status_columns_and_totals(edge):
    row = check_status(edge, ROW_RULES[:1], "raw").first()
    assert row.asDict() == {
        "layer": "raw", "check_name": "has_id", "status": False, "failed_rows": 3, "total_rows": 9,
    }


def test_all_row_rules_share_one_scan(spark, edge, folder):
    edge.write.parquet(folder)
    df = spark.read.parquet(folder)
    assert plan_of(check_status(df, ROW_RULES, "x")).count("FileScan") == 1
    assert plan_of(check_status(df, [*ROW_RULES, Unique("u", ("id",))], "x")).count("FileScan") == 2
    assert plan_of(error_records(df, ROW_RULES, "x", ["id"])).count("FileScan") == 1
    scan = plan_of(check_status(df, ROW_RULES[:1], "x"))
    assert "ReadSchema: struct<id:string>" in scan


def test_unique_counts_repeated_keys(edge):
    assert failed(edge, [Unique("u", ("id",)), Unique("v", ("id", "day", "ts"))]) == {"u": 2, "v": 0}


def test_repeated_keys_can_be_shared(edge):
    rules = [Unique("u", ("id",)), Unique("v", ("id", "day", "ts")), NotMissing("n", ("name",))]
    shared = repeated_keys(edge, rules)
    assert set(shared) == {"u", "v"}
    assert rows(check_status(edge, rules, "x", repeated=shared)) == rows(check_status(edge, rules, "x"))
    again = error_records(edge, rules, "x", ["id"], repeated=shared)
    assert rows(again) == rows(error_records(edge, rules, "x", ["id"]))


def test_table_rules(edge):
    rules = [
        MinRows("filled", 1),
        MinRows("big", 100),
        NoExtraColumns("drift", ("id", "name", "type", "state", "lat", "day")),
        HasColumns("there", ("id", "absent")),
        Fresh("fresh", "day", date(2024, 1, 5), 3),
        Fresh("stale", "day", date(2024, 1, 5), 2),
    ]
    assert failed(edge, rules) == {"filled": 0, "big": 1, "drift": 1, "there": 1, "fresh": 0, "stale": 1}


def test_empty_table(edge):
    rules = [MinRows("filled", 1), Unique("u", ("id",)), HasColumns("there", ("absent",)), *ROW_RULES]
    counts = failed(edge.filter("false"), rules)
    assert counts.pop("filled") == 1 and counts.pop("there") == 1
    assert set(counts.values()) == {0}
    assert rows(verdict(check_status(edge.filter("false"), ROW_RULES, "x"))) == [(True,)]


def test_rule_on_an_absent_column_fails_instead_of_raising(edge):
    rules = [NotMissing("gone", ("absent",)), HasColumns("there", ("absent",))]
    status = {r["check_name"]: r["status"] for r in check_status(edge, rules, "x").collect()}
    assert status == {"gone": False, "there": False}
    assert [r["check_name"] for r in error_records(edge, rules, "x", ["id"]).collect()] == ["there"]


def test_status_by_batch(edge):
    by_day = check_status(edge, [NotMissing("has_id", ("id",)), Unique("u", ("id",))], "x", by="day")
    found = {(r["day"], r["check_name"]): r["failed_rows"] for r in by_day.collect()}
    assert found[("2024-01-02", "u")] == 1 and found[("2024-01-01", "has_id")] == 1
    assert len(found) == 10


def test_error_records_keep_nulls_and_show_evidence(edge):
    found = error_records(edge, ROW_RULES, "clean", ["id"]).collect()
    numeric = [json.loads(r["error_record"]) for r in found if r["check_name"] == "numeric"]
    assert numeric == [
        {"id": None, "name": "n1", "type": None, "state": None, "lat": "n/a", "day": "2024-01-01", "ts": 1, "lat_num": None}
    ]
    short = error_records(edge, [ROW_RULES[2]], "clean", ["id"], keep_nulls=False).first()["error_record"]
    assert "type" not in json.loads(short)


def test_error_records_stop_at_the_limit_in_key_order(spark):
    df = spark.range(500).select(F.col("id"), F.lit(None).cast("string").alias("v")).repartition(16)
    found = error_records(df, [NotMissing("v", ("v",))], "x", ["id"], limit=50).collect()
    assert sorted(json.loads(r["error_record"])["id"] for r in found) == list(range(50))


def test_error_records_of_keys_and_columns(edge):
    rules = [Unique("u", ("id",)), NoExtraColumns("drift", ("id",)), HasColumns("there", ("absent",))]
    found = [(r["check_name"], json.loads(r["error_record"])) for r in error_records(edge, rules, "x", ["id"]).collect()]
    assert ("u", {"id": None, "count": 2}) in found and ("u", {"id": "a", "count": 3}) in found
    assert ("drift", {"unexpected_column": "name"}) in found and ("there", {"missing_column": "absent"}) in found


def test_no_failures_give_no_records(edge):
    assert error_records(edge, [MinRows("filled")], "x", ["id"]).count() == 0


def test_cut_happens_before_the_shuffle(edge):
    plan = plan_of(error_records(edge, ROW_RULES, "x", ["id"]))
    assert plan.count("WindowGroupLimit") == 4


@pytest.fixture
def logs(spark, schema, edge):
    audit, errors = ensure_log_tables(spark, schema)
    for day, rules in ((8, ROW_RULES), (15, ROW_RULES[:1])):
        log(audit_rows(check_status(edge, rules, "clean"), at(day)), audit)
        log(error_rows(error_records(edge, rules, "clean", ["id"]), at(day)), errors)
    return spark.table(audit), spark.table(errors)


def test_logs_grow_and_keep_their_layout(spark, schema, logs):
    assert ensure_log_tables(spark, schema) == (f"{schema}.dq_audit", f"{schema}.dq_errors")
    audit, errors = logs
    assert audit.columns == ["layer", "check_name", "status", "timestamp", "details"]
    assert errors.columns == ["layer", "check_name", "error_record", "timestamp"]
    assert audit.count() == 7
    assert json.loads(audit.filter("check_name = 'known'").first()["details"]) == {"failed_rows": 2, "total_rows": 9}


def test_monitoring(logs):
    audit, errors = logs
    failures = latest_failures(audit).collect()
    assert len(failures) == 7 and failures[0]["check_name"] == "has_id"
    assert newest_errors(errors, 2).count() == 2
    assert newest_errors(errors).first()["timestamp"] >= errors.agg(F.max("timestamp")).first()[0]
    trend = {(r["check_name"], str(r["day"])): (r["pass_rate"], r["runs"]) for r in check_trend(audit).collect()}
    assert trend[("has_id", "2024-01-15")] == (0.0, 1)
    joined = failures_with_samples(audit, errors)
    assert joined.count() == errors.count()


def test_verdicts(edge):
    good = check_status(edge, [MinRows("filled")], "raw")
    both = good.unionByName(check_status(edge, ROW_RULES, "clean"))
    assert rows(verdicts(both)) == [("all", False), ("clean", False), ("raw", True)]
    assert rows(verdict(good)) == [(True,)]


def test_the_preset_has_all_checks():
    counts = [len(f()) for f in (presets.raw_rules, presets.clean_rules, presets.agg_rules)]
    assert counts == [6, 8, 4]


def test_check_layer_gives_verdict_status_and_failing_rows(edge):
    rules = [*ROW_RULES, Unique("u", ("id",)), NoExtraColumns("drift", ("id",)), MinRows("filled")]
    passed, checks, errors = check_layer(edge, rules)
    assert passed is False and checks["filled"] is True and checks["numeric"] is False
    assert set(errors) == set(checks) == {r.name for r in rules}
    assert errors["numeric"].columns == [*edge.columns, "lat_num"] and errors["numeric"].count() == 1
    assert rows(errors["u"]) == [("a", 3), (None, 2)]
    assert errors["drift"].columns == ["unexpected_column"] and errors["drift"].count() == 6
    assert errors["filled"].count() == 0
    assert check_layer(edge, [MinRows("filled")])[0] is True


def test_monitoring_questions_in_sql(spark, schema, logs):
    newest = spark.sql(f"SELECT * FROM {schema}.dq_audit WHERE status = false ORDER BY timestamp DESC")
    assert newest.count() == latest_failures(logs[0]).count()
    samples = f"SELECT layer, check_name, error_record, timestamp FROM {schema}.dq_errors"
    assert spark.sql(f"{samples} ORDER BY timestamp DESC LIMIT 100").count() == newest_errors(logs[1]).count()


@pytest.mark.parametrize("n", [3, 1500])
def test_first_rows_of_a_hot_group(spark, n):
    df = spark.range(9000).repartition(6).selectExpr("if(id % 9 = 0, 'b', 'a') as g", "id")
    got = first_per_group(df, ["g"], ["id"], n)
    want = {"a": [i for i in range(9000) if i % 9][:n], "b": list(range(0, 9000, 9))[:n]}
    found = got.collect()
    assert {g: sorted(r["id"] for r in found if r["g"] == g) for g in "ab"} == want
    assert got.columns == ["g", "id"]


def test_a_rule_from_an_expression(spark):
    df = spark.createDataFrame([("a", 1), ("b", None), (None, 9)], "k string, v int")
    rules = [Expression("big", "v > 5", ("v",)), Expression("fine", "v > 99"), Expression("lost", "w = 1", ("w",))]
    got = {r["check_name"]: (r["status"], r["failed_rows"]) for r in check_status(df, rules, "x").collect()}
    assert got == {"big": (False, 1), "fine": (True, 0), "lost": (False, 3)}
    assert failing_rows(df, rules[0]).count() == 1
