from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from layerkit.operators.aggregate import (
    apply_delta,
    count_delta,
    group_count,
    latest_batch_count,
    replace_latest,
    tracked_delta,
)
from layerkit.operators.dedupe import latest_per_key
from layerkit.operators.upsert import upsert_tracking
from tests.conftest import rows

DDL = "k string, o int, g string, h string"
GROUPS = ["g", "h"]


def test_null_groups_are_counted_once(spark):
    df = spark.createDataFrame([("a", 1, None, "x"), ("b", 1, None, "x"), ("c", 1, "g", None)], DDL)
    assert rows(group_count(df, GROUPS, "n")) == [("g", None, 1), (None, "x", 2)]


def test_replacing_the_latest_batch_keeps_one_row_per_null_group(spark):
    df = spark.createDataFrame([("a", 1, None, "x"), ("b", 2, None, "x"), ("c", 1, "g", "x")], DDL)
    totals = group_count(df, GROUPS, "n")
    latest = latest_batch_count(df, "o", GROUPS, "n")
    assert rows(replace_latest(totals, latest, GROUPS)) == [("g", "x", 1), (None, "x", 1)]


row = st.tuples(st.sampled_from([None, "a", "b", "c", "d"]), st.integers(0, 4), st.sampled_from([None, "g", "h"]), st.sampled_from([None, "x"]))


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(first=st.lists(row, max_size=10), second=st.lists(row, max_size=10), snapshot=st.booleans())
def test_delta_maintenance_equals_recount(spark, first, second, snapshot):
    old = latest_per_key(spark.createDataFrame(first, DDL), ["k"], ["o"])
    new = latest_per_key(spark.createDataFrame(second, DDL), ["k"], ["o"])
    merged = upsert_tracking(old, new, ["k"], ["o"], GROUPS)
    delta = tracked_delta(merged, GROUPS, "n", delete_missing=snapshot)
    totals = apply_delta(group_count(old, GROUPS, "n"), delta, GROUPS, "n")
    kept = merged.filter("_sighted") if snapshot else merged
    assert rows(totals) == rows(group_count(kept, GROUPS, "n"))


def test_unchanged_rows_give_no_delta_and_empty_groups_go(spark):
    old = spark.createDataFrame([("a", 1, "g", "x"), ("b", 1, "h", "x")], DDL)
    new = spark.createDataFrame([("a", 2, "g", "x"), ("b", 2, "g", "x")], DDL)
    delta = count_delta(old, new, GROUPS, "n")
    assert rows(delta) == [("g", "x", 1), ("h", "x", -1)]
    assert rows(apply_delta(group_count(old, GROUPS, "n"), delta, GROUPS, "n")) == [("g", "x", 2)]
