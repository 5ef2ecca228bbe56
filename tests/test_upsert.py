from functools import reduce

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from layerkit.operators.dedupe import latest_per_key
from layerkit.operators.upsert import change_report, delete_missing, upsert, upsert_report, upsert_tracking
from tests.conftest import plan_of, rows

DDL = "k string, o int, v string"
KEYS, ORDER = ["k"], ["o"]


def frame(spark, data):
    return spark.createDataFrame(data, DDL)


def test_source_wins_without_order_and_null_keys_match(spark):
    target = frame(spark, [("a", 9, "old"), (None, 1, "old"), ("b", 1, "old")])
    source = frame(spark, [("a", 1, "new"), (None, 2, "new"), ("c", 1, "new")])
    expect = [("a", 1, "new"), ("b", 1, "old"), ("c", 1, "new"), (None, 2, "new")]
    assert rows(upsert(target, source, KEYS)) == expect


def test_newest_wins_with_order(spark):
    target = frame(spark, [("a", 9, "old"), (None, 1, "old")])
    source = frame(spark, [("a", 1, "late"), (None, 2, "new"), (None, 3, "newer")])
    assert rows(upsert(target, source, KEYS, ORDER)) == [("a", 9, "old"), (None, 3, "newer")]


def test_repeated_upsert_does_not_grow(spark):
    target = frame(spark, [(None, 1, "x"), ("a", 1, "x")])
    once = upsert(target, target, KEYS)
    assert rows(upsert(once, target, KEYS)) == rows(target)


row = st.tuples(st.sampled_from([None, "", "a", "b", "c"]), st.integers(0, 3), st.sampled_from([None, "x", "y"]))


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(data=st.lists(row, min_size=1, max_size=12), cuts=st.lists(st.integers(0, 12), max_size=3))
def test_any_split_into_batches_gives_the_same_table(spark, data, cuts):
    edges = [0, *sorted(min(c, len(data)) for c in cuts), len(data)]
    batches = [frame(spark, data[a:b]) for a, b in zip(edges, edges[1:])]
    batches.append(batches[0])  # a replay
    merged = reduce(lambda t, s: upsert(t, latest_per_key(s, KEYS, ORDER), KEYS, ORDER), batches)
    assert rows(merged) == rows(latest_per_key(frame(spark, data), KEYS, ORDER))


def test_tracking_tells_old_groups_and_sightings(spark):
    target = frame(spark, [("a", 1, "g1"), ("b", 1, None), ("d", 5, "g1")])
    source = frame(spark, [("a", 2, "g2"), ("c", 1, "g2"), ("d", 1, "g2")])
    out = {r["k"]: r for r in upsert_tracking(target, source, KEYS, ORDER, ["v"]).collect()}
    assert out["a"]["v"] == "g2" and out["a"]["_before"]["v"] == "g1" and out["a"]["_sighted"]
    assert out["b"]["_before"] is not None and out["b"]["_before"]["v"] is None and not out["b"]["_sighted"]
    assert out["c"]["_before"] is None
    assert out["d"]["v"] == "g1" and out["d"]["_sighted"]


def test_tracking_on_a_clustered_key_shuffles_once(spark):
    target, source = frame(spark, [("a", 1, "x")]), frame(spark, [("a", 2, "y")])
    plan = plan_of(upsert_tracking(target, source, ["o", "k"], ["v"], ["v"], cluster_by="k"))
    assert plan.count("Exchange") == 1


def test_delete_missing_is_null_safe(spark):
    target = frame(spark, [("a", 1, "x"), ("b", 1, "x"), (None, 1, "x")])
    source = frame(spark, [(None, 7, "z"), ("a", 7, "z"), ("a", 8, "z")])
    assert rows(delete_missing(target, source, KEYS)) == [("a", 1, "x"), (None, 1, "x")]


def test_change_report_compares_nulls_by_place(spark):
    before = spark.createDataFrame([("a", None, "x"), ("b", "x", None), ("c", "1", "1"), (None, "1", "1")], "k string, u string, v string")
    after = spark.createDataFrame([("a", "x", None), ("b", "x", None), ("d", "1", "1"), (None, "1", "2")], "k string, u string, v string")
    assert rows(change_report(before, after, KEYS)) == [
        ("a", "updated"), ("b", "unchanged"), ("c", "deleted"), ("d", "inserted"), (None, "updated"),
    ]


def test_upsert_report_says_what_the_upsert_does(spark):
    kind = "id string, v string, ts int"
    old = spark.createDataFrame([("a", "x", 1), ("b", "x", 5), ("c", None, 1), (None, "x", 1), ("k", "x", 1)], kind)
    new = spark.createDataFrame([("a", "y", 2), ("b", "y", 4), ("c", "x", 3), (None, "y", 2), ("n", "x", 1)], kind)
    got = upsert_report(old, new, ["id"], ["ts"])
    assert rows(got) == rows(change_report(old, upsert(old, new, ["id"], ["ts"]), ["id"]))
    assert dict(rows(got)) == {"a": "updated", "b": "unchanged", "c": "updated", None: "updated", "k": "unchanged", "n": "inserted"}
