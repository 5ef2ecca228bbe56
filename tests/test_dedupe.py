from pyspark.sql import functions as F

from layerkit.operators.dedupe import distinct_batches, duplicate_keys, latest_per_key
from tests.conftest import plan_of, rows


def test_latest_wins_within_and_across_days(edge):
    kept = {r["id"]: r["name"] for r in latest_per_key(edge, ["id"], ["day", "ts"]).collect()}
    assert kept["a"] == "newest"
    assert kept[None] == "n2"
    assert len(kept) == 6 and "" in kept


def test_columns_keep_their_order(edge):
    assert latest_per_key(edge, ["id"], ["day", "ts"]).columns == edge.columns


def test_ties_do_not_depend_on_partitioning(spark):
    tied = spark.createDataFrame([("k", 1, "x", None), ("k", 1, "y", None), ("k", 1, "y", 3)], "k string, o int, v string, w int")
    answers = {
        tuple(latest_per_key(tied.repartition(n), ["k"], ["o"]).first()) for n in (1, 2, 3)
    }
    assert answers == {("k", 1, "y", 3)}


def test_map_columns_are_carried(spark):
    df = spark.sql("SELECT 'k' AS k, 1 AS o, map('a', 1) AS m UNION ALL SELECT 'k', 2, map('b', 2)")
    assert latest_per_key(df, ["k"], ["o"]).first()["m"] == {"b": 2}


def test_rows_are_cut_before_the_one_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("o"))
    plan = plan_of(latest_per_key(df, ["k"], ["o"]))
    assert plan.count("Exchange") == 1
    assert plan.count("WindowGroupLimit") == 2


def test_hot_key(spark):
    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("o"))
    out = latest_per_key(df, ["k"], ["o"])
    assert out.count() == 20001
    assert out.filter("k = -1").first()["o"] == 29997


def test_duplicate_keys_group_nulls(edge):
    assert rows(duplicate_keys(edge, ["id"])) == [("a", 3), (None, 2)]


def test_distinct_batches_are_ordered_and_limited(edge):
    assert [r["day"] for r in distinct_batches(edge, "day").collect()] == [None, "2023-01-01", "2024-01-01", "2024-01-02", "junk"]
    assert distinct_batches(edge, "day", limit=2).count() == 2
