"""Hard negatives against brute force."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from layerkit.llm import hard_negatives as module
from layerkit.llm.hard_negatives import hard_negatives
from layerkit.llm.queries import ORACLES, QUERIES
from tests.oracle import connect, difference

DDL = "vec_id long, embedding array<double>, label int"
LAST = 1 << 62


def brute(rows, anchors, most=(5, 3)):
    """Every pair by plain integers."""
    kept = [
        (i, [math.floor(256 * x) for x in v], label)
        for i, v, label in rows
        if v is not None and label is not None and all(x is not None and math.isfinite(x) for x in v)
    ]

    def first(pairs, n):
        return sorted(pairs, key=lambda p: (-p[0], LAST if p[1] is None else p[1]))[:n]

    out = []
    for a, (i, v, label) in enumerate(kept):
        if not anchors(i):
            continue
        scored = [
            (sum(x * y for x, y in zip(v, w, strict=True)), j, other)
            for b, (j, w, other) in enumerate(kept)
            if b != a and len(w) == len(v)
        ]
        for score, j, _ in first([p for p in scored if p[2] == label], most[0]):
            fit = [p for p in scored if p[2] != label and 50 * score <= 100 * p[0] <= 95 * score]
            out += [(i, j, k + 1, n, score, s) for k, (s, n, _) in enumerate(first(fit, most[1]))]
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def mined(vectors, by=5, **options):
    return found(hard_negatives(vectors, F.col("vec_id") % by == 0, F.col("label"), **options))


def every(by):
    return lambda i: i is not None and i % by == 0


@pytest.mark.parametrize("kind", ["sphere", "lengths", "sparse", "ties", "one label for most"])
def test_brute_force(spark, kind):
    rng = np.random.default_rng(len(kind))
    n, dim = 300, 8
    x = rng.normal(size=(n, dim))
    if kind == "lengths":
        x *= rng.lognormal(0, 1.5, size=(n, 1))
    if kind == "sparse":
        x *= rng.random((n, dim)) < 0.25
    if kind == "ties":
        x = rng.integers(-2, 3, size=(n, dim)) / 256
    label = rng.integers(0, 4, n) if kind != "one label for most" else np.where(rng.random(n) < 0.8, 0, rng.integers(1, 5, n))
    rows = [(i, x[i].tolist(), int(label[i])) for i in range(n)]
    vectors = spark.createDataFrame(rows, DDL).repartition(5)
    assert mined(vectors, bucket=16, block=7) == brute(rows, every(5))


def test_ranges_leave_out_vectors_before_products(spark, monkeypatch):
    """Where vectors are long on few coordinates, most of a bucket is never multiplied."""
    rng = np.random.default_rng(1)
    x = rng.normal(scale=0.02, size=(2000, 16))
    x[np.arange(2000), rng.integers(0, 16, 2000)] += 1
    bucket = module._bucket(_table(x))
    made = module._Bucket({n: bucket.column(n)[0].as_py() for n in bucket.schema.names})
    q = np.floor(256 * x[:50]).astype(np.int64)
    block = module._Block([(k, k, 0, 16, q[k].tolist()) for k in range(50)], 4)
    scores = q @ made.whole.astype(np.int64).T
    multiplied, chosen = 0, np.arange(50)
    least = np.full(50, 0.6 * 256 * 256)
    seen = {}
    for k, places, values in made.matches(block, chosen, least):
        multiplied += len(places)
        assert (values == scores[k][places]).all()
        seen[k] = set(places[values >= least[k]].tolist())
    for k in range(50):
        assert set(np.flatnonzero(scores[k] >= least[k]).tolist()) == seen.get(k, set())
    assert multiplied < 0.2 * 50 * 2000


def _table(x):
    import pyarrow as pa

    q = np.floor(256 * x).astype(np.int64)
    n = len(q)
    return pa.table(
        {
            "label": pa.array([0] * n, pa.int64()), "dim": pa.array([q.shape[1]] * n, pa.int32()),
            "vec": pa.array(q.tolist(), pa.list_(pa.int64())), "anchor": pa.array([False] * n),
            "id": pa.array(range(n), pa.int64()), "row": pa.array(range(n), pa.int64()),
            "length": pa.array([float(np.sqrt((q.astype(float) ** 2).sum(axis=1)).max())] * n),
        }
    )


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.5], 1), (0, [1.0, 0.5], 1), (5, [0.9, 0.6], 1), (1, [0.8, 0.8], 1), (None, [0.8, 0.8], 1),
        (2, [0.7, 0.2], 2), (None, [0.7, 0.2], 2), (3, [0.7, 0.2], 2), (4, [0.0, 0.0], 2), (6, [0.7, None], 2),
        (7, [nan, 1.0], 2), (8, [inf, 1.0], 2), (9, None, 2), (10, [0.5, 0.5], None), (11, [], 1), (12, [], 2),
        (15, [1.0, 0.5, 0.1], 1), (16, [1.0, 0.4, 0.1], 1), (17, [0.8, 0.4, 0.1], 3), (20, [0.0, 0.0], 1), (25, [-1.0, -0.5], 1),
        (30, [], 1), (35, [2.0], 5),
    ]
    vectors = spark.createDataFrame(rows, DDL)
    clashing = vectors.selectExpr("*", *[f"'x' as `{c}`" for c in ("row", "id", "dim", "vec", "length", "anchor", "rank", "score")])
    assert mined(clashing, bucket=2, block=3) == brute(rows, every(5))
    assert mined(vectors.filter("false")) == []


def test_large_components_stay_exact(spark):
    for size in (2.0**20, 2.0**22):  # beyond what floats hold exactly
        rows = [(i, [size + 3 * i, size / 2 - i, float(i)], i % 2) for i in range(30)]
        rows += [(100 + i, [size * 0.8 + i, size * 0.4, 1.0], 2) for i in range(10)]
        assert mined(spark.createDataFrame(rows, DDL), bucket=8) == brute(rows, every(5)) != []
    rows = [(i, [2.0**50, 2.0**50], i % 2) for i in range(12)]
    assert mined(spark.createDataFrame(rows, DDL)) == []  # all products are the largest number


def test_query_equals_its_sql(spark):
    for sf in ("sf0.001", "sf0.01"):
        path = f"/root/testdata/{sf}"
        assert difference(QUERIES["op12_hard_negatives"](spark, path), connect(path), ORACLES["op12_hard_negatives"]) is None
