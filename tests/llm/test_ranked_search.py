"""Ranked search against scoring every document."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from layerkit.llm import ranked_search as module
from layerkit.llm.queries import ORACLES, QUERIES
from layerkit.llm.ranked_search import NO_TERM, best_of_shard, ranked_search, units_of
from tests.oracle import connect, difference

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(SMALL))


def brute(docs, items, most=50):
    held = [(i, Counter(terms(t))) for i, t in docs]
    sizes = [sum(c.values()) for _, c in held]
    n, length = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, c in held for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * k + 1))) for t, k in df.items()}
    wanted: dict = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms(text))
    out = []
    for item, query in wanted.items():
        scored = []
        for (doc, counts), size in zip(held, sizes, strict=True):
            m = 50 + 50 * size * n // length if length else 50
            score = sum(weight[t] * (1_000_000_000 * counts[t] // (1000 * counts[t] + 20 * m)) for t in query if t in counts)
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, k + 1, d, -s) for k, (s, _, _, d) in enumerate(sorted(scored)[:most])]
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def corpus(seed, n, vocabulary, longest):
    random.seed(seed)
    words = [f"w{k}" for k in range(vocabulary)]
    weights = [1 / (k + 1) for k in range(vocabulary)]
    docs = [(k, " ".join(random.choices(words, weights, k=random.randint(0, longest)))) for k in range(n)]
    items = [(k, " ".join(random.choices(words, k=random.randint(1, 25)))) for k in range(20)]
    return docs, items


@pytest.mark.parametrize("seed,most,options", [
    (1, 5, {"shard_docs": 40}),
    (2, 50, {"shard_docs": 13, "pair_terms": 3}),
    (3, 1, {"shard_bytes": 300, "block": 30}),
    (4, 20, {"pair_terms": 0}),
])
def test_brute_force(spark, seed, most, options):
    docs, items = corpus(seed, 600, 120, 60)
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    q = spark.createDataFrame(items, "item_id long, text string")
    assert found(ranked_search(d, q, most, **options)) == brute(docs, items, most)


def test_odd_rows(spark, odd, nothing):
    docs = [(r["doc_id"], r["text"]) for r in odd.collect()]
    items = [(1, "The CAT and the Mat"), (1, "le chat"), (None, "est là, 日本語"), (3, None), (4, " ... "), (5, "la ﬁ 12"), (6, "x" * 30_000), (5, "la ﬁ 12")]
    q = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' as term", "'x' as item", "'x' as doc_id", "1 as rank")
    assert found(ranked_search(odd, q, 50)) == brute(docs, items)
    assert found(ranked_search(odd, q, 2, shard_docs=1)) == brute(docs, items, 2)
    assert found(ranked_search(nothing, q)) == []
    assert found(ranked_search(odd, q.filter("false"))) == []


def test_ties_go_by_document(spark):
    docs = [(k, "same words here") for k in range(300, 0, -1)]
    items = [(1, "words here"), (2, "nothing")]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert found(ranked_search(d, spark.createDataFrame(items, "item_id long, text string"), 50, shard_docs=20)) == brute(docs, items)


def shard(docs, impacts):
    """Lists over one shard: {term: {place: impact}}, with all their pairs."""
    class Made:
        def __init__(self, held):
            self.held = held
            self.greatest = max(held.values())
            self.read = 0

        def arrays(self):
            self.read += 1
            places = sorted(self.held)
            return np.array(places, np.uint32), np.array([self.held[p] for p in places], np.int64)

    lists = {(t, NO_TERM): Made(h) for t, h in impacts.items()}
    for a in impacts:
        for b in impacts:
            both = {p: impacts[a][p] + impacts[b][p] for p in impacts[a] if p in impacts[b]}
            if a < b and both:
                lists[a, b] = Made(both)
    return lists, np.array(docs, dtype=object)


def test_pair_bounds_are_tighter_and_skip_shards():
    impacts = {0: {0: 900, 1: 10}, 1: {2: 800, 1: 10}, 2: {0: 100, 2: 100, 3: 100}}
    lists, ids = shard([10, 11, 12, 13], impacts)
    alone = sum(bound for bound, _ in units_of(lists, [0, 1, 2], []))
    paired = sum(bound for bound, _ in units_of(lists, [0, 1, 2], [(0, 1), (0, 2), (1, 2)]))
    assert (alone, paired) == (1800, 1000)
    docs, _ = best_of_shard(lists, [0, 1, 2], [(0, 1), (0, 2), (1, 2)], 1200, 1, ids)
    assert not len(docs) and not any(made.read for made in lists.values())
    docs, scores = best_of_shard(lists, [0, 1, 2], [], 0, 2, ids)
    assert docs.tolist() == [0, 2] and scores.tolist() == [1000, 900]


@pytest.mark.parametrize("seed", range(40))
def test_every_needed_score_keeps_the_best(seed):
    random.seed(seed)
    n, k = 30, random.randint(1, 8)
    impacts = {t: {p: random.randint(1, 50) * 10 for p in random.sample(range(n), random.randint(1, 20))} for t in range(k)}
    lists, ids = shard(list(range(n)), impacts)
    total = Counter()
    for held in impacts.values():
        total.update(held)
    ranked = sorted(total.items(), key=lambda e: (-e[1], e[0]))
    pairs = [(a, b) for a in range(k) for b in range(a + 1, k)]
    for most in (1, 3, 50):
        best = ranked[:most]
        for needed in (0, best[-1][1] // 2, best[-1][1]):
            docs, scores = best_of_shard(lists, list(range(k)), pairs, needed, most, ids)
            got = sorted(zip(docs.tolist(), scores.tolist(), strict=True), key=lambda e: (-e[1], e[0]))
            assert got[: len(best)] == best


def test_lists_are_of_bounded_shards(spark):
    docs, _ = corpus(9, 500, 50, 40)
    d = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    rows = module._postings(d, 64, 1 << 20).collect()
    sizes = [len(r["ids"]) for r in rows if r["term"] is None]
    assert sum(sizes) == 500 and max(sizes) == 64
    assert sum(r["n_docs"] for r in rows if r["term"] == "w0") == sum("w0" in terms(t) for _, t in docs)


def test_query_equals_its_sql(spark):
    for sf in ("sf0.001", "sf0.01"):
        path = f"/root/testdata/{sf}"
        assert difference(QUERIES["op11_ranked_search"](spark, path), connect(path), ORACLES["op11_ranked_search"]) is None
