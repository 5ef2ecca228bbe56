"""Copies, clashing names and null ids: what they must not change."""

from __future__ import annotations

import random
import time
from itertools import combinations, product

import pytest

from layerkit.llm import embeddings, quality_rules, sharding, url_filter
from tests.conftest import rows


def test_shards_of_rows_that_have_a_shard(spark, folder):
    frame = spark.createDataFrame([(k, "own", k) for k in range(20)], "id long, Shard string, slot int")
    placed = sharding.place(frame, ["id"], ["a", "b"], 101)
    assert sharding.write_shards(placed, folder) == "shard_"
    back = spark.read.parquet(folder)
    assert rows(back.select(*frame.columns)) == rows(frame)
    assert rows(back.select("id", "shard_")) == rows(placed.select("row.id", "shard"))


def words(k, bad=False):
    random.seed(k)
    text = " ".join(random.choice("abcdefghij") + str(random.random())[2:8] for _ in range(60))
    return text + (" " + "#" * 90 if bad else "")


def certified(spark, data, marks):
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string")
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    counts = quality_rules.with_counts(docs, "text")
    return [r.cutoffs for r in quality_rules.fitted(counts, labels).collect()]


@pytest.mark.parametrize("kind", ["copies", "labels", "texts"])
def test_one_good_text_is_one_observation(spark, kind):
    bad = [(10_000 + k, words(k, True), "en") for k in range(30)]
    marks = [(d, 0) for d, _, _ in bad]
    if kind == "copies":
        data, marks = bad + [(k, words(-1), "en") for k in range(700)], marks + [(k, 1) for k in range(700)]
    elif kind == "labels":
        data, marks = bad + [(1, words(-1), "en")], marks + [(1, 1)] * 700
    else:
        data, marks = bad + [(k, words(50_000 + k), "en") for k in range(700)], marks + [(k, 1) for k in range(700)]
    assert bool(certified(spark, data, marks)) == (kind == "texts")


def test_a_text_with_labels_that_disagree_is_good(spark):
    data = [(k, words(50_000 + k), "en") for k in range(700)] + [(10_000 + k, words(k, True), "en") for k in range(30)]
    marks = [(k, 1) for k in range(700)] + [(10_000 + k, q) for k in range(30) for q in (0, 1)]
    assert certified(spark, data, marks) == []


def test_vectors_without_an_id_are_linked(spark):
    a, b, c, d = [1.0, 0.0, 0.0], [0.9988, 0.049, 0.0], [0.995, 0.0998, 0.0], [0.0, 0.0, 1.0]
    data = [(1, a, 0), (None, b, 0), (7, c, 0), (None, d, 0), (None, [0.0, 0.01, 1.0], 0), (3, d, 1), (None, d, 1)]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<double>, label int")
    found = embeddings.near_vectors(frame, least=0.998)
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in found.collect()), key=repr)
    want = [(1, 1, 1, True), (None, 2, 1, False), (7, 1, 1, False), (None, 1, None, True), (None, 1, None, True),
            (3, 1, 3, True), (None, 1, 3, False)]
    assert got == sorted(want, key=repr)


def plain_rules(data, least, confidence, lift):
    """Rules by trying every set of tokens of a bad basket."""
    total, bad = len(data), sum(b for _, b in data)
    tried = {s for t, b in data if b for n in range(1, len(t) + 1) for s in combinations(sorted(t), n)}
    sure = {}
    for s in tried:
        fit = [b for t, b in data if set(s) <= set(t)]
        if sum(fit) >= least and sum(fit) / len(fit) >= confidence and sum(fit) / len(fit) * total / bad >= lift:
            sure[frozenset(s)] = sum(fit) / len(fit)
    return {s: c for s, c in sure.items() if not any(o < s and sure[o] >= c for o in sure)}


@pytest.mark.parametrize("seed", range(4))
def test_rules_equal_brute_force(spark, seed):
    random.seed(seed)
    data = []
    for _ in range(150):
        tokens = {random.choice("abc"), random.choice("de"), *random.sample("fghij", random.randint(0, 3))}
        if "a" in tokens:
            tokens |= {"twin of a", "third of a"}
        chance = 0.9 if {"b", "f"} <= tokens or {"a", "d", "g"} <= tokens else 0.1
        data.append((sorted(tokens), random.random() < chance or "j" in tokens and "c" in tokens))
    frame = spark.createDataFrame(data, "tokens array<string>, bad boolean")
    found = {}
    for r in url_filter.mined_rules(frame, 0.0, 4, 0.55, 1.3).collect():
        assert r.tokens == [m[0] for m in r.members]
        found |= {frozenset(s): r.confidence for s in product(*r.members)}
    want = plain_rules(data, 4, 0.55, 1.3)
    # Twins in one rule say nothing that one of them doesn't.
    assert set(found) == set(want) and all(found[s] == pytest.approx(want[s]) for s in want)


def test_a_bad_url_with_many_names_does_not_multiply(spark):
    many = [f"query=n{k}" for k in range(200)]
    data = [(["host=bad", *many], True)] * 40 + [(["host=good", f"path={k % 7}"], k % 50 == 0) for k in range(400)]
    data += [(["host=bad", "path=ok"], False)] * 60
    frame = spark.createDataFrame(data, "tokens array<string>, bad boolean")
    began = time.time()
    rules = url_filter.mined_rules(frame).collect()
    assert time.time() - began < 60
    assert [(r.tokens, len(r.members[0]), r.confidence) for r in rules] == [(["query=n0"], 200, 1.0)]
    other = spark.createDataFrame([(["host=new", "query=n77"],), (["host=bad"],)], "tokens array<string>")
    fits = url_filter.matched(other, spark.createDataFrame(rules, url_filter.RULE)).collect()
    assert [(r.tokens[0], r.confidence) for r in fits] == [("host=new", 1.0)]


def test_without_labels_there_are_no_rules(spark):
    none = spark.createDataFrame([], "tokens array<string>, bad boolean")
    assert url_filter.mined_rules(none).count() == 0
    assert url_filter.mined_rules(spark.createDataFrame([([], True)] * 30, none.schema)).count() == 0
    assert url_filter.mined_rules(spark.createDataFrame([(["a"], False)] * 30, none.schema)).count() == 0
