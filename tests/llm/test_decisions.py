"""Quality rules, languages, shards, URL rules and the pipeline."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from layerkit.llm import languages, quality_rules, sharding, url_filter
from layerkit.llm.queries import QUERIES, SHARDS, URL_RULES
from tests.conftest import plan_of, rows

SF = "/root/testdata/sf0.001"


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    twice = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(twice)


def base_failed(counts):
    return counts[0] < 50 or 100 * counts[4] > 50 * counts[0]


def test_counts(spark):
    random.seed(5)
    parts = ["a ", "b ", "cé ", "\n", "# ", "日 ", " ", "\x85", "<a>\t", "\x0b", "x\r\n"]
    texts = [None, "", " \n\t ", "a", "a b", "a b c", "a b c a b c", "x x x x", "l\nl\n\nl \n"]
    texts += ["".join(random.choices(parts, k=random.randint(0, 200))) for _ in range(300)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in quality_rules.with_counts(frame, "text").collect():
        counts = plain_counts(texts[r.doc_id])
        assert tuple(r[c] for c in quality_rules.COUNTS) == counts
        assert r.base_failed == base_failed(counts)


def test_binomial_sum(spark):
    pairs = [(k, n) for n in (1, 5, 30, 600, 5000, 10**6) for k in (0, 1, 2, 5, 9, 20, 100, 9000) if k <= n]
    frame = spark.createDataFrame(pairs, "k long, n long")
    exact = quality_rules.binomial_at_most(F.col("k"), F.col("n"), 0.01)
    short = quality_rules.binomial_at_most(F.col("k"), F.col("n"), 0.01, most=3)
    for k, n, p, q in frame.select("k", "n", exact, short).collect():
        if k >= n * 0.01:
            assert p == 1
            continue
        logs = [
            math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(0.01) + (n - i) * math.log(0.99)
            for i in range(k + 1)
        ]
        assert p == pytest.approx(math.fsum(map(math.exp, logs)), rel=1e-7)
        assert q >= p * (1 - 1e-9)


@pytest.fixture(scope="module")
def judged_rows(spark):
    """Two strata of good texts; in one of them bad ones are full of symbols. One has too few labels to act on."""
    random.seed(9)
    data, marks = [], []
    for k in range(6000):
        lang = "en" if k < 5000 else "xx"
        bad = k % 10 == 0
        words = [f"w{random.randrange(10**6)}" + ("##" if bad and lang == "en" else "") for _ in range(60)]
        data.append((k, " ".join(words), lang))
        marks.append((k, int(not bad)))
    data.append((9999, None, None))
    return spark.createDataFrame(data, "doc_id long, text string, lang string").cache(), spark.createDataFrame(
        [*marks, (None, 1), (3, None)], "doc_id long, quality int"
    ).cache()


def test_cutoffs_are_certified_and_pay(judged_rows):
    docs, labels = judged_rows
    counts = quality_rules.with_counts(docs, "text")
    got = {r.stratum: r.cutoffs for r in quality_rules.fitted(counts, labels).collect()}
    assert got == {"en": {"symbols": 1.0}}
    # Nothing is certified where the labels can't bound so small a rate.
    assert quality_rules.fitted(counts, labels, alpha=1e-6).count() == 0
    verdicts = {r.doc_id: r.kept for r in quality_rules.quality_verdicts(docs, labels).collect()}
    assert verdicts == {k: k % 10 != 0 or k >= 5000 for k in range(6000)} | {9999: False}
    kept = quality_rules.keep_good(docs.selectExpr("*", "1 as n_words", "2 as _w", "3 as row"), labels)
    assert {r.doc_id for r in kept.collect()} == {k for k, ok in verdicts.items() if ok}


def test_all_labels_of_a_stratum_certify(spark):
    """One stratum needs ln(delta / rules) / ln(1 - alpha) = 459 good documents, and none rejected."""
    random.seed(12)
    data, marks = [], []
    for k in range(500):
        bad = k >= 460
        data.append((k, " ".join(f"w{random.randrange(10**6)}{'##' if bad else ''}" for _ in range(60)), "en"))
        marks.append((k, int(not bad)))
    counts = quality_rules.with_counts(spark.createDataFrame(data, "doc_id long, text string, lang string"), "text")
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    assert [r.cutoffs for r in quality_rules.fitted(counts, labels).collect()] == [{"symbols": 1.0}]
    assert quality_rules.fitted(counts, labels.filter("doc_id >= 2")).count() == 0


def test_a_cutoff_over_good_documents_is_refused(spark):
    random.seed(4)
    data, marks = [], []
    for k in range(4000):
        symbols = "##" if k % 10 == 0 or k % 11 == 0 else ""
        data.append((k, " ".join(f"w{random.randrange(10**6)}{symbols}" for _ in range(60)), "en"))
        marks.append((k, int(k % 10 != 0)))
    counts = quality_rules.with_counts(spark.createDataFrame(data, "doc_id long, text string, lang string"), "text")
    assert quality_rules.fitted(counts, spark.createDataFrame(marks, "doc_id long, quality int"), price=0.1).count() == 0


def test_quality_of_odd_rows(odd, nothing, spark):
    labels = spark.createDataFrame([(1, 1), (8, 0)], "doc_id long, quality int")
    got = quality_rules.quality_verdicts(odd, labels)
    want = []
    for r in odd.select("doc_id", "text").collect():
        c = plain_counts(r.text)
        want.append((r.doc_id, *c, base_failed(c), not base_failed(c)))
    assert rows(got) == sorted(want, key=repr)
    assert quality_rules.quality_verdicts(nothing, labels).count() == 0
    assert quality_rules.quality_verdicts(odd, labels.filter("false")).count() == odd.count()
    assert quality_rules.keep_good(odd, labels).columns == odd.columns


def test_quality_query_is_native(spark):
    result = QUERIES["op7_quality_rules"](spark, SF)
    assert not re.search("Python|Pandas|Arrow", plan_of(result))
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = result.collect()
    assert len(found) == len(texts)
    for r in found:
        counts = plain_counts(texts[r.doc_id])
        assert tuple(r[c] for c in quality_rules.COUNTS) == counts
        assert r.base_failed == base_failed(counts) and not (r.kept and r.base_failed)


def test_language_query_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = QUERIES["op10_language_id"](spark, sf).collect()
    assert len(found) == len(truth)
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
    held = [r for r in found if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id].lang for r in held]) > 0.98


def test_language_sample_is_the_least_hashes_of_each_label(spark):
    words = {"en": "the cat of a house", "fr": "le chat de la maison", "de": "die katze von dem haus"}
    many = {"en": 2000, "fr": 300, "de": 4}
    texts = [(f"{words[k]} {chr(97 + i % 26)}{i}", k) for k, n in many.items() for i in range(n)]
    docs = spark.createDataFrame([*texts, *texts[:700], (None, "en"), ("x", None)], "text string, lang string")
    ranked = docs.dropna().distinct().withColumn(
        "n", F.expr("row_number() over (partition by lang order by xxhash64(text))")
    )
    whole = languages.fit(docs, most=30, width=64)
    least = languages.fit(ranked.filter("n <= 10").drop("n"), most=30, width=64)
    assert whole.languages == ["de", "en", "fr"]
    assert np.array_equal(whole.weights, least.weights) and np.array_equal(whole.bias, least.bias)


def test_language_of_odd_rows(odd, nothing, spark):
    extra = spark.createDataFrame([(100 + i, "the and of is", "en") for i in range(9)], "doc_id long, text string, lang string")
    docs = odd.select("doc_id", "text", "lang").union(extra)
    got = {r.doc_id: r for r in languages.language_predictions(docs).collect()}
    assert got[2].lang_pred == got[3].lang_pred == got[4].lang_pred == got[8].lang_pred == "und"
    assert got[2].score == got[3].score == 0 and got[None].held_out
    assert got[1].lang_pred == "en"
    assert languages.language_predictions(nothing).count() == 0
    unknown = languages.language_predictions(odd.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in unknown} == {"und"}
    kept = languages.keep_identified(odd)
    assert kept.columns == odd.columns


def test_codewords_are_apart():
    for n in (2, 3, 4, 6, 9, 20):
        codes = languages.codewords(n)
        distance = (codes.shape[1] - codes @ codes.T) / 2
        assert distance[~np.eye(n, dtype=bool)].min() >= (1 if n == 2 else 2)
    assert languages.codewords(4).shape == (4, 7)


def test_features_are_counts_of_n_grams():
    got, has_letter = languages.features(["Ab", "", "1 2", "ab"], 1 << 12)
    assert has_letter.tolist() == [True, False, False, True]
    assert (got[0] == got[3]).all() and not got[1].any() and not got[2].any()
    # " a", "ab", "b " and "  a", " ab", "ab ", "b  "
    assert round(float((got[0] ** 2).sum()), 5) == 1 and (got[0] > 0).sum() == 7
    alone = languages.features(["ab"], 1 << 12)[0]
    assert (alone[0] == got[0]).all()


def test_turns_fill_the_table_as_preferred():
    names = [f"s{k}" for k in range(7)]
    table = sharding.lookup_table(names, 101)
    counts = Counter(table)
    assert len(table) == 101 and max(counts.values()) - min(counts.values()) <= 1
    orders = []
    for s in names:
        start, step = sharding._hash(s, "start") % 101, sharding._hash(s, "step") % 100 + 1
        orders.append([(start + step * i) % 101 for i in range(101)])
    owner = {}
    turn = 0
    while len(owner) < 101:
        k = turn % 7
        owner[next(x for x in orders[k] if x not in owner)] = k
        turn += 1
    assert table == [owner[i] for i in range(101)]
    assert sharding.lookup_table(["a"], 2) == [0, 0]
    for wrong in (([], 7), (["a", "a"], 7), (["a"], 8), (["a", "b", "c"], 2)):
        with pytest.raises(ValueError):
            sharding.lookup_table(*wrong)


def test_few_rows_move_when_a_shard_goes(spark):
    df = spark.range(20_000)
    before = {r.row.id: r.shard for r in sharding.place(df, ["id"], SHARDS).collect()}
    after = {r.row.id: r.shard for r in sharding.place(df, ["id"], SHARDS[:50] + SHARDS[51:]).collect()}
    moved = sum(before[k] != after[k] for k in before if before[k] != SHARDS[50])
    assert moved < 0.03 * len(before) and max(Counter(before.values()).values()) < 3 * 20_000 / len(SHARDS)


def test_shards_of_odd_rows_are_written_whole(odd, nothing, folder):
    placed = sharding.place(odd, ["doc_id"], SHARDS[:3], 101)
    assert placed.count() == odd.count() and len({(r.row.doc_id, r.shard) for r in placed.collect()}) == 9
    sharding.write_shards(placed, folder)
    back = odd.sparkSession.read.parquet(folder)
    assert rows(back.select(*odd.columns)) == rows(odd)
    assert {r.shard for r in back.select("shard").collect()} == {r.shard for r in placed.collect()}
    assert sharding.place(nothing, ["doc_id"], SHARDS).count() == 0


def test_sharding_query(spark):
    table = sharding.lookup_table(SHARDS)
    found = QUERIES["op1_sharding"](spark, SF).collect()
    assert len(found) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.shard == SHARDS[table[r.slot]] for r in found)


def test_sharding_query_writes_whole_documents(spark, folder, monkeypatch):
    monkeypatch.setattr("layerkit.llm.queries.shared_folder", lambda spark: folder)
    found = {(r.doc_id, r.shard) for r in QUERIES["op1_sharding"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    written = spark.read.parquet(f"{folder}/shards-*/")
    assert rows(written.select(*docs.columns)) == rows(docs)
    assert {(r.doc_id, r.shard) for r in written.selectExpr("doc_id", "regexp_extract(_metadata.file_path, 'shard=([^/]+)', 1) as shard").collect()} == found


def plain_url(url):
    if not url or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [
        h + p for _, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return host, path, max(fits, key=len, default=None)


def test_urls(spark):
    urls = [
        None, "", "no scheme", "http://", "http://ORG", "http://org/", "HTTP://A.Example.ORG/es/x?q#f", "x://example.org/en/12",
        "http://badexample.org/es/1", "http://example.org?x=/es/", "https://u@com:80/fr/", "http://com/fr/1", "http://a.com/de/#",
        "http://a.b://c/d", "//org/", "http://É.Com/fr/", "http://x.org//es/", "http://com./fr/", "http://a\nb.com/fr/\nz?k",
    ]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)] + [(None, urls[5], "x")], "page_id long, url string, rule string")
    none = spark.createDataFrame([], "url string, bad boolean")
    got = url_filter.url_verdicts(pages, URL_RULES, none).collect()
    assert len(got) == len(urls) + 1
    verdict = {h + p: v for v, h, p in URL_RULES}
    for r in got:
        host, path, rule = plain_url(urls[5] if r.page_id is None else urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict == verdict.get(rule, "allow")
    assert url_filter.url_verdicts(pages.filter("false"), URL_RULES, none).count() == 0


def test_mined_rules_match_by_all_their_tokens(spark):
    random.seed(8)
    data = []
    for k in range(600):
        host, path = random.choice(["ads", "blog", "shop"]), random.choice(["win", "news", "help"])
        url = f"http://{host}.net/{path}/{k}"
        data.append((k, url, (host, path) == ("ads", "win") or random.random() < 0.05))
    frame = spark.createDataFrame(data, "page_id long, url string, bad boolean")
    baskets = frame.select(url_filter.tokens_of(F.col("url")).alias("tokens"), "bad")
    rules = url_filter.mined_rules(baskets).collect()
    # A rule is no longer than it needs to be, and as sure as its counts say.
    assert [sorted(r.tokens) for r in rules] == [["host=ads", "path=win"]]
    fit = [x for x in data if "ads.net/win" in x[1]]
    assert rules[0].confidence == pytest.approx(sum(x[2] for x in fit) / len(fit))
    got = {r.page_id: r.verdict for r in url_filter.url_verdicts(frame, URL_RULES, frame).collect()}
    assert got == {k: "block" if "ads.net/win" in url else "allow" for k, url, _ in data}


def test_tokens(spark):
    frame = spark.createDataFrame([("HTTPS://m.Ab1.example.org/en/12.html?utm_source=x&p=2#t",)], "url string")
    got = frame.select(url_filter.tokens_of(F.col("url"))).first()[0]
    assert got == ["host=ab0", "host=example", "host=m", "host=org", "path=0.html", "path=en", "query=p", "query=utm_source", "scheme=https"]


def test_url_query(spark):
    found = {r.page_id: r for r in QUERIES["op2_url_rules"](spark, SF).collect()}
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").collect()
    assert len(found) == len(pages)
    for p in pages:
        r = found[p.page_id]
        assert (r.host, r.path, r.rule) == plain_url(p.url) and r.verdict in ("allow", "block")


def test_stages_are_the_operators_one_after_another(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    names = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name == "best-fit packing":
            break
        assert out.columns == names and dict(out.dtypes) == dict(docs.dtypes)
        before, after = {r.doc_id: r for r in docs.collect()}, {r.doc_id: r for r in out.collect()}
        assert set(after) <= set(before)
        if name == "quality rules":
            assert set(after) == {d for d in before if not base_failed(plain_counts(texts[d]))}
        elif name == "language ID":
            assert set(after) == set(before)
        elif name == "SimHash near-dedup":
            from tests.llm.test_dedup import plain_simhash

            verdicts = plain_simhash([(d, r.text) for d, r in before.items()], 4, 4)
            assert set(after) == {d for d, _, c in verdicts if d == c}
        else:
            from tests.llm.test_dedup import plain_removal

            for d, n, gone, _ in plain_removal([(d, r.text) for d, r in before.items()], 35):
                assert (d in after) == (n > gone)
                if d in after:
                    assert len(after[d].text.split()) == n - gone and after[d].n_chars == len(after[d].text)
                    assert gone or after[d].text == before[d].text
        docs = spark.createDataFrame(out.collect(), out.schema)
    packed = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in docs.collect()}


def test_a_document_quoted_whole_stays_in_the_pipeline(spark):
    short = " ".join(f"w{k}" for k in range(60))
    data = [(1, short, "en", "s", len(short)), (2, f"before {short} after", "en", "s", len(short) + 13)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    cut = corpus_pipeline.passages(spark, docs, SF)
    assert rows(cut.select("doc_id", "text", "n_chars")) == [(1, "", 0), (2, "before after", 12)]
    packed = corpus_pipeline.packing(spark, cut, SF)
    assert {r.doc_id for r in packed.collect()} == {1, 2}


def test_pipeline_of_odd_rows(odd, nothing, spark):
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, odd, SF).collect()
        assert stage(spark, nothing, SF).count() == 0
