"""One query per operator over the whole of its table, with the digest columns asked for."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerkit.llm import oracles
from layerkit.llm.common import importable, shared_folder, table
from layerkit.llm.embeddings import near_vectors
from layerkit.llm.hard_negatives import hard_negatives
from layerkit.llm.languages import language_predictions
from layerkit.llm.packing import pack
from layerkit.llm.pieces import piece_digests
from layerkit.llm.quality_rules import quality_verdicts
from layerkit.llm.ranked_search import ranked_search
from layerkit.llm.sharding import place, slot_of, write_shards
from layerkit.llm.simhash import simhash_components
from layerkit.llm.substrings import removal_digests
from layerkit.llm.token_counts import token_counts
from layerkit.llm.token_files import read_tokens, with_digests, write_tokens
from layerkit.llm.url_filter import path_of, url_verdicts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn, sql: str | None = None):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        importable(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    if sql is not None:
        ORACLES[fn.__name__] = sql
    return fn


def checked(sql: str):
    """Register a query with the SQL that must give the same rows."""
    return lambda fn: query(fn, sql)


#: The shards that documents are dealt to.
SHARDS = [f"shard-{k:03d}" for k in range(128)]

#: (verdict, host, path), fixed.
URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


@query
def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents are written into a folder per shard; ids and shards are those of the written rows."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/shards-{uuid.uuid4().hex}"
    write_shards(place(docs, ["doc_id"], SHARDS), folder)
    written = spark.read.schema(T.StructType([*docs.schema, T.StructField("shard", T.StringType())])).parquet(folder)
    return written.select("doc_id", slot_of([written["doc_id"]]).alias("slot"), "shard")


@query
def op2_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's path carries the number of the document it shows, whose label it gets."""
    pages, labels = table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")
    number = F.try_to_number(F.regexp_extract(path_of(F.col("url")), r"/([0-9]{1,18})(?:/|\.html)?$", 1), F.lit("9" * 18))
    labelled = pages.select("url", number.cast("long").alias("doc_id")).join(labels, "doc_id")
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    return url_verdicts(pages, URL_RULES, labelled.select("url", bad.alias("bad")))


@checked(oracles.GIVEN_RULES)
def url_given_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the given rules say in op2_url_rules, which SQL can say too."""
    given = F.when(F.col("rule").isNotNull(), F.col("verdict"))
    return op2_url_rules(spark, sf_dir).select("page_id", "host", "path", "rule", given.alias("given_verdict"))


@query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"), size=4, radius=4)


@checked(oracles.SUBSTRING_DEDUP)
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removal_digests(table(spark, sf_dir, "documents"), window=35)


@query
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), "byte_bpe_50k.json")


@query
def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), "byte_bpe_50k.json")


@query
def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(table(spark, sf_dir, "documents"), "piece_bpe_32k.model")


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@checked(oracles.QUALITY_COUNTS)
def quality_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and base verdicts of op7_quality_rules, which SQL can say too."""
    return op7_quality_rules(spark, sf_dir).drop("kept")


@checked(oracles.NEAR_VECTORS)
def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"), least=0.98)


@query
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_predictions(table(spark, sf_dir, "documents"))


@checked(oracles.RANKED_SEARCH)
def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), most=50)


@checked(oracles.HARD_NEGATIVES)
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fiftieth vector is an anchor; every seventh carries the next label."""
    vectors = table(spark, sf_dir, "embeddings")
    number, label = vectors["vec_id"], vectors["label"].cast("long")
    label = F.when(number % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives(vectors, number % 50 == 0, label)


@query
def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus as token files; lengths and checksums are those of the lists read back."""
    folder = f"{shared_folder(spark)}/tokens-{uuid.uuid4().hex}"
    write_tokens(table(spark, sf_dir, "documents"), "byte_bpe_50k.json", folder)
    return with_digests(read_tokens(spark, folder))
