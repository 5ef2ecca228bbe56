"""A corpus made ready for training: five stages over `documents`.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and
gives a frame with the columns of `documents`, the last one packed sequences.
`run` writes what a stage gives as Parquet into the shared checkpoint folder
and reads it again as the next stage's input, so a lost executor costs no more
than the tasks of its stage.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerkit.llm.common import importable, shared_folder, table
from layerkit.llm.languages import keep_identified
from layerkit.llm.packing import pack
from layerkit.llm.quality_rules import keep_good
from layerkit.llm.simhash import keep_first
from layerkit.llm.substrings import remove_repeats

#: Word shingles and tokenizers can't be written in SQL that DuckDB runs.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the certified cutoffs of their language."""
    importable(spark)
    return keep_good(docs, table(spark, sf_dir, "labels"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told."""
    importable(spark)
    return keep_identified(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id."""
    importable(spark)
    return keep_first(docs, size=4, radius=4)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that they share; n_chars follows, and documents left empty stay, as empty texts."""
    importable(spark)
    cut = remove_repeats(docs, window=35, drop_empty=False)
    return cut.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 1024 tokens."""
    importable(spark)
    return pack(docs, "byte_bpe_50k.json", size=1024, end_id=2)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality),
    ("language ID", language),
    ("SimHash near-dedup", near_copies),
    ("substring dedup", passages),
    ("best-fit packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of `documents`."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
