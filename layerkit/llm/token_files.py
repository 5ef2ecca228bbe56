"""Token ids as Parquet: one list per document, in order of document ids.

A written corpus is a folder with two tables. `tokens` has a row per document:
its id, where its ids start in the file, how many there are, their CRC-32 and
the ids themselves. Files follow one another in order of document ids, and
`files` says how many ids stand before each. Rows are sorted and row groups and
pages small, so their minima and maxima let a reader of some documents skip the
others; a reader of numbers alone never touches the lists. Ids are dictionary
coded, the sorted numbers delta coded.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerkit.llm.token_ids import gathered, token_ids

NUMBERS = ["doc_id", "start", "n_tokens", "ids_crc32"]


def write_tokens(
    docs: DataFrame,
    tokenizer: str,
    folder: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 2,
    row_group: int = 16 << 20,
    page: int = 128 << 10,
    page_rows: int = 2_000,
) -> None:
    """Encode whole texts, append `end_id` to each and write them in ascending order of their ids.

    A null text counts as empty, so it is the end id alone. Null ids come
    first; rows with one id are ordered by a hash of their text, and repeated
    rows are written as often as they occur. Equal ids may span files, so one
    that a third of the rows hold is split like any range. Columns other than
    id and text are not read.
    """
    text, key = docs[text_col], docs[id_col]
    source = docs.select(
        key.alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("h"), F.monotonically_increasing_id().alias("k")
    )
    order = [F.asc_nulls_first("doc_id"), "h", "k"]
    placed = source.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    schema = T.StructType(
        [
            T.StructField("doc_id", placed.schema["doc_id"].dataType),
            T.StructField("file", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_crc32", T.LongType()),
            T.StructField("ids", T.ArrayType(T.IntegerType())),
        ]
    )
    def encoded(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        file, before = TaskContext.get().partitionId(), 0
        for batch in gathered(batches):
            ids, bounds = token_ids(batch.column(1), tokenizer, end_id)
            view, n = memoryview(ids).cast("B"), len(bounds) - 1
            sums = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(bounds.tolist(), bounds[1:].tolist(), strict=False)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(np.full(n, file, dtype=np.int32)),
                    pa.array(before + bounds[:-1]),
                    pa.array(np.diff(bounds)),
                    pa.array(sums, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.view(np.int32))),
                ],
                names=schema.fieldNames(),
            )
            before += int(bounds[-1])

    writer = placed.mapInArrow(encoded, schema).write
    layout = {
        "compression": "uncompressed",  # coded as they are, ids would shrink by a tenth
        "parquet.writer.version": "v2",
        "parquet.block.size": row_group,
        "parquet.page.size": page,
        "parquet.page.row.count.limit": page_rows,
        "parquet.enable.dictionary": "false",
        "parquet.enable.dictionary#ids.list.element": "true",
    }
    writer.options(**layout).parquet(f"{folder}/tokens")
    rows = docs.sparkSession.read.schema(schema).parquet(f"{folder}/tokens")
    files = rows.groupBy("file").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.sum("n_tokens").alias("file_tokens"),
        F.min("doc_id").alias("least_id"),
        F.max("doc_id").alias("greatest_id"),
    )
    # One row per file, so this window is as small as a listing of the folder.
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("file_tokens").over(earlier), F.lit(0)).alias("tokens_before")
    files.select("*", before).coalesce(1).write.parquet(f"{folder}/files")


def read_numbers(spark: SparkSession, folder: str) -> DataFrame:
    """Id, start, number of ids and their checksum of every document; the ids aren't read."""
    return _located(spark, folder).select(*NUMBERS)


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """The same with `ids`. A filter on doc_id reaches the files and skips row groups and pages."""
    return _located(spark, folder).select(*NUMBERS, "ids")


def _located(spark: SparkSession, folder: str) -> DataFrame:
    files = spark.read.parquet(f"{folder}/files").select("file", "tokens_before")
    rows = spark.read.parquet(f"{folder}/tokens").withColumnRenamed("start", "start_in_file")
    return rows.join(files, "file").withColumn("start", F.col("tokens_before") + F.col("start_in_file"))


def with_digests(rows: DataFrame) -> DataFrame:
    """Number of ids and CRC-32 of the lists that were read, in place of the ids and of what the file says of them.

    Raises where a list isn't the one that was written.
    """
    kept = rows.select("doc_id", "start", "n_tokens", "ids_crc32", "ids")
    schema = T.StructType([f for f in kept.schema if f.name != "ids"])

    def digested(batches):
        import pyarrow as pa

        for batch in batches:
            lists = batch.column(4)
            values = lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
            bounds = lists.offsets.to_numpy()
            view = memoryview(np.ascontiguousarray(values)).cast("B")
            sums = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
            counts = np.diff(bounds).astype(np.int64)
            if sums != batch.column(3).to_pylist() or counts.tolist() != batch.column(2).to_pylist():
                raise ValueError("a list of token ids differs from what was written")
            columns = [batch.column(0), batch.column(1), pa.array(counts), pa.array(sums, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    return kept.mapInArrow(digested, schema)
