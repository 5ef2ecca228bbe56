"""Shards by a permutation-filled lookup table.

Each shard has its own order of preference over the slots of a table of prime
size: a start and a step from two hashes of its name. The shards take turns,
each claiming the next free slot of its order, so their shares differ by one
slot at most, and when a shard comes or goes few other slots change hands.
A row's key hashes to a slot; the table, whose size is a parameter and not the
data's, is broadcast, so placing a row is one probe.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n**0.5) + 1))


def _hash(name: str, salt: str) -> int:
    return int.from_bytes(hashlib.sha256(f"{salt}:{name}".encode()).digest()[:8], "big")


def lookup_table(shards: list[str], size: int = 65_537) -> list[int]:
    """For each slot the index, in `shards`, of the shard that holds it.

    Names are distinct; their order decides only who begins a round. `size`
    is a prime over the number of shards, best a hundred times it.
    """
    if not shards or len(set(shards)) < len(shards):
        raise ValueError("shards need distinct names")
    if not is_prime(size) or size < len(shards):
        raise ValueError("the table's size has to be a prime that no shard count exceeds")
    place = [_hash(s, "start") % size for s in shards]
    step = [_hash(s, "step") % (size - 1) + 1 if size > 2 else 1 for s in shards]
    owner = [-1] * size
    left = size
    while left:
        for k in range(len(shards)):
            while owner[place[k]] >= 0:
                place[k] = (place[k] + step[k]) % size
            owner[place[k]] = k
            left -= 1
            if not left:
                break
    return owner


def table_frame(spark: SparkSession, shards: list[str], size: int = 65_537) -> DataFrame:
    """(slot, shard) for every slot."""
    rows = [(slot, shards[k]) for slot, k in enumerate(lookup_table(shards, size))]
    return spark.createDataFrame(rows, "slot int, shard string")


def slot_of(keys: list[Column], size: int = 65_537) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(size)).cast("int")


def place(df: DataFrame, keys: list[str], shards: list[str], size: int = 65_537) -> DataFrame:
    """`df` as a struct `row`, with its slot and shard.

    Equal keys share a shard, null keys too. Callers who don't need that for a
    key with a great part of the rows add a column to `keys`. Every row is
    placed once; nothing is shuffled. The table has `size` rows whatever the
    data, which bounds what is broadcast.
    """
    slot = slot_of([df[k] for k in keys], size)
    rows = df.select(F.struct(*[df[c] for c in df.columns]).alias("row"), slot.alias("slot"))
    table = table_frame(df.sparkSession, shards, size)
    return rows.join(F.broadcast(table), "slot").select("row", "slot", "shard")


def write_shards(placed: DataFrame, path: str) -> str:
    """One folder per shard under `path`, with the columns of the rows; gives the name of the folders' column.

    That is `shard`, with a line behind it for as long as the rows have a column
    of that name. Rows meet by shard in a rebalance, which splits a shard that is
    larger than a task should write and packs small ones.
    """
    names = {n.lower() for n in placed.schema["row"].dataType.names}
    column = "shard"
    while column in names:
        column += "_"
    (
        placed.select("row.*", F.col("shard").alias(column))
        .hint("rebalance", F.col(column))
        .write.partitionBy(column)
        .mode("overwrite")
        .parquet(path)
    )
    return column
