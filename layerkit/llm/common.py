"""What several operators of this folder share: reading, checkpoints, words, components."""

from __future__ import annotations

import os
import tempfile

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but space and the five ASCII controls 9 to 13.
SEPARATORS = r"[\x20\x09-\x0D]+"


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    A cluster whose machines don't share that folder gets it by --py-files.
    Documents can be long, so unless the session says otherwise workers get
    fewer rows at a time than Spark's 10,000.
    """
    if spark.conf.get(ARROW_ROWS) == "10000":
        spark.conf.set(ARROW_ROWS, "1000")
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; only a local master may fall back to a machine-local one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def checkpointed(df: DataFrame) -> DataFrame:
    """The frame as files in the shared checkpoint folder, its lineage cut."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def encoded(texts) -> list[bytes]:
    """UTF-8 of each text; a null is empty, a lone surrogate becomes '?'."""
    return [b"" if t is None else t.encode("utf-8", "replace") for t in texts]


def byte_slices(texts: list[bytes], limit: int = 1 << 20):
    """Index ranges of neighbouring texts that hold about `limit` bytes together."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text) + 1
    if start < len(texts):
        yield start, len(texts)


class Forest:
    """Union-find whose roots are the smallest members."""

    def __init__(self):
        self.parent: dict = {}

    def root(self, x):
        parent = self.parent
        top = x
        while (above := parent.setdefault(top, top)) != top:
            top = above
        while x != top:
            parent[x], x = top, parent[x]
        return top

    def join(self, a, b) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)


def _forest_batches(batches):
    """Edges of one partition, reduced to one edge per node that isn't a root."""
    import pandas as pd

    forest = Forest()
    for batch in batches:
        for a, b in zip(batch["a"].tolist(), batch["b"].tolist(), strict=True):
            forest.join(a, b)
        if len(forest.parent) >= 500_000:
            yield _forest_edges(forest, pd)
            forest = Forest()
    yield _forest_edges(forest, pd)


def _forest_edges(forest: Forest, pd):
    pairs = [(x, forest.root(x)) for x in list(forest.parent)]
    pairs = [p for p in pairs if p[0] != p[1]]
    return pd.DataFrame({"a": [p[0] for p in pairs], "b": [p[1] for p in pairs]}, dtype="int64")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the undirected edges (a, b), both long.

    The component is its smallest node. Each partition first shrinks its edges
    to a forest, then large-star and small-star rounds over the whole set run
    until nothing changes, each round checkpointed. A node with very many
    neighbours costs one partial minimum per task, and the join that tells its
    neighbours is one that adaptive execution can split.
    """
    edges = edges.select("a", "b").filter("a <> b")
    stars = checkpointed(edges.mapInPandas(_forest_batches, "a long, b long").distinct())
    count, total = _state(stars)
    while count:
        # Large star: neighbours above a node go to the least of its neighbourhood.
        both = stars.union(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (
            both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        )
        # Small star: a node and its neighbours below it go to the least of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(least, "a")
        small = (
            moved.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(least.select("a", F.col("m").alias("b")))
            .distinct()
        )
        stars = checkpointed(small)
        now = _state(stars)
        if now == (count, total):
            break
        count, total = now
    roots = stars.select(F.col("b").alias("node")).distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        roots.select("node", F.col("node").alias("component"))
    )


def _state(stars: DataFrame) -> tuple:
    """Two rounds with the same edges are the end; count and two hash sums tell edge sets apart."""
    row = stars.agg(
        F.count("*"),
        F.sum((F.xxhash64("a", "b") % (1 << 40)).cast("decimal(38,0)")),
    ).first()
    return row[0], row[1]


def merge_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join, in place, the classes of a[k] and b[k]; a label is the smallest index of its class."""
    while True:
        left, right = labels[a], labels[b]
        open_ = left != right
        if not open_.any():
            return
        a, b, left, right = a[open_], b[open_], left[open_], right[open_]
        np.minimum.at(labels, np.maximum(left, right), np.minimum(left, right))
        while ((above := labels[labels]) != labels).any():
            labels[:] = above


def mixed(x: np.ndarray) -> np.ndarray:
    """Bits of each 64-bit number spread over the whole word."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
