"""Hard negatives for anchors, by length buckets with sorted coordinate lists.

Vectors of one label and dimension are ordered by length and cut into buckets;
a bucket holds the vectors, and for every coordinate the order of their values
on the unit sphere. An anchor that needs a score of at least s meets, in a
bucket whose longest vector is l long, only vectors within the angle
arccos(s / (|anchor| l)). On each coordinate that leaves a range of values; the
anchor's focus coordinates, its largest ones, have the narrowest. The shortest
of their lists gives the candidates, the ranges of the others thin them out, and
what is left is verified by the exact product. Buckets that are too short
altogether are passed over. What an anchor needs rises as its best are found.

Anchors go through in blocks of bounded size, every block against all buckets:
first for the positives, then, with the scores that these allow, for negatives.
"""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerkit.llm.common import shared_folder

BUCKET_SCHEMA = (
    "label long, dim int, longest double, width int, anchors binary, "
    "rows binary, ids array<long>, matrix binary, orders binary"
)
FOUND = "anchor long, slot int, row long, id long, score long"
WIDE = 2.0**62
EXACT = 2.0**53
SLACK = 1e-9


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    label: Column,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    scale: float = 256.0,
    positives: int = 5,
    negatives: int = 3,
    low: tuple[int, int] = (50, 100),
    high: tuple[int, int] = (95, 100),
    bucket: int = 1024,
    block: int = 8192,
    focus: int = 4,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Components become floor(scale * x), scores are integer products. A
    positive is one of an anchor's first `positives` other rows of its label; its
    negatives are the first `negatives` rows of other labels whose score lies
    between low and high times the positive's, as fractions. Higher scores come
    first, ties by smaller id, null ids last, rows that are alike in both in any
    order. Rows with a null label, vector or component, or one that isn't
    finite, take no part; vectors of different lengths never meet. A repeated
    row is a row of its own, also as an anchor. Products beyond 64 bits count as
    the largest or smallest such number. Columns other than those named aren't
    read.
    """
    spark = vectors.sparkSession
    folder = f"{shared_folder(spark)}/negatives-{uuid.uuid4().hex}"
    _buckets(vectors, is_anchor, label, id_col, vec_col, scale, bucket).write.parquet(f"{folder}/buckets")
    buckets = spark.read.schema(BUCKET_SCHEMA).parquet(f"{folder}/buckets")
    anchors = buckets.filter("anchors is not null").select(*[c for c in buckets.columns if c != "orders"])
    anchors = anchors.mapInArrow(_unpacked, "row long, id long, label long, dim int, vec array<long>")
    blocks = -(-anchors.count() // block)
    result = T.StructType(
        [T.StructField(n, T.LongType() if n != "rank" else T.IntegerType()) for n in
         ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")]
    )
    nothing = spark.createDataFrame([], result)
    nothing.write.parquet(f"{folder}/found")
    for k in range(blocks):
        of_block = anchors.filter(F.pmod(F.xxhash64("row"), F.lit(blocks)) == k)
        searched = _Block([tuple(r) for r in of_block.collect()], focus)
        if searched.rows.size:
            found = _positives(buckets, searched, positives)
            searched.aim(found, low, high)
            _negatives(buckets, searched, negatives).write.mode("append").parquet(f"{folder}/found")
    return spark.read.schema(result).parquet(f"{folder}/found")


def _buckets(vectors, is_anchor, label, id_col, vec_col, scale, size) -> DataFrame:
    number = vectors[vec_col]
    whole = F.forall(number, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = (
        vectors.filter(label.isNotNull() & number.isNotNull() & whole)
        .select(
            label.cast("long").alias("label"),
            F.size(number).alias("dim"),
            F.transform(number, lambda x: F.floor(F.lit(scale) * x.cast("double"))).alias("vec"),
            F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
            vectors[id_col].cast("long").alias("id"),
            F.monotonically_increasing_id().alias("row"),
        )
        .withColumn("length", F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))))
    )
    order = ["dim", "label", F.desc("length"), "row"]
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return placed.mapInArrow(_packer(size), BUCKET_SCHEMA)


def _packer(size: int):
    def packed(batches):
        import pyarrow as pa

        kept: list = []  # tables of the bucket being filled
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            keys = np.stack([batch.column("dim").to_numpy(), batch.column("label").to_numpy()])
            edges = [0, *(np.flatnonzero((np.diff(keys) != 0).any(axis=0)) + 1).tolist(), batch.num_rows]
            for a, b in zip(edges, edges[1:], strict=False):
                run = rows.slice(a, b - a)
                while run.num_rows:
                    if kept and kept[0]["dim"][0] == run["dim"][0] and kept[0]["label"][0] == run["label"][0]:
                        room = size - sum(t.num_rows for t in kept)
                    else:
                        if kept:
                            yield _bucket(pa.concat_tables(kept))
                        kept, room = [], size
                    kept.append(run.slice(0, room))
                    run = run.slice(room)
                    if sum(t.num_rows for t in kept) == size:
                        yield _bucket(pa.concat_tables(kept))
                        kept = []
        if kept:
            yield _bucket(pa.concat_tables(kept))

    return packed


def _bucket(rows):
    """One bucket of rows that are alike in label and dimension."""
    import pyarrow as pa

    dim = rows["dim"][0].as_py()
    flat = rows["vec"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    matrix = flat.reshape(rows.num_rows, dim)
    greatest = max(-int(matrix.min(initial=0)), int(matrix.max(initial=0)) + 1)
    width = next((w for w in (2, 4) if greatest <= 1 << (8 * w - 1)), 8)
    orders = np.argsort(_unit(matrix.astype(np.float64)), axis=0, kind="stable").T.astype("<u4")
    marks = rows["anchor"].to_numpy()
    return pa.RecordBatch.from_arrays(
        [
            rows["label"].combine_chunks().slice(0, 1),
            pa.array([dim], pa.int32()),
            pa.array([float(rows["length"][0].as_py())], pa.float64()),
            pa.array([width], pa.int32()),
            pa.array([marks.tobytes() if marks.any() else None], pa.binary()),
            pa.array([rows["row"].to_numpy().astype("<i8").tobytes()], pa.binary()),
            pa.array([rows["id"].to_pylist()], pa.list_(pa.int64())),
            pa.array([matrix.astype(f"<i{width}").tobytes()], pa.binary()),
            pa.array([orders.tobytes()], pa.binary()),
        ],
        names=[column.split()[0] for column in BUCKET_SCHEMA.split(", ")],
    )


def _unit(matrix: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; zero rows stay."""
    length = np.sqrt(np.einsum("ij,ij->i", matrix, matrix))
    return matrix / np.where(length > 0, length, 1.0)[:, None]


def _matrix(row: dict) -> np.ndarray:
    made = np.frombuffer(row["matrix"], f"<i{row['width']}")
    return made.reshape(len(row["ids"]), row["dim"])


def _unpacked(batches):
    """The anchors of buckets, one row each."""
    import pyarrow as pa

    for batch in batches:
        for row in batch.to_pylist():
            at = np.flatnonzero(np.frombuffer(row["anchors"], bool))
            vectors = _matrix(row)[at].astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.frombuffer(row["rows"], "<i8")[at]),
                    pa.array([row["ids"][k] for k in at], pa.int64()),
                    pa.array(np.full(len(at), row["label"], np.int64)),
                    pa.array(np.full(len(at), row["dim"], np.int32)),
                    pa.array(vectors.tolist(), pa.list_(pa.int64())),
                ],
                names=["row", "id", "label", "dim", "vec"],
            )


class _Block:
    """A bounded number of anchors, and what each of them looks for."""

    def __init__(self, anchors: list[tuple], focus: int):
        self.rows = np.array([a[0] for a in anchors], dtype=np.int64)
        self.ids = [a[1] for a in anchors]
        self.labels = np.array([a[2] for a in anchors], dtype=np.int64)
        self.dims = np.array([a[3] for a in anchors], dtype=np.int64)
        self.vectors = [np.array(a[4], dtype=np.int64) for a in anchors]
        self.lengths = np.array([np.sqrt((v.astype(np.float64) ** 2).sum()) for v in self.vectors])
        self.focus = [np.argsort(-np.abs(v.astype(np.float64)), kind="stable")[:focus] for v in self.vectors]
        self.wanted: list[list[tuple]] = [[] for _ in anchors]  # (slot, positive id, its score, least, greatest)

    def aim(self, found: list, low: tuple[int, int], high: tuple[int, int]) -> None:
        """Keep the positives, and between which scores the negatives of each have to lie."""
        place = {row: k for k, row in enumerate(self.rows.tolist())}
        for row in found:
            score = row["score"]
            least, greatest = -(-low[0] * score // low[1]), high[0] * score // high[1]
            if least <= greatest:
                self.wanted[place[row["anchor"]]].append((row["slot"], row["id"], score, least, greatest))


class _Bucket:
    """The vectors of one bucket with their sorted coordinate lists."""

    def __init__(self, row: dict):
        self.label, self.dim, self.longest = row["label"], row["dim"], row["longest"]
        self.rows = np.frombuffer(row["rows"], "<i8")
        self.ids = row["ids"]
        last = np.iinfo(np.int64).max
        self.id_order = np.array([last if i is None else i for i in self.ids], dtype=np.int64)
        self.whole = _matrix(row)
        self.floats = self.whole.astype(np.float64)
        self.unit = _unit(self.floats)
        self.orders = np.frombuffer(row["orders"], "<u4").reshape(self.dim, len(self.rows))

    def products(self, at, anchors: list[np.ndarray], bound: float) -> np.ndarray:
        """Exact products of some anchors with all vectors, or with those at the places `at`."""
        q = np.stack(anchors)
        if bound < EXACT:
            vectors = self.floats if at is None else self.floats[at]
            return (q.astype(np.float64) @ vectors.T).astype(np.int64)
        vectors = self.whole if at is None else self.whole[at]
        if bound < WIDE:
            return q @ vectors.astype(np.int64).T
        limits = np.iinfo(np.int64)
        made = np.dot(q.astype(object), vectors.astype(object).T).reshape(len(q), len(vectors))
        return np.array([[min(max(int(x), limits.min), limits.max) for x in line] for line in made], dtype=np.int64)

    def matches(self, block: _Block, chosen: np.ndarray, least: np.ndarray):
        """(anchor, places, scores) for each chosen anchor; all vectors that score at least `least` are among them.

        `least` is a float per chosen anchor, minus infinity where anything will do.
        """
        n = len(self.rows)
        lengths = block.lengths[chosen]
        reach = lengths * self.longest
        near = (least <= 0) | (least <= reach * (1 + SLACK))  # else the bucket is too short
        chosen, least, reach = chosen[near], least[near], reach[near]
        if not len(chosen):
            return
        pruned = (least > 0) & (self.dim > 0)
        starts, stops, lists = self._ranges(block, chosen, np.where(pruned, least, 0.0), reach)
        widths = np.where(pruned[:, None], stops - starts, n) if self.dim else np.full((len(chosen), 1), n)
        narrow = pruned & (widths.min(axis=1) < n // 2)
        bound = float(reach.max()) * (1 + SLACK) + 1
        for k in np.flatnonzero(narrow).tolist():
            by = int(widths[k].argmin())
            places = self.orders[lists[k, by], starts[k, by] : stops[k, by]]
            for other in range(widths.shape[1]):
                if other != by and len(places):
                    j = lists[k, other]
                    ranked = self._rank(j)[places]
                    places = places[(ranked >= starts[k, other]) & (ranked < stops[k, other])]
            if len(places):
                yield chosen[k], places, self.products(places, [block.vectors[chosen[k]]], bound)[0]
        wide = np.flatnonzero(~narrow)
        every = np.arange(n)
        for part in np.array_split(wide, -(-len(wide) // 256)) if len(wide) else ():
            scores = self.products(None, [block.vectors[chosen[k]] for k in part], bound)
            for k, line in zip(part.tolist(), scores, strict=True):
                yield chosen[k], every, line

    def _ranges(self, block: _Block, chosen, least, reach):
        """Where each anchor's focus lists begin and end to be feasible."""
        focus = np.stack([block.focus[k] for k in chosen]) if self.dim else np.zeros((len(chosen), 0), np.int64)
        with np.errstate(divide="ignore", invalid="ignore"):
            angle = np.arccos(np.clip(np.where(reach > 0, least / reach, 1.0), -1.0, 1.0))[:, None]
            values = np.stack([block.vectors[k][f] for k, f in zip(chosen, focus, strict=True)]).astype(np.float64)
            lengths = block.lengths[chosen][:, None]
            own = np.arccos(np.clip(np.where(lengths > 0, values / lengths, 0.0), -1.0, 1.0))
        lows = np.cos(np.minimum(own + angle, np.pi)) - SLACK
        highs = np.cos(np.maximum(own - angle, 0.0)) + SLACK
        starts, stops = np.zeros(focus.shape, np.int64), np.zeros(focus.shape, np.int64)
        for j in np.unique(focus):
            at = focus == j
            values = self.unit[self.orders[j], j]
            starts[at] = np.searchsorted(values, lows[at], "left")
            stops[at] = np.searchsorted(values, highs[at], "right")
        return starts, stops, focus

    def _rank(self, j: int) -> np.ndarray:
        """Each vector's place in a coordinate's list."""
        ranks = self.__dict__.setdefault("_ranks", {})
        if j not in ranks:
            ranks[j] = np.empty(len(self.rows), np.int64)
            ranks[j][self.orders[j]] = np.arange(len(self.rows))
        return ranks[j]


class _Best:
    """The first `most` rows found so far: higher scores, then smaller ids, then rows."""

    __slots__ = ("most", "found", "least")

    def __init__(self, most: int, least: int | float):
        self.most, self.found, self.least = most, [], least

    def add(self, scores, id_order, rows, ids) -> None:
        """Take rows that score at least `least`."""
        if len(scores) > 4 * self.most:
            cut = np.partition(scores, len(scores) - self.most)[len(scores) - self.most]
            at = np.flatnonzero(scores >= cut)
            scores, id_order, rows, ids = scores[at], id_order[at], rows[at], [ids[k] for k in at]
        for s, o, r, i in zip(scores.tolist(), id_order.tolist(), rows.tolist(), ids, strict=True):
            self.found.append((-s, o, r, i))
        self.found.sort(key=lambda f: f[:3])
        del self.found[self.most :]
        if len(self.found) == self.most:
            self.least = max(self.least, -self.found[-1][0])


def _positives(buckets: DataFrame, block: _Block, most: int) -> list:
    """The first `most` other rows of each anchor's label, at most that many per anchor of the block."""

    def searched(batches):
        best = {}
        for bucket in _read(batches):
            chosen = np.flatnonzero((block.labels == bucket.label) & (block.dims == bucket.dim))
            for k in chosen.tolist():
                best.setdefault(k, _Best(most, -np.inf))
            least = np.array([best[k].least for k in chosen.tolist()], dtype=np.float64)
            for k, places, scores in bucket.matches(block, chosen, least):
                keep = np.flatnonzero((scores >= best[k].least) & (bucket.rows[places] != block.rows[k]))
                _take(best[k], bucket, places[keep], scores[keep])
        yield from _emitted(block, [(k, 0, b) for k, b in best.items()])

    found = _ranked(buckets.mapInArrow(searched, FOUND), ["anchor"], most)
    return found.select("anchor", F.col("rank").alias("slot"), "id", "score").collect()


def _negatives(buckets: DataFrame, block: _Block, most: int) -> DataFrame:
    """The first `most` rows of other labels between the scores that each positive of the block allows."""

    def searched(batches):
        best = {}
        aiming = np.array([bool(w) for w in block.wanted])
        for bucket in _read(batches):
            chosen = np.flatnonzero(aiming & (block.labels != bucket.label) & (block.dims == bucket.dim))
            for k in chosen.tolist():
                if k not in best:
                    best[k] = [_Best(most, w[3]) for w in block.wanted[k]]
            least = np.array([min(b.least for b in best[k]) for k in chosen.tolist()], dtype=np.float64)
            for k, places, scores in bucket.matches(block, chosen, least):
                some = np.flatnonzero(scores >= min(b.least for b in best[k]))
                if len(some):
                    places, scores = places[some], scores[some]
                    for want, b in zip(block.wanted[k], best[k], strict=True):
                        keep = np.flatnonzero((scores >= want[3]) & (scores <= want[4]) & (scores >= b.least))
                        _take(b, bucket, places[keep], scores[keep])
        yield from _emitted(block, [(k, w[0], b) for k, bs in best.items() for w, b in zip(block.wanted[k], bs, strict=True)])

    found = _ranked(buckets.mapInArrow(searched, FOUND), ["anchor", "slot"], most)
    wanted = [
        (row, w[0], block.ids[k], w[1], w[2]) for k, row in enumerate(block.rows.tolist()) for w in block.wanted[k]
    ]
    spark = buckets.sparkSession
    aims = spark.createDataFrame(wanted, "anchor long, slot int, anchor_id long, positive_id long, positive_score long")
    return found.join(aims, ["anchor", "slot"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def _read(batches):
    for batch in batches:
        for k in range(batch.num_rows):
            yield _Bucket({name: batch.column(name)[k].as_py() for name in batch.schema.names})


def _take(best: _Best, bucket: _Bucket, places, scores) -> None:
    if len(places):
        best.add(scores, bucket.id_order[places], bucket.rows[places], [bucket.ids[p] for p in places.tolist()])


def _emitted(block: _Block, best: list):
    import pyarrow as pa

    rows = [(int(block.rows[k]), slot, f[2], f[3], -f[0]) for k, slot, b in best for f in b.found]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    columns = [pa.array([r[c] for r in rows], kind) for c, kind in enumerate(kinds)]
    yield pa.RecordBatch.from_arrays(columns, names=["anchor", "slot", "row", "id", "score"])


def _ranked(found: DataFrame, by: list[str], most: int) -> DataFrame:
    """The first rows over all tasks; each task gives at most `most` per anchor and slot."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)
