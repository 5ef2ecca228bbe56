"""Near-duplicate vectors by an inverted multi-index.

Unit vectors are cut in halves, and each half gets a codebook of its own; a
pair of codewords, one of each book, is a cell of the grid. Every distinct
vector lies in the cell of its nearest codewords. As a query it walks the
cells by the multi-sequence order, least lower bound first, and stops when no
unseen cell can hold a vector within the radius: points nearer to codeword i
than to codeword b lie at least (d_i^2 - d_b^2) / (2 |c_i - c_b|) away. So no
link is missed, whatever the codebooks. Of two cells within reach of each other
only one's vectors visit the other, and a link counts for both of its ends.
A row that is sent costs as much as many products, so cells are large. What
they hold is verified by the cosine in double precision.
"""

from __future__ import annotations

from heapq import heappop, heappush

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerkit.llm.common import checkpointed, components, merge_labels

#: Widens the walk beyond rounding errors of the bounds.
_SLACK = 1e-9

#: About so many vectors of a label to a cell. Fewer need less products, but are sent to more cells.
_MEMBERS = 1024


def codebook(points: np.ndarray, size: int, rounds: int = 12, seed: int = 42) -> np.ndarray:
    """Centres of a k-means over the rows, at most `size` of them."""
    if not points.shape[1]:
        return points[:1]
    random = np.random.default_rng(seed)
    points = np.unique(points, axis=0)
    centres = points[random.permutation(len(points))[:size]].copy()
    for _ in range(rounds):
        nearest = _squares(points, centres).argmin(axis=1)
        for k in range(len(centres)):
            mine = points[nearest == k]
            if len(mine):
                centres[k] = mine.mean(axis=0)
    return np.unique(centres, axis=0)


def _squares(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    squares = (points**2).sum(axis=1)[:, None] + (centres**2).sum(axis=1) - 2 * points @ centres.T
    return np.maximum(squares, 0)


def _bounds(squares: np.ndarray, gaps: np.ndarray) -> np.ndarray:
    """Squared lower bound of the distance from each point to each codeword's region."""
    bound = np.zeros_like(squares)
    for b in range(squares.shape[1]):
        with np.errstate(divide="ignore", invalid="ignore"):
            away = np.where(gaps[b] > 0, (squares - squares[:, b : b + 1]) / (2 * gaps[b]), 0.0)
        bound = np.maximum(bound, away)
    return bound**2


def walk(first: np.ndarray, second: np.ndarray, radius: float) -> list[tuple[int, int]]:
    """Cells by increasing sum of two sorted sequences, while the sum is within the squared radius.

    `first` and `second` are one vector's bounds to the codewords of either
    book. A cell enters the heap when both its predecessors have been visited.
    """
    i_order, j_order = first.argsort(kind="stable"), second.argsort(kind="stable")
    a, b = first[i_order].tolist(), second[j_order].tolist()
    limit = radius * radius + _SLACK
    heap = [(a[0] + b[0], 0, 0)]
    done = [0] * len(a)  # cells visited in each row of the grid
    out = []
    while heap:
        cost, i, j = heappop(heap)
        if cost > limit:
            break
        out.append((int(i_order[i]), int(j_order[j])))
        done[i] += 1
        if i + 1 < len(a) and done[i + 1] == j:
            heappush(heap, (a[i + 1] + b[j], i + 1, j))
        if j + 1 < len(b) and (i == 0 or done[i - 1] > j + 1):
            heappush(heap, (a[i] + b[j + 1], i, j + 1))
    return out


def fitted_reach(
    points: np.ndarray, books: tuple[np.ndarray, np.ndarray], least: float, target: float, seed: int = 42
) -> float:
    """How far the walks go: the whole radius for a `target` of 1.

    For less, neighbours at exactly the cosine `least` are planted around sample
    vectors in random directions, and the reach is the least that meets the
    share `target` of them. Links along the directions in which the data varies
    cross more borders, and are met less often than that.
    """
    radius = float(np.sqrt(max(0.0, 2 - 2 * least)))
    if target >= 1 or points.shape[1] < 2:
        return radius
    random = np.random.default_rng(seed)
    base = points[random.integers(len(points), size=20_000)]
    away = random.normal(size=base.shape)
    away -= (away * base).sum(axis=1)[:, None] * base
    away /= np.maximum(np.sqrt((away**2).sum(axis=1)), 1e-300)[:, None]
    planted = least * base + np.sqrt(max(0.0, 1 - least**2)) * away
    half = len(books[0][0])
    bound = np.zeros(len(base))
    for part, book in ((slice(None, half), books[0]), (slice(half, None), books[1])):
        gaps = np.sqrt(_squares(book, book))
        to = _squares(planted[:, part], book).argmin(axis=1)
        for k in range(0, len(base), 2000):
            mine = slice(k, k + 2000)
            bounds = _bounds(_squares(base[mine, part], book), gaps)
            bound[mine] += bounds[np.arange(len(bounds)), to[mine]]
    return min(radius, float(np.sqrt(np.quantile(bound, target))))


def _unit(vectors: list) -> np.ndarray:
    rows = np.array(vectors, dtype=np.float64)
    rows /= np.abs(rows).max(axis=1)[:, None]
    return rows / np.sqrt((rows**2).sum(axis=1))[:, None]


def _visits(own: np.ndarray, cell: np.ndarray) -> np.ndarray:
    """Whether the vectors of cell `own` visit `cell`: their own, and of each two cells one the other, half of all."""
    return (own == cell) | ((cell < own) ^ ((cell + own) % 2 == 1))


def _cells(books: dict[int, tuple[np.ndarray, np.ndarray]], reach: dict[int, float]):
    """Each vector's own cell, and a row for every cell it visits; a length without books is one cell."""

    def run(batches):
        by_length = (same for b in batches for _, same in b.groupby(b["vec"].map(len).to_numpy()))
        for batch in (same.iloc[k : k + 256] for same in by_length for k in range(0, len(same), 256)):
            unit = _unit(batch["vec"].tolist())
            length = unit.shape[1]
            half = length // 2
            pair = books.get(length) or (np.zeros((1, half)), np.zeros((1, length - half)))
            width = len(pair[1])
            parts = unit[:, :half], unit[:, half:]
            squares = [_squares(p, b) for p, b in zip(parts, pair, strict=True)]
            own = squares[0].argmin(axis=1) * width + squares[1].argmin(axis=1)
            bounds = [_bounds(s, np.sqrt(_squares(b, b))) for s, b in zip(squares, pair, strict=True)]
            rows, cells = [], []
            for k in range(len(batch)):
                seen = walk(bounds[0][k], bounds[1][k], reach.get(length, 0.0))
                rows += [k] * len(seen)
                cells += [i * width + j for i, j in seen]
            rows, cells = np.array(rows), np.array(cells)
            meant = _visits(own[rows], cells)
            rows, cells = rows[meant], cells[meant]
            for k in range(0, len(rows), 4096):
                row, cell = rows[k : k + 4096], cells[k : k + 4096]
                yield pd.DataFrame(
                    {
                        "label": batch["label"].to_numpy()[row],
                        "id": batch["id"].to_numpy()[row],
                        "copies": batch["copies"].to_numpy()[row],
                        "vec": batch["vec"].to_numpy()[row],
                        "n": length,
                        "cell": cell,
                        "own": own[row] == cell,
                    }
                )

    return run


def _verified(least: float):
    """Links between the members of a cell and its visitors, from both lists in one group."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        members = group[group["own"] & (group["side"] == 0)]
        visitors = group[group["side"] == 1]
        if not len(members) or not len(visitors):
            return pd.DataFrame({"a": [], "b": [], "links": []}).astype("int64")
        m, v = members["id"].to_numpy(), visitors["id"].to_numpy()
        m_unit, v_unit = _unit(members["vec"].tolist()), _unit(visitors["vec"].tolist())
        m_copies, v_copies = members["copies"].to_numpy(), visitors["copies"].to_numpy()
        own = visitors["own"].to_numpy()
        ids, place = np.unique(np.concatenate((v, m)), return_inverse=True)
        labels = np.arange(len(ids))
        found = np.zeros(len(ids), dtype="int64")
        for k in range(0, len(v), 512):
            part = slice(k, k + 512)
            linked = v_unit[part] @ m_unit.T >= least
            # Two members of a cell meet twice, as either's visitor.
            linked &= np.where(own[part, None], v[part, None] < m, v[part, None] != m)
            row, col = np.nonzero(linked)
            merge_labels(labels, place[k + row], place[len(v) + col])
            # Both ends of a link count it; every id, members too, has an edge to its class in this group.
            np.add.at(found, place[k + row], m_copies[col])
            np.add.at(found, place[len(v) + col], v_copies[k + row])
        told = (found > 0) | (labels != np.arange(len(ids)))
        return pd.DataFrame({"a": ids[told], "b": ids[labels[told]], "links": found[told]})

    return run


NO_ID = 1 << 62


def near_vectors(
    vectors: DataFrame,
    least: float = 0.98,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    sample: int = 20_000,
    words: int | None = None,
    group: int = 4096,
    target: float = 1.0,
) -> DataFrame:
    """Per row: id, n_links, component_id, kept.

    Two vectors are linked if their labels are equal and not null and their
    cosine is `least` or more; those of different lengths have none. Vectors
    that are null, empty, zero, or hold nulls or numbers that aren't finite link
    with nothing. Equal vectors of a label are one vector to the search, with a
    number of copies, and link with each other.
    component_id is the smallest id that links lead to, itself included, and
    null where none of them has one. Ids are longs below 2**62; rows that repeat
    an id count as copies of it.

    Each length has codebooks of its own, fitted on the driver on at most
    `sample` rows for all; a length that the sample misses is one cell. The number
    of codewords of a book follows the number of vectors that share a label,
    about _MEMBERS to a cell, unless `words` says it. Every link is found. A
    `target` below 1 asks for less: the share of neighbours at exactly `least`,
    in random directions, that the walks have to meet (see `fitted_reach`). A
    cell with more than `group` members, or visitors, is dealt in slices of
    that size.
    """
    plain = vectors.select(vectors[id_col].alias("id"), vectors[vec_col].alias("vec"), vectors[label_col].alias("label"))
    fit = F.coalesce(
        (F.size("vec") > 0)
        & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("vec", lambda x: x != 0),
        F.lit(False),
    ) & F.col("label").isNotNull()
    rows = plain.select("id", "label", F.when(fit, F.transform("vec", lambda x: x.cast("double"))).alias("vec"))
    usable = rows.filter("vec is not null").withColumn("vec", F.transform("vec", lambda x: x + F.lit(0.0)))  # -0 is 0
    # Vectors without any id go by a number above all ids; it is taken away again below.
    own = F.lit(NO_ID) + F.xxhash64("label", "vec").bitwiseAND(NO_ID - 1)
    distinct = checkpointed(
        usable.groupBy("label", "vec").agg(F.min("id").alias("id"), F.count("*").alias("copies"))
        .withColumn("id", F.coalesce("id", own))
    )
    total = distinct.count()
    if not total:
        return rows.select(
            F.col("id").alias(id_col),
            F.lit(0).cast("long").alias("n_links"),
            F.col("id").alias("component_id"),
            F.lit(True).alias("kept"),
        )
    share = min(1.0, 2 * sample / total)
    drawn = distinct.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < int(share * (1 << 20))).select("vec").limit(sample)
    points = {}
    for row in drawn.collect():
        points.setdefault(len(row.vec), []).append(row.vec)
    peers = distinct.groupBy("label", F.size("vec").alias("n")).count().groupBy("n")
    peers = peers.agg((F.sum(F.col("count") * F.col("count")) / F.sum("count")).alias("peers"))
    books, reach = {}, {}
    for row in peers.filter(F.col("n").isin(list(points))).collect():
        unit = _unit(points[row.n])
        size = words or max(1, min(256, round((row.peers / _MEMBERS) ** 0.5)))
        half = row.n // 2
        books[row.n] = codebook(unit[:, :half], size), codebook(unit[:, half:], size)
        reach[row.n] = fitted_reach(unit, books[row.n], least, target)
    schema = T.StructType(
        [distinct.schema["label"], distinct.schema["id"], distinct.schema["copies"], distinct.schema["vec"]]
        + [T.StructField("n", T.IntegerType()), T.StructField("cell", T.LongType()), T.StructField("own", T.BooleanType())]
    )
    placed = (
        distinct.select("label", "id", "copies", "vec")
        .repartition("id")
        .mapInPandas(_cells(books, reach), schema)
    )
    sizes = placed.groupBy("label", "n", "cell").agg(F.count_if("own").alias("members"), F.count("*").alias("visitors"))
    slices = sizes.filter("members > 0 and visitors > 1").select(
        "label",
        "n",
        "cell",
        F.ceil(F.col("members") / group).cast("int").alias("m"),
        F.ceil(F.col("visitors") / group).cast("int").alias("v"),
    )
    cut = placed.join(slices, ["label", "n", "cell"])
    turn = F.pmod(F.xxhash64("id"), F.lit(1 << 30))
    members = cut.filter("own").select(
        "label", "n", "cell", "id", "copies", "vec", "own", F.lit(0).alias("side"),
        (turn % F.col("m")).alias("m_slice"), F.explode(F.expr("sequence(0, v - 1)")).alias("v_slice"),
    )
    visitors = cut.select(
        "label", "n", "cell", "id", "copies", "vec", "own", F.lit(1).alias("side"),
        F.explode(F.expr("sequence(0, m - 1)")).alias("m_slice"), (turn % F.col("v")).alias("v_slice"),
    )
    found = checkpointed(
        members.unionByName(visitors.select(*members.columns))
        .groupBy("label", "n", "cell", "m_slice", "v_slice")
        .applyInPandas(_verified(least), "a long, b long, links long")
    )
    links = found.groupBy(F.col("a").alias("first")).agg(F.sum("links").alias("others"))
    classes = components(found.select("a", "b")).select(F.col("node").alias("first"), "component")
    named = (
        distinct.select("label", "vec", F.col("id").alias("first"), "copies")
        .join(links, "first", "left")
        .join(classes, "first", "left")
        .select(
            "label",
            "vec",
            (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "first").alias("component_id"),
        )
    )
    keyed = rows.select("id", "label", F.transform("vec", lambda x: x + F.lit(0.0)).alias("vec"))
    done = keyed.join(named, ["label", "vec"], "left").select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce(F.when(F.col("id").isNotNull() | (F.col("component_id") < NO_ID), F.col("component_id")), "id").alias("component_id"),
    )
    return done.withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))
