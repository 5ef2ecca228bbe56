"""Ranked lexical search by MaxScore with pair bounds, over shards of documents.

A shard is a bounded run of documents with a list per term: places of the
documents and how often they hold it. For a block of queries the lists of its
terms are turned into impact lists, and for pairs of an item's rarest terms the
intersection is listed too, with the largest joint impact. At query time a
shard's bound for an item is put together from disjoint pairs, each worth the
most that either term or both together give, which is less than the sum of
both maxima wherever the two peaks never meet, and from the terms left over.
Units whose bounds together stay below the score that is needed are not
essential: their lists only add to documents that the others have found, as
long as these can still get there. Whole shards are passed over the same way.

The score needed is known before the search: the k-th largest impact of any
list of the item over all shards is reached by k documents.
"""

from __future__ import annotations

import uuid
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from layerkit.llm.common import shared_folder

#: Bytes as terms hold them: A-Z small, digits, letters and all above ASCII as they are, the rest a space.
LETTERS = np.array(
    [c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)],
    dtype=np.uint8,
)
POSTINGS = "shard long, term string, n_docs int, n_terms long, docs binary, counts binary, ids array<long>"
LISTS = "shard long, a int, b int, greatest long, best array<long>, docs binary, impacts binary, ids array<long>"
NO_TERM = -1


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    most: int = 50,
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    text_col: str = "text",
    shard_docs: int = 8192,
    shard_bytes: int = 8 << 20,
    pair_terms: int = 8,
    block: int = 100_000,
) -> DataFrame:
    """item_id, rank, doc_id, score: each item's `most` best documents with a score above 0.

    Equal scores go by ascending doc_id, null ids last. A null text has no
    terms. Every row of docs is a document, also where rows or ids repeat; rows
    of items with one id are one item with the terms of them all, a null id
    being an id. Items go through in blocks of about `block` terms, each against
    all shards. Columns other than id and text aren't read.
    """
    spark = docs.sparkSession
    folder = f"{shared_folder(spark)}/search-{uuid.uuid4().hex}"
    _postings(docs.select(doc_id, text_col), shard_docs, shard_bytes).write.parquet(f"{folder}/postings")
    postings = spark.read.schema(POSTINGS).parquet(f"{folder}/postings")
    wanted = _terms(items.select(item_id, text_col)).distinct()
    held = postings.filter("term is not null")
    found = held.join(wanted.select("term").distinct(), "term").groupBy("term").agg(F.sum("n_docs").alias("df"))
    totals = postings.filter("term is null").agg(F.sum("n_docs"), F.sum("n_terms"), F.count(F.lit(1))).first()
    n, length, shards = (x or 0 for x in totals)
    weight = F.floor(F.lit(1000) * F.log(F.lit(2.0 * n + 2) / (2 * F.col("df") + 1)))
    wanted.join(found.select("term", weight.alias("w")), "term").write.parquet(f"{folder}/wanted")
    wanted = spark.read.parquet(f"{folder}/wanted")
    out = "item_id long, doc_id long, score long"
    spark.createDataFrame([], out).write.parquet(f"{folder}/found")
    blocks = -(-wanted.count() // block)
    for k in range(blocks):
        of_block = wanted.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == k)
        searched = _Block(of_block.collect(), most, pair_terms, max(8, -(-2 * most // max(shards, 1))))
        path = f"{folder}/lists-{k}"
        _impact_lists(postings, searched, n, length).write.parquet(path)
        lists = spark.read.schema(LISTS).parquet(path)
        searched.need(_reached(lists, most))
        hits = lists.groupBy("shard").applyInArrow(_searcher(searched), out)
        hits.write.mode("append").parquet(f"{folder}/found")
    hits = spark.read.schema(out).parquet(f"{folder}/found")
    best = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = hits.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= most)
    return ranked.select(F.col("item_id").alias(item_id), "rank", F.col("doc_id").alias(doc_id), "score")


def _split(column):
    """(terms as an Arrow array, number of terms of each text): Arrow cuts, numpy makes small letters."""
    import pyarrow as pa
    import pyarrow.compute as pc

    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    small = LETTERS[np.frombuffer(data, np.uint8)] if data is not None and data.size else np.empty(0, np.uint8)
    column = pa.Array.from_buffers(column.type, len(column), [None, offsets, pa.py_buffer(small)], offset=column.offset)
    cut = pc.ascii_split_whitespace(column)
    terms = cut.flatten()
    there = pc.greater(pc.binary_length(terms), 0).to_numpy(zero_copy_only=False)
    sizes = np.diff(cut.offsets.to_numpy())
    owner = np.repeat(np.arange(len(column)), sizes)
    return terms.filter(pa.array(there)), np.bincount(owner[there], minlength=len(column))


def _terms(items: DataFrame) -> DataFrame:
    """(item, term), as often as it occurs."""

    def cut(batches):
        import pyarrow as pa

        for batch in batches:
            terms, counts = _split(batch.column(1))
            owner = pa.array(np.repeat(np.arange(batch.num_rows), counts))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(owner), terms.cast(pa.string())], names=["item", "term"])

    first, second = items.columns
    items = items.select(items[first].cast("long").alias("item"), items[second].alias("text"))
    return items.mapInArrow(cut, "item long, term string")


def _postings(docs: DataFrame, shard_docs: int, shard_bytes: int) -> DataFrame:
    """A row per shard and term, and one per shard without a term: its documents' ids and lengths."""

    def inverted(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        shard, kept, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            bytes_of = pc.binary_length(batch.column(1).fill_null("")).to_numpy(zero_copy_only=False)
            start = 0
            for k in range(batch.num_rows):
                size += int(bytes_of[k]) + 1
                count = sum(b.num_rows for b in kept) + k + 1 - start
                if size >= shard_bytes or count >= shard_docs:
                    kept.append(batch.slice(start, k + 1 - start))
                    yield from _inverted(pa.Table.from_batches(kept).combine_chunks(), shard)
                    shard, kept, size, start = shard + 1, [], 0, k + 1
            if start < batch.num_rows:
                kept.append(batch.slice(start))
        if kept:
            yield from _inverted(pa.Table.from_batches(kept).combine_chunks(), shard)

    first, second = docs.columns
    docs = docs.select(docs[first].cast("long").alias("id"), docs[second].alias("text"))
    return docs.mapInArrow(inverted, POSTINGS)


def _inverted(rows, shard: int):
    import pyarrow as pa

    n = rows.num_rows
    terms, lengths = _split(rows["text"].combine_chunks())
    names = [c.split()[0] for c in POSTINGS.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64())]
    own = [[shard], [None], [int((lengths > 0).sum())], [int(lengths.sum())], [None], [lengths.astype("<u4").tobytes()],
           [rows["id"].to_pylist()]]
    yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(own, kinds, strict=True)], names=names)
    if not len(terms):
        return
    coded = terms.dictionary_encode()
    key = coded.indices.to_numpy().astype(np.int64) * n + np.repeat(np.arange(n), lengths)
    key, counts = np.unique(key, return_counts=True)
    code = key // n
    edges = np.append(np.flatnonzero(np.diff(code, prepend=-1)), len(code))
    docs, counts = (key % n).astype("<u4"), counts.astype("<u4")
    bounds = pa.py_buffer((4 * edges).astype(np.int32))
    k = len(edges) - 1
    binary = [pa.Array.from_buffers(pa.binary(), k, [None, bounds, pa.py_buffer(x.tobytes())]) for x in (docs, counts)]
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(k, shard)),
            coded.dictionary.cast(pa.string()),
            pa.array(np.diff(edges).astype(np.int32)),
            pa.nulls(k, pa.int64()),
            *binary,
            pa.nulls(k, kinds[6]),
        ],
        names=names,
    )


class _Block:
    """A bounded number of items: their terms as numbers, the pairs to list, and the score each needs."""

    def __init__(self, rows: list, most: int, pair_terms: int, seeds: int):
        self.most, self.seeds = most, seeds
        weights = {r["term"]: r["w"] for r in rows}
        self.code = {term: k for k, term in enumerate(sorted(weights))}
        self.weight = [weights[term] for term in sorted(weights)]
        by_item: dict = {}
        for r in rows:
            by_item.setdefault(r["item"], []).append(self.code[r["term"]])
        self.items = [(item, sorted(codes, key=lambda c: (-self.weight[c], c))) for item, codes in by_item.items()]
        self.chosen = [list(combinations(sorted(codes[:pair_terms]), 2)) for _, codes in self.items]
        self.pairs = sorted({pair for pairs in self.chosen for pair in pairs})
        self.needed = [0] * len(self.items)

    def need(self, reached: dict) -> None:
        """Scores that `most` documents are known to reach."""
        for k, (_, codes) in enumerate(self.items):
            units = [(c, NO_TERM) for c in codes] + self.chosen[k]
            self.needed[k] = max((reached.get(u, 0) for u in units), default=0)


def _impact_lists(postings: DataFrame, block: _Block, n: int, length: int) -> DataFrame:
    """Per shard the impact lists of the block's terms and pairs, and one row with the documents' ids."""
    spark = postings.sparkSession
    codes = spark.createDataFrame(list(block.code.items()), "term string, code int")
    of_terms = postings.filter("term is not null").join(codes, "term")
    own = postings.filter("term is null").withColumn("code", F.lit(NO_TERM))
    columns = ["shard", "code", "docs", "counts", "ids"]
    rows = of_terms.select(*columns).unionByName(own.select(*columns))
    weight, pairs, seeds = block.weight, block.pairs, block.seeds

    def listed(table):
        import pyarrow as pa

        rows = table.to_pylist()
        own = next(r for r in rows if r["code"] == NO_TERM)
        lengths = np.frombuffer(own["counts"], "<u4").astype(object)  # products may pass 64 bits
        m = np.array([50 + 50 * int(x) * n // length if length else 50 for x in lengths], dtype=np.int64)
        lists = {}
        for r in rows:
            if r["code"] != NO_TERM:
                docs = np.frombuffer(r["docs"], "<u4")
                tf = np.frombuffer(r["counts"], "<u4").astype(np.int64)
                lists[r["code"]] = docs, weight[r["code"]] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[docs]))
        shard = rows[0]["shard"]
        out = [(shard, NO_TERM, NO_TERM, 0, [], None, None, own["ids"])]
        out += [_listed(shard, a, NO_TERM, *found, seeds) for a, found in lists.items()]
        for a, b in pairs:
            if a in lists and b in lists:
                (left, x), (right, y) = lists[a], lists[b]
                both, at, to = np.intersect1d(left, right, assume_unique=True, return_indices=True)
                if len(both):
                    out.append(_listed(shard, a, b, both, x[at] + y[to], seeds))
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.list_(pa.int64())]
        columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
        return pa.Table.from_arrays(columns, names=[c.split()[0] for c in LISTS.split(", ")])

    return rows.groupBy("shard").applyInArrow(listed, LISTS)


def _listed(shard: int, a: int, b: int, docs: np.ndarray, impacts: np.ndarray, seeds: int) -> tuple:
    best = np.sort(impacts)[::-1][:seeds].tolist()
    return shard, a, b, best[0], best, docs.astype("<u4").tobytes(), impacts.astype("<i8").tobytes(), None


def _reached(lists: DataFrame, most: int) -> dict:
    """For each list the `most`-th largest impact over all shards, where their best ones are that many."""
    best = lists.filter(F.col("a") >= 0).select("a", "b", F.explode("best").alias("impact"))
    order = Window.partitionBy("a", "b").orderBy(F.desc("impact"))
    last = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") == most)
    return {(r["a"], r["b"]): r["impact"] for r in last.collect()}


def _searcher(block: _Block):
    """Each shard's best documents for each item of the block."""

    def searched(table):
        import pyarrow as pa

        lists, ids = {}, None
        for name_a, name_b, greatest, k in zip(
            table["a"].to_pylist(), table["b"].to_pylist(), table["greatest"].to_pylist(), range(table.num_rows), strict=True
        ):
            if name_a == NO_TERM:
                ids = np.array(table["ids"][k].as_py(), dtype=object)
            else:
                lists[name_a, name_b] = _List(table, k, greatest)
        hits = []
        for (item, codes), chosen, needed in zip(block.items, block.chosen, block.needed, strict=True):
            docs, scores = best_of_shard(lists, codes, chosen, needed, block.most, ids)
            hits += zip([item] * len(docs), ids[docs].tolist(), scores.tolist(), strict=True)
        columns = [pa.array([h[c] for h in hits], pa.int64()) for c in range(3)]
        return pa.Table.from_arrays(columns, names=["item_id", "doc_id", "score"])

    return searched


class _List:
    """A list of one shard, its arrays made when it is read."""

    __slots__ = ("_table", "_row", "greatest", "_arrays")

    def __init__(self, table, row: int, greatest: int):
        self._table, self._row, self.greatest, self._arrays = table, row, greatest, None

    def arrays(self) -> tuple[np.ndarray, np.ndarray]:
        if self._arrays is None:
            docs = np.frombuffer(self._table["docs"][self._row].as_py(), "<u4")
            self._arrays = docs, np.frombuffer(self._table["impacts"][self._row].as_py(), "<i8")
        return self._arrays


def units_of(lists: dict, codes: list[int], chosen: list[tuple[int, int]]) -> list[tuple[int, tuple[int, ...]]]:
    """(bound, terms) of disjoint units, smallest bound first: pairs where they tighten it most, then single terms."""
    bound = {c: lists[c, NO_TERM].greatest for c in codes if (c, NO_TERM) in lists}
    savings = []
    for a, b in chosen:
        if a in bound and b in bound:
            joint = lists[a, b].greatest if (a, b) in lists else 0
            most = max(bound[a], bound[b], joint)
            if most < bound[a] + bound[b]:
                savings.append((bound[a] + bound[b] - most, a, b, most))
    units = []
    for _, a, b, most in sorted(savings, reverse=True):
        if a in bound and b in bound:
            units.append((most, (a, b)))
            del bound[a], bound[b]
    return sorted([*units, *[(most, (c,)) for c, most in bound.items()]])


def best_of_shard(lists: dict, codes, chosen, needed: int, most: int, ids) -> tuple[np.ndarray, np.ndarray]:
    """Places and scores of the documents that may be among an item's first `most`; a score of `needed` is."""
    units = units_of(lists, codes, chosen)
    needed = max(needed, 1)
    nothing = np.empty(0, np.int64), np.empty(0, np.int64)
    before = np.cumsum([0, *[bound for bound, _ in units]])  # before[k]: what the first k units can add
    if before[-1] < needed:
        return nothing
    rest = int(np.searchsorted(before, needed, "left")) - 1  # units[:rest] together stay below what is needed
    total = np.zeros(len(ids), np.int64)
    for _, terms in units[rest:]:
        for c in terms:
            docs, impacts = lists[c, NO_TERM].arrays()
            total[docs] += impacts
    places = np.flatnonzero(total)
    for k in range(rest, -1, -1):
        scores = total[places]
        if len(places) > most:
            needed = max(needed, int(np.partition(scores, len(scores) - most)[len(scores) - most]))
        places = places[scores + before[k] >= needed]
        if not k or not len(places):
            break
        for c in units[k - 1][1]:
            docs, impacts = lists[c, NO_TERM].arrays()
            at = np.minimum(np.searchsorted(docs, places), len(docs) - 1)
            there = docs[at] == places
            total[places[there]] += impacts[at[there]]
    scores = total[places]
    if len(places) > most:
        order = sorted(range(len(places)), key=lambda k: (-scores[k], ids[places[k]] is None, ids[places[k]] or 0))[:most]
        places, scores = places[order], scores[order]
    return places, scores
