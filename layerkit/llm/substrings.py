"""Removal of repeated passages by prefix-partitioned suffix trees over words.

A passage that occurs twice shows as a node of the corpus's suffix tree that
lies at least `window` words deep and has two leaves or more. The tree is
never built whole:

1. Each distinct text is one string of words (copies of a text are counted,
   not repeated). In every window the shingle with the least hash is its
   anchor; equal windows have equal anchors at equal places, so only suffixes
   whose anchor occurs twice in the corpus can reach a deep inner node.
2. Those suffixes are dealt by the words at their anchor. Groups of one anchor
   have at most `group` occurrences, what a task's memory holds; suffixes of a more frequent anchor are
   dealt by a longer prefix, the whole window, as 128-bit hashes counted
   before they are shuffled.
3. A task takes groups that fit into its memory and grows their subtrees level
   by level: the nodes at depth 2d are pairs of nodes at depth d. Inner nodes
   at depth `window` mark their leaves. Neighbouring marked suffixes make one
   maximal passage.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerkit.llm.common import byte_slices, encoded, mixed

_BYTE_BASE = 0x9E3779B97F4A7C15
_WORD_BASE = 0xD6E8FEB86659FD93
KEY = ["k1", "k2"]


class Words:
    """The words of a few texts, as hashes in one array; text t has those from first[t] to first[t + 1]."""

    def __init__(self, texts: list[bytes]):
        joined = b" ".join(texts) + b" "
        data = np.frombuffer(joined, dtype=np.uint8)
        white = (data == 32) | ((data >= 9) & (data <= 13))
        edges = np.diff(np.concatenate(([True], white)).astype(np.int8))
        self.starts = np.nonzero(edges == -1)[0]
        self.ends = np.nonzero(edges == 1)[0]
        if len(self.ends) < len(self.starts):
            self.ends = np.append(self.ends, len(data))
        self.data = joined
        lengths = np.array([len(t) + 1 for t in texts])
        self.first = np.concatenate(([0], np.searchsorted(self.starts, np.cumsum(lengths))))
        power, back = _powers(_BYTE_BASE, len(data) + 1)
        letters = mixed(np.arange(1, 257, dtype=np.uint64))
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(letters[data] * power[: len(data)])))
        self.hashes = mixed((sums[self.ends] - sums[self.starts]) * back[self.starts])

    def shingles(self, size: int, salt: int = 0) -> np.ndarray:
        """Hash of the `size` words from each word on; the last size - 1 have none."""
        n = len(self.hashes)
        if n < size:
            return np.zeros(0, dtype=np.uint64)
        power, back = _powers(_WORD_BASE, n + 1)
        hashes = mixed(self.hashes + np.uint64(salt)) if salt else self.hashes
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes * power[:n])))
        return mixed((sums[size:] - sums[:-size]) * back[: n - size + 1])

    def text(self, first: int, last: int) -> bytes:
        """The words from first up to last, without last, as they stand in the text."""
        return self.data[self.starts[first] : self.ends[last - 1]]


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2 to the 64, and those of its inverse."""
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        steps = np.full(n, b, dtype=np.uint64)
        steps[0] = 1
        out.append(np.cumprod(steps))
    return out[0], out[1]


def anchors(words: Words, window: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window start, anchor, anchor hash) for every window that lies in one text.

    The anchor is the leftmost shingle of `size` words with the least hash of
    the window. Places are packed under the upper 40 bits of the hashes, so that
    one minimum gives both; the number is fixed, for equal windows to agree
    wherever they stand. Only a text of over 16 million words leaves less.
    """
    hashes = words.shingles(size)
    choice = window - size + 1
    if len(hashes) < choice:
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, np.zeros(0, dtype=np.uint64)
    bits = np.uint64(max(24, len(hashes).bit_length()))
    least = ((hashes >> bits) << bits) | np.arange(len(hashes), dtype=np.uint64)
    reach = 1
    while 2 * reach <= choice:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if reach < choice:
        rest = choice - reach
        least = np.minimum(least[:-rest], least[rest:])
    at = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    inside = np.zeros(len(words.hashes) + 1, dtype=bool)
    room = np.diff(words.first)
    for first, n in zip(words.first[:-1][room >= window].tolist(), room[room >= window].tolist(), strict=True):
        inside[first : first + n - window + 1] = True
    start = np.nonzero(inside[: len(at)])[0]
    return start, at[start], hashes[at[start]]


def _runs(values: np.ndarray) -> np.ndarray:
    """Index of the first of each run of equal neighbours."""
    if not len(values):
        return np.zeros(0, dtype=np.int64)
    return np.concatenate(([0], np.nonzero(values[1:] != values[:-1])[0] + 1))


def _listed(keys: list[np.ndarray], values: np.ndarray):
    """Values of equal keys as lists: an index of each distinct key, and the lists as an Arrow array."""
    import pyarrow as pa

    order = np.lexsort((values, *keys))
    change = np.zeros(len(order), dtype=bool)
    change[:1] = True
    for key in keys:
        change[1:] |= key[order][1:] != key[order][:-1]
    begin = np.nonzero(change)[0]
    offsets = pa.array(np.append(begin, len(order)).astype(np.int32))
    return order[begin], pa.ListArray.from_arrays(offsets, pa.array(values[order].astype(np.int32)))


def _anchor_rows(window: int, size: int):
    """The anchors of every text: hash, the text's key, the places in the text that have it.

    A text that says the same over and over gives one row for each hash, so it
    makes no hash frequent in the shuffle.
    """

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = encoded(batch.column(2).to_pylist())
            for low, high in byte_slices(texts):
                words = Words(texts[low:high])
                _, at, hashes = anchors(words, window, size)
                place = at[_runs(at)]
                hashes = hashes[_runs(at)]
                text = np.searchsorted(words.first, place, "right") - 1
                found, places = _listed([hashes, text], place - words.first[text])
                hashes, text = hashes[found], text[found]
                rows = pa.array(text + low)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes.view(np.int64)), batch.column(0).take(rows), batch.column(1).take(rows), places],
                    ["h", *KEY, "places"],
                )

    return run


def _suffix_rows(window: int, size: int, group: int, frequent: bool):
    """The suffixes of repeated anchors: those of one anchor as one stretch of words, or each one's hashes.

    Rows are a text's key, the text, and `hits`, its (places, count) of anchors
    found repeated. Equal windows of one text come as one row with a list of
    starts.
    """

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = encoded(batch.column(2).to_pylist())
            hits = batch.column(3).to_pylist()
            for low, high in byte_slices(texts):
                words = Words(texts[low:high])
                start, at, hashes = anchors(words, window, size)
                wanted = np.zeros(len(words.hashes) + 1, dtype=bool)
                for t in range(low, high):
                    for hit in hits[t]:
                        if (hit["n"] > group) == frequent:
                            wanted[words.first[t - low] + np.array(hit["places"])] = True
                chosen = wanted[at]
                start, at, hashes = start[chosen], at[chosen], hashes[chosen]
                first = _runs(at)
                if frequent:
                    text = np.searchsorted(words.first, start, "right") - 1
                    one, two = words.shingles(window)[start], words.shingles(window, salt=1)[start]
                    found, starts = _listed([one, two, text], start - words.first[text])
                    columns = [pa.array(one[found].view(np.int64)), pa.array(two[found].view(np.int64))]
                    text = text[found]
                else:
                    n = np.diff(np.append(first, len(at)))
                    begin = start[first]
                    text = np.searchsorted(words.first, begin, "right") - 1
                    columns = [
                        pa.array(hashes[first].view(np.int64)),
                        pa.array(n.astype(np.int32)),
                        pa.array(
                            [words.text(a, a + k - 1 + window) for a, k in zip(begin.tolist(), n.tolist(), strict=True)],
                            pa.binary(),
                        ),
                    ]
                    starts = pa.array((begin - words.first[text]).astype(np.int32))
                rows = pa.array(text + low)
                yield pa.RecordBatch.from_arrays(
                    [*columns, batch.column(0).take(rows), batch.column(1).take(rows), starts],
                    [*(["w1", "w2"] if frequent else ["h", "n", "words"]), *KEY, "starts" if frequent else "start"],
                )

    return run


def deep_leaves(symbols: np.ndarray, leaves: np.ndarray, depth: int) -> np.ndarray:
    """Which of the suffixes at `leaves` lie under an inner node at least `depth` symbols deep.

    Level by level: a node at depth 2d is a pair of nodes at depth d, numbered
    in order. Suffixes alone under their node are leaves already and go no
    deeper. The last level overlaps the one before to reach `depth`.
    """
    alive = np.arange(len(leaves))
    node = symbols.astype(np.int64)
    reach = 1
    while True:
        step = min(reach, depth - reach)
        if not step:
            break
        far = np.concatenate((node[step:], np.full(step, -1)))
        if 2 * reach >= depth:
            pair = np.stack((node[leaves[alive]], far[leaves[alive]]))
            _, label, count = np.unique(
                pair[0] * (node.max() + 2) + pair[1] + 1, return_inverse=True, return_counts=True
            )
            alive = alive[count[label] > 1]
            break
        _, node = np.unique(node * (node.max() + 2) + far + 1, return_inverse=True)
        reach *= 2
        lives = np.bincount(node[leaves[alive]], minlength=1)
        alive = alive[lives[node[leaves[alive]]] > 1]
    if depth == 1:
        lives = np.bincount(node[leaves])
        alive = alive[lives[node[leaves]] > 1]
    out = np.zeros(len(leaves), dtype=bool)
    out[alive] = True
    return out


def _repeated_rows(window: int, most_words: int = 1_500_000):
    """Subtrees of the groups that a task gets, a memory's worth at a time; gives runs of repeated suffixes."""

    def grown(held: list[tuple[pd.DataFrame, np.ndarray, np.ndarray]]) -> pd.DataFrame:
        frame = pd.concat([f for f, _, _ in held])
        symbols = np.concatenate([x for _, x, _ in held])
        lengths = np.concatenate([x for _, _, x in held])
        n = frame["n"].to_numpy()
        first = np.cumsum(lengths) - lengths
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        deep = deep_leaves(symbols, np.repeat(first, n) + step, window)
        row = np.repeat(np.arange(len(frame)), n)[deep]
        place = step[deep]
        begin = np.ones(len(row), dtype=bool)
        begin[1:] = (row[1:] != row[:-1]) | (place[1:] != place[:-1] + 1)
        begin = np.nonzero(begin)[0]
        run = np.diff(np.append(begin, len(row)))
        rows = row[begin]
        start = frame["start"].to_numpy()[rows] + place[begin]
        found = {"k1": frame["k1"].to_numpy()[rows], "k2": frame["k2"].to_numpy()[rows]}
        return pd.DataFrame(found | {"start": start, "stop": start + run - 1 + window}).astype(
            {"start": "int32", "stop": "int32"}
        )

    def run(batches):
        held, size, numbers = [], 0, {}
        for batch in batches:
            hashes = batch["h"].to_numpy()
            # A few groups at a time, words as numbers as soon as they come.
            cuts = np.unique(np.append(np.searchsorted(hashes, hashes[::1000], "left"), len(batch)))
            for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                if size > most_words and hashes[low] != held[-1][0]["h"].iat[-1]:
                    yield grown(held)
                    held, size, numbers = [], 0, {}
                part = batch.iloc[low:high]
                words = [w.split() for w in part["words"]]
                lengths = np.array([len(w) for w in words])
                symbols = np.fromiter(
                    (numbers.setdefault(w, len(numbers)) for ws in words for w in ws), np.int64, int(lengths.sum())
                )
                held.append((part[["h", "k1", "k2", "start", "n"]], symbols, lengths))
                size += len(symbols)
        if held:
            yield grown(held)

    return run


def _distinct_texts(source: DataFrame) -> DataFrame:
    """(k1, k2, text, copies): each text once, found by a 128-bit hash; copies meet as one row per task."""
    return (
        source.filter(F.col("text").isNotNull())
        .select(*_keys("text"), "text")
        .groupBy(*KEY)
        .agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    )


def _keys(text: str):
    return F.xxhash64(text).alias("k1"), F.xxhash64(text, F.lit("second")).alias("k2")


def _merged(spans, n: int) -> np.ndarray:
    """Which of n words lie in a span."""
    change = np.zeros(n + 1, dtype=np.int64)
    for span in spans:
        change[span["start"]] += 1
        change[span["stop"]] -= 1
    return np.cumsum(change[:n]) > 0


def repeated_passages(docs: DataFrame, window: int = 35, text_col: str = "text", shingle: int = 8, group: int = 30_000) -> DataFrame:
    """Per distinct text: k1, k2, text, spans (array of start and stop word places).

    Spans cover the windows of `window` words that start at another place of
    the corpus too, in the same text or another one; a text that has copies is
    one span. Each span is a maximal repeat as seen from one group, so spans
    may overlap. See the module for the method. `shingle` is the length of an
    anchor, at most `window`; `group` bounds the occurrences of an anchor that
    one subtree gets: 30,000 of about 50 words are the words that a task holds.
    """
    shingle = min(shingle, window)
    source = docs.select(docs[text_col].alias("text"))
    texts = _distinct_texts(source)
    found = texts.mapInArrow(_anchor_rows(window, shingle), "h long, k1 long, k2 long, places array<int>")
    often = found.groupBy("h").agg(F.sum(F.size("places")).alias("n")).filter("n > 1")
    hits = found.join(often, "h").groupBy(*KEY).agg(F.collect_list(F.struct("places", "n")).alias("hits"))
    wanted = texts.join(hits, KEY)
    suffixes = wanted.select(*KEY, "text", "hits").mapInArrow(
        _suffix_rows(window, shingle, group, False), "h long, n int, words binary, k1 long, k2 long, start int"
    )
    spans = suffixes.repartition("h").sortWithinPartitions("h").mapInPandas(
        _repeated_rows(window), "k1 long, k2 long, start int, stop int"
    )
    crowded = hits.filter(F.exists("hits", lambda hit: hit["n"] > group))
    whole = (
        texts.join(crowded, KEY)
        .select(*KEY, "text", "hits")
        .mapInArrow(_suffix_rows(window, shingle, group, True), "w1 long, w2 long, k1 long, k2 long, starts array<int>")
    )
    twice = whole.groupBy("w1", "w2").agg(F.sum(F.size("starts")).alias("n")).filter("n > 1")
    each = whole.join(twice, ["w1", "w2"]).select(*KEY, F.explode("starts").alias("start"))
    spans = spans.union(each.select(*KEY, "start", (F.col("start") + window).cast("int").alias("stop")))
    per_text = spans.groupBy(*KEY).agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    return texts.join(per_text, KEY, "left")


def _kept_words(text: bytes, copies: int, spans, window: int) -> tuple[list[bytes], int]:
    """The words that stay, and how many there were."""
    words = text.split()
    if copies > 1 and len(words) >= window:
        return [], len(words)
    if spans is None or not len(spans):
        return words, len(words)
    gone = _merged(spans, len(words)).tolist()
    return [w for w, g in zip(words, gone, strict=True) if not g], len(words)


def _digest_rows(window: int):
    """Words, removed words, and the digest of the kept ones."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            counts, removed, kept = [], [], []
            texts, others = encoded(batch.column(2).to_pylist()), (batch.column(c).to_pylist() for c in (3, 4))
            for text, copies, spans in zip(texts, *others, strict=True):
                left, n = _kept_words(text, copies, spans, window)
                counts.append(n)
                removed.append(n - len(left))
                kept.append(hashlib.sha256(b" ".join(left)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(counts, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(kept, pa.string()),
                ],
                [*KEY, "n_words", "n_removed", "kept"],
            )

    return run


def _kept_text(window: int):
    """A column function: the text without its spans, unchanged where nothing goes."""

    @F.pandas_udf("string")
    def kept(text: pd.Series, copies: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for t, c, found in zip(text, copies, spans, strict=True):
            left, n = _kept_words(t.encode("utf-8", "replace"), c, found, window)
            out.append(t if len(left) == n else b" ".join(left).decode())
        return pd.Series(out, dtype=object)

    return kept


_KEPT = "k1 long, k2 long, n_words long, n_removed long, kept string"


def removal_digests(
    docs: DataFrame, window: int = 35, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """(id, n_words, n_removed, kept_sha256) per row of `docs`.

    Words are runs of anything but ASCII white space. A word goes if a window
    of `window` words over it also starts elsewhere. Null, empty and wordless
    texts have no words. Repeated rows count as copies of each other; a null
    id gets its row. Other columns are not read.
    """
    passages = repeated_passages(docs, window, text_col, **options)
    kept = passages.select(*KEY, "text", "copies", "spans").mapInArrow(_digest_rows(window), _KEPT)
    rows = docs.select(docs[id_col].alias(id_col), *_keys(docs[text_col]), docs[text_col].isNull().alias("none"))
    nothing = hashlib.sha256(b"").hexdigest()
    return rows.join(kept, KEY, "left").select(
        id_col,
        F.when(F.col("none"), F.lit(0)).otherwise(F.col("n_words")).cast("long").alias("n_words"),
        F.when(F.col("none"), F.lit(0)).otherwise(F.col("n_removed")).cast("long").alias("n_removed"),
        F.when(F.col("none"), F.lit(nothing)).otherwise(F.col("kept")).alias("kept_sha256"),
    )


def remove_repeats(
    docs: DataFrame, window: int = 35, text_col: str = "text", drop_empty: bool = True, **options
) -> DataFrame:
    """The rows of `docs` with repeated passages removed from the text column.

    A text that loses nothing stays as it is; another one becomes its kept
    words joined by single spaces. With `drop_empty`, rows that lose all their
    words go. Other columns pass through unchanged, whatever their names.
    """
    passages = repeated_passages(docs, window, text_col, **options)
    # A column function keeps the dealing by text, so texts aren't shuffled again to meet their rows.
    cut = passages.withColumn("new", _kept_text(window)("text", "copies", "spans")).select(
        *KEY, "new", ((F.col("new") == "") & (F.col("text") != "")).alias("emptied")
    )
    others = [docs[c] for c in docs.columns if c != text_col]
    rows = docs.select(*_keys(docs[text_col]), F.struct(*(others or [F.lit(0)])).alias("row"))
    joined = rows.join(cut, KEY, "left")
    if drop_empty:
        joined = joined.filter(F.coalesce(~F.col("emptied"), F.lit(True)))
    return joined.select(*[F.col("new").alias(c) if c == text_col else F.col(f"row.`{c}`") for c in docs.columns])
