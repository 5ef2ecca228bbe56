"""SimHash near-duplicates by bit-sliced comparison.

Fingerprints that share all the blocks of one choice are compared. With
`radius` differing bits and `blocks` blocks, two linked fingerprints agree on
at least blocks - radius of them, so trying every such choice misses no link.
Inside a group the fingerprints lie as bit planes, 64 fingerprints to a
machine word; the distances of one fingerprint to all others are counted by
carry-save adders over the planes, and a block of 64 is given up as soon as
all its distances are past the radius. A group gives a forest, not its pairs.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerkit.llm.common import checkpointed, components, encoded, merge_labels

BITS = 64


def fingerprint(text: bytes, size: int) -> int:
    """Majority bits of the XXH64 (seed 42) of all `size`-word shingles of a text."""
    import xxhash

    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= size:
        return xxhash.xxh64_intdigest(joined, 42)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))[: len(words) - size + 1].tolist()
    stops = (ends[size - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    n = len(starts)
    hashes = np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts, stops, strict=True)), np.uint64, n)
    counts = np.zeros(BITS, dtype=np.int64)
    for k in range(0, n, 4096):
        part = hashes[k : k + 4096].astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def fingerprints(docs: DataFrame, size: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_hash, fp) per row, fp being the fingerprint as a signed long. Null and wordless texts have 0."""
    source = docs.select(
        docs[id_col].alias(id_col), F.xxhash64(docs[text_col]).alias("text_hash"), docs[text_col].alias("text")
    )
    schema = T.StructType([*source.schema.fields[:2], T.StructField("fp", T.LongType())])

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            found = np.array(
                [fingerprint(t, size) for t in encoded(batch.column(2).to_pylist())], dtype=np.uint64
            ).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found)], schema.fieldNames())

    return source.mapInArrow(run, schema)


def bit_planes(values: np.ndarray) -> np.ndarray:
    """One row per bit of the fingerprints; each word of a row holds that bit of 64 fingerprints."""
    padded = np.zeros((len(values) + 63) // 64 * 64, dtype=np.uint64)
    padded[: len(values)] = values
    bits = np.unpackbits(padded.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    return np.packbits(bits.T.copy(), axis=1, bitorder="little").view("<u8")


def near(
    values: np.ndarray, planes: np.ndarray, query: np.ndarray, word: np.ndarray, radius: int
) -> tuple[np.ndarray, np.ndarray]:
    """For pairs of a fingerprint's index and a word of the planes: which of the word's 64 are within `radius` bits.

    Gives (query index, fingerprint index). The counters are bit planes
    themselves: they hold the binary digits of 64 distances in each word. A
    distance that outgrows them, or the radius, sets its bit in `past`; pairs
    all of whose bits are past leave the work.
    """
    counters = [np.zeros(len(word), dtype=np.uint64) for _ in range(radius.bit_length())]
    past = np.zeros(len(word), dtype=np.uint64)
    full = ~np.uint64(0)
    value = values[query]
    for k in range(BITS):
        bit = (value >> np.uint64(BITS - 1 - k)) & np.uint64(1)
        carry = planes[k][word] ^ (np.uint64(0) - bit)
        for d in range(len(counters)):
            counters[d], carry = counters[d] ^ carry, counters[d] & carry
        past |= carry
        if k % 8 == 7:
            past |= _above(counters, radius)
            live = past != full
            if not live.all():
                query, word, value, past = query[live], word[live], value[live], past[live]
                counters = [c[live] for c in counters]
    bits = np.unpackbits((~past).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    row, bit = np.nonzero(bits)
    return query[row], word[row] * 64 + bit


def _above(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """Bits of the counters whose number is over the radius."""
    above = np.zeros_like(counters[0])
    equal = ~above
    for d in range(len(counters) - 1, -1, -1):
        if radius >> d & 1:
            equal &= counters[d]
        else:
            above |= equal & counters[d]
            equal &= ~counters[d]
    return above


def forest_of(groups: list[np.ndarray], radius: int, most: int = 1 << 14) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what links within `radius` bits connect inside each group, fewer than there are values.

    Each group starts at a word of its own. A fingerprint meets the words from
    its own on, `most` pairs of fingerprint and word at a time.
    """
    sizes = np.array([len(g) for g in groups])
    words = (sizes + 63) // 64
    first = np.concatenate(([0], np.cumsum(words)))
    values = np.zeros(first[-1] * 64, dtype=np.uint64)
    real = np.zeros(len(values), dtype=bool)
    for g, at in zip(groups, first.tolist(), strict=False):
        values[at * 64 : at * 64 + len(g)] = g
        real[at * 64 : at * 64 + len(g)] = True
    planes = bit_planes(values)
    index = np.nonzero(real)[0]
    ends = np.repeat(first[1:], words)[index // 64]
    counts = ends - index // 64
    labels = np.arange(len(values))
    done = 0
    sums = np.cumsum(counts)
    while done < len(index):
        upto = max(done + 1, int(np.searchsorted(sums, (sums[done - 1] if done else 0) + most, "right")))
        query = np.repeat(index[done:upto], counts[done:upto])
        steps = np.arange(len(query)) - np.repeat(np.cumsum(counts[done:upto]) - counts[done:upto], counts[done:upto])
        a, b = near(values, planes, query, query // 64 + steps, radius)
        fine = (a < b) & real[b]
        merge_labels(labels, a[fine], b[fine])
        done = upto
    moved = np.nonzero(labels != np.arange(len(labels)))[0]
    return values[moved], values[labels[moved]]


def block_masks(blocks: int, radius: int) -> list[int]:
    """One mask of fingerprint bits for each choice of blocks that may have to agree."""
    bounds = [round(BITS * i / blocks) for i in range(blocks + 1)]
    parts = [((1 << (b - a)) - 1) << a for a, b in zip(bounds, bounds[1:], strict=False)]
    return [sum(chosen) for chosen in combinations(parts, blocks - radius)]


def links(fps: DataFrame, radius: int, group: int = 2048) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column fp) that connect all within `radius` bits.

    The number of blocks follows the number of fingerprints, so that a choice
    spreads evenly dealt fingerprints over groups of at most `group`. Groups
    that are larger all the same are dealt in slices of that size; each pair
    of slices is compared in a group of its own, so nothing is left out and no
    task holds more than two slices.
    """
    total = fps.count()
    blocks = radius + 1
    while blocks < 2 * radius and total >> (BITS * (blocks - radius) // blocks) > group:
        blocks += 1
    masks = block_masks(blocks, radius)
    choices = F.array(*[F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for i, m in enumerate(masks)])
    dealt = fps.select("fp", F.explode(choices).alias("at")).select("fp", "at.choice", "at.key")
    sizes = dealt.groupBy("choice", "key").count().filter("count > 1")
    slices = F.ceil(F.col("count") / group).cast("int")
    mine = F.pmod(F.xxhash64("fp"), F.col("slices")).cast("int")
    parts = (
        dealt.join(sizes.select("choice", "key", slices.alias("slices")), ["choice", "key"])
        .select("fp", "choice", "key", mine.alias("mine"), F.explode(F.expr("sequence(0, slices - 1)")).alias("other"))
        .select("fp", "choice", "key", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"))
    )
    key = F.xxhash64("choice", "key", "low", "high")
    return (
        parts.select("fp", key.alias("deal"), "choice", "key", "low", "high")
        .repartition("deal")
        .sortWithinPartitions("deal", "choice", "key", "low", "high", "fp")
        .mapInPandas(_link_groups(radius), "a long, b long")
        .distinct()
    )


def _link_groups(radius: int):
    """Groups arrive in order; one is compared when its last row has come."""
    columns = ["choice", "key", "low", "high"]

    def flushed(held):
        frame = pd.concat(held) if len(held) > 1 else held[0]
        keys = frame[columns].to_numpy()
        cuts = np.nonzero((keys[1:] != keys[:-1]).any(axis=1))[0] + 1
        groups = [np.unique(part) for part in np.split(frame["fp"].to_numpy().view(np.uint64), cuts)]
        a, b = forest_of(groups, radius)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    def run(batches):
        held, waiting = [], None
        for batch in batches:
            if not len(batch):
                continue
            keys = batch[columns].to_numpy()
            last = tuple(keys[-1])
            new = np.nonzero((keys != keys[-1]).any(axis=1))[0]
            cut = new[-1] + 1 if len(new) else 0
            if cut or (waiting is not None and waiting != last):
                held.append(batch.iloc[:cut])
                yield flushed([h for h in held if len(h)])
                held = []
            held.append(batch.iloc[cut:])
            waiting = last
        if held:
            yield flushed(held)

    return run


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _classed(docs: DataFrame, size: int, radius: int, id_col: str, text_col: str, group: int) -> DataFrame:
    """(id, text_hash, fp, component_id) per row."""
    marked = checkpointed(fingerprints(docs, size, id_col, text_col))
    groups = marked.groupBy("fp").agg(F.min(id_col).alias("least"))
    found = components(links(groups.select("fp"), radius, group))
    classes = groups.join(found.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component")
    )
    named = classes.groupBy("component").agg(F.min("least").alias("component_id"))
    return marked.join(classes.join(named, "component").select("fp", "component_id"), "fp")


def simhash_components(
    docs: DataFrame,
    size: int = 4,
    radius: int = 4,
    id_col: str = "doc_id",
    text_col: str = "text",
    group: int = 2048,
) -> DataFrame:
    """(id, fingerprint, component_id) per row of `docs`.

    The fingerprint has 16 lowercase hex digits. Rows are linked by equal
    fingerprints and by those within `radius` bits; component_id is the
    smallest id that links lead to. Copies share a fingerprint, so however
    many there are they are one value to the search and one small partial
    minimum per task. Texts without words, null ones among them, have
    fingerprint zero and are linked like any other. A null id gets its row but
    is no component's id. Other columns are not read.
    """
    return _classed(docs, size, radius, id_col, text_col, group).select(
        id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_first(
    docs: DataFrame, size: int = 4, radius: int = 4, id_col: str = "doc_id", text_col: str = "text", group: int = 2048
) -> DataFrame:
    """The row with the smallest id of each component, with all its columns.

    Rows meet their verdict by id and text, so texts are shuffled once. Of
    rows with the same id and text one stays. Rows with a null id can't be the
    first of a component; they stay only where none of its rows has an id.
    """
    marked = _classed(docs, size, radius, id_col, text_col, group)
    first = (
        marked.filter(F.col(id_col).eqNullSafe(F.col("component_id")))
        .select(F.struct(id_col, "text_hash").alias("key"))
        .distinct()
    )
    packed = docs.select(
        F.struct(docs[id_col].alias(id_col), F.xxhash64(docs[text_col]).alias("text_hash")).alias("key"),
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
    )
    kept = packed.join(first, "key", "left_semi").dropDuplicates(["key"])
    return kept.select(*[F.col(f"row.`{c}`") for c in docs.columns])
