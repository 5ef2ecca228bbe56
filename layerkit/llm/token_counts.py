"""Token counts of a byte-level BPE, by heap and linked list, without making ids.

A pre-token starts as one symbol per byte. A heap holds its adjacent pairs by
merge rank, then place; the lowest is popped, the two symbols become one in a
linked list, and the pairs beside it are pushed. Pairs whose symbols have
changed since are skipped. The count is the symbols at the start less the
merges, in n log n steps also for one word of a whole text's length.
"""

from __future__ import annotations

import json
from heapq import heapify, heappop, heappush

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerkit.llm.chunks import Kept, resolved

_COUNTERS: dict[str, Counter] = {}


def byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte.

    Printable Latin-1 stands for itself; the others follow from 256 on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


class Counter:
    """Counts for the vocabulary of one tokenizers JSON file."""

    def __init__(self, path: str):
        import public_tokenizers
        import regex

        with open(resolved(path), encoding="utf-8") as file:
            spec = json.load(file)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        letters = byte_letters()
        self.byte = [vocab[letters[b]] for b in range(256)]
        self.width = max(vocab.values()) + 1
        self.merge: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(merges):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merge[vocab[left] * self.width + vocab[right]] = rank, vocab[left + right]
        special = [t["content"] for t in spec.get("added_tokens", [])]
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.kept = Kept(self.plain)

    def merged(self, word: bytes) -> int:
        """Symbols that are left of one pre-token."""
        symbols = [self.byte[b] for b in word]
        n = len(symbols)
        width, merge = self.width, self.merge
        heap = []
        for i in range(n - 1):
            key = symbols[i] * width + symbols[i + 1]
            if key in merge:
                heap.append((merge[key][0], i, key))
        if not heap:
            return n
        heapify(heap)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        merges = 0
        while heap:
            _, i, key = heappop(heap)
            j = after[i]
            if j >= n or symbols[i] < 0 or symbols[i] * width + symbols[j] != key:
                continue
            symbols[i] = merge[key][1]
            symbols[j] = -1
            merges += 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                key = symbols[i] * width + symbols[k]
                if key in merge:
                    heappush(heap, (merge[key][0], i, key))
            h = before[i]
            if h >= 0:
                key = symbols[h] * width + symbols[i]
                if key in merge:
                    heappush(heap, (merge[key][0], h, key))
        return n - merges

    def plain(self, text: str) -> int:
        """A stretch of text, its special strings counted as one token each."""
        if self.special is None:
            return self._ordinary(text)
        parts = self.special.split(text)
        return sum(map(self._ordinary, parts)) + len(parts) - 1

    def _ordinary(self, text: str) -> int:
        return sum(self.merged(w.encode("utf-8", "replace")) for w in self.pattern.findall(text))

    def count(self, text: str) -> int:
        if not text:
            return 0
        first, *rest = text.split(" ")
        if not first or first[-1].isspace():
            return self.plain(text)
        try:
            return self.plain(first) + sum(map(self.kept.__getitem__, rest))
        except TypeError:  # white space beside a space
            return self.plain(text)


def token_counts(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = 512,
) -> DataFrame:
    """Per row: id, n_bytes (UTF-8), n_tokens, over_limit (more than `limit` tokens).

    A null text counts as empty. Repeated rows and null ids give their own rows;
    columns other than id and text are not read. Nothing is shuffled.
    """
    source = docs.select(docs[id_col].alias(id_col), docs[text_col].alias("text"))
    schema = T.StructType(
        [
            T.StructField(id_col, source.schema[0].dataType),
            T.StructField("n_bytes", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
        ]
    )

    def counted(batches):
        import pyarrow as pa

        if tokenizer not in _COUNTERS:
            _COUNTERS[tokenizer] = Counter(tokenizer)
        counter = _COUNTERS[tokenizer]
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            sizes = [len(t) if t.isascii() else len(t.encode("utf-8", "replace")) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array([counter.count(t) for t in texts], pa.int64()),
                ],
                schema.fieldNames(),
            )

    return source.mapInArrow(counted, schema).withColumn("over_limit", F.col("n_tokens") > limit)
