"""Best-fit packing of token sequences into rows of one length, with few bins open at a time.

Every task packs the documents it reads, in their order. Open bins are found
by a bitset over their free space: the lowest set bit at or above a piece's
length is the tightest bin. When more than `open_bins` are open, the fullest
one closes. Nothing is shuffled; a task that runs again gives the same rows.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from layerkit.llm.token_ids import gathered, token_ids


class BestFit:
    """Online best-fit over at most `most` open bins of `size` places."""

    def __init__(self, size: int, most: int):
        self.size, self.most = size, most
        self.by_free: dict[int, list[int]] = {}
        self.bits = 0
        self.open = 0
        self.made = 0

    def place(self, length: int) -> tuple[int, int]:
        """(bin, offset) for a piece of 1 to `size` places."""
        fits = self.bits >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            number = self._take(free)
        else:
            free, number = self.size, self.made
            self.made += 1
        left = free - length
        if left:
            self.by_free.setdefault(left, []).append(number)
            self.bits |= 1 << left
            self.open += 1
            if self.open > self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)
        return number, self.size - free

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        number = bins.pop()
        if not bins:
            self.bits ^= 1 << free
        self.open -= 1
        return number


def pieces(n: int, size: int):
    """(start, length) of each piece of n ids: all of `size`, the first one shorter if need be."""
    start = 0
    first = n % size or size
    while start < n:
        length = first if start == 0 else size
        yield start, length
        start += length


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 1024,
    end_id: int = 2,
    open_bins: int = 256,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: document, piece, start, length, ids_crc32, sequence_id, offset.

    With `with_ids` the piece's ids follow as `ids` (binary, little-endian
    unsigned 32-bit). A null or empty text is the end id alone. Documents
    longer than `size` are cut, the first piece being the short one; nothing
    is dropped. Repeated rows and null ids are packed like any other; columns
    other than id and text are not read.
    """
    source = docs.select(docs[id_col].alias(id_col), docs[text_col].alias("text"))
    fields = [T.StructField(id_col, source.schema[0].dataType)] + [
        T.StructField(n, t)
        for n, t in (
            ("piece", T.IntegerType()),
            ("start", T.LongType()),
            ("length", T.LongType()),
            ("ids_crc32", T.LongType()),
            ("sequence_id", T.LongType()),
            ("offset", T.LongType()),
        )
    ]
    if with_ids:
        fields.append(T.StructField("ids", T.BinaryType()))
    names = [f.name for f in fields]

    def packed(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 36
        bins = BestFit(size, open_bins)
        for batch in gathered(batches):
            if not batch.num_rows:
                continue
            rows, numbers = [], [[] for _ in range(7)]
            piece_col, start_col, length_col, crc_col, seq_col, off_col, ids_col = numbers
            ids, bounds = token_ids(batch.column(1), tokenizer, end_id)
            view, bounds = memoryview(ids).cast("B"), bounds.tolist()
            for i, (first, last) in enumerate(zip(bounds, bounds[1:], strict=False)):
                for k, (start, length) in enumerate(pieces(last - first, size)):
                    part = view[4 * (first + start) : 4 * (first + start + length)]
                    number, offset = bins.place(length)
                    rows.append(i)
                    piece_col.append(k)
                    start_col.append(start)
                    length_col.append(length)
                    crc_col.append(zlib.crc32(part))
                    seq_col.append(base + number)
                    off_col.append(offset)
                    if with_ids:
                        ids_col.append(bytes(part))
            columns = [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(piece_col, pa.int32())]
            columns += [pa.array(c, pa.int64()) for c in (start_col, length_col, crc_col, seq_col, off_col)]
            if with_ids:
                columns.append(pa.array(ids_col, pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names)

    return source.mapInArrow(packed, T.StructType(fields))
