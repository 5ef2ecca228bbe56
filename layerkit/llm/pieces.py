"""SentencePiece encoding by a batched numpy Viterbi, and decoding.

The models are of the merge kind (BPE with byte fallback). There the best
split of a word is not the one with the largest sum of scores, so a path's
score is replaced by what the merges decide: a path is a run of pieces of
which each neighbouring pair stays apart when the two are merged by rank. For
every prefix of a word exactly one last piece continues such a path, so the
lattice, the substring probes, the maxima and the backpointers are those of
Viterbi, and the ids are those of the library.

Words of equal length advance together, one character a step. All substrings
that end there are hashed at once by prefix sums and probed in the sorted keys
of the pieces; pieces found are kept where the pair with the backpointer's
piece stays apart, and a maximum over the lengths stores the new backpointer.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from layerkit.llm.chunks import resolved
from layerkit.llm.common import mixed

SPACE = "▁"
_MODELS: dict[str, Model] = {}
_NEVER = np.int64(1) << 40


def model(path: str) -> Model:
    """One model per Python worker."""
    if path not in _MODELS:
        _MODELS[path] = Model(path)
    return _MODELS[path]


class Model:
    """Piece tables of one model file.

    Only what the public models of this kind use is taken: identity
    normalizer, a space put before the text, spaces kept as they are.
    """

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as proto

        file = resolved(path)
        spec = proto.ModelProto()
        with open(file, "rb") as stream:
            spec.ParseFromString(stream.read())
        rules = spec.normalizer_spec
        if spec.trainer_spec.model_type != 2 or not spec.trainer_spec.byte_fallback:
            raise ValueError("only merge models with byte fallback are known")
        if rules.name != "identity" or not rules.add_dummy_prefix or rules.remove_extra_whitespaces:
            raise ValueError("only the identity normalizer with a leading space is known")
        library = sentencepiece.SentencePieceProcessor(model_file=file)
        size = library.get_piece_size()
        pieces = [library.id_to_piece(i) for i in range(size)]
        self.byte = np.zeros(256, dtype=np.int64)
        self.text = [b""] * size
        plain = []
        for i, piece in enumerate(pieces):
            if library.is_byte(i):
                self.byte[int(piece[1:-1], 16)] = i
                self.text[i] = bytes([int(piece[1:-1], 16)])
            elif not library.is_control(i):
                self.text[i] = piece.replace(SPACE, " ").encode()
                if not library.is_unknown(i):
                    plain.append(i)
        self.text[library.unk_id()] = " ⁇ ".encode()
        words = [i for i in plain if not pieces[i].startswith(SPACE * 2)]
        if any(SPACE in pieces[i].lstrip(SPACE) for i in plain):
            raise ValueError("pieces over several words are not known")
        self.runs = {len(pieces[i]): i for i in plain if set(pieces[i]) == {SPACE}}
        if len({library.get_score(i) for n, i in self.runs.items() if n > 1}) > 1:
            raise ValueError("runs of spaces need one score")
        known = {pieces[i] for i in words if len(pieces[i]) == 1}
        if any(set(pieces[i]) - known for i in words):
            raise ValueError("every character of a piece needs a piece of its own")
        self.longest = max(len(pieces[i]) for i in words)
        self.width = size
        rank = np.full(size, _NEVER)
        order = sorted(words, key=lambda i: (-library.get_score(i), i))
        rank[order] = np.arange(len(order))
        self._tables(pieces, words, rank)
        letters = "".join(re.escape(c) for c in sorted(known - {SPACE}))
        self.split = re.compile(f"[ {SPACE}]*[{letters}]+|[ {SPACE}]+|[^ {SPACE}{letters}]+")
        self.known = known - {SPACE}
        self.chunks: dict[str, bytes] = {}  # by what stands between two spaces
        self.old: dict[str, bytes] = {}  # chunks not seen since there were too many

    def _tables(self, pieces: list[str], words: list[int], rank: np.ndarray) -> None:
        """Sorted piece keys, the pairs that merge, and each piece's edges through its merges."""
        of = {pieces[i]: i for i in words}
        pairs = {}
        for i in words:
            piece = pieces[i]
            for cut in range(1, len(piece)):
                left, right = of.get(piece[:cut]), of.get(piece[cut:])
                if left is not None and right is not None:
                    pairs[left * self.width + right] = i
        self.pair_keys = np.array(sorted(pairs), dtype=np.int64)
        self.pair_rank = rank[[pairs[k] for k in sorted(pairs)]]
        # A piece's time is the latest rank of the merges that make it.
        time = np.zeros(self.width, dtype=np.int64)
        parts: dict[int, tuple[int, int]] = {}
        whole = set()
        for i in sorted(words, key=lambda i: len(pieces[i])):
            symbols = [of[c] for c in pieces[i]]
            time_now = -1
            while len(symbols) > 1:
                best = min(
                    (
                        (rank[pairs[a * self.width + b]], k)
                        for k, (a, b) in enumerate(zip(symbols, symbols[1:], strict=False))
                        if a * self.width + b in pairs
                    ),
                    default=None,
                )
                if best is None:
                    break
                time_now = max(time_now, int(best[0]))
                k = best[1]
                made = pairs[symbols[k] * self.width + symbols[k + 1]]
                if len(symbols) == 2:
                    parts[i] = symbols[0], symbols[1]
                symbols[k : k + 2] = [made]
            if symbols == [i]:
                whole.add(i)
                time[i] = time_now
        deep = self.longest
        self.right = np.full((self.width, deep), -1, dtype=np.int64)  # pieces at the right edge, first made first
        self.left = np.full((self.width, deep), -1, dtype=np.int64)
        self.right_n = np.zeros(self.width, dtype=np.int64)
        self.left_n = np.zeros(self.width, dtype=np.int64)
        for i in whole:
            for side, table, count in ((1, self.right, self.right_n), (0, self.left, self.left_n)):
                edge = [i]
                while edge[-1] in parts:
                    edge.append(parts[edge[-1]][side])
                table[i, : len(edge)] = edge[::-1]
                count[i] = len(edge)
        self.time = time
        keys = np.array([self._key(pieces[i]) for i in sorted(whole)], dtype=np.uint64)
        place = np.argsort(keys)
        keys = keys[place]
        if (keys[1:] == keys[:-1]).any():
            raise ValueError("two pieces share a key")
        # Where the keys of each value of the upper bits begin, and how many there are at most.
        upper = keys >> np.uint64(64 - self.KEY_BITS)
        self.key_from = np.searchsorted(upper, np.arange(1 << self.KEY_BITS, dtype=np.uint64))
        self.key_most = int(np.bincount(upper.astype(np.int64)).max())
        self.keys = np.concatenate((keys, np.zeros(self.key_most, dtype=np.uint64)))
        self.key_ids = np.array(sorted(whole))[place]
        self.pair_seen = np.full(1 << self.PAIR_BITS, -1, dtype=np.int64)
        self.pair_good = np.zeros(1 << self.PAIR_BITS, dtype=bool)

    _BASE = np.uint64(0x9E3779B97F4A7C15)
    MOST_KEPT = 500_000
    KEY_BITS = 17
    PAIR_BITS = 21

    def _key(self, piece: str) -> int:
        value = 0
        for c in mixed(np.array([ord(c) for c in piece], dtype=np.uint64) + np.uint64(1)).tolist():
            value = (value * int(self._BASE) + c) % (1 << 64)
        return value

    def apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether two neighbouring pieces stay apart when their characters are merged by rank.

        From the characters at the cut on, the side that grows first grows, up
        to the whole pieces; if the two edges merge before either grows, the
        pieces don't stay. At equal ranks the left one goes first.
        """
        stays = np.ones(len(left), dtype=bool)
        i = np.zeros(len(left), dtype=np.int64)
        j = np.zeros(len(left), dtype=np.int64)
        live = np.arange(len(left))
        while len(live):
            p, t, a, b = left[live], right[live], i[live], j[live]
            pe, te = self.right[p, a], self.left[t, b]
            more_p, more_t = a + 1 < self.right_n[p], b + 1 < self.left_n[t]
            next_p = np.where(more_p, self.time[self.right[p, np.minimum(a + 1, self.right_n[p] - 1)]], _NEVER)
            next_t = np.where(more_t, self.time[self.left[t, np.minimum(b + 1, self.left_n[t] - 1)]], _NEVER)
            key = pe * self.width + te
            at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            merge = np.where(self.pair_keys[at] == key, self.pair_rank[at], _NEVER)
            merge = np.where(merge < _NEVER, np.maximum(merge, np.maximum(self.time[pe], self.time[te])), _NEVER)
            broken = (merge < _NEVER) & (merge < next_p) & (merge <= next_t)
            stays[live[broken]] = False
            grow_p = more_p & (next_p <= next_t)
            grow_t = more_t & ~grow_p
            i[live[grow_p]] += 1
            j[live[grow_t]] += 1
            live = live[~broken & (grow_p | grow_t)]
        return stays

    def _stay(self, pairs: np.ndarray) -> np.ndarray:
        """`apart` for pairs written as one number; recent answers are kept in a table of fixed size."""
        slot = (mixed(pairs.astype(np.uint64)) >> np.uint64(64 - self.PAIR_BITS)).astype(np.int64)
        missing = self.pair_seen[slot] != pairs
        if missing.any():
            new = np.unique(pairs[missing])
            good = self.apart(new // self.width, new % self.width)
            out = np.empty(len(pairs), dtype=bool)
            out[~missing] = self.pair_good[slot[~missing]]
            out[missing] = good[np.searchsorted(new, pairs[missing])]
            slot = (mixed(new.astype(np.uint64)) >> np.uint64(64 - self.PAIR_BITS)).astype(np.int64)
            self.pair_seen[slot] = new
            last = self.pair_seen[slot] == new  # of those that share a slot, the one that holds it
            self.pair_good[slot[last]] = good[last]
            return out
        return self.pair_good[slot]

    def _advance(self, codes: np.ndarray) -> list[bytes]:
        """Ids of words of one length, given as rows of code points."""
        n, length = codes.shape
        letters = mixed(codes.astype(np.uint64) + np.uint64(1))
        sums = np.zeros((n, length + 1), dtype=np.uint64)
        for k in range(length):
            sums[:, k + 1] = sums[:, k] * self._BASE + letters[:, k]
        power = np.array([pow(int(self._BASE), k, 1 << 64) for k in range(self.longest + 1)], dtype=np.uint64)
        last = np.full((n, length + 1), -1, dtype=np.int64)  # the piece that ends here
        back = np.zeros((n, length + 1), dtype=np.int64)  # its length
        for end in range(1, length + 1):
            most = min(self.longest, end)
            sizes = np.arange(1, most + 1)
            keys = sums[:, end, None] - sums[:, end - sizes] * power[sizes]
            at = self.key_from[keys >> np.uint64(64 - self.KEY_BITS)]
            row, col = np.nonzero(self.keys[at] == keys)
            found = [(row, col, at[row, col])]
            for step in range(1, self.key_most):
                more = np.nonzero(self.keys[at + step] == keys)
                found.append((*more, at[more] + step))
            row, col, place = (np.concatenate(x) for x in zip(*found, strict=True))
            piece, size = self.key_ids[place], sizes[col]
            before = last[row, end - size]
            inner = size < end
            good = np.ones(len(piece), dtype=bool)
            good[inner] = self._stay(before[inner] * self.width + piece[inner])
            row, piece, size = row[good], piece[good], size[good]
            best = np.zeros(n, dtype=np.int64)
            np.maximum.at(best, row, size)
            won = size == best[row]
            back[row[won], end] = size[won]
            last[row[won], end] = piece[won]
        # Follow the backpointers of all words at once, filling the ids from the right.
        ids = np.zeros((n, length), dtype="<u4")
        rows, at, begin = np.arange(n), np.full(n, length), np.full(n, length)
        for column in range(length - 1, -1, -1):
            ids[rows, column] = last[rows, at]
            at = at - back[rows, at]
            begin[rows] = column
            going = at > 0
            if not going.all():
                rows, at = rows[going], at[going]
                if not len(rows):
                    break
        raw = ids.tobytes()
        return [
            raw[4 * (k * length + first) : 4 * (k + 1) * length] for k, first in enumerate(begin.tolist())
        ]

    def _learn(self, words: set[str]) -> dict[str, bytes]:
        """Ids of each word; those of one length are encoded together."""
        out: dict[str, bytes] = {}
        by_length: dict[int, list[str]] = {}
        for w in words:
            by_length.setdefault(len(w), []).append(w)
        for length, group in by_length.items():
            step = max(1, 200_000 // length)
            for k in range(0, len(group), step):
                part = group[k : k + step]
                codes = np.frombuffer("".join(part).replace(" ", SPACE).encode("utf-32-le"), dtype="<u4").reshape(len(part), length)
                out.update(zip(part, self._advance(codes), strict=True))
        return out

    def _spaces(self, n: int) -> bytes:
        """Runs of spaces have one rank, so the leftmost pair that makes a piece merges first."""
        made: list[int] = []
        for _ in range(n):
            made.append(1)
            while len(made) > 1 and made[-2] + made[-1] in self.runs:
                made[-2:] = [made[-2] + made[-1]]
        return np.array([self.runs[k] for k in made], dtype="<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text.

        No piece goes over the start of a run of spaces, so what stands between
        two single spaces is encoded once and kept.
        """
        chunks = [t.split(" ") if t else [] for t in texts]
        new = set().union(*chunks) - self.chunks.keys()
        if new and self.old:
            again = new & self.old.keys()
            self.chunks.update((c, self.old.pop(c)) for c in again)
            new -= again
        if len(self.chunks) > self.MOST_KEPT:
            self.old, self.chunks = self.chunks, {}
            return self.encode(texts)
        if new:
            plain = [c for c in new if c and SPACE not in c]
            self.chunks.update(zip(plain, self._whole([" " + c for c in plain]), strict=True))
        out = []
        for text, parts in zip(texts, chunks, strict=True):
            try:
                out.append(b"".join(map(self.chunks.__getitem__, parts)))
            except KeyError:  # several spaces in a row, or the space mark itself
                out += self._whole([" " + text])
        return out

    def _whole(self, texts: list[str]) -> list[bytes]:
        """Ids of texts that begin with the space put before them."""
        found = [self.split.findall(t) for t in texts]
        kept: dict[str, bytes] = {}
        words, longer = set(), []
        for part in set().union(*found):
            bare = part.lstrip(" " + SPACE)
            spaces = len(part) - len(bare)
            if not bare:
                kept[part] = self._spaces(spaces)
            elif bare[0] not in self.known:
                raw = np.frombuffer(bare.encode("utf-8", "replace"), np.uint8)
                kept[part] = self.byte[raw].astype("<u4").tobytes()
            elif spaces < 2:
                words.add(part)
            else:
                words.add(SPACE + bare)
                longer.append((part, SPACE + bare, spaces))
        kept |= self._learn(words)
        one = self._spaces(1)
        for part, word, spaces in longer:
            ids = kept[word]
            if ids.startswith(one):
                kept[part] = self._spaces(spaces) + ids[4:]
            else:
                kept[part] = self._spaces(spaces - 1) + ids
        return [kept[p[0]] if len(p) == 1 else b"".join([kept[x] for x in p]) for p in found]

    def decode(self, ids) -> str:
        """The text of ids; bytes that aren't UTF-8 become replacement characters."""
        raw = b"".join(map(self.text.__getitem__, ids))
        return raw.removeprefix(b" ").decode("utf-8", "replace")


def encode_pieces(
    docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: id and `ids`, an array of piece ids.

    A null text gives null, an empty one no ids. Repeated rows and null ids
    give their own rows; columns other than id and text are not read.
    """
    source = docs.select(docs[id_col].alias(id_col), docs[text_col].alias("text"))
    schema = T.StructType([T.StructField(id_col, source.schema[0].dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            ids = [
                None if t is None else np.frombuffer(_encoded(t, model_path), "<i4")
                for t in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], schema.fieldNames())

    return source.mapInArrow(run, schema)


def _encoded(text: str, path: str) -> bytes:
    return model(path).encode([text])[0]


def decode_pieces(df: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Per row: id and `text`; null ids give null."""
    source = df.select(df[id_col].alias(id_col), df[ids_col].alias("ids"))
    schema = T.StructType([T.StructField(id_col, source.schema[0].dataType), T.StructField("text", T.StringType())])

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = [None if ids is None else model(model_path).decode(ids) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], schema.fieldNames())

    return source.mapInArrow(run, schema)


def piece_digests(
    docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: id, n_pieces, ids_crc32 (little-endian unsigned 32-bit ids) and whether decoding gives the text.

    A null text counts as empty. Spaces and U+2581 are the same to such a
    model, so decoding is held against the text with the latter as spaces.
    """
    source = docs.select(docs[id_col].alias(id_col), docs[text_col].alias("text"))
    schema = T.StructType(
        [
            T.StructField(id_col, source.schema[0].dataType),
            T.StructField("n_pieces", T.LongType()),
            T.StructField("ids_crc32", T.LongType()),
            T.StructField("round_trip", T.BooleanType()),
        ]
    )

    def run(batches):
        import pyarrow as pa

        pieces = model(model_path)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            counts, sums, same = [], [], []
            for k in range(0, len(texts), 1024):
                part = texts[k : k + 1024]
                for text, ids in zip(part, pieces.encode(part), strict=True):
                    counts.append(len(ids) // 4)
                    sums.append(zlib.crc32(ids))
                    same.append(pieces.decode(np.frombuffer(ids, "<u4").tolist()) == text.replace(SPACE, " "))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(sums, pa.int64()), pa.array(same, pa.bool_())],
                schema.fieldNames(),
            )

    return source.mapInArrow(run, schema)
