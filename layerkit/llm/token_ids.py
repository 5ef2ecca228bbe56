"""Token ids by the tokenizers library, with the ids of recurring chunks kept per worker.

A byte-level BPE always cuts at a space between two characters that aren't
white (see `chunks`), and in front of a line break behind such a character, so
a chunk gives the same ids wherever it stands. Arrow cuts texts into chunks,
tells the distinct ones and finds those that are kept. Of the others, words of
letters go to the library's merges; the rest goes through the library in one
call, and the ids that come back are told apart by their lengths in bytes. Texts of other tokenizers go through the library whole.
"""

from __future__ import annotations

import json
import re
from array import array

import numpy as np

from layerkit.llm.chunks import resolved
from layerkit.llm.token_counts import byte_letters

#: Where every chunk but a text's first begins.
CUT = re.compile(r"(?<=\S) (?=\S)")

#: Neither letters, numbers nor white space: behind a letter they are tokens of their own.
MARKS = ".,;:!?|$%&*#@)]}\"'"

#: Letters below this are letters to every version of Unicode: a run of them is one pre-token.
LATIN_END = "\u0250"

#: Bytes of text worked on together; a longer text is worked on alone.
SLICE = 10 << 20

#: Texts with white space beside spaces are worked on in spans of about so many characters.
SPAN = 1 << 20

_ENCODERS: dict[str, TokenIds] = {}


class Known:
    """Distinct words and their ids in arrays, which take less room than a dict of strings."""

    def __init__(self):
        import pyarrow as pa

        self.words = pa.array([], pa.string())
        self.ids = np.empty(0, "<u4")
        self.bounds = np.zeros(1, np.int64)

    def __len__(self) -> int:
        return len(self.words)

    def find(self, words) -> np.ndarray:
        """The number of each word, -1 where it isn't here."""
        import pyarrow.compute as pc

        if not len(self.words):
            return np.full(len(words), -1)
        at = pc.index_in(words, value_set=self.words)
        return at.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)

    def add(self, words, ids: np.ndarray, sizes: np.ndarray) -> None:
        import pyarrow as pa

        self.words = pa.concat_arrays([self.words, words])
        self.ids = np.concatenate([self.ids, ids])
        self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(sizes)])

    def take(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words of these numbers, and how many each has."""
        sizes = self.bounds[at + 1] - self.bounds[at]
        return _joined(self.ids, self.bounds[at], sizes), sizes

    def of_length(self, most: int) -> Known:
        """The words of at most so many bytes."""
        import pyarrow as pa
        import pyarrow.compute as pc

        short = np.flatnonzero(pc.binary_length(self.words).to_numpy(zero_copy_only=False) <= most)
        if len(short) == len(self):
            return self
        kept = Known()
        kept.add(self.words.take(pa.array(short)), *self.take(short))
        return kept


class TokenIds:
    """Ids of whole texts as little-endian unsigned 32-bit numbers, for one tokenizers JSON file.

    At most about `limit` chunks are kept, and as many old ones.
    """

    def __init__(self, path: str, limit: int = 450_000):
        from tokenizers import Tokenizer

        with open(resolved(path), encoding="utf-8") as file:
            spec = json.load(file)
        self.tokenizer = Tokenizer.from_str(json.dumps(spec))
        # Cut to nothing and filled up to nothing, whatever the file says.
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        # What a special string ends in is left at its chunk, so that none is torn.
        special = {t["content"][-1:] for t in spec.get("added_tokens", [])}
        self.ends = "".join(c for c in MARKS if c not in special)
        self.merges = self.tokenizer.model
        self.letters = byte_letters()
        self.sizes = _byte_sizes(spec)
        self.limit = limit
        self.kept = Known()
        self.old = Known()
        self.marks: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def __call__(self, texts, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All ids in one array, and the bounds of each text's ids in it; a null is empty, `end` follows every text.

        `texts` is an Arrow array of strings or a list of them.
        """
        import pyarrow as pa
        import pyarrow.compute as pc

        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        column = column.fill_null("")
        after = b"" if end is None else np.array([end], dtype="<u4").tobytes()
        before = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64)) // SLICE
        edges = [0, *(np.flatnonzero(np.diff(before)) + 1).tolist(), len(column)] if len(column) else [0]
        parts = [self._slice(column.slice(a, b - a), after) for a, b in zip(edges, edges[1:], strict=False)]
        ids = np.concatenate([np.empty(0, "<u4"), *[p[0] for p in parts]])
        lengths = np.concatenate([np.zeros(1, np.int64), *[p[1] for p in parts]])
        return ids, np.cumsum(lengths)

    def _slice(self, texts, after: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number per text: Arrow cuts the texts, each distinct word is looked up once."""
        import pyarrow as pa
        import pyarrow.compute as pc

        if self.sizes is None:
            made = [np.frombuffer(self.whole(t) + after, "<u4") for t in texts.to_pylist()]
            return np.concatenate(made), np.array([len(ids) for ids in made], dtype=np.int64)
        texts = texts.cast(pa.string())
        # A line break behind a character that isn't white is cut off too, and begins a chunk; no other chunk but
        # those of texts with a space before a line break begins with one, and such texts are odd.
        broken = pc.match_substring(texts, " \n").to_numpy(zero_copy_only=False)
        cut = pc.split_pattern(pc.replace_substring_regex(texts, r"([^\s])\n", "\\1 \n"), " ")
        coded = cut.flatten().dictionary_encode()
        index = coded.indices.to_numpy()
        starts = cut.offsets.to_numpy()[:-1].astype(np.int64)
        starts -= starts[0]
        counts = np.diff(np.append(starts, len(index)))

        # A distinct chunk is a word and the marks behind it, if it ends in a letter and marks.
        chunks = coded.dictionary
        bare = pc.utf8_rtrim(chunks, characters=self.ends)
        bare = pc.if_else(pc.match_substring_regex(bare, r"\p{L}$"), bare, chunks)
        length = pc.utf8_length(bare).to_numpy(zero_copy_only=False)
        marked = np.flatnonzero(pc.utf8_length(chunks).to_numpy(zero_copy_only=False) > length)
        coded = bare.dictionary_encode()
        words, word_of = coded.dictionary, coded.indices.to_numpy()

        inner = pc.utf8_ltrim(words, characters="\n")
        size = pc.binary_length(inner).to_numpy(zero_copy_only=False)
        edged = pc.binary_length(pc.utf8_trim_whitespace(inner)).to_numpy(zero_copy_only=False) != size
        edged |= size == 0
        heads = chunks.take(pa.array(index[starts])).to_pylist()
        odd = edged[word_of][index]
        odd[starts] = [h != h.rstrip() for h in heads]
        odd = np.logical_or.reduceat(odd, starts) | broken

        # Pieces: distinct chunks, each a word's ids and those of its marks, then heads (an odd text is one), then the end.
        known, first, size = self._placed(words, np.flatnonzero(~edged))
        ends_in = chunks.take(pa.array(marked)).to_numpy(zero_copy_only=False).tolist()
        ends_in = [c[n:] for c, n in zip(ends_in, length[marked].tolist(), strict=True)]
        marks = list(dict.fromkeys(ends_in))
        number = dict(zip(marks, range(len(words), len(words) + len(marks)), strict=True))
        made = [self._marks(m) for m in marks]
        sizes = np.fromiter(map(len, made), np.int64, len(made)) // 4
        first = np.concatenate([first, len(known) + np.cumsum(sizes) - sizes])
        size = np.concatenate([size, sizes])
        known = np.concatenate([known, np.frombuffer(b"".join(made), "<u4")])
        parts = np.insert(word_of, marked + 1, [number[m] for m in ends_in])
        pieces = _joined(known, first[parts], size[parts])
        sizes = size[word_of]
        sizes[marked] += size[[number[m] for m in ends_in]]
        made = [self.whole(h) if h and not o else b"" for h, o in zip(heads, odd.tolist(), strict=True)]
        if odd.any():
            at = np.flatnonzero(odd)
            for i, ids in zip(at.tolist(), self._spanned(texts.take(pa.array(at)).to_pylist()), strict=True):
                made[i] = ids
        made.append(after)
        sizes = np.concatenate([sizes, np.fromiter(map(len, made), np.int64, len(made)) // 4])
        pieces = np.concatenate([pieces, np.frombuffer(b"".join(made), "<u4")])

        piece = index.copy()
        piece[starts] = len(chunks) + np.arange(len(heads))
        if odd.any():
            kept = ~np.repeat(odd, counts)
            kept[starts] = True
            piece, counts = piece[kept], np.where(odd, 1, counts)
        ends = np.cumsum(counts)
        piece = np.insert(piece, ends, len(sizes) - 1)
        lengths = sizes[piece]
        ids = _joined(pieces, (np.cumsum(sizes) - sizes)[piece], lengths)
        return ids, np.add.reduceat(lengths, ends - counts + np.arange(len(ends)))

    def _spanned(self, texts: list[str]) -> list[bytes]:
        """The ids of texts that have white space beside their spaces."""
        out: list[list[bytes]] = [[] for _ in texts]
        held, size = [], 0
        for k, text in enumerate(texts):
            for span in _spans(text):
                held.append((k, span))
                size += len(span)
                if size > SPAN:
                    self._spans_to(out, held)
                    held, size = [], 0
        self._spans_to(out, held)
        return [b"".join(parts) for parts in out]

    def _spans_to(self, out: list[list[bytes]], held: list[tuple[int, str]]) -> None:
        """The ids of spans go to the texts of these numbers; their words are looked up together."""
        import pyarrow as pa

        cut, rests = [], []
        for _, span in held:
            head, *rest = CUT.split(span)
            tail = " " + rest.pop() if rest and rest[-1][-1].isspace() else ""
            cut.append((head, len(rest), tail))
            rests += rest
        coded = pa.array(rests, pa.string()).dictionary_encode()
        at = coded.indices.to_numpy()
        known, first, size = self._placed(coded.dictionary, np.arange(len(coded.dictionary)))
        done = 0
        for (k, _), (head, n, tail) in zip(held, cut, strict=True):
            here = at[done : done + n]
            out[k] += [self.whole(head) if head else b"", _joined(known, first[here], size[here]).tobytes()]
            out[k].append(self.whole(tail) if tail else b"")
            done += n

    def _placed(self, words, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """An array that holds the ids of distinct words behind a space, and where and how many; those not wanted have none.

        Words that aren't kept yet are from now on. When too many are kept they
        become the old ones; those of the old ones that come again stay.
        """
        import pyarrow as pa

        kept = self.kept
        at = kept.find(words)
        lost = wanted[at[wanted] < 0]
        if len(lost):
            found = self.old.find(words.take(pa.array(lost)))
            again = lost[found >= 0]
            kept.add(words.take(pa.array(again)), *self.old.take(found[found >= 0]))
            fresh = lost[found < 0]
            order, ids, sizes = self._made(words.take(pa.array(fresh)).to_numpy(zero_copy_only=False).tolist())
            fresh = fresh[order]
            kept.add(words.take(pa.array(fresh)), ids, sizes)
            lost = np.concatenate([again, fresh])
            at[lost] = len(kept) - len(lost) + np.arange(len(lost))
        first, size = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        at = at[wanted]
        first[wanted] = kept.bounds[at]
        size[wanted] = kept.bounds[at + 1] - kept.bounds[at]
        if len(kept) > self.limit or kept.words.nbytes > 64 * self.limit:
            self.old, self.kept = kept.of_length(64), Known()
        return kept.ids, first, size

    def _made(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of words that aren't known yet, one after another, how many each has, and in what order they come."""
        bare = [w[1:] if w[0] == "\n" else w for w in words]
        plain = np.fromiter((w.isalpha() and (w.isascii() or max(w) < LATIN_END) for w in bare), bool, len(words))
        letters, others = np.flatnonzero(plain), np.flatnonzero(~plain)
        ids, sizes = self._words([words[k] for k in letters.tolist()])
        if len(others):
            more = self._together([words[k] for k in others.tolist()])
            ids, sizes = np.concatenate([ids, more[0]]), np.concatenate([sizes, more[1]])
        return np.concatenate([letters, others]), ids, sizes

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of runs of letters behind a space or a line break, straight from the library's merges."""
        merged, letters, space = self.merges.tokenize, self.letters, self.letters[32]
        line = [t.id for t in merged(letters[10])]
        ids, sizes = array("I"), array("q")
        for word in words:
            before = len(ids)
            shown = word if word.isascii() else word.encode().decode("latin-1").translate(letters)
            if word[0] == "\n":
                ids.extend(line)
                ids.extend([t.id for t in merged(shown[1:])])
            else:
                ids.extend([t.id for t in merged(space + shown)])
            sizes.append(len(ids) - before)
        return np.frombuffer(ids, "<u4"), np.frombuffer(sizes, np.int64)

    def _marks(self, marks: str) -> bytes:
        if marks not in self.marks:
            ids = self.whole(marks)
            if len(marks) > 8:
                return ids
            self.marks[marks] = ids
        return self.marks[marks]

    def _together(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of each chunk behind a space, if no line break begins it, from one call of the library."""
        chunks = [c if c[0] == "\n" else " " + c for c in chunks]
        made = self.tokenizer.encode_batch_fast(["".join(chunks)], add_special_tokens=False)[0].ids
        ids = np.array(made, dtype="<u4")
        lengths = np.fromiter((len(c.encode()) for c in chunks), np.int64, len(chunks))
        ends = np.searchsorted(np.cumsum(self.sizes[ids]), np.cumsum(lengths)) + 1
        return ids, np.diff(ends, prepend=0)


def _joined(data: np.ndarray, first: np.ndarray, sizes: np.ndarray, block: int = 1 << 16) -> np.ndarray:
    """The stretches of `data` that begin at `first` and have these sizes, one after another."""
    ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])
    out = np.empty(ends[-1], data.dtype)
    for a in range(0, len(sizes), block):
        b = min(a + block, len(sizes))
        places = np.repeat(first[a:b] - ends[a:b], sizes[a:b])
        places += np.arange(ends[a], ends[b])
        out[ends[a] : ends[b]] = data[places]
    return out


def _byte_sizes(spec: dict) -> np.ndarray | None:
    """Bytes of text that each id stands for; None where texts can't be cut at spaces."""
    before, model = spec.get("pre_tokenizer") or {}, spec["model"]
    added = spec.get("added_tokens", [])
    plain = (
        model["type"] == "BPE"
        and not spec.get("normalizer")
        and before.get("type") == "ByteLevel"
        and before.get("use_regex", True)
        and not before.get("add_prefix_space")
        and not model.get("continuing_subword_prefix")
        and not model.get("end_of_word_suffix")
        and not any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in added)
        and not any(c.isspace() for t in added for c in t["content"])
    )
    if not plain:
        return None
    # A byte-level token is written with one letter per byte.
    lengths = {i: len(t) for t, i in model["vocab"].items()} | {t["id"]: len(t["content"].encode()) for t in added}
    sizes = np.zeros(max(lengths) + 1, dtype=np.int64)
    sizes[list(lengths)] = list(lengths.values())
    return sizes


def _spans(text: str):
    """The text in parts of about SPAN characters, each but the first beginning with the space it was cut at."""
    start = 0
    while len(text) - start > SPAN and (found := CUT.search(text, start + SPAN)):
        yield text[start : found.start()]
        start = found.start()
    yield text[start:] if start else text


def token_ids(texts, path: str, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Ids and bounds of whole texts by one tokenizers JSON file, once loaded per Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = TokenIds(path)
    return _ENCODERS[path](texts, end)


def gathered(batches, column: int = 1, size: int = 6 << 20):
    """Neighbouring batches as one, so that words which recur in them are looked up once."""
    import pyarrow as pa

    kept, held = [], 0
    for batch in batches:
        kept.append(batch)
        held += batch.column(column).nbytes
        if held >= size:
            yield pa.concat_batches(kept)
            kept, held = [], 0
    if kept:
        yield pa.concat_batches(kept)
