"""Token counts, packing and SentencePiece against the libraries."""

from __future__ import annotations

import random
import zlib
from collections import Counter as Bag
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from layerkit.llm import chunks, packing, pieces, token_counts
from layerkit.llm.queries import QUERIES
from tests.conftest import rows

SF = "/root/testdata/sf0.001"
JSON, MODEL = "byte_bpe_50k.json", "piece_bpe_32k.model"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path(JSON))


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(MODEL))


@pytest.fixture(scope="module")
def texts(spark):
    found = [r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    random.seed(7)
    letters = ["a", "b", "é", " ", "  ", "\n", " \n", "'s", "don't", ".", ",", "1", "日", "▁", "\xa0", "　", "😀"]
    made = ["".join(random.choices(letters, k=random.randint(0, 30))) for _ in range(1500)]
    latin = ["".join(map(chr, random.choices(range(256), k=20))) for _ in range(500)]
    every = ["a" + chr(c) + "b " + chr(c) + chr(c) + " 1" + chr(c) for c in range(256)]
    special = ["foo<|endoftext|>bar <|endoftext|> x", "<|endoftext|>", "a<s> </s>", "x" * 3000, " " * 700 + "y" + " " * 37]
    return found + made + latin + every + special


def test_counts_are_the_librarys(texts, tokenizer):
    counter = token_counts.Counter(JSON)
    assert [counter.count(t) for t in texts] == [len(tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]


def test_ids_are_the_librarys(texts, tokenizer):
    ids, bounds = packing.token_ids(texts, JSON)
    for text, a, b in zip(texts, bounds, bounds[1:], strict=False):
        assert ids[a:b].tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_chunks_kept_stay_right_when_there_are_too_many(texts, tokenizer):
    counter = token_counts.Counter(JSON)
    counter.kept = chunks.Kept(counter.plain, limit=5)
    for text in texts[:60]:
        assert counter.count(text) == len(tokenizer.encode(text, add_special_tokens=False).ids)


def test_heap_merges_like_a_scan_for_the_lowest_rank():
    counter = token_counts.Counter(JSON)
    random.seed(3)
    for _ in range(300):
        word = "".join(random.choices("aehlnot ", k=random.randint(1, 25))).encode()
        symbols = [counter.byte[b] for b in word]
        while True:
            pairs = [
                (counter.merge[k][0], i)
                for i in range(len(symbols) - 1)
                if (k := symbols[i] * counter.width + symbols[i + 1]) in counter.merge
            ]
            if not pairs:
                break
            i = min(pairs)[1]
            symbols[i : i + 2] = [counter.merge[symbols[i] * counter.width + symbols[i + 1]][1]]
        assert counter.merged(word) == len(symbols)


def test_token_counts_of_odd_rows(odd, nothing, tokenizer):
    got = token_counts.token_counts(odd, JSON, limit=10)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    want = []
    for r in odd.select("doc_id", "text").collect():
        n = len(tokenizer.encode(r.text or "", add_special_tokens=False).ids)
        want.append((r.doc_id, len((r.text or "").encode()), n, n > 10))
    assert rows(got) == sorted(want, key=repr)
    assert token_counts.token_counts(nothing, JSON).count() == 0


def check_packing(out, source, tokenizer, size):
    """Every document's ids come back whole, and every sequence is gapless and within size."""
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for r in out.collect():
        by_sequence[r.sequence_id].append((r.offset, r.length))
        by_doc[r.doc_id].append(r)
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at and length > 0
            at += length
        assert at <= size
    want = Bag()
    for r in source.select("doc_id", "text").collect():
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [2]
        short = len(ids) % size or size
        cuts = [0, *range(short, len(ids) + 1, size)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            want[(r.doc_id, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))] += 1
    got = Bag((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for rs in by_doc.values() for r in rs)
    assert got == want
    return sum(n for places in by_sequence.values() for _, n in places) / (size * len(by_sequence))


def test_packing_of_odd_rows(odd, nothing, tokenizer):
    check_packing(packing.pack(odd, JSON, size=64, open_bins=3), odd, tokenizer, 64)
    assert packing.pack(nothing, JSON).count() == 0


def test_packing_query(spark, tokenizer):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert check_packing(QUERIES["op9_best_fit_packing"](spark, SF), docs, tokenizer, 1024) > 0.9


def test_packed_ids_are_those_of_the_digest(odd):
    for r in packing.pack(odd, JSON, size=64, with_ids=True).collect():
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length


def test_best_fit_takes_the_tightest_bin_and_closes_the_fullest():
    random.seed(1)
    bins, free, made = packing.BestFit(100, 4), {}, 0
    for _ in range(3000):
        length = random.randint(1, 100)
        number, offset = bins.place(length)
        fits = [f for f in free.values() if f >= length]
        if fits:
            assert free[number] == min(fits) and offset == 100 - free[number]
        else:
            assert number == made and offset == 0
            made += 1
        free[number] = 100 - offset - length
        if not free[number]:
            del free[number]
        if len(free) > 4:
            tight = min(free.values())
            gone = [n for n, f in free.items() if f == tight and n not in bins.by_free.get(f, [])]
            assert len(gone) == 1
            del free[gone[0]]


def test_pieces_are_the_librarys(texts, library):
    model = pieces.Model(MODEL)
    got = [np.frombuffer(ids, "<u4").tolist() for ids in model.encode(texts)]
    assert got == [library.encode(t) for t in texts]
    for text, ids in zip(texts, got, strict=True):
        assert model.decode(ids) == text.replace("▁", " ") == library.decode(ids)


def test_pieces_of_runs_of_random_pieces(library):
    random.seed(5)
    all_pieces = [library.id_to_piece(i).replace("▁", " ") for i in range(259, 32_000)]
    texts = ["".join(random.choices(all_pieces, k=6)) for _ in range(4000)]
    model = pieces.Model(MODEL)
    model.MOST_KEPT = 500
    for k in range(0, len(texts), 1000):
        part = texts[k : k + 1000]
        assert [np.frombuffer(i, "<u4").tolist() for i in model.encode(part)] == [library.encode(t) for t in part]


def test_pieces_of_odd_rows(odd, nothing, library):
    ids = pieces.encode_pieces(odd, MODEL)
    want = [(r.doc_id, None if r.text is None else library.encode(r.text)) for r in odd.select("doc_id", "text").collect()]
    assert rows(ids) == sorted(want, key=repr)
    back = [(r.doc_id, None if r.text is None else r.text.replace("▁", " ")) for r in odd.select("doc_id", "text").collect()]
    assert rows(pieces.decode_pieces(ids, MODEL)) == sorted(back, key=repr)
    digests = pieces.piece_digests(odd, MODEL)
    assert {r.round_trip for r in digests.collect()} == {True}
    assert pieces.piece_digests(nothing, MODEL).count() == 0


def test_piece_query(spark, library):
    want = []
    for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect():
        ids = library.encode(r.text or "")
        want.append((r.doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), True))
    assert rows(QUERIES["op8_sentencepiece"](spark, SF)) == sorted(want, key=repr)


@pytest.mark.parametrize("middle", [" " * 2_000_000, "\n" * 2_000_000, "x" * 1_200_000, "x y " * 300_000])
def test_very_long_texts_are_packed(spark, tokenizer, middle):
    docs = spark.createDataFrame([(1, f"x{middle}y"), (2, "more")], "doc_id long, text string")
    check_packing(packing.pack(docs, JSON), docs, tokenizer, 1024)
