"""Token ids and token files against the tokenizers library and the files' own metadata."""

from __future__ import annotations

import glob
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from layerkit.llm.queries import QUERIES
from layerkit.llm.token_files import read_numbers, read_tokens, with_digests, write_tokens
from layerkit.llm.token_ids import Known, TokenIds, token_ids
from tests.conftest import plan_of

FILE = "byte_bpe_50k.json"
LIBRARY = Tokenizer.from_file(public_tokenizers.path(FILE))
SF = "/root/testdata/sf0.001"


def by_library(text, path=None):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(path)) if path else LIBRARY
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids, dtype="<u4").tobytes()


def ids_of(texts, encoder=None):
    ids, bounds = encoder(texts) if encoder else token_ids(texts, FILE)
    return [ids[a:b].tobytes() for a, b in zip(bounds, bounds[1:], strict=False)]


PARTS = st.lists(
    st.one_of(
        st.sampled_from([" ", "  ", "\n", "\t ", " \n", "the", "don't", "1234", "<|endoftext|>", "é", "日本", "\x1c", "\x85", "　", "\xa0", "'s", ".", "...", "Word", "ciónñas,", "a$$$", "b'", "x)]", "y|>", "<|", "|>"]),
        st.text(max_size=6),
    ),
    max_size=25,
)


@settings(max_examples=400, deadline=None)
@given(st.lists(PARTS, max_size=4))
def test_ids_are_the_librarys(parts):
    texts = ["".join(p).encode("utf-8", "replace").decode() for p in parts]
    assert ids_of([None, *texts]) == [b"", *map(by_library, texts)]


@pytest.mark.parametrize("middle", [" " * 2_000_000, "\n" * 2_000_000, "x" * 1_200_000, " a" * 1_100_000, "\n x" * 500_000, "<|endoftext|> " * 90_000])
def test_very_long_texts(middle):
    text = f"x{middle}y"
    assert ids_of(["before", text, "after it"]) == [by_library(t) for t in ("before", text, "after it")]


def test_few_chunks_kept_give_the_same_ids():
    small = TokenIds(FILE, limit=3)
    texts = [f"word{i} and another{i % 7} one." for i in range(50)]
    for text in texts:
        assert ids_of([text], small) == [by_library(text)]
    assert len(small.kept) + len(small.old) <= 16


@pytest.mark.parametrize("line", ["\n", "\n\n", " \n", "\n ", "\r\n", "\n\t", "\x0b\n", "\xa0\n", "\n\xa0", "\u3000\n", "\x85\n", "\x1c\n", "\n<|endoftext|>", "<|endoftext|>\n"])
def test_line_breaks(line):
    words = ["one", "Two.", "três,", "日本", "4!", "don't", ")", "x" * 100, "Ünd"]
    texts = [f"a {v}{line}{w} {w}{line}{v}{end}" for v in words for w in words for end in ("", line)]
    texts += [line + t for t in texts] + ["\n".join(words), line]
    assert ids_of(texts) == [by_library(t) for t in texts]


def test_words_at_line_breaks_are_kept_by_themselves():
    left, right = [f"left{'ab'[k % 2] * k}" for k in range(1, 21)], [f"Right{'ab'[k % 2] * k}" for k in range(1, 21)]
    text = "so " + " ".join(f"{v}.\n{w}" for v in left for w in right)
    encoder = TokenIds(FILE)
    assert ids_of([text], encoder) == [by_library(text)]
    assert len(encoder.kept) == 41


def test_texts_with_odd_white_space_are_looked_up_together(monkeypatch):
    calls, find = [], Known.find
    monkeypatch.setattr(Known, "find", lambda self, words: calls.append(len(words)) or find(self, words))
    texts = [f"some words{i}  and  more of{i % 9} them" for i in range(500)]
    assert ids_of(texts, TokenIds(FILE)) == [by_library(t) for t in texts]
    assert len(calls) <= 4


def test_long_words_and_many_bytes_do_not_stay():
    encoder = TokenIds(FILE, limit=100)
    texts = [f"a {'日本' * 300}{i} b" for i in range(60)]
    for text in texts:
        assert ids_of([text], encoder) == [by_library(text)]
    assert encoder.kept.words.nbytes + encoder.old.words.nbytes < 20_000


def test_other_tokenizers_encode_whole_texts():
    texts = ["Some words, and  more.", "Ein Wort\n"]
    assert ids_of(texts, TokenIds("word_bpe_49k.json")) == [by_library(t, "word_bpe_49k.json") for t in texts]


def expected(texts_by_id, end=2):
    start, out = 0, []
    for doc, text in texts_by_id:
        ids = by_library(text) + np.array([end], dtype="<u4").tobytes()
        out.append((doc, start, len(ids) // 4, zlib.crc32(ids)))
        start += len(ids) // 4
    return out


def test_query_equals_the_library(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    found = QUERIES["op13_token_files"](spark, SF).orderBy("doc_id").collect()
    assert [tuple(r) for r in found] == expected(docs)


def test_odd_rows(spark, odd, folder):
    write_tokens(odd.repartition(3), FILE, folder)
    found = [tuple(r) for r in with_digests(read_tokens(spark, folder)).orderBy("start").collect()]
    texts = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    wanted = expected(sorted(texts, key=lambda r: (r[0] is not None, r[0] or 0)))
    assert found == wanted
    assert [tuple(r) for r in read_numbers(spark, folder).orderBy("start").collect()] == wanted


def test_one_id_for_many_rows_is_split(spark, folder):
    docs = spark.range(4000).selectExpr("1L as doc_id", "concat('t ', id % 50) as text")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the table is small
    try:
        write_tokens(docs, FILE, folder)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = spark.read.parquet(f"{folder}/files")
    assert files.count() > 1 and files.agg({"n_docs": "max"}).first()[0] < 2500
    found = with_digests(read_tokens(spark, folder)).orderBy("start").collect()
    starts = [r["start"] for r in found]
    assert starts[0] == 0 and all(a["start"] + a["n_tokens"] == b for a, b in zip(found, starts[1:], strict=False))
    assert len(found) == 4000


def test_empty_table(spark, nothing, folder):
    write_tokens(nothing, FILE, folder)
    assert with_digests(read_tokens(spark, folder)).count() == 0


def test_a_changed_list_is_noticed(spark, odd, folder):
    write_tokens(odd, FILE, folder)
    rows = read_tokens(spark, folder).selectExpr("doc_id", "start", "n_tokens", "ids_crc32", "reverse(ids) as ids")
    with pytest.raises(Exception, match="differs from what was written"):
        with_digests(rows).collect()


def test_layout(spark, folder):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    write_tokens(docs, FILE, folder, row_group=64 << 10, page=4 << 10, page_rows=100)
    groups = 0
    for path in glob.glob(f"{folder}/tokens/*.parquet"):
        meta = pq.ParquetFile(path).metadata
        greatest = None
        for g in range(meta.num_row_groups):
            columns = {meta.row_group(g).column(c).path_in_schema: meta.row_group(g).column(c) for c in range(meta.num_columns)}
            ids = columns["ids.list.element"]
            assert ids.has_dictionary_page and any("DICTIONARY" in e for e in ids.encodings)
            for name in ("doc_id", "start", "n_tokens", "ids_crc32"):
                assert "DELTA_BINARY_PACKED" in columns[name].encodings
            assert all(c.has_offset_index for c in columns.values()) and columns["doc_id"].has_column_index
            low, high = columns["doc_id"].statistics.min, columns["doc_id"].statistics.max
            assert greatest is None or low >= greatest
            greatest = high
            groups += 1
    assert groups > len(glob.glob(f"{folder}/tokens/*.parquet"))
    some = read_tokens(spark, folder).filter("doc_id between 100 and 110")
    assert some.count() == 11 and "GreaterThanOrEqual(doc_id,100)" in plan_of(some)
    plan = plan_of(read_numbers(spark, folder))
    assert "ids:array" not in plan.replace("ids_crc32", "")
