"""Packing: every id in one piece, gapless windows, ids as the library gives them."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from marketseries.llm import packing
from marketseries.llm.words import WordEncoder

BYTES = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "  a", "a ", "a  ", "a   b", "x\n\n y", "x \n y", "it's  'll we've", "\ta \t b", "<|endoftext|> a", "é" * 50,
       "a  b", "tail \n", " lead", "1 22  333", "a" * 5000, "\x1c \x1c a", "日本 語", None]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BYTES)


@settings(deadline=None, max_examples=200)
@given(st.lists(st.text(alphabet=st.sampled_from(list(" \n\tab'sé1. ")), max_size=30), max_size=4))
def test_words_as_library(texts):
    enc = test_words_as_library.__dict__.setdefault("enc", WordEncoder(BYTES))
    ids, starts = enc.encode(pa.array(texts, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(starts, starts[1:])] == [
        enc.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


@settings(deadline=None, max_examples=300)
@given(st.lists(st.text(alphabet=st.sampled_from(list(" \n\ras'1,.-_é×÷ßĿƒʰˈ́…«日。ж")), max_size=20), max_size=4))
def test_marks_and_lines_as_library(texts):
    test_words_as_library.hypothesis.inner_test(texts)


def test_words_are_learnt_once_whatever_closes_them():
    enc = WordEncoder(BYTES)
    enc.encode(pa.array(["été word, été word.", None, "word! word***\nété\nword", " word's× ×."]))
    assert set(enc.known) == {"été", " été", "word", " word", ",", ".", "!", "***", "\n", "'s×", " ×."}


def check(rows, texts, library, window=1024):
    docs = defaultdict(list)
    windows = defaultdict(list)
    for r in rows:
        docs[r["doc_id"]].append(r)
        windows[r["sequence_id"]].append(r)
    assert set(docs) == set(texts)
    for key, parts in docs.items():
        own = np.array(library.encode(texts[key] or "", add_special_tokens=False).ids + [0], "<u4")
        parts.sort(key=lambda r: r["start"])
        at = 0
        for r in parts:
            assert r["start"] == at and r["doc_tokens"] == len(own)
            at += r["length"]
            assert r["ids_crc32"] == zlib.crc32(own[r["start"] : at])
        assert at == len(own)
    assert sorted(windows) == list(range(len(windows)))
    used = padded = 0
    for parts in windows.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= window and {r["padded_length"] for r in parts} == {at if at & (at - 1) == 0 else window}
        used, padded = used + at, padded + parts[0]["padded_length"]
    return used / padded


def test_documents(spark, library):
    import __spark_entry__ as contract

    rows = contract.queries()["op7_packing"](spark, "/root/testdata/sf0.001").collect()
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    assert check(rows, {r["doc_id"]: r["text"] for r in table}, library) > 0.97


def test_odd_texts(spark, library):
    texts = dict(enumerate(ODD))
    docs = spark.createDataFrame([(k, v, "x") for k, v in texts.items()], "doc_id long, text string, length string")
    check(packing.pack_documents(docs, BYTES).collect(), texts, library)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack_documents(docs, BYTES).collect() == []


def test_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "a b c")] * 5, "doc_id long, text string")
    rows = packing.pack_documents(docs, BYTES).collect()
    assert len(rows) == 5 and sorted(r["offset"] for r in rows) == [0, 4, 8, 12, 16]


def test_plan_uses_each_length():
    rng = np.random.default_rng(0)
    lengths = np.minimum(1024, rng.geometric(1 / 300, 50_000))
    histogram = dict(zip(*(x.tolist() for x in np.unique(lengths, return_counts=True))))
    found = defaultdict(int)
    total = 0
    for pattern, times in packing.plan(histogram, 1024):
        assert sum(pattern) <= 1024
        total += times
        for n in pattern:
            found[n] += times
    assert dict(found) == histogram
    assert lengths.sum() / (total * 1024) > 0.98
