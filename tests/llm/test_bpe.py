"""The token automaton against plain merging and against the tokenizers library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from marketseries.llm import bpe, queries

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def own():
    return bpe.WordBpe(PATH)


def merged(word, merges):
    """The lowest merge first, from left to right, until none is left."""
    tokens = list(word)
    while True:
        pairs = [(merges[p], i) for i, p in enumerate(zip(tokens, tokens[1:])) if p in merges]
        if not pairs:
            return tokens
        rank = min(pairs)[0]
        out, i = [], 0
        while i < len(tokens):
            if i + 1 < len(tokens) and merges.get((tokens[i], tokens[i + 1])) == rank:
                out.append(tokens[i] + tokens[i + 1])
                i += 2
            else:
                out.append(tokens[i])
                i += 1
        tokens = out


@pytest.mark.parametrize("seed", range(60))
def test_random_merges(seed):
    """Also merges that other merges make useless, and runs of one symbol."""
    rng = random.Random(seed)
    vocabulary = {c: i for i, c in enumerate("abc"[: 1 + seed % 3])}
    merges = []
    for _ in range(rng.randint(1, 12)):
        a, b = rng.choice(list(vocabulary)), rng.choice(list(vocabulary))
        if a + b not in vocabulary:
            vocabulary[a + b] = len(vocabulary)
            merges.append((a, b))
    machine = bpe.TokenAutomaton(vocabulary, merges)
    ranks = {m: k for k, m in enumerate(merges)}
    for _ in range(150):
        word = "".join(rng.choice("abc"[: 1 + seed % 3]) for _ in range(rng.randint(0, 14)))
        assert [machine.labels[i] for i in machine.encode(word)] == merged(word, ranks)


@settings(deadline=None, max_examples=300)
@given(text=st.text(alphabet=st.sampled_from(list("aabeht'sSTLLx1-.é ß\nΣ日Ⅷ½̀̈  \x1c\0😀")), max_size=25))
def test_as_library(library, own, text):
    ids, starts = own.encode(pa.array([text, "<|endoftext|>" + text, None]))
    for k, t in enumerate((text, "<|endoftext|>" + text, "")):
        true = library.encode(t, add_special_tokens=False).ids
        assert ids[starts[k] : starts[k + 1]].tolist() == true
        assert own.decode(ids, starts)[k].as_py() == library.decode(true, skip_special_tokens=False)


def expected(rows, library):
    out = []
    for key, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        out.append((key, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def test_query(spark, library):
    root = "/root/testdata/sf0.01"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{root}/documents.parquet").collect()]
    found = queries.QUERIES["op8_bpe"](spark, root).collect()
    assert sorted(map(tuple, found), key=str) == expected(rows, library)


def test_odd_rows(spark, library):
    rows = [(1, None), (1, None), (None, "a b"), (2, ""), (3, " \n"), (4, "longword" * 3000), (5, "It's  ÉTÉ!!\r\n42 " * 5000)]
    docs = spark.createDataFrame([(k, t, "x", 0) for k, t in rows], "doc_id long, text string, ids string, n_tokens int")
    assert sorted(map(tuple, bpe.round_trip(docs, PATH).collect()), key=str) == expected(rows, library)
    assert bpe.round_trip(docs.limit(0), PATH).collect() == []
    back = bpe.decode(bpe.encode(docs, PATH), PATH).collect()
    assert sorted(((r["doc_id"], hashlib.sha256(r["text"].encode()).hexdigest()) for r in back), key=str) == [
        (k, d) for k, _, _, d in expected(rows, library)]
    odd = spark.createDataFrame([(1, None), (2, [320, None, -1, 999999])], "doc_id long, ids array<int>")
    assert {r["doc_id"]: r["text"] for r in bpe.decode(odd, PATH).collect()} == {1: "", 2: library.decode([320], skip_special_tokens=False)}
