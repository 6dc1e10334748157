"""Suffix order, common prefixes and removed bytes against brute force."""

import hashlib
import random
import uuid
from collections import Counter

import numpy as np
import pytest

from marketseries.llm import queries, suffixdedup, suffixsort


@pytest.mark.parametrize("seed", range(40))
def test_suffix_order_and_common_prefixes(seed):
    rng = np.random.default_rng(seed)
    for memory in (64, 1 << 26):  # the smaller one sends every queue to disk
        n, depth = int(rng.integers(1, 80)), int(rng.choice([4, 9, 40]))
        text = rng.integers(0, rng.integers(1, 5), n).astype(np.uint8) + np.uint8(rng.choice([0, 250]))
        text = np.tile(text[: max(1, n // 7)], 9) if seed % 3 == 0 else text
        data = text.tobytes()
        parts = list(suffixsort.sorted_suffixes(text, depth, memory))[::-1]
        order, common = (np.concatenate(x).tolist() for x in zip(*parts))
        assert sorted(order) == list(range(len(data)))
        heads = [data[i : i + depth] for i in order]
        assert heads == sorted(heads)
        for i in range(1, len(order)):
            x, y = heads[i - 1], heads[i]
            assert min(common[i], depth) == next((k for k, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))


def report(docs, length):
    out = suffixdedup.byte_report(docs, length)
    assert out.filter("n_kept + n_removed <> n_bytes").count() == 0
    return out.drop("n_kept").collect()


def expected(rows, length):
    seen = Counter(b[i : i + length] for _, t in rows for b in [(t or "").encode()] for i in range(len(b) - length + 1))
    out = []
    for key, text in rows:
        b = (text or "").encode()
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((key, len(b), int(gone.sum()), int((gone[1:] < gone[:-1]).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_query(spark):
    root = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{root}/documents.parquet").collect()]
    assert sorted(map(tuple, queries.QUERIES["op2_suffix_dedup"](spark, root).drop("n_kept").collect()), key=str) == expected(rows, 400)


def made(seed, n=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abé\0") for _ in range(rng.randint(1, 5)))
    passages = ["".join(word() for _ in range(rng.randint(3, 30))) for _ in range(6)]
    texts = []
    for _ in range(n):
        parts = [rng.choice(passages) if rng.random() < 0.4 else word() for _ in range(rng.randint(0, 25))]
        texts.append("".join(parts))
    return texts + ["x" * 300, "ab" * 150, "abc" * 30 + "abd", None, "", texts[0], texts[1]]


@pytest.mark.parametrize("hot", [None, 300])
def test_made_texts(spark, monkeypatch, hot):
    if hot:
        monkeypatch.setattr(suffixdedup, "HOT_BYTES", hot)
        monkeypatch.setattr(suffixdedup, "SHARD_BYTES", 3000)
    rows = list(enumerate(made(hot or 1))) + [(3, "x" * 300), (3, "y" * 90), (None, "x" * 290)]
    docs = spark.createDataFrame([(k, t, "r", 7) for k, t in rows], "doc_id long, text string, rid string, body int")
    for length in (20, 37):
        assert sorted(map(tuple, report(docs, length)), key=str) == expected(rows, length)


def test_kept_columns_and_characters(spark):
    rows = [(1, "é" * 30 + "unique", "a"), (2, "head" + "é" * 30, "b"), (3, None, "c"), (4, "short", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    out = suffixdedup.remove_repeated(docs, 40)
    assert out.columns == docs.columns
    assert sorted(map(tuple, out.collect())) == [(1, "unique", "a"), (2, "head", "b"), (3, None, "c"), (4, "short", None)]
    assert suffixdedup.remove_repeated(docs.limit(0), 40).collect() == []
    assert suffixdedup.byte_report(docs.limit(0), 40).collect() == []


def test_no_shard_outgrows_its_bound(spark, monkeypatch, tmp_path):
    """One 300-byte passage in a third of the rows, with different text around it; one of 390 bytes in some others."""
    sort = suffixdedup._sort_shard

    def sized(table, length):
        (tmp_path / uuid.uuid4().hex).write_text(str(sum(len(b) for b in table.column("body").to_pylist() if b)))
        return sort(table, length)

    monkeypatch.setattr(suffixdedup, "HOT_BYTES", 5_000)
    monkeypatch.setattr(suffixdedup, "SHARD_BYTES", 10_000)
    monkeypatch.setattr(suffixdedup, "_sort_shard", sized)
    rng = random.Random(5)
    noise = lambda n: "".join(rng.choices("abcdefghijklmnop ", k=n))
    short, long = noise(300), noise(390)
    texts = [noise(500) + (short if i % 3 == 0 else long if i % 3 == 1 and i < 250 else "") + noise(500) for i in range(500)]
    texts += ["z" * 40_000, texts[0][200:900], "ab" * 20_000]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, report(docs, 400)), key=str) == expected(rows, 400)
    sizes = [int(p.read_text()) for p in tmp_path.iterdir()]
    assert sizes and max(sizes) <= 40_000, max(sizes)


def test_long_rows_as_whole_strings(spark, monkeypatch):
    monkeypatch.setattr(suffixdedup, "SLICE", 50)
    texts = [bytearray(b"xyz" * 60), bytearray(b"q" * 130 + b"xyz" * 7), bytearray(b"short")]
    rows = spark.createDataFrame([(bytearray([i] * 16), t) for i, t in enumerate(texts)], "rid binary, body binary")
    seen = Counter(bytes(t[i : i + 20]) for t in texts for i in range(len(t) - 19))
    mine = {(r["rid"][0], i) for r in suffixdedup._whole_strings(rows, 20).collect() for i in range(r["a"], r["b"])}
    assert mine == {(k, i) for k, t in enumerate(texts) for i in range(len(t) - 19) if seen[bytes(t[i : i + 20])] > 1}


def test_copies_of_a_context_meet_its_spans_once(spark, monkeypatch):
    """Texts around one hot passage, each three times, whose strings are found one by one in the end."""
    monkeypatch.setattr(suffixdedup, "HOT_BYTES", 300)
    rng = random.Random(6)
    noise = lambda n: "".join(rng.choices("abcdefghijklmnop ", k=n))
    passage = noise(90)
    texts = [(noise(60) + passage + noise(60)).encode() for _ in range(30)]
    bodies = [t for t in texts for _ in range(3)] + [b"alone" * 3]
    rows = spark.createDataFrame([(bytearray(i.to_bytes(16, "big")), bytearray(t)) for i, t in enumerate(bodies)], "rid binary, body binary")
    out = {int.from_bytes(r["rid"], "big"): r["spans"] for r in suffixdedup.repeated(rows, 40).collect()}
    assert sorted(out) == list(range(90))
    for i, spans in out.items():
        assert {p for s in spans for p in range(s["a"], s["b"])} == set(range(len(bodies[i]) - 39))
        assert len(spans) <= 40  # one for each context, not one for each of the starts, in each copy
