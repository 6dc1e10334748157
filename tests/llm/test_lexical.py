"""Ranked search against scores of all documents for all items."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from marketseries.llm import lexical
from marketseries.llm.lexical import search, term_counts

DOCS = "doc_id long, text string, item_id long, rank int, score long, terms string"
ITEMS = "item_id long, text string, doc_id long, score string"
COLUMNS = ["item_id", "rank", "doc_id", "score"]


def terms(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def by_loop(docs, items, k):
    counted = [(i, Counter(terms(t))) for i, t in docs]
    sizes = [c.total() for _, c in counted]
    n_docs, total = sum(n > 0 for n in sizes), sum(sizes)
    df = Counter(t for _, c in counted for t in c)
    asked = {}
    for item, text in set(items):
        asked.setdefault(item, Counter()).update(terms(text))
    out = []
    for item, query in asked.items():
        found = []
        for (doc_id, counts), n in zip(counted, sizes):
            score = 0
            for t, times in query.items():
                if counts[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += times * w * (10**9 * counts[t] // (1000 * counts[t] + 12 * (75 + 25 * n * n_docs // total)))
            if score > 0 and doc_id is not None:
                found.append((-score, doc_id))
        out += [(item, r, d, -s) for r, (s, d) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=repr)


def check(spark, docs, items, k=20, parts=3):
    df = spark.createDataFrame([(i, t, 1, 2, 3, "x") for i, t in docs], DOCS).repartition(parts)
    asked = spark.createDataFrame([(i, t, 5, "y") for i, t in items], ITEMS)
    out = search(df, asked, k)
    assert out.columns == COLUMNS
    assert sorted(map(tuple, out.collect()), key=repr) == by_loop(docs, items, k)


def test_terms():
    for text in ["", "A1-b_c é.É\x7fñ\x00Zz", "ÀB 中文,x y z", "ſK"]:
        assert term_counts(text.encode()) == Counter(t.encode() for t in terms(text))
    long = "Word " * 2_000_000 + "x" * 5_000_000
    assert term_counts(long.encode()) == {b"word": 2_000_000, b"x" * 5_000_000: 1}


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, " .,"), (4, "Été a a b"), (5, "a"), (5, "a"), (5, "b a"), (None, "a a a"), (9, "z " * 100_000 + "a"), (7, "A-b")]
    items = [(1, "a b b"), (1, "a b b"), (1, "z"), (None, "A"), (2, None), (3, ""), (4, "nowhere"), (5, "été")]
    check(spark, docs, items)
    check(spark, docs, items, k=2)


def test_empty(spark):
    check(spark, [], [(1, "a")])
    check(spark, [(1, "a")], [])
    check(spark, [(1, ""), (2, None)], [(1, "a")])


@pytest.mark.parametrize("k", [1, 20])
def test_random(spark, monkeypatch, k):
    rnd = random.Random(k)
    words = [f"w{i}" for i in range(400)]
    pick = lambda n: " ".join(words[min(int(rnd.expovariate(0.02)), 399)] for _ in range(n))
    docs = [(i, pick(int(rnd.expovariate(0.02)))) for i in range(3000)]
    docs += [(10_000 + i, docs[5][1]) for i in range(400)]  # equal scores
    check(spark, docs, [(i, pick(rnd.randrange(1, 60))) for i in range(25)], k)
    monkeypatch.setattr(lexical, "PASS_TERMS", 40)
    check(spark, docs, [(i, pick(rnd.randrange(1, 60))) for i in range(7)], k)


def test_chunks_are_skipped(monkeypatch):
    rnd = np.random.default_rng(0)
    n = 4096
    common = np.flatnonzero(rnd.random(n) < 0.5)
    rare = np.array([70, 71, 900], np.int64)
    row = {"doc_ids": list(range(n)), "lengths": [50] * n, "terms": [0, 1], "counts": [len(common), 3],
           "docs": np.concatenate([common, rare]).astype(np.uint16).tobytes(), "tfs": np.ones(len(common) + 3, "<u4").tobytes()}
    block = lexical.Block(row, n, 50 * n)
    assert set(block.long) == {0} and set(block.short) == {1}
    seen = []
    visit = lexical.Block._visit
    monkeypatch.setattr(lexical.Block, "_visit", lambda self, chunks, *a: (seen.extend(chunks.tolist()), visit(self, chunks, *a)))
    best = lexical.Best(2)
    block.search({0: 10, 1: 5000}, best)
    assert len(seen) <= 12 < block.chunks and set(best.ids) <= {70, 71, 900}
