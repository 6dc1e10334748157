"""Near-duplicates against brute force over full sets."""

import re
from itertools import combinations

import numpy as np
import pytest

from marketseries.llm import neardup
from marketseries.llm.components import components


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(text, k):
    w = words_of(text)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(texts, k, percent=80):
    sets = {d: shingles(t, k) for d, t in texts.items()}
    root = {d: d for d in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = {}
    for d, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(d)
    seen = {p for v in holders.values() for p in combinations(sorted(v), 2)}
    for a, b in seen:
        common = len(sets[a] & sets[b])
        if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {d: (len(sets[d]), find(d), find(d) == d) for d in texts}


def result(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()}


def test_query_small_table(spark):
    import __spark_entry__ as contract

    root = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{root}/documents.parquet").collect()}
    assert result(contract.queries()["op9_near_duplicates"](spark, root)) == brute(texts, 4)


def test_families(spark):
    """Copies with edits from 0 to 40 %, chains of edits, and many documents around one passage."""
    rng = np.random.default_rng(1)
    vocabulary = [f"w{i}" for i in range(5000)]
    texts, passage = {}, list(rng.choice(vocabulary, 150))
    for base in range(6):
        words = list(rng.choice(vocabulary, 150))
        for copy in range(40):
            own = list(words)
            for i in rng.choice(150, int(rng.integers(0, 12)), replace=False):
                own[i] = str(rng.choice(vocabulary))
            texts[len(texts)] = " ".join(own)
            if base == 0:
                words = own
    for _ in range(150):
        texts[len(texts)] = " ".join(passage + list(rng.choice(vocabulary, int(rng.integers(20, 120)))))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert result(neardup.near_duplicates(docs, 5)) == brute(texts, 5)


def test_odd_rows(spark):
    texts = {1: None, 2: "", 3: " \n", 4: "One two", 5: "one  TWO", 6: "ÉTÉ a b c", 7: "été a b c", 8: "x " * 30000, 9: "x x x x x x"}
    docs = spark.createDataFrame([(k, v, "k", b"s") for k, v in texts.items()], "doc_id long, text string, set_key string, sketch binary")
    assert result(neardup.near_duplicates(docs, 4)) == brute(texts, 4)


def test_repeated_rows_and_empty_table(spark):
    docs = spark.createDataFrame([(3, "a b c d e f")] * 4 + [(2, "a b c d e f")], "doc_id long, text string")
    assert sorted((r["doc_id"], r["component_id"]) for r in neardup.near_duplicates(docs).collect()) == [(2, 2)] + [(3, 2)] * 4
    assert neardup.near_duplicates(docs.limit(0)).collect() == []


def test_rows_of_one_id_share_a_component(spark):
    rows = [(3, "a b c d e"), (5, "a b c d e"), (5, "p q r s t"), (8, "p q r s t"), (6, None), (6, "p q r s t"), (7, "u v w x y"), (7, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = neardup.near_duplicates(docs, 4).select("doc_id", "component_id", "kept").collect()
    assert sorted(map(tuple, found)) == sorted((d, 7 if d == 7 else 3, d in (3, 7)) for d, _ in rows)


def test_likelihood_estimate():
    rng = np.random.default_rng(3)
    for true in (0.3, 0.8, 0.95):
        left, right, n = [], [], 2000
        for _ in range(60):
            common = int(2 * n * true / (1 + true))
            pool = rng.integers(0, 1 << 63, 2 * n - common, np.uint64)
            left.append(pool[:n]), right.append(pool[n - common :])
        size = np.full(60, float(n))
        found = neardup.likeliest_similarity(neardup.registers(left), neardup.registers(right), size, size)
        assert abs(found.mean() - true) < 0.02 and np.abs(found - true).max() < neardup.MARGIN


def test_components_of_chain_and_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(159, 200), (5, 5), (None, 3)]
    found = {r["id"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in [*range(101, 160), 200]}}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
