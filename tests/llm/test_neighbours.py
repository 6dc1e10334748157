"""Nearest neighbours against brute force."""

import numpy as np
import pytest

from marketseries.llm import neighbours


def brute(rows, queries, k=5):
    ids = [i for i, _ in rows]
    v = np.array([x for _, x in rows], float)
    out = {}
    for j, q in enumerate(ids):
        if q in queries:
            score = (v * v[j]).sum(1) / (np.sqrt((v * v).sum(1)) * np.sqrt((v[j] * v[j]).sum()))
            out[q] = sorted((-s, i) for s, i in zip(score.tolist(), ids) if i != q)[:k]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((-r["score"], r["vec_id"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_recall_of_query(spark):
    import __spark_entry__ as contract

    root = "/root/testdata/sf0.1"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{root}/embeddings.parquet").collect()]
    true = brute(rows, {i for i, _ in rows if i % 50 == 0})
    mine = found(contract.queries()["op10_nearest_neighbours"](spark, root))
    assert set(mine) == set(true) and {len(x) for x in mine.values()} == {5}
    exact = {(q, i): s for q, x in true.items() for s, i in x}
    hits = [(q, i) for q, x in mine.items() for _, i in x if (q, i) in exact]
    assert len(hits) >= 0.9 * len(exact)
    assert all(abs(s - exact[q, i]) < 1e-12 for q, x in mine.items() for s, i in x if (q, i) in exact)


def test_small_table_is_exact_with_copies_and_odd_vectors(spark):
    rng = np.random.default_rng(0)
    good = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(100)]
    good += [(i, good[0][1]) for i in range(100, 180)] + [(i, [2 * x for x in good[1][1]]) for i in range(180, 185)]
    odd = [(900, None), (950, [0.0] * 8), (1000, [float("nan")] + [1.0] * 7), (1050, [float("inf")] + [1.0] * 7),
           (1100, [None] + [1.0] * 7), (1150, [1.0] * 3), (1200, []), (None, [1.0] * 8)]
    schema = "vec_id long, embedding array<double>, vector string, ids int"
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in good + odd + good[:3]], schema)
    mine = found(neighbours.nearest(df, "vec_id % 50 = 0"))
    assert mine == brute(good, {i for i, _ in good if i % 50 == 0})


def test_fewer_candidates_and_empty(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (50, [1.0, 1.0])], "vec_id long, embedding array<float>")
    assert {q: len(x) for q, x in found(neighbours.nearest(df, "vec_id % 50 = 0")).items()} == {0: 2, 50: 2}
    assert neighbours.nearest(df.limit(0), "vec_id % 50 = 0").collect() == []
    assert neighbours.nearest(df.limit(1), "vec_id % 50 = 0").collect() == []


def test_graph_finds_what_a_scan_finds():
    rng = np.random.default_rng(2)
    index = neighbours.fit(rng.normal(size=(4000, 16)), 300)
    sizes = np.bincount(np.argmax(neighbours.unit(rng.normal(size=(4000, 16))) @ index.centroids.T, 1))
    assert len(index.centroids) == 300 and sizes.max() < 200
    q = neighbours.unit(rng.normal(size=(200, 16)))
    ids, far = index.search(q)
    true = np.argsort(-(q @ index.centroids.T), 1)[:, :5]
    assert np.mean([len(set(a[:5]) & set(b)) for a, b in zip(ids.tolist(), true.tolist())]) > 4.7
    assert (np.diff(far, axis=1) >= 0).all()
