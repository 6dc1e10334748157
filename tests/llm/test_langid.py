"""Cross-parsing against a plain search in the reference, and accuracy on held-out rows."""

import math

import numpy as np

from marketseries.llm import langid, queries


def phrases(text, reference):
    """Greedy parse of each block into longest strings of the reference, or single unknown characters."""
    total = 0
    for a in range(0, len(text), langid.BLOCK):
        block, i = text[a : a + langid.BLOCK], 0
        while i < len(block):
            j = i
            while j < len(block) and block[i : j + 1] in reference:
                j += 1
            i, total = max(j, i + 1), total + 1
    return total


def test_phrases_as_searched():
    rng = np.random.default_rng(0)
    words = ["ab", "abc", "cab", "é", "𝒳y", "zz", "q"]
    make = lambda n: " ".join(rng.choice(words, n))
    known = [make(60)[:150], make(100).replace("z", "k"), "x"]
    machines = [langid.Automaton(np.array(list(map(ord, r)), np.uint32)) for r in known]
    texts = [make(n) for n in (1, 5, 40, 900, 2500)]
    cost = langid.cross_entropies([np.array(list(map(ord, t)), np.uint32) for t in texts], machines)
    for i, t in enumerate(texts):
        for k, r in enumerate(known):
            assert math.isclose(cost[i, k], phrases(t, r) * math.log2(len(r) + 1) / len(t))


def test_normalised():
    show = lambda t: "".join(map(chr, langid.normalised(t)))
    assert [show(t) for t in ("", " 12", "Ab,  cD!", "É\n1x", "𝒳 ", "..a")] == ["", "", "ab cd ", "é x", "𝒳 ", "a"]


def test_held_out_accuracy(spark):
    root = "/root/testdata/sf0.01"
    truth = {r["doc_id"]: (r["lang"], r["text"]) for r in spark.read.parquet(f"{root}/documents.parquet").collect()}
    rows = queries.QUERIES["op1_language"](spark, root).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(truth)
    mine = [r for r in rows if r["held_out"]]
    assert 200 < len(mine) < 500 and all(0 <= r["score"] <= 1 for r in rows)
    assert sum(r["lang_pred"] == truth[r["doc_id"]][0] for r in mine) > 0.98 * len(mine)


def test_odd_rows(spark):
    known = {"aa": "hello world this is it", "bb": "bonjour le monde c est ca"}
    docs = spark.createDataFrame(
        [(None, None, "k"), (2, "", "k"), (3, "12 !?", "k"), (4, "hello it is", "k"), (4, "hello it is", "k"), (5, "le monde " * 40000, "k"), (6, "ж", None)],
        "doc_id long, text string, lang_pred string")
    rows = sorted(((r["doc_id"] or 0, r["lang_pred"], r["score"]) for r in langid.identify(docs, known).collect()))
    assert [x[:2] for x in rows] == [(0, "und"), (2, "und"), (3, "und"), (4, "aa"), (4, "aa"), (5, "bb"), (6, "aa")]
    assert {r["lang_pred"] for r in langid.identify(docs, {}).collect()} == {"und"}
    assert {r["score"] for r in langid.identify(docs.filter("doc_id = 4"), {"aa": "hello"}).collect()} == {1.0}
    assert langid.identify(docs.limit(0), known).collect() == []
    labelled = docs.withColumnRenamed("lang_pred", "lang")
    assert set(langid.references(labelled, "doc_id <> 5")) == {"k"} and langid.references(labelled.limit(0), "true") == {}
