"""Likeness from peeled sketches against sets of paragraphs."""

import hashlib
import random

import pytest

from marketseries.llm import fingerprint, queries


def likeness(a, b):
    x, y = set(a.split("\n")), set(b.split("\n"))
    return len(x & y) / len(x | y)


def expected(rows):
    rows = sorted((k, t or "") for k, t in rows if k is not None)
    out = []
    for i, (key, text) in enumerate(rows):
        other = rows[(i + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + other[:half]
        out.append((key, len(text), hashlib.sha256(edited.encode()).hexdigest(), round(likeness(text, edited), 12), round(likeness(text, other), 12)))
    return sorted(out)


def found(df):
    return sorted((r["doc_id"], r["n_chars"], r["edited_sha256"], round(r["near_edited"], 12), round(r["near_next"], 12)) for r in df.collect())


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query(spark, sf):
    root = f"/root/testdata/{sf}"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{root}/documents.parquet").collect()]
    df = queries.QUERIES["op3_fingerprints"](spark, root)
    assert found(df) == expected(rows)
    assert {f.name: f.dataType.typeName() for f in df.schema} == {
        "doc_id": "long", "n_chars": "long", "edited_sha256": "string", "fingerprint": "string", "edited_fingerprint": "string",
        "near_edited": "double", "near_next": "double"}


def test_many_ranges_ties_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(fingerprint, "RANGE_ROWS", 10)
    rng = random.Random(0)
    lines = [f"line {i}" for i in range(500)]
    rows = [(rng.choice([i, i * 1000]), "\n".join(rng.choices(lines, k=rng.choice([1, 5, 60, 400])))) for i in range(150)]
    rows += [(7, "same"), (7, "same"), (7, "other"), (900, None), (901, ""), (902, "\n\n"), (903, "é😀x" * 50), (None, "lost"), (-3, "x\n" * 9)]
    docs = spark.createDataFrame([(k, t, "z", 1) for k, t in rows], "doc_id long, text string, at string, range int")
    assert found(fingerprint.fingerprints(docs)) == expected(rows)


def test_one_row_and_empty(spark):
    docs = spark.createDataFrame([(1, "a\nb")], "doc_id long, text string")
    assert found(fingerprint.fingerprints(docs)) == expected([(1, "a\nb")])
    assert fingerprint.fingerprints(docs.limit(0)).collect() == []


def test_equal_texts_and_recovered_digests(spark):
    docs = spark.createDataFrame([(1, "a\nb\nc", "a\nx\nc"), (2, "q", "q")], "id int, s string, t string")
    df = docs.select("id", fingerprint.digests(docs.s).alias("a"), fingerprint.digests(docs.t).alias("b"))
    df = df.select("*", fingerprint.sketch("a").alias("aa"), fingerprint.sketch("b").alias("bb"))
    df = df.select("*", fingerprint.differences("a", "b", "aa", "bb").alias("d"), fingerprint.fingerprint("aa").alias("f"), fingerprint.fingerprint("bb").alias("g"))
    one, two = df.orderBy("id").collect()
    assert {(x["n"], x["k"]) for x in one["d"]} == {(1, one["a"][1]), (-1, one["b"][1])} and one["f"] != one["g"]
    assert two["d"] == [] and two["f"] == two["g"]
