"""The pipeline against its stages done by brute force on a small table."""

from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import test_neardup
import test_packing


def without_repeats(texts, length):
    seen = Counter(b[i : i + length] for t in texts.values() for b in [t.encode()] for i in range(len(b) - length + 1))
    out = {}
    for key, text in texts.items():
        b = text.encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = True
        out[key] = bytes(x for x, g in zip(b, gone) if not g).decode("utf-8", "ignore")
    return out


def test_pipeline_on_small_table(spark):
    import __spark_entry__ as contract

    root = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{root}/documents.parquet").collect() if any(map(str.isalpha, r["text"] or ""))}
    groups = test_neardup.brute(texts, 5)
    texts = without_repeats({k: t for k, t in texts.items() if groups[k][2]}, corpus_pipeline.PASSAGE_BYTES)
    rows = contract.queries()["pipeline"](spark, root).collect()
    test_packing.check(rows, texts, Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")))


def test_stages_on_odd_rows(spark):
    long = "lorem ipsum dolor sit amet " * 40
    rows = [(1, "one two three four five six", "en", "s", 27), (2, "one two three four five six", None, None, None), (None, "seven eight nine ten eleven twelve", "en", None, 1),
            (3, None, "en", "s", None), (4, "", "en", "s", 0), (5, "123 !!", "en", "s", 6), (6, long, "la", "s", 1), (6, long, "la", "s", 1)]
    docs = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, key string")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
        seen[name] = docs.collect()
        if name != "packing":
            assert docs.columns == corpus_pipeline.COLUMNS
    assert sorted(str(r["doc_id"]) for r in seen["language"]) == ["1", "2", "6", "6", "None"]
    assert all(r["lang"] for r in seen["language"])
    assert sorted(str(r["doc_id"]) for r in seen["near_duplicates"]) == ["1", "6", "None"]
    texts = {r["doc_id"]: (r["text"], r["n_chars"]) for r in seen["repeated_passages"]}
    assert texts[1] == ("one two three four five six", 27) and len(texts[6][0]) < len(long) and texts[6][1] == len(texts[6][0])
    pieces = defaultdict(int)
    for r in seen["packing"]:
        pieces[r["doc_id"]] += r["length"]
    assert set(pieces) == {1, 6, None}
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, "")
    assert empty.collect() == []


def test_passages_of_51_words_and_clean_texts(spark):
    """A passage of 51 words that documents share goes; texts that share only an id, or have none, stay."""
    rng = np.random.default_rng(5)
    words = lambda n: " ".join("".join(rng.choice(list("abcdefghijklmnop"), int(rng.integers(3, 9)))) for _ in range(n))
    passage = words(51)
    rows = [(i, f"{words(200)} {passage} {words(200)}") for i in range(6)] + [(9, words(60)), (9, words(60)), (None, words(60)), (None, words(60))]
    rows += [(20, rows[6][1]), (None, rows[6][1])]  # copies of a text whose id stands twice
    docs = spark.createDataFrame([(i, t, None, "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, "")
        assert docs.columns == corpus_pipeline.COLUMNS
    out = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert len(out) == 6 + 4
    assert sorted(t for i, t in out if i is None or i >= 9) == sorted({t for _, t in rows[6:]})
    assert all(passage not in t and len(t) > 1500 for i, t in out if i is not None and i < 6)
