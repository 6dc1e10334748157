"""Exact duplicates against a loop over the rows."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from marketseries.llm.exactdup import deduplicated, digest128, exact_groups, normalised

SCHEMA = "doc_id long, text string, digest string, kept int, body string, _id long"


def by_loop(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text or ""), []).append(doc_id)
    out = []
    for body, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        sha, left = hashlib.sha256(body.encode()).hexdigest(), 1
        for i in sorted(ids, key=lambda i: (i is None, i)):
            out.append((i, keep, len(ids), i == keep and left == 1, sha))
            left -= i == keep
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(map(tuple, df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 7, "y", 1) for i, t in rows], SCHEMA)


ODD = [
    (5, "a b"), (3, "a\t\n b"), (3, "a b"), (3, "a b"), (9, " a b"), (1, None), (2, ""), (4, " "), (6, " "), (8, " x"),
    (None, "z"), (None, "z"), (7, "q"), (None, "q"), (10, "a  b "), (11, "x" * 200_000), (12, "x" * 199_999 + "y"),
    (13, "x" * 200_000), (14, "é\r\né"), (15, "é é"),
]


@pytest.mark.parametrize("bad", [False, True])
def test_odd_rows(spark, bad):
    digest = (lambda c: F.unhex(F.md5(F.substring(c, 1, 1)))) if bad else digest128
    assert rows_of(exact_groups(frame(spark, ODD), digest)) == by_loop(ODD)


@pytest.mark.parametrize("bad", [False, True])
def test_random_rows_and_hot_groups(spark, bad):
    rnd = random.Random(3)
    rows = [(rnd.randrange(4000), rnd.choice(["hot  text", "hot text"]) if rnd.random() < 0.4 else f"t{rnd.randrange(300)}") for _ in range(6000)]
    digest = (lambda c: F.unhex(F.md5(F.length(c).cast("string")))) if bad else digest128
    assert rows_of(exact_groups(frame(spark, rows).repartition(7), digest)) == by_loop(rows)


def test_empty(spark):
    out = exact_groups(frame(spark, []))
    assert out.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"] and out.count() == 0


def test_deduplicated_keeps_all_columns(spark):
    out = deduplicated(frame(spark, ODD))
    assert out.columns == ["doc_id", "text", "digest", "kept", "body", "_id"]
    wanted = {(k, s) for i, k, n, kept, s in by_loop(ODD) if kept}
    got = out.select("doc_id", F.sha2(normalised(F.col("text")), 256)).collect()
    assert len(got) == len(wanted) and set(map(tuple, got)) == wanted


def test_native(spark):
    plan = exact_groups(frame(spark, ODD))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
