"""Archives hold what was written; records of a capture come together."""

import gzip
import hashlib
from collections import Counter

import duckdb
import pytest

from marketseries.llm import queries, warc


def expected(rows, least=1000):
    last = {}
    for page, _, html in rows:
        last[html or ""] = max(page, last.get(html or "", page))
    out = Counter()
    for page, _, html in rows:
        data = (html or "").encode()
        to = last[html or ""] if len(data) >= least and page < last[html or ""] else None
        out[page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if to is not None else "response", to] += 1
    return out


BIG, SEAM = "<p>é" * 400, "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\nb\r\n\r\n\r\n"
ROWS = [(1, "http://a.example/x?y", BIG), (2, None, BIG), (3, "bad url\r\nX: y", BIG), (4, "http://b", SEAM * 30), (5, "http://b", SEAM * 30),
        (6, "http://c", None), (7, "", ""), (8, "http://d", "\r\n"), (9, "http://d", "\r\n\r\n"), (10, "http://d", "short"), (11, "http://e", "short"),
        (12, "http://f", "x" * 3_000_000), (13, "http://g", "\r\n" * 600), (-1, "http://h", BIG)]


@pytest.fixture
def pages(spark):
    return spark.createDataFrame([(*r, "x", 1) for r in ROWS], "page_id long, url string, html string, record_id string, payload int")


def test_round_trip(spark, pages, tmp_path):
    warc.write_archives(pages, f"{tmp_path}/w")
    captures = warc.assemble(warc.read_records(spark, f"{tmp_path}/w"))
    rows = captures.collect()
    page = {r["record_id"]: int(r["metadata"]["fields"]["pageId"]) for r in rows}
    found = Counter((page[r["record_id"]], r["payload_bytes"], r["payload_digest"], r["record_type"], page.get(r["refers_to"])) for r in rows)
    assert found == expected(ROWS)
    full = {page[r["record_id"]]: r for r in warc.with_payloads(captures).collect()}
    assert {k: bytes(r["payload"]) for k, r in full.items()} == {k: (h or "").encode() for k, _, h in ROWS}
    assert full[1]["request"]["fields"]["start"] == "GET http://a.example/x?y HTTP/1.1" and full[1]["request"]["fields"]["Host"] == "a.example"
    assert full[2]["target_uri"] is None and full[3]["target_uri"] == "bad url%0D%0AX: y" and full[1]["http_status"] == 200


def test_files_are_plain_records(spark, pages, tmp_path):
    warc.write_archives(pages.filter("page_id = 10"), f"{tmp_path}/w")
    data = b"".join(gzip.open(p).read() for p in tmp_path.glob("w/part-*.gz"))
    types = [x.split(b"\r\n")[0] for x in data.split(b"WARC-Type: ")[1:]]
    assert data.startswith(b"WARC/1.1\r\n") and types == [b"request", b"response", b"metadata"] and data.endswith(b"\r\n\r\n")


def test_missing_parts_repeats_and_empty(spark, tmp_path):
    schema = warc.RECORD
    one = ("r1", "response", None, None, "u", "d", None, {}, 200, bytearray(b"abc"))
    other = [("m2", "metadata", "r1", None, None, None, None, {"a": "2"}, None, None), ("m1", "metadata", "r1", None, None, None, None, {"a": "1"}, None, None),
             ("q9", "request", "gone", None, None, None, None, {}, None, None), ("q8", "request", None, None, None, None, None, {}, None, None)]
    rows = warc.assemble(spark.createDataFrame([one, *other], schema)).collect()
    assert [(r["record_id"], r["request"], r["metadata"]["fields"], r["payload_bytes"]) for r in rows] == [("r1", None, {"a": "1"}, 3)]
    none = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_archives(none, f"{tmp_path}/e")
    assert warc.assemble(warc.read_records(spark, f"{tmp_path}/e")).collect() == []
    twice = spark.createDataFrame([(1, "u", BIG)] * 2 + [(None, "u", BIG)], "page_id long, url string, html string")
    warc.write_archives(twice, f"{tmp_path}/t")
    assert {(r["record_type"], r["payload_bytes"]) for r in warc.assemble(warc.read_records(spark, f"{tmp_path}/t")).collect()} == {("response", len(BIG.encode()))}


def test_query_as_sql(spark):
    root = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{root}/pages.parquet'")
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    mine = sorted(map(repr, (tuple(r) for r in queries.QUERIES["op6_warc"](spark, root).select(names).collect())))
    theirs = sorted(map(repr, con.execute(f"SELECT {', '.join(names)} FROM ({queries.ORACLES['op6_warc']})").fetchall()))
    assert mine == theirs


def test_query_with_repeated_rows(spark, tmp_path):
    """Repeated responses and revisits come back as often as they are there."""
    rows = ROWS + [ROWS[2]] * 2 + [ROWS[0]] + [ROWS[10]] * 3 + [ROWS[4]]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    found = Counter(map(tuple, queries.QUERIES["op6_warc"](spark, str(tmp_path)).collect()))
    assert found == expected(rows)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    names = "page_id, payload_bytes, payload_digest, record_type, refers_to"
    assert found == Counter(con.execute(f"SELECT {names} FROM ({queries.ORACLES['op6_warc']})").fetchall())
