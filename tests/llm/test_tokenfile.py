"""Coded blocks and files come back whole; damage is noticed."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from marketseries.llm import queries, tokenfile

BYTES = public_tokenizers.path("byte_bpe_50k.json")


def round_trip(ids):
    data = tokenfile.write_block([7], [len(ids)], ids)
    keys, counts, back, end = tokenfile.read_block(memoryview(data + b"more"))
    assert keys.tolist() == [7] and counts.tolist() == [len(ids)] and back.tolist() == ids.tolist() and end == len(data)
    return len(data)


@settings(deadline=None, max_examples=30)
@given(st.lists(st.integers(0, 300), max_size=700))
def test_any_ids(ids):
    round_trip(np.array(ids, np.uint32))


@pytest.mark.parametrize("n", [1, 255, 256, 257, 5000, 4096 * 256 + 3])
def test_shapes(n):
    rng = np.random.default_rng(n)
    round_trip(rng.integers(0, 50257, n).astype(np.uint32))


def test_predictable_ids_are_small():
    rng = np.random.default_rng(0)
    repeated = np.tile(rng.integers(0, 50257, 100), 3000).astype(np.uint32)
    assert round_trip(repeated) * 8 / len(repeated) < 1.5
    assert round_trip(np.array([(1 << 18) - 1, 0] * 2000, np.uint32)) < 2000


def test_blocks_of_earlier_files():
    """Files written before stay readable, and written as they were: coded words of 4000 ids, by their checksum."""
    ids = (np.arange(4000, dtype=np.uint32) ** 2 % 977 * 51).astype(np.uint32)
    words, used = tokenfile.code_ids(ids, int(ids.max()) + 1)
    assert (zlib.crc32(words.tobytes()), used.sum()) == (2139576062, 1280)
    assert tokenfile.decode_ids(words, used, len(ids), int(ids.max()) + 1).tolist() == ids.tolist()


def test_damage_and_large_ids():
    data = bytearray(tokenfile.write_block([1], [500], np.arange(500, dtype=np.uint32)))
    data[-9] ^= 1
    with pytest.raises(ValueError):
        tokenfile.read_block(memoryview(data))
    with pytest.raises(ValueError):
        tokenfile.read_block(memoryview(data[:40]))
    with pytest.raises(ValueError):
        tokenfile.write_block([1], [1], np.array([1 << 18], np.uint32))


def expected(rows):
    library, at, out = Tokenizer.from_file(BYTES), 0, []
    for key, text in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        out.append((key, at, len(ids), zlib.crc32(ids)))
        at += len(ids)
    return out


def test_query(spark):
    root = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{root}/documents.parquet").collect()]
    found = queries.QUERIES["op5_token_files"](spark, root).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, found)) == expected(rows)


def test_odd_rows_over_blocks_and_files(spark, tmp_path, monkeypatch):
    rows = [(i, "w%d " % i * (i % 7)) for i in range(200)] + [(300, None), (301, ""), (None, "lost"), (302, "long " * 60000), (302, "long " * 60000), (-5, "é")]
    docs = spark.createDataFrame([(k, t, "x", 1) for k, t in rows], "doc_id long, text string, file string, at int")
    tokenfile.write_tokens(docs.repartition(5), f"{tmp_path}/t", BYTES, 2, blocks_per_file=1)
    assert sorted(map(tuple, tokenfile.token_index(spark, f"{tmp_path}/t").collect())) == expected(rows)
    full = tokenfile.read_tokens(spark, f"{tmp_path}/t").orderBy("file", "at").collect()
    assert [(r["doc_id"], zlib.crc32(np.array(r["ids"], "<u4"))) for r in full] == [(k, c) for k, _, _, c in expected(rows)]


def test_order_of_files_with_long_numbers(spark, tmp_path):
    """Names sort as text where their numbers outgrow the digits they are padded to; documents must not."""
    rows, folder = [], tmp_path / "n"
    folder.mkdir()
    names = [f"part-{t:05d}-c{f:03d}.txt" for t in (99998, 99999, 100000, 100001) for f in (0, 1, 999, 1000, 1001)]
    for i, name in enumerate(names):
        ids = np.arange(i + 2, dtype=np.uint32)
        rows.append((10 * i, ids))
        (folder / name).write_bytes(bytes(tokenfile.write_block([10 * i], [len(ids)], ids)) + tokenfile.TRAILER.encode())
    assert sorted(names) != names
    found = {r["doc_id"]: r["start"] for r in tokenfile.token_index(spark, str(folder)).collect()}
    sizes = np.cumsum([0, *(len(ids) for _, ids in rows)])
    assert found == {k: int(s) for (k, _), s in zip(rows, sizes)}


def test_empty_table(spark, tmp_path):
    tokenfile.write_tokens(spark.createDataFrame([], "doc_id long, text string"), f"{tmp_path}/e", BYTES, 2)
    assert tokenfile.token_index(spark, f"{tmp_path}/e").collect() == []
