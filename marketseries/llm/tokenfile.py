"""Token ids in files of checksummed blocks, coded by a range coder over mixed order-0 to order-2 predictions.

A block is coded in lanes, runs of ids that share one model and advance in step, so that each step is a few array
operations. Every block starts from an empty model and can be read alone.

File: blocks, each closed by :data:`TRAILER`. Block: header (:data:`HEADER`: magic, flags, documents, ids, lanes,
symbols, bytes of the coded part, CRC-32 of all that follows the header with the ids in place of the coded part),
int64 keys, uint32 id counts, uint32 words per lane, uint16 words. All little-endian.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketseries.llm.words import encoded
from marketseries.session import cut_lineage

MAGIC, TRAILER = b"TKB1", "\nTKB1-END\n"
HEADER = struct.Struct("<4sIIQIIQI")
#: Ids of a block (more only where one document has more), and the lanes of a full block.
BLOCK_IDS, LANES, LANE_IDS = 1 << 21, 4096, 256
#: Largest symbol + 1; order-2 slots; steps between two refreshments of the shared frequencies.
MOST_SYMBOLS, SLOTS, REFRESH = 1 << 18, 1 << 18, 16
#: Total of the order-0 frequencies, and of the mixed intervals.
_ZERO_BITS, _MIX_BITS = 20, 24
_U = np.uint64
_LOW = _U((1 << 48) - 1)


class _Model:
    """Shared predictions of a block: order-0 frequencies, one candidate with a confidence per order-1 and order-2
    context, and how often candidates of each pair of confidences were right."""

    def __init__(self, symbols: int, decode: bool):
        self.symbols, self.decode = symbols, decode
        self.counts = np.zeros(symbols, np.int64)
        self.one, self.two = np.zeros(symbols, np.int32), np.zeros(SLOTS, np.int32)
        self.right = np.ones((3, 128))  # order 2 right, order 1 right, neither; by both confidences and agreement
        self.seen: list[np.ndarray] = []
        self.refresh()

    def refresh(self) -> None:
        if self.seen:
            self.counts += np.bincount(np.concatenate(self.seen), minlength=self.symbols)
            self.seen = []
        free = (1 << _ZERO_BITS) - self.symbols
        own = 1 + self.counts * free // max(1, int(self.counts.sum()))
        own[int(own.argmax())] += (1 << _ZERO_BITS) - int(own.sum())
        self.start = np.concatenate([[0], np.cumsum(own)])
        if self.decode:
            self.symbol_at = np.repeat(np.arange(self.symbols, dtype=np.int32), own)
        share = self.right[:2] / self.right.sum(0) * ((1 << _MIX_BITS) * 15 // 16)
        self.f2, f1 = np.maximum(16, share).astype(np.int64)
        self.f12 = self.f2 + np.where(np.arange(128) & 1, 0, f1)  # odd where both candidates are the same

    def predict(self, last: np.ndarray, before: np.ndarray) -> None:
        self.last = last
        self.slot = ((last * 0x9E3779B1) ^ (before * 0x85EBCA77)) >> 14 & (SLOTS - 1)
        self.e1, self.e2 = self.one.take(last), self.two.take(self.slot)
        self.c1, self.c2 = self.e1 & 0xFFFFF, self.e2 & 0xFFFFF
        self.same = self.c1 == self.c2
        self.mix = ((self.e2 >> 20 << 4) | (self.e1 >> 20 << 1) | self.same).astype(np.int64)
        self.w2, self.w12 = self.f2.take(self.mix), self.f12.take(self.mix)
        self.rest = (1 << _MIX_BITS) - self.w12

    def interval(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        begin = self.w12 + (self.start.take(ids) * self.rest >> _ZERO_BITS)
        end = self.w12 + (self.start[1:].take(ids) * self.rest >> _ZERO_BITS)
        self.ids = ids.astype(np.int32)
        self.first, self.hit1 = self.ids == self.c2, self.ids == self.c1
        self.second = self.hit1 > self.same
        np.copyto(begin, 0, where=self.first)
        np.copyto(end, self.w2, where=self.first)
        np.copyto(begin, self.w2, where=self.second)
        np.copyto(end, self.w12, where=self.second)
        return begin.view(_U), (end - begin).view(_U)

    def symbols_of(self, value: np.ndarray) -> np.ndarray:
        inner = np.maximum(value - self.w12, 0)
        t = (((inner + 1) << _ZERO_BITS) - 1) // self.rest
        ids = self.symbol_at.take(np.minimum(t, (1 << _ZERO_BITS) - 1))
        np.copyto(ids, self.c1, where=value < self.w12)
        np.copyto(ids, self.c2, where=value < self.w2)
        return ids.astype(np.int64)

    def learn(self, ids: np.ndarray) -> None:
        """After :meth:`interval` of the same ids."""
        kind = 2 - 2 * self.first.view(np.int8) - self.second.view(np.int8)
        self.right += np.bincount(kind.astype(np.int64) * 128 + self.mix, minlength=384).reshape(3, 128)
        tables = ((self.one, self.last, self.e1, self.c1, self.hit1), (self.two, self.slot, self.e2, self.c2, self.first))
        for table, at, entry, candidate, hit in tables:
            trust = entry >> 20
            after = np.where(hit, np.minimum(trust + 1, 7), trust >> 1)
            table[at] = np.where(trust > 0, candidate, self.ids) | after << 20
        self.seen.append(ids)


def _shape(n: int) -> tuple[int, int]:
    steps = max(LANE_IDS, -(-n // LANES))
    return steps, -(-n // steps)


def code_ids(ids: np.ndarray, symbols: int) -> tuple[np.ndarray, np.ndarray]:
    """Words of each lane, one lane after another, and their numbers."""
    n = len(ids)
    steps, lanes = _shape(n)
    table = np.zeros(steps * lanes, np.int64)
    table[:n] = ids
    table = np.ascontiguousarray(table.reshape(lanes, steps).T)
    model = _Model(symbols, False)
    low, span = np.zeros(lanes, _U), np.full(lanes, (1 << 64) - 1, _U)
    words, used = np.zeros((lanes, 2 * steps + 16), np.uint16), np.zeros(lanes, np.int64)
    last = before = np.zeros(lanes, np.int64)
    for t in range(steps):
        live = lanes if t + (lanes - 1) * steps < n else lanes - 1
        own = table[t, :live]
        model.predict(last[:live], before[:live])
        begin, width = model.interval(own)
        unit = span[:live] >> _U(_MIX_BITS)
        low[:live] += begin * unit
        span[:live] = width * unit
        at = np.flatnonzero(span < _U(1 << 48))
        while len(at):
            a, s = low[at], span[at]
            s = np.where((a ^ (a + s - _U(1))) >> _U(48) != 0, (_U(0) - a) & _LOW, s)
            words[at, used[at]] = a >> _U(48)
            used[at] += 1
            low[at], span[at] = a << _U(16), s << _U(16)
            at = at[(s << _U(16)) < _U(1 << 48)]
        model.learn(own)
        before, last = last, own if live == lanes else np.append(own, 0)
        if t % REFRESH == REFRESH - 1 or t < 8:
            model.refresh()
    for k in (48, 32, 16, 0):
        words[np.arange(lanes), used] = (low >> _U(k)).astype(np.uint16)
        used += 1
    return words[np.arange(words.shape[1]) < used[:, None]], used.astype(np.uint32)


def decode_ids(words: np.ndarray, used: np.ndarray, n: int, symbols: int) -> np.ndarray:
    steps, lanes = _shape(n)
    model = _Model(symbols, True)
    at = np.cumsum(used, dtype=np.int64) - used
    words = np.append(words, np.zeros(4, np.uint16)).astype(_U)
    code = np.zeros(lanes, _U)
    for _ in range(4):
        code = code << _U(16) | words[at]
        at = at + 1
    low, span = np.zeros(lanes, _U), np.full(lanes, (1 << 64) - 1, _U)
    last = before = np.zeros(lanes, np.int64)
    out = np.zeros((steps, lanes), np.int32)
    for t in range(steps):
        live = lanes if t + (lanes - 1) * steps < n else lanes - 1
        model.predict(last[:live], before[:live])
        unit = span[:live] >> _U(_MIX_BITS)
        # at most 1 << 24, but for damaged data
        own = model.symbols_of(np.minimum((code[:live] - low[:live]) // unit, _U(1 << 25)).view(np.int64))
        begin, width = model.interval(own)
        low[:live] += begin * unit
        span[:live] = width * unit
        out[t, :live] = own
        few = np.flatnonzero(span < _U(1 << 48))
        while len(few):
            a, s = low[few], span[few]
            s = np.where((a ^ (a + s - _U(1))) >> _U(48) != 0, (_U(0) - a) & _LOW, s)
            code[few] = code[few] << _U(16) | words[at[few]]
            at[few] += 1
            low[few], span[few] = a << _U(16), s << _U(16)
            few = few[(s << _U(16)) < _U(1 << 48)]
        model.learn(own)
        before, last = last, own if live == lanes else np.append(own, 0)
        if t % REFRESH == REFRESH - 1 or t < 8:
            model.refresh()
    return np.ascontiguousarray(out.T).ravel()[:n].astype(np.uint32)


def write_block(keys: list[int], counts: list[int], ids: np.ndarray) -> bytes:
    symbols = int(ids.max(initial=0)) + 1
    if symbols > MOST_SYMBOLS:
        raise ValueError(f"ids up to {MOST_SYMBOLS - 1} can be written, not {symbols - 1}")
    words, used = code_ids(ids, symbols) if len(ids) else (np.zeros(0, np.uint16), np.zeros(0, np.uint32))
    index = np.array(keys, "<i8").tobytes() + np.array(counts, "<u4").tobytes()
    coded = used.astype("<u4").tobytes() + words.astype("<u2").tobytes()
    check = zlib.crc32(ids.astype("<u4").tobytes(), zlib.crc32(index))
    return HEADER.pack(MAGIC, 0, len(keys), len(ids), len(used), symbols, len(coded), check) + index + coded


def read_block(data: memoryview) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Keys, counts and ids of the block that ``data`` begins with, and its length in bytes."""
    if len(data) < HEADER.size:
        raise ValueError("a file ends within a block")
    magic, _, docs, n, lanes, symbols, size, check = HEADER.unpack(data[: HEADER.size])
    end = HEADER.size + 12 * docs + size
    if magic != MAGIC or len(data) < end:
        raise ValueError("no block, or a file ends within it")
    index, coded = data[HEADER.size : HEADER.size + 12 * docs], data[end - size : end]
    keys, counts = np.frombuffer(index, "<i8", docs), np.frombuffer(index, "<u4", docs, 8 * docs)
    used, words = np.frombuffer(coded, "<u4", lanes), np.frombuffer(coded, "<u2", offset=4 * lanes)
    ids = decode_ids(words, used, n, symbols) if n else np.zeros(0, np.uint32)
    if zlib.crc32(ids.astype("<u4").tobytes(), zlib.crc32(index)) != check or int(counts.sum()) != n:
        raise ValueError("a block's checksum is wrong")
    return keys, counts, ids, end


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int, blocks_per_file: int = 8) -> None:
    """Writes the ids of each row's text, closed by ``end_id``, in ascending order of doc_id.

    Null text is empty; rows without doc_id are left out; rows that repeat a doc_id stand side by side. The files are
    written by Spark's text writer, whose line separator is the blocks' trailer, so they survive lost executors.
    """

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[int] = []
        counts: list[int] = []
        held: list[np.ndarray] = []
        have = 0
        for own, ids, starts in encoded(batches, "doc_id", tokenizer):
            ids = np.insert(ids, starts[1:], end_id)
            starts = starts + np.arange(len(starts))
            done = 0
            while done < len(own):
                more = max(1, int(np.searchsorted(starts, starts[done] + BLOCK_IDS - have, "right")) - 1 - done)
                upto = min(len(own), done + more)
                keys += own[done:upto]
                counts += np.diff(starts[done : upto + 1]).tolist()
                held.append(ids[starts[done] : starts[upto]])
                have += len(held[-1])
                done = upto
                if have >= BLOCK_IDS or done < len(own):
                    yield pa.RecordBatch.from_pydict({"block": [write_block(keys, counts, np.concatenate(held))]})
                    keys, counts, held, have = [], [], [], 0
        if keys:
            yield pa.RecordBatch.from_pydict({"block": [write_block(keys, counts, np.concatenate(held))]})

    rows = docs.filter("doc_id is not null").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id").mapInArrow(blocks, "block binary")
    rows.select(F.col("block").cast("string").alias("value")).write.option("lineSep", TRAILER).option(
        "maxRecordsPerFile", blocks_per_file).text(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """file, at (ids of the file before the document), doc_id and ids of every document, file by file in task memory
    one block at a time."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file, at, keys, counts, ids in _documents(batches):
            ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array([file] * len(keys), pa.string()), pa.array(at + ends[:-1].astype(np.int64)), pa.array(keys),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(ids.astype(np.int32)))], names=["file", "at", "doc_id", "ids"])

    return _files(spark, path).mapInArrow(read, "file string, at long, doc_id long, ids array<int>")


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), "content")


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        for file, content in zip(batch.column("file").to_pylist(), batch.column("content")):
            data, at = memoryview(content.as_buffer()), 0
            while len(data):
                keys, counts, ids, end = read_block(data)
                yield file, at, keys, counts, ids
                at += len(ids)
                if bytes(data[end : end + len(TRAILER)]) != TRAILER.encode():
                    raise ValueError("a block has no trailer")
                data = data[end + len(TRAILER) :]


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32 of every document in the files."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file, at, keys, counts, ids in _documents(batches):
            ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
            raw = memoryview(ids.astype("<u4")).cast("B")
            sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([file] * len(keys), pa.string()), pa.array(at + ends[:-1]), pa.array(keys),
                 pa.array(counts.astype(np.int64)), pa.array(sums, pa.int64())], names=["file", "at", "doc_id", "n_tokens", "ids_crc32"])

    found = _files(spark, path).mapInArrow(index, "file string, at long, doc_id long, n_tokens long, ids_crc32 long")
    found = cut_lineage(found, "tokens")
    # files in the order of what they hold, as their names sort by number only up to the digits they are padded to;
    # where one doc_id fills several files, they may stand in any order between the one it begins in and that it ends in
    totals = found.groupBy("file").agg(F.sum("n_tokens").alias("_ids"), F.min("doc_id").alias("_lo"), F.max("doc_id").alias("_hi"))
    in_order = Window.orderBy("_lo", "_hi", "file")  # one row for each file
    before = totals.select("file", (F.sum("_ids").over(in_order) - F.col("_ids")).alias("_before"))
    return found.join(before, "file").select("doc_id", (F.col("at") + F.col("_before")).alias("start"), "n_tokens", "ids_crc32")
