"""Packing of documents into token windows by non-negative least squares over length combinations."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketseries.llm.words import encoded
from marketseries.session import cut_lineage

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def token_pieces(docs: DataFrame, tokenizer: str, window: int = 1024, end_id: int = 0) -> DataFrame:
    """Pieces of at most ``window`` ids of each row's text, closed by ``end_id``.

    A null or empty text is one piece that holds the end id. Repeated rows give repeated pieces; columns other
    than ``doc_id`` and ``text`` are not read. The ids themselves stay in the task: a piece is known by its
    place in its document and its checksum.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")])
        for keys, ids, starts in encoded(batches, "doc_id", tokenizer):
            rows: list[tuple] = []
            for key, a, b in zip(keys, starts[:-1].tolist(), starts[1:].tolist()):
                own = np.append(ids[a:b], end_id).astype("<u4")
                for s in range(0, len(own), window):
                    part = own[s : s + window]
                    rows.append((key, s, len(part), zlib.crc32(part), len(own)))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, PIECES)


def combinations(window: int) -> list[tuple[int, ...]]:
    """Shallow combinations that fill a window: pairs, and two or three equal lengths with what is left."""
    found = {(a, window - a) for a in range(window // 2, window)}
    for k in (2, 3):
        found |= {tuple(sorted((a,) * k + (window - k * a,), reverse=True)) for a in range(1, (window - 1) // k + 1)}
    return sorted(found, reverse=True)


def repeat_counts(histogram: np.ndarray, combos: list[tuple[int, ...]], steps: int = 4000) -> np.ndarray:
    """Non-negative x with the least squares of A x - histogram; A counts the lengths of each combination.

    Accelerated projected gradients on the sparse columns; the columns are short, so that 4 times the largest
    row sum bounds the curvature. What the last digits leave open is packed greedily later.
    """
    column = np.concatenate([np.full(len(c), i) for i, c in enumerate(combos)])
    length = np.concatenate([np.array(c) for c in combos])
    n = len(combos)
    rows = np.bincount(length, minlength=len(histogram))
    bound = float(max(len(c) for c in combos) * rows.max())
    x = y = np.zeros(n)
    t = 1.0
    for _ in range(steps):
        gap = np.bincount(length, y[column], len(histogram)) - histogram
        new = np.maximum(0.0, y - np.bincount(column, gap[length], n) / bound)
        nxt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / nxt * (new - x)
        if np.abs(new - x).max() < 1e-4:
            x = new
            break
        x, t = new, nxt
    return x


def plan(histogram: dict[int, int], window: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths with their repeats; every length is used exactly as often as the histogram has it."""
    left = np.zeros(window + 1, np.int64)
    for length, n in histogram.items():
        left[length] = n
    out: list[tuple[tuple[int, ...], int]] = []

    def take(pattern: tuple[int, ...], times: int) -> None:
        need = Counter(pattern)
        times = min(times, *(int(left[k]) // v for k, v in need.items()))
        if times > 0:
            out.append((pattern, times))
            for k, v in need.items():
                left[k] -= v * times

    if left[window]:
        take((window,), int(left[window]))
    if left.any():
        combos = combinations(window)
        solved = np.floor(repeat_counts(left.astype(float), combos) + 1e-6).astype(np.int64)
        for i in np.argsort(-solved, kind="stable"):
            if solved[i] == 0:
                break
            take(combos[i], int(solved[i]))
    while left.any():  # residuals: the longest first, then always the longest that fits
        pattern: list[int] = []
        free = window
        spare = left.copy()
        while free and (fits := np.flatnonzero(spare[: free + 1])).size:
            pattern.append(int(fits[-1]))
            spare[fits[-1]] -= 1
            free -= pattern[-1]
        take(tuple(pattern), int(left.max()))
    return out


def places(patterns: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, offset, tokens in the sequence) of every slot of every pattern."""
    rank: Counter = Counter()
    out, first = [], 0
    for pattern, times in patterns:
        offset = 0
        for length in pattern:
            out.append((length, rank[length], rank[length] + times, first, offset, sum(pattern)))
            rank[length] += times
            offset += length
        first += times
    return out


def pack(pieces: DataFrame, window: int = 1024, rows_per_bucket: int = 100_000) -> DataFrame:
    """Adds ``sequence_id``, ``offset`` and ``padded_length`` to rows with ``doc_id``, ``start`` and ``length``.

    The driver sees the histogram of lengths only (``window`` entries). Rows of one length are numbered in
    buckets by hash, so that a length which a third of all rows have is no single task; the table of slots is
    bounded by the window and broadcast. A window is padded to ``window``, except where its tokens are a power
    of two. An empty input gives no rows.
    """
    spark: SparkSession = pieces.sparkSession
    pieces = cut_lineage(pieces, "pieces")
    total = pieces.count()
    buckets = max(1, -(-total // rows_per_bucket))
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = spark.createDataFrame(
        places(plan(histogram, window)), "_l long, _lo long, _hi long, _first long, offset long, _tokens long"
    )
    bucket = F.pmod(F.xxhash64("doc_id", "start", "length"), F.lit(buckets))
    counts = pieces.groupBy("length", bucket.alias("_b")).agg(F.count("*").alias("_n"))
    before = counts.select(
        F.col("length").alias("_cl"), F.col("_b").alias("_cb"),
        (F.sum("_n").over(Window.partitionBy("length").orderBy("_b")) - F.col("_n")).alias("_before"),
    )
    inside = Window.partitionBy("length", "_b").orderBy("doc_id", "start")
    ranked = pieces.withColumn("_b", bucket).withColumn("_r", F.row_number().over(inside) - 1)
    ranked = ranked.join(before, (F.col("length") == F.col("_cl")) & (F.col("_b") == F.col("_cb")))
    ranked = ranked.withColumn("_r", F.col("_r") + F.col("_before"))
    hit = (F.col("length") == F.col("_l")) & (F.col("_r") >= F.col("_lo")) & (F.col("_r") < F.col("_hi"))
    power = F.expr("(_tokens & (_tokens - 1)) = 0")
    return ranked.join(F.broadcast(slots), hit).select(
        *pieces.columns, (F.col("_first") + F.col("_r") - F.col("_lo")).alias("sequence_id"), "offset",
        F.when(power, F.col("_tokens")).otherwise(F.lit(window).cast("long")).alias("padded_length"),
    )


def pack_documents(docs: DataFrame, tokenizer: str, window: int = 1024, end_id: int = 0) -> DataFrame:
    """Documents to placed pieces; see :func:`token_pieces` and :func:`pack`."""
    return pack(token_pieces(docs, tokenizer, window, end_id), window)
