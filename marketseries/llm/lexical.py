"""Ranked lexical search: short posting lists term by term, long ones document by document.

The documents are cut into blocks with posting lists of the terms that are asked for. In a block, the short lists of a
query are summed into accumulators at once; these then stand beside the long lists as one more list with known bounds.
Chunks of documents are visited in the order of the sum of those bounds, long lists are only looked up at documents
that can still enter the best, and chunks whose bound is below the k-th best score so far are skipped.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketseries.llm.batches import arrow_rows, worker_task
from marketseries.session import cut_lineage

#: Term occurrences of the queries that are searched in one pass; it bounds what each task is sent.
PASS_TERMS = 50_000
#: Documents and postings of a block at most (a document is never cut).
BLOCK_DOCS, BLOCK_POSTINGS = 4096, 4_000_000
#: A list with more than one document in so many of its block is long.
LONG_SHARE = 16
#: Documents that share one bound.
CHUNK = 64
#: Bytes of a text that are cut into terms at once.
SLICE = 1 << 22

_SEPARATORS = [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
_TERMS = bytearray(range(256))
for _c in range(0x41, 0x5B):
    _TERMS[_c] += 32
for _c in _SEPARATORS:
    _TERMS[_c] = 0x20
_TERMS = bytes(_TERMS)


def term_counts(text: bytes) -> Counter:
    """Occurrences of each term of a UTF-8 text: all that stands between ASCII characters other than letters and digits."""
    if len(text) <= SLICE:
        return Counter(text.translate(_TERMS).split())
    counts: Counter = Counter()
    at = 0
    plain = text.translate(_TERMS)
    while at < len(plain):
        end = plain.find(b" ", at + SLICE)
        end = len(plain) if end < 0 else end
        counts.update(plain[at:end].split())
        at = end
    return counts


_INDEX = (
    "n_docs long, n_terms long, doc_ids array<long>, lengths array<long>, terms array<int>, counts array<int>, docs binary, tfs binary"
)


def _index(batches: Iterable[pa.RecordBatch], vocabulary: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    """Blocks of documents: their ids and lengths, and the posting lists of the vocabulary one after another."""
    known = vocabulary.keys()
    ids, lengths, at, tf = [], [], [], []

    def block() -> pa.RecordBatch:
        docs = np.repeat(np.arange(len(ids), dtype=np.uint16), [len(a) for a in at])
        term, freq = np.concatenate([*at, np.zeros(0, np.int32)]), np.concatenate([*tf, np.zeros(0, np.int64)])
        order = np.argsort(term, kind="stable")
        terms, counts = np.unique(term, return_counts=True)
        row = {
            "n_docs": sum(n > 0 for n in lengths), "n_terms": sum(lengths), "doc_ids": ids, "lengths": lengths,
            "terms": terms.astype(np.int32).tolist(), "counts": counts.astype(np.int32).tolist(),
            "docs": docs[order].tobytes(), "tfs": freq[order].astype("<u4").tobytes(),
        }
        return pa.RecordBatch.from_pylist([row], pa.schema([
            ("n_docs", pa.int64()), ("n_terms", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())),
            ("terms", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32())), ("docs", pa.binary()), ("tfs", pa.binary())]))

    with worker_task("lexical"):
        total = 0
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            for i, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                counts = term_counts(texts[i].as_py() or b"")
                found = list(counts.keys() & known)
                ids.append(doc_id)
                lengths.append(counts.total())
                at.append(np.array([vocabulary[w] for w in found], np.int32))
                tf.append(np.array([counts[w] for w in found], np.int64))
                total += len(found)
                if len(ids) >= BLOCK_DOCS or total >= BLOCK_POSTINGS:
                    yield block()
                    ids, lengths, at, tf, total = [], [], [], [], 0
        if ids:
            yield block()


@dataclass
class Query:
    item_id: int | None
    terms: dict[bytes, int]


@dataclass
class Best:
    """The k best documents so far."""

    k: int
    scores: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    ids: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    @property
    def least(self) -> int:
        """Documents below this score cannot enter; at it they can, by a smaller id."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        good = scores >= self.least
        if good.any():
            scores, ids = np.concatenate([self.scores, scores[good]]), np.concatenate([self.ids, ids[good]])
            order = np.lexsort((ids, -scores))[: self.k]
            self.scores, self.ids = scores[order], ids[order]


class Block:
    """Posting lists of a block of documents, with impacts instead of frequencies."""

    def __init__(self, row: dict, n_docs: int, n_terms: int):
        ids = row["doc_ids"]
        self.size = len(ids)
        self.listed = np.array([i is not None for i in ids])
        self.ids = np.array([0 if i is None else i for i in ids], np.int64)
        norm = np.array([12 * (75 + 25 * n * n_docs // n_terms) for n in row["lengths"]], np.int64)
        docs, tf = np.frombuffer(row["docs"], np.uint16), np.frombuffer(row["tfs"], "<u4").astype(np.int64)
        impact = 1_000_000_000 * tf // (1000 * tf + norm[docs])
        ends = np.cumsum([0, *row["counts"]])
        self.short: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.long: dict[int, int] = {}
        self.chunks = -(-self.size // CHUNK)
        dense = []
        for term, a, b in zip(row["terms"], ends, ends[1:]):
            if (b - a) * LONG_SHARE <= self.size:
                self.short[term] = docs[a:b], impact[a:b]
            else:
                self.long[term] = len(dense)
                full = np.zeros(self.chunks * CHUNK, np.int32)  # an impact is at most a million
                full[docs[a:b]] = impact[a:b]
                dense.append(full)
        self.dense = np.array(dense, np.int32).reshape(len(dense), -1)
        self.tops = self.dense.reshape(len(dense), self.chunks, CHUNK).max(axis=2).astype(np.int64)

    def search(self, weights: dict[int, int], best: Best) -> None:
        """Adds what this block has to the best documents of a query with these weights of its terms."""
        sums = np.zeros(self.chunks * CHUNK, np.int64)
        touched = False
        for term in weights.keys() & self.short.keys():
            docs, impact = self.short[term]
            sums[docs] += weights[term] * impact
            touched = True
        rows = [(self.long[t], weights[t]) for t in weights.keys() & self.long.keys()]
        if not rows and not touched:
            return
        at, w = (np.array(x, np.int64) for x in zip(*rows)) if rows else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        tops = self.tops[at] * w[:, None]
        strongest = np.argsort(-tops.sum(axis=1)) if rows else at
        at, w, tops = at[strongest], w[strongest], tops[strongest]
        # bound[j]: what the lists from j on can still add in each chunk; the accumulators are one list more
        bound = np.zeros((len(at) + 1, self.chunks), np.int64)
        bound[:-1] = np.cumsum(tops[::-1], axis=0)[::-1]
        whole = bound[0] + sums.reshape(-1, CHUNK).max(axis=1)
        order = np.argsort(-whole, kind="stable")
        done, step = 0, 4
        while done < len(order):
            order = order[: np.searchsorted(-whole[order], -best.least, side="right")]
            chunks = order[done : done + step]
            if not len(chunks):
                return
            self._visit(chunks, sums, at, w, bound, best)
            done, step = done + step, step * 2

    def _visit(self, chunks: np.ndarray, sums: np.ndarray, at: np.ndarray, w: np.ndarray, bound: np.ndarray, best: Best) -> None:
        docs = (chunks[:, None] * CHUNK + np.arange(CHUNK)).ravel()
        docs = docs[docs < self.size]
        docs = docs[self.listed[docs]]
        scores = sums[docs]
        for j, row in enumerate(at):
            keep = scores + bound[j][docs // CHUNK] >= best.least
            if not keep.all():
                docs, scores = docs[keep], scores[keep]
            if not len(docs):
                return
            scores = scores + w[j] * self.dense[row, docs].astype(np.int64)
        best.add(scores, self.ids[docs])


def _search(batches: Iterable[pa.RecordBatch], queries: list[tuple[int | None, dict[int, int]]], n_docs: int, n_terms: int, k: int) -> Iterator[pa.RecordBatch]:
    with worker_task("lexical"):
        best = [Best(k) for _ in queries]
        for batch in batches:
            for i in range(batch.num_rows):
                block = Block(batch.slice(i, 1).to_pylist()[0], n_docs, n_terms)
                for (_, weights), held in zip(queries, best):
                    block.search(weights, held)
        sizes = [len(b.ids) for b in best]
        items = [q for (q, _), n in zip(queries, sizes) for _ in range(n)]
        found = [np.concatenate([np.zeros(0, np.int64), *(getattr(b, c) for b in best)]) for c in ("ids", "scores")]
        yield pa.RecordBatch.from_arrays([pa.array(items, pa.int64()), *map(pa.array, found)], ["item_id", "doc_id", "score"])


def _passes(items: DataFrame) -> Iterator[list[Query]]:
    """The queries in blocks of a bounded number of term occurrences, read one after another in the order of their ids."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("text is not null").distinct()
    held: list[Query] = []
    size = 0
    for item_id, text in rows.orderBy("item_id").toLocalIterator():
        terms = term_counts(text.encode())
        if held and held[-1].item_id == item_id:
            held[-1].terms = Counter(held[-1].terms) + terms
        else:
            if size >= PASS_TERMS:
                yield held
                held, size = [], 0
            held.append(Query(item_id, terms))
        size += len(terms)
    if held:
        yield held


def _one_pass(docs: DataFrame, queries: list[Query], k: int) -> DataFrame | None:
    spark = docs.sparkSession
    vocabulary = {w: i for i, w in enumerate(sorted({w for q in queries for w in q.terms}))}
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    with arrow_rows(spark, 500):
        blocks = cut_lineage(texts.mapInArrow(lambda batches: _index(batches, vocabulary), _INDEX), "postings")
    n_docs, n_terms = blocks.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    if not n_terms:
        return None
    lists = blocks.select(F.explode(F.arrays_zip("terms", "counts")).alias("x"))
    df = dict(lists.groupBy("x.terms").agg(F.sum("x.counts")).collect())  # at most one row for each term of the pass
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
    asked = [(q.item_id, {t: n * weight[t] for w, n in q.terms.items() if (t := vocabulary[w]) in weight}) for q in queries]
    blocks = blocks.select("doc_ids", "lengths", "terms", "counts", "docs", "tfs")
    with arrow_rows(spark, 2):
        found = blocks.mapInArrow(lambda batches: _search(batches, asked, n_docs, n_terms, k), "item_id long, doc_id long, score long")
        return cut_lineage(found, "found")


def search(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` best documents (doc_id, text) for each item (item_id, text): item_id, rank from 1, doc_id, score.

    Only scores above 0 count, equal scores go by doc_id. Null and empty texts have no terms; documents without terms
    count in no statistic. A document without doc_id counts, but is not listed. Repeated documents are documents of
    their own; equal items are one, and several texts of one item_id (null is one, too) are searched as one. Other columns are not
    read; an empty table gives no rows.

    The queries are searched in passes over all documents; a pass takes at least one item and else stops at
    ``PASS_TERMS`` terms, so that what tasks are sent is bounded. A task returns its k best of each item.
    """
    spark: SparkSession = docs.sparkSession
    parts = [p for queries in _passes(items) if (p := _one_pass(docs, queries, k)) is not None]
    if not parts:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), "doc_id")
    ranked = reduce(DataFrame.unionByName, parts).withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
