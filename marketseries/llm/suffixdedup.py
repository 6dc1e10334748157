"""Removal of byte strings that occur more than once anywhere in a corpus, by suffix sorting of shards.

A string of ``length`` bytes is known by the least hash of the k-byte strings in it (its anchor), so equal strings
have equal anchors and those with an anchor of their own need no partner. What stands around the other anchors is
dealt out by anchor, so that all places of a string meet in one shard, whose suffixes are sorted by induction.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketseries.llm.batches import arrow_rows, parts, worker_task
from marketseries.llm.bitmap import with_maybe
from marketseries.llm.suffixsort import PrefixHash, sorted_suffixes
from marketseries.llm.words import slices
from marketseries.session import cut_lineage

#: Length of the strings that are hashed, as shares of ``length``, by level; a hot anchor goes to the next level, after
#: the last one to whole strings. They grow, as a passage holds no anchor that is longer than itself.
ANCHOR_SHARES = (0.3, 0.9)
#: Bytes of a shard, and of the places of one anchor from which on they are dealt out by another one.
SHARD_BYTES, HOT_BYTES = 1_000_000, 2_000_000
#: Rows with whole texts, and bytes of text, that are worked on at once.
DOCUMENT_ROWS, SLICE = 1000, 300_000
_RUNS = "rid binary, h long, p0 int, p1 int, again boolean"


def _anchors(data: np.ndarray, begin: np.ndarray, end: np.ndarray, length: int, level: int) -> tuple[np.ndarray, ...]:
    """Row, hash, first and last start, and whether the anchor occurs twice, of each run of strings with one anchor."""
    k = max(1, int(length * ANCHOR_SHARES[level]))
    width = length - k + 1
    n = len(data) - length + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none, none, none, none, none.astype(bool)
    hashed = PrefixHash(data)
    g = (hashed.sums[k:] - hashed.sums[:-k]) * hashed.back[: len(data) - k + 1]
    g = (g ^ (g >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9 + 2 * level)
    g ^= g >> np.uint64(32)
    least, span = g, 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[: n], least[width - span : width - span + n])
    owner = np.repeat(np.arange(len(begin), dtype=np.int32), end - begin)[:n]
    inside = np.zeros(n, bool)
    for a, b in zip(begin.tolist(), end.tolist()):
        inside[a : max(a, b - length + 1)] = True
    if not inside.any():
        return none, none, none, none, none.astype(bool)
    new = inside & np.concatenate([[True], (least[1:] != least[:-1]) | (owner[1:] != owner[:-1]) | ~inside[:-1]])
    run = np.cumsum(new, dtype=np.int64) - 1
    first = np.flatnonzero(new)
    last = np.append(first[1:], n) - 1
    last = np.minimum(last, end[owner[first]] - length)
    # an anchor at two places of a run: where a run's least hash stands at a start, or at the end of the span of one
    ahead = np.flatnonzero(inside & (g[:n] == least))
    behind = np.flatnonzero(inside & (g[width - 1 : width - 1 + n] == least))
    places = np.unique(np.concatenate([run[ahead] * len(g) + ahead, run[behind] * len(g) + behind + width - 1]))
    again = np.bincount(places // len(g), minlength=len(first)) > 1
    own = owner[first]
    return own, least[first].view(np.int64), first - begin[own], last - begin[own], again


def _spread(bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    size = np.array([len(b) for b in bodies], np.int64)
    begin = np.cumsum(size) - size
    return np.frombuffer(b"".join(bodies), np.uint8), begin, begin + size


def _runs(rows: DataFrame, length: int, level: int) -> DataFrame:
    """Runs of starts with one anchor, of rows (rid, body)."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with worker_task("suffixes"):
            for batch in batches:
                rid, bodies = batch.column("rid"), batch.column("body").to_pylist()
                for a, b in slices([len(x) for x in bodies], SLICE):
                    own, h, p0, p1, again = _anchors(*_spread(bodies[a:b]), length, level)
                    yield pa.RecordBatch.from_arrays(
                        [rid.take(pa.array(own + a)), pa.array(h), pa.array(p0, pa.int32()), pa.array(p1, pa.int32()), pa.array(again)],
                        names=["rid", "h", "p0", "p1", "again"])

    return rows.filter(F.octet_length("body") >= length).mapInArrow(find, _RUNS)


def _contexts(rows: DataFrame, length: int) -> DataFrame:
    """One row for each run of rows (rid, body, runs): its bytes are null if the task has sent equal ones before."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[bytes] = set()
        for batch in batches:
            out: list[tuple] = []
            held = 0
            for rid, body, runs in zip(batch.column("rid").to_pylist(), batch.column("body").to_pylist(), batch.column("runs").to_pylist()):
                for r in runs:
                    part = body[r["p0"] : r["p1"] + length]
                    key = hashlib.blake2b(part, digest_size=16).digest()
                    out.append((r["h"], key, rid, r["p0"], None if key in sent else part))
                    if key not in sent:
                        held += len(part)
                        sent.add(key)
                if held > 4_000_000:
                    yield _context_batch(out)
                    out, held = [], 0
            if len(sent) > 300_000:
                sent.clear()
            yield _context_batch(out)

    return rows.mapInArrow(cut, "h long, key binary, rid binary, p0 int, body binary")


def _context_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.binary())
    columns = list(zip(*rows)) or [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["h", "key", "rid", "p0", "body"])


def _sort_shard(table: pa.Table, length: int) -> pa.Table:
    """Starts (key, a, b: from a to before b) of the strings of a shard's contexts that occur twice, copies counted."""
    bodies: dict[bytes, bytes] = {}
    copies: dict[bytes, int] = {}
    for key, body, n in zip(table.column("key").to_pylist(), table.column("body").to_pylist(), table.column("n").to_pylist()):
        if body is not None:
            bodies[key] = body
        else:
            copies[key] = copies.get(key, 0) + n
    keys = list(bodies)
    size = np.array([len(bodies[k]) for k in keys], np.int64)
    # one byte value that no context may hold is needed between them: lengths tell contexts apart, not the separator
    text = np.frombuffer(b"\0".join(bodies[k] for k in keys), np.uint8)
    begin = np.cumsum(size + 1) - size - 1
    owner = np.repeat(np.arange(len(keys)), size + 1)[: len(text)]
    whole = np.arange(len(text)) + length <= begin[owner] + size[owner]  # starts of strings within one context
    twice = np.zeros(len(text), bool)
    for position, common in sorted_suffixes(text, length):
        # strings within a context only: what stands between two of them in the order may cross contexts
        kept = np.flatnonzero(whole[position])
        if len(kept) < 2:
            continue
        own = np.minimum.reduceat(np.append(common, 0), np.stack([kept[:-1] + 1, kept[1:] + 1], 1).ravel())[0::2]
        hit = np.flatnonzero(own >= length)
        twice[position[kept[hit]]] = True
        twice[position[kept[hit + 1]]] = True
    many = np.array([copies.get(k, 1) > 1 for k in keys])
    twice |= many[owner] & whole
    edge = np.flatnonzero(np.diff(np.concatenate([[False], twice, [False]]).astype(np.int8)))
    a, b = edge[0::2], edge[1::2]
    own = owner[a]
    return pa.table({"key": pa.array([keys[i] for i in own], pa.binary()), "a": pa.array(a - begin[own], pa.int32()),
                     "b": pa.array(b - begin[own], pa.int32())})


def _strings(data: np.ndarray, begin: np.ndarray, end: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Row, two hashes of the whole string, first and last start of each run of starts of equal strings."""
    n = len(data) - length + 1
    owner = np.repeat(np.arange(len(begin)), end - begin)[: max(0, n)]
    start = np.arange(len(owner))
    start = start[start + length <= end[owner]]
    own = owner[start]
    one, two = (PrefixHash(x).of(start, length) for x in (data, data ^ np.uint8(0xA5)))
    new = np.ones(len(start), bool)
    new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1]) | (own[1:] != own[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start))[: len(first)] - 1
    own = own[first]
    return own, one[first].view(np.int64), two[first].view(np.int64), start[first] - begin[own], start[last] - begin[own]


def _whole_strings(rows: DataFrame, length: int) -> DataFrame:
    """What :func:`repeated` gives, by a join on the hashes (128 bits) of all strings, however many share an anchor."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with worker_task("suffixes"):
            for batch in batches:
                rid, bodies = batch.column("rid"), batch.column("body").to_pylist()
                pieces = [(i, at, body[at : at + SLICE + length - 1])
                          for i, body in enumerate(bodies) for at in range(0, len(body) - length + 1, SLICE)]
                for a, b in slices([len(x) for _, _, x in pieces], SLICE):
                    row, shift = (np.array(x, np.int64) for x in list(zip(*pieces[a:b]))[:2])
                    own, h, h2, p0, p1 = _strings(*_spread([x for _, _, x in pieces[a:b]]), length)
                    yield pa.RecordBatch.from_arrays(
                        [rid.take(pa.array(row[own])), pa.array(h), pa.array(h2), pa.array(p0 + shift[own], pa.int32()), pa.array(p1 + shift[own], pa.int32())],
                        names=["rid", "h", "h2", "p0", "p1"])

    with arrow_rows(rows.sparkSession, DOCUMENT_ROWS):
        runs = cut_lineage(rows.mapInArrow(find, "rid binary, h long, h2 long, p0 int, p1 int"), "strings")
    twice = runs.groupBy("h", "h2").agg(F.sum(F.col("p1") - F.col("p0") + 1).alias("c")).filter("c > 1").select("h", "h2")
    return runs.join(twice, ["h", "h2"]).select("rid", F.col("p0").alias("a"), (F.col("p1") + 1).alias("b")).distinct()


def _by_row(spans: DataFrame, key: str) -> DataFrame:
    """(key, spans): the spans (a, b) of each key of rows (key, a, b) in one list, those that touch or overlap as one."""
    order = Window.partitionBy(key).orderBy("a", "b")
    before = F.max("b").over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = spans.withColumn("_new", F.coalesce(F.col("a") > before, F.lit(True)).cast("int"))
    numbered = fresh.withColumn("_run", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    whole = numbered.groupBy(key, "_run").agg(F.min("a").alias("a"), F.max("b").alias("b"))
    return whole.groupBy(key).agg(F.collect_list(F.struct("a", "b")).alias("spans"))


def repeated(rows: DataFrame, length: int, level: int = 0) -> DataFrame:
    """(rid, spans): starts from a to before b of the strings of ``length`` bytes of rows (rid, body) that occur again.

    Each ``rid`` with such strings is one row, and each context meets one row with all its spans, so that copies of a
    context don't multiply them. ``rid`` is a 16-byte id; rows with equal ids must have equal bodies. Equal contexts are one entry with its number
    of copies. An anchor whose distinct contexts exceed :data:`HOT_BYTES` is not one shard: its contexts are texts
    again, dealt out by longer anchors and at last by whole strings, so that no shard outgrows its bound.
    """
    if level == len(ANCHOR_SHARES):
        return _by_row(_whole_strings(rows, length), "rid")
    with arrow_rows(rows.sparkSession, DOCUMENT_ROWS):
        runs = cut_lineage(_runs(rows, length, level), "runs")
    counts = runs.groupBy("h").agg(F.count("*").alias("c"), F.max("again").alias("r"))
    some = runs.join(counts.filter("c > 1 or r").select("h"), "h").groupBy("rid").agg(
        F.array_distinct(F.collect_list(F.struct("p0", "p1", "h"))).alias("runs"), F.count("*").alias("c"))
    some = cut_lineage(some, "runs")
    texts = with_maybe(rows, "rid", some.select("rid")).filter("maybe").drop("maybe").join(some.select("rid", "runs"), "rid")
    with arrow_rows(rows.sparkSession, DOCUMENT_ROWS):
        found = cut_lineage(_contexts(texts, length), "contexts")
    numbers = found.groupBy("h", "key").agg(F.count("*").alias("n"))
    bodies = found.filter("body is not null").select("h", "key", "body")
    weight = bodies.groupBy("h").agg(F.sum(F.octet_length("body")).alias("bytes")).filter(F.col("bytes") > HOT_BYTES)
    hot = cut_lineage(weight.select("h"), "hot")
    hot = None if hot.isEmpty() else hot
    if hot is not None:
        warm = bodies.join(hot, "h").select(F.col("key").alias("rid"), "body")
        deeper = repeated(cut_lineage(warm, "warm"), length, level + 1)
        deeper = deeper.select(F.col("rid").alias("key"), F.explode("spans").alias("_s")).select("key", "_s.a", "_s.b")
        size = warm.select(F.col("rid").alias("key"), F.octet_length("body").alias("size")).distinct()
        copied = numbers.filter("n > 1").join(size, "key").select("key", F.lit(0).alias("a"), (F.col("size") - length + 1).alias("b"))
        numbers, bodies = numbers.join(hot, "h", "left_anti"), bodies.join(hot, "h", "left_anti")
    total = bodies.agg(F.coalesce(F.sum(F.octet_length("body")), F.lit(0))).first()[0]
    shards = max(1, -(-total // SHARD_BYTES))
    dealt = bodies.withColumn("n", F.lit(0).cast("long")).unionByName(numbers.withColumn("body", F.lit(None).cast("binary")))
    dealt = dealt.select(F.pmod(F.xxhash64("h"), F.lit(shards)).alias("shard"), "key", "body", "n")

    def sort(shard: pa.Table) -> pa.Table:
        with worker_task("suffixes"):
            return _sort_shard(shard, length)

    spans = dealt.groupBy("shard").applyInArrow(sort, "key binary, a int, b int")
    if hot is not None:
        spans = spans.unionByName(deeper).unionByName(copied)
    spans = cut_lineage(_by_row(spans, "key"), "spans")
    placed = found.select("rid", "key", "p0").distinct().join(spans, "key")
    own = F.transform("spans", lambda s: F.struct((F.col("p0") + s["a"]).alias("a"), (F.col("p0") + s["b"]).alias("b")))
    return placed.groupBy("rid").agg(F.flatten(F.collect_list(own)).alias("spans"))


def _row_id(columns: list[Column]) -> Column:
    return F.unhex(F.md5(F.concat_ws("\0", *columns)))


def _covered(size: int, spans: list | None, length: int) -> tuple[list[tuple[int, int]], int]:
    """What is left of ``size`` bytes once the strings that begin in the spans are taken away, and the removed runs."""
    left, at, runs = [], 0, 0
    for a, b in sorted((s["a"], s["b"] + length - 1) for s in spans or ()):
        if a > at or not runs:
            if a > at:
                left.append((at, a))
            runs += 1
        at = max(at, b)
    if at < size:
        left.append((at, size))
    return left, runs


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches in parts of some rows with whole texts, in a task that gives its memory back."""
    with worker_task("suffixes"):
        yield from parts(batches)


def _marked(docs: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """Rows with ``rid``, ``body`` and ``spans`` that have repeated strings, or may have, and the surely clean ones."""
    rows = docs.withColumn("body", F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"))
    rows = rows.withColumn("rid", _row_id([F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.coalesce(F.col("text").cast("string"), F.lit(""))]))
    spans = cut_lineage(repeated(rows.select("rid", "body"), length), "spans")
    rows = with_maybe(rows, "rid", spans.select("rid"))
    return rows.filter("maybe").drop("maybe").join(spans, "rid", "left"), rows.filter("not maybe").drop("maybe")


def byte_report(docs: DataFrame, length: int = 400) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and n_kept of every row, see :func:`remove_repeated`, byte by byte."""

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            out = []
            for key, body, spans in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "body", "spans"))):
                left, runs = _covered(len(body), spans, length)
                digest = hashlib.sha256()
                for a, b in left:
                    digest.update(body[a:b])
                n = sum(b - a for a, b in left)
                out.append((key, len(body), len(body) - n, runs, digest.hexdigest(), n))
            columns = list(zip(*out)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int64()) for c in columns[:4]), pa.array(columns[4], pa.string()), pa.array(columns[5], pa.int64())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_kept"])

    marked, clean = _marked(docs.select(F.col("doc_id").cast("long"), "text"), length)
    none = F.lit(0).cast("long")
    return marked.select("doc_id", "body", "spans").mapInArrow(
        report, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_kept long").unionByName(clean.select(
            "doc_id", F.octet_length("body").cast("long").alias("n_bytes"), none.alias("n_removed"), none.alias("n_spans"),
            F.sha2("body", 256).alias("kept_sha256"), F.octet_length("body").cast("long").alias("n_kept")))


def remove_repeated(docs: DataFrame, length: int = 400) -> DataFrame:
    """Rows of ``docs`` without the bytes of their texts that a string of ``length`` bytes covers which also starts
    anywhere else, in the same text too. Strings are judged on the input and never cross texts.

    A character goes if one of its bytes does. Null texts stay null, repeated rows repeat each other's strings; other
    columns are kept.
    """
    names = docs.columns

    def clean_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            texts = []
            for known, body, spans in zip(*(batch.column(c).to_pylist() for c in ("_known", "_body", "_spans"))):
                left, runs = _covered(len(body), spans, length)
                kept = b"".join(body[a:b] for a, b in left) if runs else body
                texts.append(kept.decode("utf-8", "ignore" if runs else "replace") if known else None)
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, pa.string()) if c == "text" else batch.column(f"_c{i}") for i, c in enumerate(names)], names=names)

    schema = docs.withColumn("text", F.col("text").cast("string")).select(*names).schema
    bare = docs.select(*[F.col(c).alias(f"_c{i}") for i, c in enumerate(names)], F.col("text").cast("string").alias("text"), F.col("doc_id"))
    marked, clean = _marked(bare, length)
    own = [f"_c{i}" for i, c in enumerate(names) if c != "text"]
    changed = marked.select(*own, F.col("text").isNotNull().alias("_known"), F.col("body").alias("_body"), F.col("spans").alias("_spans")).mapInArrow(clean_up, schema)
    return changed.unionByName(clean.select(*[F.col("text").alias(c) if c == "text" else F.col(f"_c{i}").alias(c) for i, c in enumerate(names)]))
