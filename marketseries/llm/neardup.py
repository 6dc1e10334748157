"""Near-duplicate documents by set sketches with exponentially spaced registers."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketseries.llm.batches import arrow_rows, worker_task
from marketseries.llm.bitmap import with_maybe
from marketseries.llm.components import components
from marketseries.llm.words import text_slices
from marketseries.session import cut_lineage

#: Registers of a sketch and registers of a band: at a similarity of 0.8 all 32 bands differ once in 20 million pairs.
REGISTERS, BAND = 128, 4
BANDS = REGISTERS // BAND
#: Base of the register spacing, rate of the exponentials and largest register (two bytes).
BASE, RATE, TOP = 1.001, 20.0, 65535
#: Pairs whose likeliest similarity lies so far under the threshold (five standard errors) are not compared.
MARGIN = 0.18
#: Documents and shingles of a block of a group that is compared in one task.
BLOCK_ROWS, BLOCK_SHINGLES = 1000, 1_000_000
#: Documents, and pairs of documents, of a batch that goes to a Python worker.
DOCUMENT_ROWS, PAIR_ROWS = 2000, 500

_rng = np.random.default_rng(20)
_BYTE = _rng.integers(0, 1 << 64, 256, np.uint64)
_MULTIPLY = _rng.integers(0, 1 << 63, REGISTERS, np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 1 << 64, REGISTERS, np.uint64)
_SPACE = bytes.maketrans(b"\t\n\v\f\rABCDEFGHIJKLMNOPQRSTUVWXYZ", b"     abcdefghijklmnopqrstuvwxyz")
_P = np.uint64(0x9E3779B97F4A7C15)
_P_INVERSE = np.uint64(pow(int(_P), -1, 1 << 64))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def shingle_sets(texts: list[str | None], words: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's word shingles.

    A-Z are lower-cased; words are runs of other bytes than space and 0x09-0x0D. A text of fewer words has its
    whole sequence as one shingle; no words or null: empty.
    """
    raw = [(t or "").encode("utf-8", "surrogatepass").translate(_SPACE) for t in texts]
    data = np.frombuffer(b" ".join([b"", *raw, b""]), np.uint8)
    first = np.cumsum([1, *(len(x) + 1 for x in raw)])  # where each text begins, and the end
    word = np.concatenate([[False], data != 32, [False]])
    begin, end = np.flatnonzero(word[1:] & ~word[:-1]), np.flatnonzero(word[:-1] & ~word[1:])
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * _powers(_P, len(data)), dtype=np.uint64)])
    back = _powers(_P_INVERSE, len(data) + 1)
    own = _mixed((sums[end] - sums[begin]) * back[begin] + (end - begin).astype(np.uint64))
    at = np.searchsorted(begin, first)  # words before each text
    joint = np.zeros(max(0, len(own) - words + 1), np.uint64)
    for k in range(words):
        joint = joint * _P + own[k : k + len(joint)] if len(joint) else joint
    joint = _mixed(joint + np.uint64(words))
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        if b - a >= words:
            out.append(np.unique(joint[a : b - words + 1]))
        elif b > a:
            one = np.zeros(1, np.uint64)
            for k in range(a, b):
                one = one * _P + own[k]
            out.append(_mixed(one + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """Sketches of non-empty sets: least exponential hash of each register, on a logarithmic scale, cut to two bytes.

    Sketches merge by the larger register.
    """
    flat = np.concatenate(sets)
    begin = np.cumsum([0, *map(len, sets[:-1])])
    least = np.empty((len(sets), REGISTERS), np.uint64)
    for i in range(REGISTERS):
        least[:, i] = np.minimum.reduceat(flat * _MULTIPLY[i] + _ADD[i], begin)
    exponential = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**64 * (1 - 1e-16)) / RATE
    return np.clip(np.floor(1 - np.log(exponential) / np.log(BASE)), 0, TOP).astype(">u2")


def likeliest_similarity(left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray) -> np.ndarray:
    """Jaccard similarity that makes the numbers of larger, smaller and equal registers likeliest, sizes being known."""
    more, less = (left > right).sum(1), (left < right).sum(1)
    same = left.shape[1] - more - less
    u = n_left / (n_left + n_right)
    v = 1 - u

    def p(x):
        return np.maximum(-np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE), 1e-12)

    def score(j):
        a, b = p(u - v * j), p(v - u * j)
        return more * np.log(a) + less * np.log(b) + same * np.log(np.maximum(1 - a - b, 1e-12))

    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(40):  # the likelihood has one peak
        x, y = low + (high - low) * 0.382, low + (high - low) * 0.618
        left_is_better = score(x) >= score(y)
        low, high = np.where(left_is_better, low, x), np.where(left_is_better, y, high)
    return (low + high) / 2


def sketches(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n_shingles, set_key (equal for equal sets; null for empty ones) and sketch of every row."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with worker_task("sets"):
            yield from made(batches)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in text_slices([t or "" for t in texts], 500_000):
                sets = shingle_sets(texts[a:b], words)
                full = [i for i, s in enumerate(sets) if len(s)]
                marks: list[bytes | None] = [None] * len(sets)
                sketch: list[bytes | None] = [None] * len(sets)
                if full:
                    for i, r in zip(full, registers([sets[i] for i in full])):
                        marks[i] = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest()
                        sketch[i] = r.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[a:b], pa.int64()), pa.array(map(len, sets), pa.int64()),
                     pa.array(marks, pa.binary()), pa.array(sketch, pa.binary())],
                    names=["doc_id", "n_shingles", "set_key", "sketch"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        make, "doc_id long, n_shingles long, set_key binary, sketch binary")


def _likely(pairs: DataFrame, own: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) whose sizes and sketches allow the similarity."""

    def estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), ">u2").reshape(-1, REGISTERS) for c in ("sa", "sb"))
                n, m = (batch.column(c).to_numpy().astype(float) for c in ("na", "nb"))
                yield batch.select(["a", "b"]).filter(pa.array(likeliest_similarity(x, y, n, m) >= least - MARGIN))

    side = lambda k: own.select(
        F.col("doc_id").alias(k), F.col("n_shingles").alias(f"n{k}"), F.col("sketch").alias(f"s{k}"))
    sized = (F.col("na") >= least * F.col("nb")) & (F.col("nb") >= least * F.col("na"))
    return pairs.join(side("a"), "a").join(side("b"), "b").filter(sized).mapInArrow(estimate, "a long, b long")


def _texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, text) of the rows of ``docs`` whose doc_id is in ``ids``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return with_maybe(rows, "doc_id", ids).filter("maybe").drop("maybe").join(ids, "doc_id")


def _confirmed(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Those of some written pairs (a, b) whose full shingle sets reach ``percent``."""
    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select(F.col("b").alias("doc_id"))).distinct()
    texts = cut_lineage(_texts_of(docs, ids), "texts")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}
        for batch in batches:
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            for lo in range(0, len(a), 500):
                part = range(lo, min(lo + 500, len(a)))
                new: dict[int, str] = {}
                for ids_, name in ((a, "ta"), (b, "tb")):
                    column = batch.column(name)
                    new |= {ids_[i]: column[i].as_py() for i in part if ids_[i] not in known and ids_[i] not in new}
                if len(known) > 2000:
                    known = {}
                    new |= {a[i]: batch.column("ta")[i].as_py() for i in part} | {b[i]: batch.column("tb")[i].as_py() for i in part}
                known |= zip(new, shingle_sets(list(new.values()), words))
                hit = []
                for i in part:
                    x, y = known[a[i]], known[b[i]]
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    hit.append(100 * common >= percent * (len(x) + len(y) - common))
                yield batch.select(["a", "b"]).slice(lo, len(hit)).filter(pa.array(hit))

    side = lambda k: texts.select(F.col("doc_id").alias(k), F.col("text").alias(f"t{k}"))
    return pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "ta", "tb").mapInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs``.

    Documents are linked where ``100 * |A & B| >= percent * |A | B|`` over their sets of word shingles (see
    :func:`shingle_sets`); a component is named by its least doc_id, the one that is kept. Documents with an empty
    set (null text, no words) are linked with nothing. Rows of one doc_id are linked with each other, whatever their texts;
    rows without doc_id are left out, as nothing could name them. Other columns are not read.

    Documents with equal sets are one node. Bands of equal registers propose links: first of every document with
    the least and the greatest document of its band, which joins groups of copies in a number of comparisons in
    proportion to their size; then of the documents of a band that still lie in different components, which are
    compared in blocks and never listed pair by pair. Every link is confirmed on the full sets.
    """
    docs = docs.filter("doc_id is not null")
    spark = docs.sparkSession
    with arrow_rows(spark, DOCUMENT_ROWS):
        own = cut_lineage(sketches(docs, words), "sketches")
    classes = own.filter("set_key is not null").groupBy("set_key").agg(F.min("doc_id").alias("rep"))
    classes = cut_lineage(classes, "classes")
    nodes = own.join(classes.select("set_key", F.col("rep").alias("doc_id")), ["set_key", "doc_id"])
    nodes = cut_lineage(nodes.select("doc_id", "n_shingles", "sketch").distinct(), "nodes")

    width = 2 * BAND
    rows = nodes.select(F.col("doc_id").alias("id"), F.expr(
        f"explode(transform(sequence(0, {BANDS - 1}), i -> xxhash64(i, substring(sketch, i * {width} + 1, {width}))))"
    ).alias("band"))
    ends = rows.groupBy("band").agg(F.count("*").alias("n"), F.min("id").alias("lo"), F.max("id").alias("hi"))
    rows = cut_lineage(rows.join(ends.filter("n > 1"), "band"), "bands")
    pairs = rows.filter("id > lo").select(F.col("lo").alias("a"), F.col("id").alias("b")).unionByName(
        rows.filter("id < hi and id > lo").select(F.col("id").alias("a"), F.col("hi").alias("b"))).distinct()
    least = percent / 100
    likely = cut_lineage(_likely(pairs, nodes, least), "pairs")
    with arrow_rows(spark, PAIR_ROWS):
        links = cut_lineage(_confirmed(likely, docs, words, percent), "links")
    several = own.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").select("doc_id")
    several = cut_lineage(several, "repeated")  # ids of several rows
    repeated = not several.isEmpty()
    if repeated:
        sets = own.join(several, "doc_id").join(classes, "set_key").select("doc_id", "rep").distinct()
        links = links.unionByName(sets.select(F.col("rep").alias("a"), F.col("doc_id").alias("b")))
    roots = components(links)

    with arrow_rows(spark, DOCUMENT_ROWS):
        more = cut_lineage(_across(rows, roots, nodes, docs, words, percent), "links")
    if not more.isEmpty():
        roots = components(links.unionByName(more))

    out = own.join(classes, "set_key", "left").join(roots, F.col("rep") == F.col("id"), "left")
    root = F.coalesce("root", "rep", "doc_id")
    if repeated:  # a row with an empty set has no class, but may share its doc_id with one that has
        least = out.join(several, "doc_id").groupBy("doc_id").agg(F.min(root).alias("_least"))
        out, root = out.join(least, "doc_id", "left"), F.coalesce("_least", root)
    return out.select("doc_id", "n_shingles", root.alias("component_id"), (F.col("doc_id") == root).alias("kept"))


def _across(rows: DataFrame, roots: DataFrame, nodes: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (a, b) between documents of one band that lie in different components so far.

    Bands with one least document are one group, so that copies which share many bands meet once or a few times.
    Groups are dealt out as pairs of blocks of bounded size; the full sets are compared in the task and only links
    leave it. Bands of up to three documents were compared whole with their least and greatest.
    """
    placed = rows.filter("n > 3").select("id", "band", "lo").join(roots, "id", "left")
    placed = placed.select("id", "band", "lo", F.coalesce("root", "id").alias("root"))
    ends = placed.groupBy("band").agg(F.min("root").alias("r1"), F.max("root").alias("r2"))
    mixed = placed.join(ends.filter("r1 < r2"), "band").select("lo", "id", "root").distinct()
    mixed = cut_lineage(mixed.join(nodes.select(F.col("doc_id").alias("id"), "n_shingles"), "id"), "mixed")
    sizes = mixed.groupBy("lo").agg(F.ceil(F.greatest(
        F.count("*") / BLOCK_ROWS, F.sum("n_shingles") / BLOCK_SHINGLES)).cast("int").alias("parts"))
    own = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    every = F.sequence(F.lit(0), F.col("parts") - 1)
    dealt = mixed.join(sizes, "lo").withColumn("part", own).withColumn("other", F.explode(every)).select(
        "lo", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "id", "root")
    texts = cut_lineage(_texts_of(docs, mixed.select(F.col("id").alias("doc_id")).distinct()), "texts")
    texts = texts.withColumnRenamed("doc_id", "id")

    def compare(group: pa.Table) -> pa.Table:
        ids, roots, parts = (group.column(c).to_numpy() for c in ("id", "root", "part"))
        a, b = _links_between(ids, roots, parts, shingle_sets(group.column("text").to_pylist(), words), percent)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return dealt.join(texts, "id").groupBy("lo", "i", "j").applyInArrow(compare, "a long, b long").distinct()


def _links_between(ids, roots, parts, sets, percent) -> tuple[np.ndarray, np.ndarray]:
    """Links between rows of different roots, and of different parts if there are two, by counts over shared shingles."""
    size = np.array([len(x) for x in sets])
    flat = np.concatenate(sets)
    _, shingle, count = np.unique(flat, return_inverse=True, return_counts=True)
    holder = np.repeat(np.arange(len(sets)), size)
    order = np.argsort(shingle, kind="stable")
    holder, end = holder[order], np.cumsum(count)
    at = np.cumsum([0, *size])
    names, inverse, many = np.unique(roots, return_inverse=True, return_counts=True)
    asking = np.flatnonzero(inverse != many.argmax())  # rows of the largest component are met by all others
    if len(names) < 2:
        asking = asking[:0]
    two = parts.min() < parts.max()
    found: list[tuple[int, int]] = []
    for u in asking.tolist():
        mine = shingle[at[u] : at[u + 1]]
        mine = mine[count[mine] > 1]
        n = count[mine]
        start = np.repeat(end[mine] - n - (np.cumsum(n) - n), n)
        common = np.bincount(holder[start + np.arange(len(start))], minlength=len(sets))
        hit = (100 * common >= percent * (size[u] + size - common)) & (roots != roots[u])
        if two:
            hit &= parts != parts[u]
        found += [(ids[u], ids[v]) for v in np.flatnonzero(hit)]
    pairs = np.array(found, np.int64).reshape(-1, 2)
    return pairs.min(1), pairs.max(1)
