"""Approximate nearest neighbours over balanced posting lists whose centroids a small graph finds."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketseries.session import cut_lineage

#: Rows that the lists are fitted on, vectors of the sample that a list stands for, and the most lists.
SAMPLE, PER_LIST, MOST_LISTS = 20_000, 120, 2048
#: Neighbours of a centroid in the graph, and how many centroids a search holds.
DEGREE, BEAM = 24, 128
#: A vector is also put on lists up to so many times as far as its nearest (up to so many in all); a query reads
#: the lists up to so many times as far as its nearest.
REPLICA_RATIO, REPLICAS, PROBE_RATIO = 1.06, 4, 1.25
#: Lists that every query reads, whatever their distance.
PROBES = 8
#: Rows of a list, and queries to it, that one task compares at once.
MEMBER_BLOCK, QUERY_BLOCK = 8000, 4000


@dataclass
class Index:
    """Unit centroids, their graph, and where searches begin."""

    centroids: np.ndarray
    graph: np.ndarray
    entries: np.ndarray

    def search(self, vectors: np.ndarray, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
        """Nearest centroids of unit vectors, best first, with their distances; -1 where fewer were met.

        Best-first search of all vectors in step: each round opens every vector's nearest centroid not yet opened.
        """
        n, k = len(vectors), len(self.centroids)
        beam = min(beam, k)
        row = np.arange(n)[:, None]
        met = np.zeros((n, k), bool)
        ids = np.tile(self.entries, (n, 1))
        near = np.einsum("nd,ed->ne", vectors, self.centroids[self.entries])
        met[row, ids] = True
        opened = np.zeros(ids.shape, bool)
        while True:
            open_score = np.where(opened | (ids < 0), -np.inf, near)
            best = open_score.argmax(1)
            live = np.flatnonzero(open_score[np.arange(n), best] > -np.inf)
            if not len(live):
                order = np.argsort(-near, axis=1, kind="stable")
                return ids[row, order], np.sqrt(np.maximum(0, 2 - 2 * near[row, order]))
            opened[live, best[live]] = True
            fresh = self.graph[ids[live, best[live]]]
            new = ~met[live[:, None], fresh]
            met[live[:, None], fresh] = True
            score = np.full((n, fresh.shape[1]), -np.inf)
            score[live] = np.where(new, np.einsum("nd,ngd->ng", vectors[live], self.centroids[fresh]), -np.inf)
            other = np.full((n, fresh.shape[1]), -1)
            other[live] = np.where(new, fresh, -1)
            ids, near = np.concatenate([ids, other], 1), np.concatenate([near, score], 1)
            opened = np.concatenate([opened, other < 0], 1)
            if ids.shape[1] > beam:
                keep = np.argpartition(-near, beam - 1, axis=1)[:, :beam]
                ids, near, opened = ids[row, keep], near[row, keep], opened[row, keep]


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def balanced_centroids(sample: np.ndarray, lists: int, seed: int = 7) -> np.ndarray:
    """Means of equal parts of the sample: halved again and again between two means, at the middle of the difference."""
    rng = np.random.default_rng(seed)
    parts, out = [(np.arange(len(sample)), lists)], []
    while parts:
        rows, want = parts.pop()
        if want <= 1 or len(rows) < 2:
            out.append(sample[rows].mean(0))
            continue
        a, b = sample[rng.choice(rows, 2, replace=False)]
        share = want // 2 * len(rows) // want
        for _ in range(8):
            order = np.argsort(sample[rows] @ (b - a), kind="stable")
            a, b = sample[rows[order[:share]]].mean(0), sample[rows[order[share:]]].mean(0)
        parts += [(rows[order[:share]], want // 2), (rows[order[share:]], want - want // 2)]
    return unit(np.array(out) + 1e-12)


def fit(sample: np.ndarray, lists: int) -> Index:
    centroids = balanced_centroids(unit(sample), lists)
    k = len(centroids)
    near = np.argsort(-(centroids @ centroids.T), axis=1, kind="stable")[:, 1 : DEGREE + 1]
    far = np.random.default_rng(8).integers(0, k, (k, 4))  # long links, so that no part of the graph is cut off
    graph = np.concatenate([near, far, (np.arange(k)[:, None] + 1) % k], 1)
    return Index(centroids, graph, np.unique(np.linspace(0, k - 1, min(k, 16)).astype(int)))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _on_lists(rows: DataFrame, index: Index, ratio: float, least: int, most: int | None, beam: int, schema: str) -> DataFrame:
    """One row for each list that a row belongs to; the last column of ``rows`` is the vector."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2000):
                batch = whole.slice(at, 2000)
                ids, far = index.search(unit(_matrix(batch.column(batch.num_columns - 1))), beam)
                take = far <= ratio * far[:, :1] + 1e-9
                take[:, :least] = True
                take &= ids >= 0
                if most:
                    take[:, most:] = False
                row, col = np.nonzero(take)
                out = batch.take(pa.array(row))
                yield pa.RecordBatch.from_arrays([pa.array(ids[row, col], pa.int32()), *out.columns], names=["list", *batch.schema.names])

    return rows.mapInArrow(place, "list int, " + schema)


def _best(k: int):
    """Scores the queries of a list against its vectors and keeps the k best (vec_id, score) of each query."""

    def score(members: pa.Table, queries: pa.Table) -> pa.Table:
        v, q = _matrix(members.column("vector")), _matrix(queries.column("vector"))
        own, asked = members.column("ids").to_pylist(), queries.column("query_id").to_pylist()
        v_size, q_size = (np.sqrt((x * x).sum(1)) for x in (v, q))
        unit_v = v / v_size[:, None]
        out: list[tuple[int, int, float]] = []
        for at in range(0, len(q), 256):
            rough = (q[at : at + 256] / q_size[at : at + 256, None]) @ unit_v.T
            want = min(k + 1, len(v))
            limit = -np.partition(-rough, want - 1, axis=1)[:, want - 1]
            for i, j in enumerate(range(at, min(at + 256, len(q)))):
                hit = np.flatnonzero(rough[i] >= limit[i] - 1e-12)
                exact = (v[hit] * q[j]).sum(1) / (v_size[hit] * q_size[j])
                found = sorted((-s, m) for s, h in zip(exact.tolist(), hit) for m in own[h] if m != asked[j])[:k]
                out += [(asked[j], m, -s) for s, m in found]
        columns = list(zip(*out)) or [(), (), ()]
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64()))], names=["query_id", "vec_id", "score"])

    return score


def valid_vectors(table: DataFrame, key: str, vector: str) -> DataFrame:
    """(vec_id, vector of doubles) of the rows that take part: no nulls, all components finite, not all zero."""
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists(v, lambda x: x != 0)
    return table.filter(F.col(key).isNotNull() & v.isNotNull()).filter(finite & some).select(
        F.col(key).cast("long").alias("vec_id"), v.alias("vector"))


def nearest(
    table: DataFrame, queries: str, k: int = 5, key: str = "vec_id", vector: str = "embedding",
    sample: int = SAMPLE, per_list: int = PER_LIST,
) -> DataFrame:
    """query_id, rank, vec_id and score (cosine) of the ``k`` nearest rows found for each row where ``queries`` holds.

    ``queries`` is a SQL condition on ``vec_id``. Vectors that are null, zero or hold null or non-finite components
    take no part, nor do those of another length than most; a row is not its own neighbour, ties go to the smaller
    vec_id. Lists are fitted on the ``sample`` rows with the least key hashes; every row is put on lists. Equal
    vectors are one entry with the ``k + 1`` least keys, which loses no neighbour. The rows and queries of a list are
    split into blocks, so that a list of a third of all rows is spread. Rows that repeat a key count once.
    """
    valid = valid_vectors(table, key, vector)
    sizes = valid.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    spark = table.sparkSession
    if sizes is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    valid = valid.filter(F.size("vector") == sizes["d"])
    first = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    entries = valid.distinct().withColumn("_n", first).filter(F.col("_n") <= k + 1).groupBy("vector").agg(
        F.sort_array(F.collect_list("vec_id")).alias("ids"))  # k + 1 keys at most
    entries = cut_lineage(entries.select("ids", "vector"), "entries")
    total = entries.count()
    # hashes are even, so a little more than the sample lies under this bound and little else is sent to be ordered
    mark, bound = F.xxhash64(F.col("ids")[0]), int((1.2 * sample / max(total, 1.2 * sample) - 0.5) * 2**64)
    rows = entries.filter(mark <= min(bound, 2**63 - 1)).orderBy(mark, F.col("ids")[0]).select("vector").limit(sample).toArrow()
    index = fit(_matrix(rows.column(0)), int(min(MOST_LISTS, max(1, total // per_list), max(1, len(rows) // 4))))

    kind = "vector array<double>"
    members = cut_lineage(_on_lists(entries, index, REPLICA_RATIO, 1, REPLICAS, BEAM // 4, "ids array<long>, " + kind), "members")
    asked = valid.filter(queries).select(F.col("vec_id").alias("query_id"), "vector").distinct()
    asked = cut_lineage(_on_lists(asked, index, PROBE_RATIO, PROBES, None, BEAM, "query_id long, " + kind), "asked")
    block = lambda rows, size, name: rows.groupBy("list").agg(F.ceil(F.count("*") / size).cast("int").alias(name))
    blocks = block(members, MEMBER_BLOCK, "_m").join(block(asked, QUERY_BLOCK, "_q"), "list")
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    one = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
    members = members.join(blocks, "list").select("list", one(F.col("ids")[0], "_m").alias("m"), spread("_q").alias("q"), "ids", "vector")
    asked = asked.join(blocks, "list").select("list", spread("_m").alias("m"), one("query_id", "_q").alias("q"), "query_id", "vector")
    found = members.groupBy("list", "m", "q").cogroup(asked.groupBy("list", "m", "q")).applyInArrow(
        lambda m, a: _best(k)(m, a), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
