"""k-means inside every group at once, as alternating DataFrame steps."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketseries.operators.blocks import join_group_stats
from marketseries.session import cut_lineage


def _distance(a: Column, b: Column) -> Column:
    gaps = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.aggregate(gaps, F.lit(0.0), lambda acc, g: acc + g)


def _square(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda acc, v: acc + v * v)


def assign(points: DataFrame, centroids: DataFrame, by: Sequence[str], label: str = "cluster") -> DataFrame:
    """Nearest centroid of the row's own group; ties go to the lowest label."""
    d = F.transform("centroids", lambda c: _distance(c, F.col("x")))
    joined = join_group_stats(points, centroids, by).withColumn("_d", d)
    nearest = F.array_position("_d", F.array_min("_d")) - 1
    return joined.withColumn(label, nearest.cast("int")).drop("_d", "centroids")


def update(labelled: DataFrame, centroids: DataFrame, by: Sequence[str], k: int, dim: int) -> DataFrame:
    """Mean of each cluster, summed in two phases; an empty cluster keeps its centroid."""
    by = list(by)
    means = labelled.groupBy(*by, "cluster").agg(*[F.avg(F.get("x", F.lit(i))).alias(f"_{i}") for i in range(dim)])
    by_label = means.groupBy(*by).agg(
        # at most k rows meet here
        F.map_from_entries(F.collect_list(F.struct("cluster", F.array(*[f"_{i}" for i in range(dim)])))).alias("_new")
    )
    fresh = F.array(*[
        F.coalesce(F.try_element_at("_new", F.lit(j)), F.get("centroids", F.lit(j))) for j in range(k)
    ])
    return centroids.join(by_label, by, "left").select(*by, fresh.alias("centroids"), F.col("centroids").alias("_old"))


#: Rows whose distances to all centroids are held at once; up to so many values of a point are summed by Spark's expressions.
ROWS, FEW = 1024, 12


def moved(points: DataFrame, centroids: DataFrame, by: Sequence[str], k: int, dim: int) -> DataFrame:
    """:func:`update` of :func:`assign`, summed in numpy where the points are read: one row per batch, group and cluster
    leaves a task. Distances add up in the order of :func:`assign`."""
    by = list(by)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = batch.column("x")
            flat = lists.flatten()
            if lists.null_count or flat.null_count or len(flat) != dim * len(lists) or (np.diff(lists.offsets.to_numpy()) != dim).any():
                raise ValueError(f"points without {dim} values have no nearest centroid")
            x = flat.to_numpy(zero_copy_only=False).reshape(-1, dim)
            c = batch.column("centroids").flatten().flatten().to_numpy(zero_copy_only=False).reshape(-1, k, dim)
            label = np.empty(len(x), np.int64)
            for a in range(0, len(x), ROWS):
                d = np.zeros((len(x[a : a + ROWS]), k))
                for i in range(dim):
                    gap = x[a : a + ROWS, None, i] - c[a : a + ROWS, :, i]
                    d += gap * gap
                label[a : a + ROWS] = np.where(np.isnan(d), np.inf, d).argmin(axis=1)
            group = np.zeros(len(x), np.int64)
            for name in by:
                codes = batch.column(name).dictionary_encode()
                group = group * len(codes.dictionary) + codes.indices.to_numpy()
                group = np.unique(group, return_inverse=True)[1].reshape(-1)
            order = np.argsort(group * k + label, kind="stable")
            first = np.flatnonzero(np.diff((group * k + label)[order], prepend=-1))
            total = np.add.reduceat(x[order], first, axis=0)
            keys = pa.array(order[first])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name).take(keys) for name in by), pa.array(label[order[first]], pa.int32()),
                 pa.array(np.diff(np.append(first, len(x))), pa.int64()),
                 pa.ListArray.from_arrays(pa.array(np.arange(0, total.size + 1, dim), pa.int32()), pa.array(total.ravel()))],
                names=[*by, "cluster", "n", "sums"])

    joined = join_group_stats(points, centroids.select(*by, "centroids"), by).select(*by, "x", "centroids")
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in joined.select(*by).schema.fields]
    parts = joined.mapInArrow(sums, ", ".join([*fields, "cluster int", "n long", "sums array<double>"]))
    parts = parts.groupBy(*by).agg(F.collect_list(F.struct("cluster", "n", "sums")).alias("_parts"))

    def mean(j: int) -> Column:
        own = F.filter("_parts", lambda p: p["cluster"] == j)
        n = F.aggregate(own, F.lit(0).cast("long"), lambda acc, p: acc + p["n"])
        total = F.aggregate(own, F.array_repeat(F.lit(0.0), dim), lambda acc, p: F.zip_with(acc, p["sums"], lambda a, b: a + b))
        return F.when(n > 0, F.transform(total, lambda v: v / n)).otherwise(F.get("centroids", F.lit(j)))

    return centroids.join(parts, by, "left").select(*by, F.array(*[mean(j) for j in range(k)]).alias("centroids"), F.col("centroids").alias("_old"))


def hashed_start(points: DataFrame, by: Sequence[str], id_col: str, k: int, seed: str | None = None) -> DataFrame:
    """k rows per group in the order of a hash of their id, and of the column ``seed``: arbitrary, yet always the same."""
    from pyspark.sql import Window

    drawn = F.xxhash64(id_col) if seed is None else F.xxhash64(id_col, seed)
    order = Window.partitionBy(*by).orderBy(drawn, id_col)
    first = points.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= k)
    picked = first.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("_n", "x"))).alias("_s"))
    # a group with fewer rows than k repeats its rows; the repeats stay empty
    return picked.select(
        *by, F.array(*[F.get("_s", F.lit(j) % F.size("_s"))["x"] for j in range(k)]).alias("centroids")
    )


def fixed_start(points: DataFrame, by: Sequence[str], centroids: Sequence[Sequence[float]]) -> DataFrame:
    start = F.array(*[F.array(*[F.lit(float(v)) for v in c]) for c in centroids])
    return points.select(*by).distinct().withColumn("centroids", start)


def settled(vectors: DataFrame, state: DataFrame, by: Sequence[str], k: int, dim: int, max_iter: int | None, tolerance: float) -> DataFrame:
    """Centroids after alternating steps until none moves by more than ``tolerance`` of its length.

    Labels of equal distance go to the lowest one, so that a round that changes anything lowers the cost and rounds
    end. With ``max_iter``, more rounds than that are an error, not a result.
    """
    rounds = 0
    while True:
        step = update(assign(vectors, state, by), state, by, k, dim) if dim <= FEW else moved(vectors, state, by, k, dim)
        written = cut_lineage(step, "centroids")
        shifted = F.zip_with("centroids", "_old", lambda a, b: _distance(a, b) > tolerance**2 * _square(b))
        state = written.drop("_old")
        if written.where(F.exists(shifted, lambda m: m)).isEmpty():
            return state
        rounds += 1
        if max_iter is not None and rounds >= max_iter:
            raise RuntimeError(f"clusters still move after {rounds} rounds")


def kmeans_grouped(
    df: DataFrame,
    by: Sequence[str],
    features: Sequence[str],
    id_col: str,
    k: int = 4,
    start: Sequence[Sequence[float]] | None = None,
    max_iter: int | None = None,
    tolerance: float = 1e-11,
    restarts: int = 1,
) -> DataFrame:
    """``df`` with a ``cluster`` column.

    All groups, and all ``restarts`` from different random rows, iterate together; of each group the start of the
    least cost is kept, of equal ones the first. The points are written once, the centroids once per round. Only a
    yes/no answer per round reaches the driver. A given ``start`` is the only one.
    """
    by = list(by)
    vector = F.array(*[F.col(f).cast("double") for f in features]) if len(features) > 1 else F.col(features[0])
    points = df.withColumn("x", vector)
    if len(features) == 1 or len(features) > FEW:  # a file for each core, as every round reads the long vectors
        points = points.repartition(df.sparkSession.sparkContext.defaultParallelism)
    points = cut_lineage(points, "points")
    dim = points.select(F.size("x")).first()
    if dim is None:
        return points.withColumn("cluster", F.lit(None).cast("int")).drop("x")
    dim = dim[0]
    runs = F.explode(F.sequence(F.lit(0), F.lit(restarts - 1))).alias("_run")
    if start is None and restarts > 1:
        keys = [*by, "_run"]
        vectors = points.select(*by, "x", runs)
        state = cut_lineage(hashed_start(points.select(*by, id_col, "x", runs), keys, id_col, k, "_run"), "centroids")
        state = cut_lineage(settled(vectors, state, keys, k, dim, max_iter, tolerance), "centroids")
        least = cost(vectors, state, keys).groupBy(*by).agg(F.min_by("_run", F.struct("cost", "_run")).alias("_run"))
        state = state.join(least, keys).drop("_run")
    else:
        state = hashed_start(points, by, id_col, k) if start is None else fixed_start(points, by, start)
        state = settled(points.select(*by, "x"), cut_lineage(state, "centroids"), by, k, dim, max_iter, tolerance)
    out = assign(points, state, by)
    return out if features == ["x"] else out.drop("x")


def cost(points: DataFrame, centroids: DataFrame, by: Sequence[str]) -> DataFrame:
    """Sum of squared distances to the nearest centroid, per group."""
    nearest = F.array_min(F.transform("centroids", lambda c: _distance(c, F.col("x"))))
    return join_group_stats(points, centroids, by).groupBy(*by).agg(F.sum(nearest).alias("cost"))
