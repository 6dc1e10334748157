"""Tree ensembles of Spark ML taken apart: one fit scores every shorter, shallower or more cautious ensemble in it.

Trees grow from the root down, so the first trees of an ensemble are a smaller ensemble, and a tree cut at a depth, or
at nodes with few rows, is the tree that a learner with that limit would have grown from the same draws. The nodes of
an ensemble are bounded by its parameters and sent to the tasks; rows never leave theirs but as sums.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from itertools import product
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from marketseries.operators.boosting import BINS, boosted_errors
from marketseries.session import scratch_path

#: Rows whose ways through all trees are followed at once.
ROWS = 512
#: Rows of folds that one task of a fit reads, and partitions that are not too many for any number of rows.
TASK_ROWS, FEW_PARTS = 20_000, 8
#: Rounds up to which a boosted fit is left to Spark's learner whatever its rows, and numbers (features of a fold, bins of the
#: nodes of a level) up to which a longer one is grown inside one task.
FEW_ROUNDS, FIT_VALUES = 100, 4_000_000


@dataclass
class Nodes:
    """Nodes of all trees one after another; ``left`` is -1 at a leaf."""

    start: np.ndarray
    weight: np.ndarray
    left: np.ndarray
    right: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    count: np.ndarray

    def cut(self, min_split: int) -> "Nodes":
        """Nodes that fewer rows reached than ``min_split`` become leaves."""
        return Nodes(**{**self.__dict__, "left": np.where(self.count < min_split, -1, self.left)})

    def values(self, x: np.ndarray, depths: Sequence[int]) -> Iterator[tuple[int, np.ndarray]]:
        """For each depth, the value of every tree (columns) for every row, if trees ended there."""
        at = np.broadcast_to(self.start, (len(x), len(self.start))).copy()
        row = np.arange(len(x))[:, None]
        for depth in range(max(depths) + 1):
            if depth in depths:
                yield depth, self.value[at]
            inner = self.left[at] >= 0
            below = x[row, np.maximum(self.feature[at], 0)] <= self.threshold[at]
            at = np.where(inner, self.start[None, :] + np.where(below, self.left[at], self.right[at]), at)


def tree_nodes(spark: SparkSession, model) -> Nodes:
    """The nodes of a fitted ensemble of regression trees over numeric columns, as its saved form lists them."""
    path = scratch_path(spark, "trees")
    model.write().save(path)
    n = spark.read.parquet(f"{path}/data").select(
        "treeID", F.col("nodeData.id").alias("id"), "nodeData.leftChild", "nodeData.rightChild", "nodeData.split.featureIndex",
        F.get("nodeData.split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"), "nodeData.prediction", "nodeData.rawCount",
    ).toPandas().sort_values(["treeID", "id"])
    size = n.groupby("treeID").size().to_numpy()
    return Nodes(
        np.cumsum(size) - size, np.array(model.treeWeights), n["leftChild"].to_numpy(), n["rightChild"].to_numpy(),
        n["featureIndex"].to_numpy(), n["threshold"].fillna(0.0).to_numpy(), n["prediction"].to_numpy(), n["rawCount"].to_numpy(),
    )


def _vectors(df: DataFrame, label: str, features: str = "features") -> DataFrame:
    return df.select(F.col(label).cast("double").alias("y"), vector_to_array(features).alias("x"))


def _batches(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for batch in batches:
        for a in range(0, batch.num_rows, ROWS):
            part = batch.slice(a, ROWS)
            lists = part.column("x")
            yield part.column("y").to_numpy(), lists.flatten().to_numpy().reshape(part.num_rows, -1)


def prefix_losses(model, df: DataFrame, label: str = "y") -> DataFrame:
    """Mean squared error after each round of a boosted model, all rounds in one pass: round (from 1), mse."""
    nodes, depth = tree_nodes(df.sparkSession, model), model.getMaxDepth()

    def losses(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(len(nodes.start)), 0
        for y, x in _batches(batches):
            _, values = next(nodes.values(x, [depth]))
            total += ((np.cumsum(values * nodes.weight, axis=1) - y[:, None]) ** 2).sum(axis=0)
            n += len(y)
        rounds = np.arange(1, len(total) + 1, dtype=np.int32)
        yield pa.RecordBatch.from_pydict({"round": rounds, "sse": total, "n": np.full(len(total), n)})

    sums = _vectors(df, label).mapInArrow(losses, "round int, sse double, n long")
    return sums.groupBy("round").agg((F.sum("sse") / F.sum("n")).alias("mse"))


def first_rounds(spark: SparkSession, model: GBTRegressionModel, rounds: int) -> GBTRegressionModel:
    """The boosted model as it was after ``rounds`` rounds."""
    gateway = spark.sparkContext._gateway
    kinds = gateway.jvm.org.apache.spark.ml.regression
    trees = gateway.new_array(kinds.DecisionTreeRegressionModel, rounds)
    weights = gateway.new_array(gateway.jvm.double, rounds)
    whole = model._java_obj.trees()
    for i, w in enumerate(model.treeWeights[:rounds]):
        trees[i], weights[i] = whole[i], float(w)
    short = kinds.GBTRegressionModel(f"{model.uid}_{rounds}", trees, weights, model.numFeatures)
    return model._copyValues(GBTRegressionModel(model._java_obj.copyValues(short, model._java_obj.extractParamMap())))


def boosted_checkpoint(train: DataFrame, validation: DataFrame, learner: GBTRegressor, path: str | None = None):
    """Fits all rounds, keeps the ensemble of the round with the least validation error, saves it and loads it back.

    Returns the loaded model and the curve: round, mse, best (the first round with the least error).
    """
    model = learner.fit(train)
    curve = sorted(prefix_losses(model, validation, learner.getLabelCol()).collect())  # one row for each round
    if not curve:
        raise ValueError("no validation rows: no round can be chosen")
    best = min(curve, key=lambda r: (r["mse"], r["round"]))["round"]
    path = path or scratch_path(train.sparkSession, "model")
    PipelineModel(stages=[first_rounds(train.sparkSession, model, best)]).write().overwrite().save(path)
    table = [(r["round"], r["mse"], r["round"] == best) for r in curve]
    return PipelineModel.load(path), train.sparkSession.createDataFrame(table, "round int, mse double, best boolean")


@dataclass(frozen=True)
class ForestGrid:
    """Values tried for a forest; all combinations count."""

    trees: Sequence[int] = (500, 1000)
    depths: Sequence[int] = (3, 6, 9)
    features: Sequence[int] = (2, 3, 4)
    leaves: Sequence[int] = (1, 3, 5)
    splits: Sequence[int] = (2, 4)


def _dealt(folds: DataFrame) -> DataFrame:
    """``folds`` kept for many fits, in no more partitions than their rows need, whatever the session's number is.

    A fit is dozens of short jobs with a task for each partition, so partitions of a few rows cost more than the trees.
    A bootstrap follows the rows of a partition in their order: a frame of few partitions stays as it is, another is
    dealt by position and sorted.
    """
    kept = folds.persist(StorageLevel.MEMORY_AND_DISK)
    parts = max(1, -(-kept.count() // TASK_ROWS))
    if kept.rdd.getNumPartitions() <= max(parts, FEW_PARTS):
        return kept
    dealt = kept.repartition(parts, "pos").sortWithinPartitions("pos", "fold").persist(StorageLevel.MEMORY_AND_DISK)
    dealt.count()
    kept.unpersist()
    return dealt


def _forest(label: str, trees: int, depth: int, features: int, leaf: int, seed: int) -> RandomForestRegressor:
    return RandomForestRegressor(
        labelCol=label, numTrees=trees, maxDepth=depth, featureSubsetStrategy=str(features), minInstancesPerNode=leaf,
        seed=seed, maxMemoryInMB=1024,
    )


def _variant_sums(df: DataFrame, label: str, nodes: Nodes, grid: ForestGrid) -> DataFrame:
    """Sums for R² of all cuts of one forest: trees, depth, split, n, sy, syy, sse."""
    cuts = [(s, nodes.cut(s)) for s in grid.splits]

    def sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int, int], np.ndarray] = {}
        for y, x in _batches(batches):
            for split, cut in cuts:
                for depth, values in cut.values(x, grid.depths):
                    run = np.cumsum(values, axis=1)
                    for k in grid.trees:
                        gap = y - run[:, k - 1] / k
                        own = np.array([len(y), y.sum(), (y * y).sum(), (gap * gap).sum()])
                        total[k, depth, split] = total.get((k, depth, split), 0) + own
        rows = [(*key, *v) for key, v in total.items()]
        yield pa.RecordBatch.from_pandas(pd.DataFrame(rows, columns=["trees", "depth", "split", "n", "sy", "syy", "sse"]).astype(
            {"trees": "int32", "depth": "int32", "split": "int32", "n": float, "sy": float, "syy": float, "sse": float}), preserve_index=False)

    parts = _vectors(df, label).mapInArrow(sums, "trees int, depth int, split int, n double, sy double, syy double, sse double")
    return parts.groupBy("trees", "depth", "split").agg(*[F.sum(c).alias(c) for c in ("n", "sy", "syy", "sse")])


def forest_grid(folds: DataFrame, grid: ForestGrid = ForestGrid(), label: str = "y", seed: int = 0, parallelism: int = 8):
    """Mean R² over the folds for every combination of a forest's parameters, and the best one.

    One forest is fitted for each fold, number of features and least rows of a leaf: the largest number of trees at
    the greatest depth. Its first trees, its trees cut at each depth, and cut at nodes of fewer rows than a split needs,
    are all the other combinations, so that 108 of them take 9 fits a fold. Rows of a node count with the repeats of
    the bootstrap. ``folds`` comes from ``forward_folds`` with a ``features`` column; fits run side by side.
    """
    spark = folds.sparkSession
    kept = _dealt(folds)
    numbers = [r[0] for r in kept.select("fold").distinct().orderBy("fold").collect()]

    def score(task: tuple[int, int, int]) -> list[tuple]:
        fold, features, leaf = task
        part = kept.where(F.col("fold") == fold)
        model = _forest(label, max(grid.trees), max(grid.depths), features, leaf, seed).fit(part.where(F.col("role") == "train"))
        found = _variant_sums(part.where(F.col("role") == "test"), label, tree_nodes(spark, model), grid).collect()
        return [((r["trees"], r["depth"], features, leaf, r["split"]), fold,
                 None if r["syy"] * r["n"] <= r["sy"] ** 2 else 1 - r["sse"] / (r["syy"] - r["sy"] ** 2 / r["n"])) for r in found]

    # the longest fits first: small leaves, late folds
    tasks = sorted(product(numbers, grid.features, grid.leaves), key=lambda t: (t[2], -t[0]))
    with ThreadPool(parallelism) as pool:
        scores = {(combo, fold): r2 for found in pool.imap_unordered(score, tasks) for combo, fold, r2 in found}
    kept.unpersist()
    combos = list(product(grid.trees, grid.depths, grid.features, grid.leaves, grid.splits))
    return _grid_table(spark, ("trees int", "depth int", "features int", "leaf int", "split int"), combos, numbers, scores)


def _grid_table(spark: SparkSession, names: Sequence[str], combos: list[tuple], folds: list[int], scores: dict) -> tuple[DataFrame, dict]:
    """All scores with their means, and the combination with the best mean.

    A fold without variance has no score; a combination with one counts as the worst.
    """
    means = {}
    for c in combos:
        own = [scores[c, f] for f in folds]
        means[c] = None if None in own else float(np.mean(own))
    best = max(combos, key=lambda c: -np.inf if means[c] is None else means[c])
    table = [(i, *c, f, scores[c, f], means[c], c == best) for i, c in enumerate(combos) for f in folds]
    out = spark.createDataFrame(table, f"combo int, {', '.join(names)}, fold int, r2 double, mean_r2 double, best boolean")
    return out, {n.split()[0]: v for n, v in zip(names, best)}


@dataclass(frozen=True)
class BoostedGrid:
    """Values tried for boosted trees; all combinations count. ``columns`` is the share of columns a node may split on."""

    rounds: Sequence[int] = (800, 1000)
    depths: Sequence[int] = (4, 8)
    rates: Sequence[float] = (0.01, 0.05, 0.1)
    columns: Sequence[float] = (0.7, 1.0)


def _spots(spark: SparkSession, n: int) -> list[int]:
    """``n`` keys that a shuffle into n partitions sends to one each, in the order of the partitions."""
    found = spark.range(32 * n).groupBy(F.pmod(F.hash("id"), F.lit(n)).alias("part")).agg(F.min("id").alias("id")).orderBy("part").collect()
    ids = [r["id"] for r in found]
    return [*ids, *range(32 * n, 33 * n - len(ids))]


def _grown_errors(kept: DataFrame, tasks: list[tuple[int, int, float, float]], rounds: Sequence[int], label: str, seed: int) -> DataFrame:
    """Errors of boosted trees, each fit in a task of its own: task (its place in ``tasks``), round, mse."""
    spots = _spots(kept.sparkSession, len(tasks))
    place = {spot: i for i, spot in enumerate(spots)}
    by_fold: dict[int, list[int]] = {}
    for spot, (fold, *_) in zip(spots, tasks):
        by_fold.setdefault(fold, []).append(spot)

    def errors(table: pa.Table) -> pa.Table:
        task = place[table.column("spot")[0].as_py()]
        _, depth, rate, share = tasks[task]
        if table.column("y").null_count or table.column("x").null_count:
            raise ValueError("a row of the folds has no label or no features")
        y = table.column("y").to_numpy()
        x = np.concatenate([c.flatten().to_numpy() for c in table.column("x").chunks]).reshape(len(y), -1)
        order = np.argsort(table.column("pos").to_numpy(), kind="stable")
        trains = table.column("trains").to_numpy()[order]
        own, test = order[trains], order[~trains]
        found = boosted_errors(x[own], y[own], x[test], y[test], rounds, depth, rate, share, seed)
        return pa.table({"task": pa.array([task] * len(found), pa.int32()), "round": pa.array(list(found), pa.int32()),
                         "mse": pa.array([e / len(test) if len(test) else None for e in found.values()], pa.float64())})

    rows = kept.select("pos", (F.col("role") == "train").alias("trains"), F.col(label).cast("double").alias("y"),
                       vector_to_array("features").alias("x"), F.explode(F.create_map(*[
                           c for fold, own in by_fold.items() for c in (F.lit(fold), F.array(*map(F.lit, own)))])[F.col("fold")]).alias("spot"))
    return rows.repartition(len(tasks), "spot").groupBy("spot").applyInArrow(errors, "task int, round int, mse double")


def boosted_grid(folds: DataFrame, grid: BoostedGrid = BoostedGrid(), label: str = "y", seed: int = 0, parallelism: int = 8):
    """Mean R² over the folds for every combination of boosted trees, and the best one; see :func:`forest_grid`.

    All numbers of rounds are read from one fit of the most rounds. Spark's learner starts jobs for every level of a
    tree, however few the rows are: long fits over folds that a task can hold are grown there, one task for each fold,
    depth, rate and share of columns. Their trees are the same.
    """
    spark = folds.sparkSession
    kept = _dealt(folds)
    width = F.size(vector_to_array("features"))
    sizes = kept.groupBy("fold").agg(
        F.sum(width).alias("values"), F.max(width).alias("width"), F.var_pop(F.when(F.col("role") == "test", F.col(label))).alias("spread")
    ).orderBy("fold").collect()
    numbers, spreads = [r["fold"] for r in sizes], {r["fold"]: r["spread"] for r in sizes}
    largest = max((max(r["values"], r["width"] * BINS << max(grid.depths)) for r in sizes), default=0)

    def scored(fold: int, mse: float | None) -> float | None:
        return 1 - mse / spreads[fold] if spreads[fold] else None

    def score(task: tuple[int, int, float, float]) -> list[tuple]:
        fold, depth, rate, share = task
        part = kept.where(F.col("fold") == fold)
        learner = GBTRegressor(labelCol=label, maxIter=max(grid.rounds), maxDepth=depth, stepSize=rate, seed=seed,
                               featureSubsetStrategy="all" if share == 1 else str(share))
        model = learner.fit(part.where(F.col("role") == "train"))
        losses = prefix_losses(model, part.where(F.col("role") == "test"), label).where(F.col("round").isin(list(grid.rounds)))
        mse = {r["round"]: r["mse"] for r in losses.collect()}
        return [((k, depth, rate, share), fold, scored(fold, mse[k])) for k in grid.rounds]

    tasks = sorted(product(numbers, grid.depths, grid.rates, grid.columns), key=lambda t: (-t[1], -t[0]))
    if tasks and max(grid.rounds) > FEW_ROUNDS and largest <= FIT_VALUES:
        scores = {}
        for r in _grown_errors(kept, tasks, grid.rounds, label, seed).collect():  # a row for each score
            fold, *rest = tasks[r["task"]]
            scores[(r["round"], *rest), fold] = scored(fold, r["mse"])
    else:
        with ThreadPool(parallelism) as pool:
            scores = {(combo, fold): r2 for found in pool.imap_unordered(score, tasks) for combo, fold, r2 in found}
    kept.unpersist()
    combos = list(product(grid.rounds, grid.depths, grid.rates, grid.columns))
    return _grid_table(spark, ("rounds int", "depth int", "rate double", "columns double"), combos, numbers, scores)


def fit_forest(train: DataFrame, best: dict[str, int], label: str = "y", seed: int = 0):
    """A forest with the parameters of a combination, but for its split, which :func:`forest_prediction` applies."""
    return _forest(label, best["trees"], best["depth"], best["features"], best["leaf"], seed).fit(train)


def forest_prediction(spark: SparkSession, model, split: int = 2, features: str = "features") -> Column:
    """Mean of the trees, which end at nodes of fewer than ``split`` rows."""
    nodes, depth = tree_nodes(spark, model).cut(split), model.getMaxDepth()

    @F.pandas_udf("double")
    def predict(x: pd.Series) -> pd.Series:
        rows = np.stack(x.to_numpy()) if len(x) else np.zeros((0, 1))
        out = [next(nodes.values(rows[a : a + ROWS], [depth]))[1].mean(axis=1) for a in range(0, len(rows), ROWS)]
        return pd.Series(np.concatenate(out) if out else np.zeros(0))

    return predict(vector_to_array(features))
