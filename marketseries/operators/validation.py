"""Forward-chaining folds, grid search over them, and Spark ML learners."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product
from multiprocessing.pool import ThreadPool

from pyspark.ml import PipelineModel
from pyspark.ml.base import Estimator, Model
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from marketseries.functions.metrics import accuracy, r2
from marketseries.operators.blocks import index_series
from marketseries.session import scratch_path


def fold_bounds(n: int, n_splits: int, test_size: int, gap: int) -> list[tuple[int, int, int]]:
    """(end of train, start of test, end of test) by row position."""
    out = []
    for i in range(n_splits):
        start = n - (n_splits - i) * test_size
        if start - gap <= 0:
            raise ValueError(
                f"fold {i} has no training rows: {n} rows, {n_splits} folds of {test_size} and a gap of {gap}"
            )
        out.append((start - gap, start, start + test_size))
    return out


def forward_folds(
    df: DataFrame, ts: str, n_splits: int = 5, test_size: int = 17520, gap: int = 24, every: str = "month"
) -> DataFrame:
    """One row per (row, fold it plays a part in) with ``fold`` and ``role``."""
    rows = index_series(df, [], ts, every)
    bounds = fold_bounds(df.count(), n_splits, test_size, gap)
    parts = F.array(*[
        F.struct(
            F.lit(i).alias("fold"),
            F.when(F.col("pos") < train_end, "train")
            .when((F.col("pos") >= start) & (F.col("pos") < end), "test")
            .alias("role"),
        )
        for i, (train_end, start, end) in enumerate(bounds)
    ])
    out = rows.withColumn("_p", F.explode(parts)).where(F.col("_p.role").isNotNull())
    return out.select(*df.columns, "pos", F.col("_p.fold").alias("fold"), F.col("_p.role").alias("role"))


def assemble(df: DataFrame, features: Sequence[str], vector: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=vector, handleInvalid="skip").transform(df)


def grid(params: dict[str, Sequence]) -> list[dict]:
    names = list(params)
    return [dict(zip(names, values)) for values in product(*params.values())]


def grid_search(
    folds: DataFrame, estimator: Estimator, params: dict[str, Sequence], label: str = "y", parallelism: int = 4
) -> tuple[DataFrame, dict]:
    """Mean R² over the folds for every combination, and the best combination.

    ``folds`` comes from ``forward_folds`` with a ``features`` column. Each fit
    is a Spark job; a few run side by side. Only scores reach the driver.
    """
    spark = folds.sparkSession
    combos = grid(params)
    kept = folds.persist(StorageLevel.MEMORY_AND_DISK)
    numbers = [r[0] for r in kept.select("fold").distinct().orderBy("fold").collect()]

    def score(task: tuple[int, int]) -> tuple[int, int, float]:
        at, fold = task
        part = kept.where(F.col("fold") == fold)
        extra = {estimator.getParam(k): v for k, v in combos[at].items()}
        model = estimator.copy(extra).fit(part.where(F.col("role") == "train"))
        value = model.transform(part.where(F.col("role") == "test")).agg(r2(label, "prediction")).first()[0]
        return at, fold, value

    with ThreadPool(parallelism) as pool:
        scores = pool.map(score, [(i, f) for i in range(len(combos)) for f in numbers])
    kept.unpersist()
    # a fold without variance has no score; a combination with one counts as the worst
    own = [[v for a, _, v in scores if a == i] for i in range(len(combos))]
    means = [None if None in v else float(sum(v) / len(numbers)) for v in own]
    best = max(range(len(combos)), key=lambda i: float("-inf") if means[i] is None else means[i])
    table = [(i, str(combos[i]), f, v if v is None else float(v), means[i], i == best) for i, f, v in sorted(scores, key=lambda x: x[:2])]
    return (
        spark.createDataFrame(table, "combo int, params string, fold int, r2 double, mean_r2 double, best boolean"),
        combos[best],
    )


def boosted_trees(label: str = "y", trees: int = 1000, rate: float = 0.01, depth: int = 5, seed: int = 0) -> GBTRegressor:
    return GBTRegressor(labelCol=label, maxIter=trees, stepSize=rate, maxDepth=depth, seed=seed)


def forest(label: str = "y", trees: int = 100, depth: int = 10, min_leaf: int = 1, seed: int = 0, **kw) -> RandomForestRegressor:
    """The minimum rows to split a node has no counterpart here; ``min_leaf`` bounds the leaves."""
    return RandomForestRegressor(
        labelCol=label, numTrees=trees, maxDepth=depth, minInstancesPerNode=min_leaf, seed=seed, **kw
    )


def importances(model, names: Sequence[str]) -> DataFrame:
    spark = SparkSession.getActiveSession()
    values = model.featureImportances.toArray()
    return spark.createDataFrame([(n, float(v)) for n, v in zip(names, values)], "feature string, importance double")



def window_classifier(inputs: int, hidden: Sequence[int] = (64, 64, 64), max_iter: int = 100, seed: int = 0):
    return MultilayerPerceptronClassifier(layers=[inputs, *hidden, 2], labelCol="label", maxIter=max_iter, seed=seed)


def direction_baseline() -> LogisticRegression:
    return LogisticRegression(labelCol="label", regParam=0.01)


def window_regressor() -> LinearRegression:
    return LinearRegression(labelCol="label", regParam=1e-6)


def fit_best(train: DataFrame, validation: DataFrame, candidates: Sequence[Estimator], score=None, path: str | None = None):
    """Fit all candidates, keep the one with the best validation score, save it and load it back."""
    return keep_best([c.fit(train) for c in candidates], validation, score, path)


def keep_best(models: Sequence[Model], validation: DataFrame, score=None, path: str | None = None):
    """The model with the best validation score (accuracy, if none is given), saved and loaded back, all scores, its place."""
    score = accuracy("label", "prediction") if score is None else score
    values = [m.transform(validation).agg(score).first()[0] for m in models]
    best = max(range(len(models)), key=lambda i: (values[i] is not None, values[i]))
    path = path or scratch_path(validation.sparkSession, "model")
    PipelineModel(stages=[models[best]]).write().overwrite().save(path)
    return PipelineModel.load(path), values, best
