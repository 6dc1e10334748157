"""Boosted trees grown inside a task against Spark ML's learner, and the grid that the query tries."""

import numpy as np
import pytest
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from marketseries.operators import boosting as bo
from marketseries.operators import ensembles as ens
from marketseries.operators import validation as val
from marketseries.plans import models

NAMES = ["a", "b", "c", "d", "e", "f", "g"]


@pytest.fixture(scope="module")
def rows(spark):
    """Wide and few values, zeros, a constant column and a copy of another, labels in the millions with ties."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, 7))
    x[:, 1], x[:, 2], x[:, 3], x[:, 4] = np.arange(500) % 12, np.maximum(x[:, 2], 0), 5, x[:, 0]
    y = np.round(1e6 + 3e5 * x[:, 0] * x[:, 2] - 2e5 * (x[:, 1] > 6) + rng.normal(0, 1e5, 500), -3)
    table = [(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))]
    df = spark.createDataFrame(table, f"ts int, {', '.join(f'{c} double' for c in NAMES)}, y double")
    df = df.withColumn("ts", F.timestamp_seconds(F.col("ts") * 86400).cast("timestamp_ntz"))
    return val.assemble(df, NAMES).persist()


def arrays(df):
    found = df.orderBy("ts").select("features", "y").collect()
    return np.array([r["features"].toArray() for r in found]), np.array([r["y"] for r in found])


def test_the_grid_is_that_of_the_original(monkeypatch):
    """24 combinations of 800 and 1000 rounds at rates from 0.01 to 0.1, not a hundredth of the rounds."""
    asked = []
    monkeypatch.setattr(models, "training_folds", lambda *a: "folds")
    monkeypatch.setattr(models.ensembles, "boosted_grid", lambda folds, grid, *a, **k: (asked.append((folds, grid)), (None, None))[1])
    models.grid_search_boosted(None, "")
    (folds, grid), = asked
    assert folds == "folds" and tuple(grid.rounds) == (800, 1000) and tuple(grid.depths) == (4, 8)
    assert tuple(grid.rates) == (0.01, 0.05, 0.1) and tuple(grid.columns) == (0.7, 1.0)


@pytest.mark.parametrize("depth, share, cells", [(0, 1.0, 1 << 20), (1, 0.3, 1 << 20), (4, 0.7, 600), (8, 1.0, 1 << 20), (8, 0.7, 1 << 20)])
def test_trees_are_those_of_the_learner(rows, monkeypatch, depth, share, cells):
    monkeypatch.setattr(bo, "CELLS", cells)
    one = rows.coalesce(1).sortWithinPartitions("ts")
    train, test = one.where("ts < '1971-02-01'"), one.where("ts >= '1971-02-01'")
    learner = GBTRegressor(labelCol="y", maxIter=12, maxDepth=depth, stepSize=0.1, seed=5, featureSubsetStrategy="all" if share == 1 else str(share))
    theirs = {r["round"]: r["mse"] for r in ens.prefix_losses(learner.fit(train), test).collect()}
    (x, y), (test_x, test_y) = arrays(train), arrays(test)
    mine = bo.boosted_errors(x, y, test_x, test_y, range(1, 13), depth, 0.1, share, 5)
    assert list(mine) == list(range(1, 13))
    assert [e / len(test_y) for e in mine.values()] == pytest.approx([theirs[k] for k in mine], rel=1e-9)


def test_thresholds():
    assert list(bo.thresholds(np.array([3.0, 1.0, 1.0, 2.0]))) == [1.5, 2.5] and len(bo.thresholds(np.full(9, 2.0))) == 0
    assert len(bo.thresholds(np.arange(1000.0))) == 31 and list(bo.thresholds(np.arange(8.0), 4)) == [1.5, 3.5, 5.5]
    assert list(bo.thresholds(np.array([1.0, 2.0]), 32)) == [1.5]


def test_rows_that_cannot_be_fitted():
    x, y = np.zeros((3, 1)), np.array([1.0, 2.0, 3.0])
    assert bo.boosted_errors(x, y, x, y, [1, 3], 2, 0.1) == {1: pytest.approx(2), 3: pytest.approx(2)}
    for bad_x, bad_y in ((x, np.array([1.0, np.nan, 2.0])), (np.full((3, 1), np.inf), y), (x[:0], y[:0])):
        with pytest.raises(ValueError):
            bo.boosted_errors(bad_x, bad_y, x, y, [1], 2, 0.1)


GRID = ens.BoostedGrid(rounds=(3, 9), depths=(2, 5), rates=(0.1, 0.5), columns=(0.7, 1.0))


def test_long_fits_are_grown_in_tasks(rows, monkeypatch):
    """The same table as from Spark's learner, without a call of it."""
    folds = val.forward_folds(rows, "ts", n_splits=2, test_size=60, gap=5).repartition(40, "pos")
    theirs, best = ens.boosted_grid(folds, GRID)
    monkeypatch.setattr(ens, "FEW_ROUNDS", 8)
    monkeypatch.setattr(GBTRegressor, "fit", lambda *a: pytest.fail("the learner was called"))
    mine, own = ens.boosted_grid(folds, GRID)
    a, b = (t.orderBy("combo", "fold").collect() for t in (theirs, mine))
    assert len(a) == len(b) == 16 * 2 and best == own and theirs.schema == mine.schema
    numbers = ("r2", "mean_r2")
    assert [{**r.asDict(), **dict.fromkeys(numbers)} for r in a] == [{**r.asDict(), **dict.fromkeys(numbers)} for r in b]
    assert [r[c] for r in b for c in numbers] == pytest.approx([r[c] for r in a for c in numbers], rel=1e-9)


@pytest.mark.parametrize("depth", [2, 20])
def test_large_folds_and_deep_trees_stay_with_the_learner(rows, monkeypatch, depth):
    monkeypatch.setattr(ens, "FEW_ROUNDS", 0)
    monkeypatch.setattr(ens, "FIT_VALUES", 1000 if depth == 2 else ens.FIT_VALUES)
    seen, fit = [], GBTRegressor.fit
    monkeypatch.setattr(GBTRegressor, "fit", lambda self, train: (seen.append(train.count()), fit(self, train))[1])
    folds = val.forward_folds(rows, "ts", n_splits=1, test_size=60, gap=5)
    ens.boosted_grid(folds, ens.BoostedGrid(rounds=(2,), depths=(depth,), rates=(0.5,), columns=(1.0,)))
    assert seen == [435]


def test_folds_without_scores(rows, monkeypatch):
    monkeypatch.setattr(ens, "FEW_ROUNDS", 0)
    grid = ens.BoostedGrid(rounds=(2,), depths=(2,), rates=(0.5,), columns=(1.0,))
    folds = val.forward_folds(rows, "ts", n_splits=2, test_size=60, gap=5)
    flat = folds.withColumn("y", F.when(F.expr("fold = 1 and role = 'test'"), F.lit(0.5)).otherwise(F.col("y")))
    assert [r["r2"] is None for r in ens.boosted_grid(flat, grid)[0].orderBy("fold").collect()] == [False, True]
    untold = folds.where("not (fold = 0 and role = 'test')")
    assert [r["r2"] is None for r in ens.boosted_grid(untold, grid)[0].orderBy("fold").collect()] == [True, False]
    assert ens.boosted_grid(folds.where("fold < 0"), grid)[0].count() == 0
    with pytest.raises(Exception, match="no label"):
        ens.boosted_grid(folds.withColumn("y", F.when(F.col("pos") > 3, F.col("y"))), grid)


def test_each_fit_gets_its_partition(spark):
    for n in (1, 7, 60):
        spots = ens._spots(spark, n)
        at = spark.createDataFrame([(s,) for s in spots], "spot long").repartition(n, "spot").select("spot", F.spark_partition_id().alias("at"))
        assert [r["spot"] for r in at.orderBy("at").collect()] == spots and at.select("at").distinct().count() == n == len(set(spots))
