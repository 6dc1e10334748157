"""Prefixes and cuts of fitted ensembles against models fitted with those limits, and against their own predictions."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from marketseries.operators import ensembles as ens
from marketseries.operators import validation as val


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 4))
    y = 3 * x[:, 0] - 2 * (x[:, 1] > 0) + x[:, 2] * x[:, 0] + rng.normal(0, 0.3, 600)
    df = spark.createDataFrame([(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))], "ts int, a double, b double, c double, d double, y double")
    df = df.withColumn("ts", F.timestamp_seconds(F.col("ts") * 86400).cast("timestamp_ntz"))
    return val.assemble(df, ["a", "b", "c", "d"]).persist()


def parts(rows):
    return rows.where("ts < '1971-02-01'"), rows.where("ts >= '1971-02-01'")


def test_curve_and_saved_checkpoint(spark, rows, tmp_path):
    train, valid = parts(rows)
    learner = GBTRegressor(labelCol="y", maxIter=40, stepSize=0.5, maxDepth=4, seed=1)
    loaded, curve = ens.boosted_checkpoint(train, valid, learner, str(tmp_path / "m"))
    found = {r["round"]: (r["mse"], r["best"]) for r in curve.collect()}
    whole = learner.fit(train)
    assert len(found) == 40
    by_ml = whole.evaluateEachIteration(valid, "squared")
    assert np.allclose([found[i + 1][0] for i in range(40)], by_ml)
    best = 1 + int(np.argmin(by_ml))
    assert best < 40 and [k for k, v in found.items() if v[1]] == [best]
    # the saved ensemble is that of a fit that had stopped there, and loads alike
    short = GBTRegressor(labelCol="y", maxIter=best, stepSize=0.5, maxDepth=4, seed=1).fit(train)
    again = PipelineModel.load(str(tmp_path / "m"))
    out = [np.array(m.transform(valid).orderBy("ts").select("prediction").collect()) for m in (short, loaded, again)]
    assert np.allclose(out[0], out[1]) and np.array_equal(out[1], out[2])
    assert loaded.stages[0].getNumTrees == best and np.mean((out[0][:, 0] - np.array(valid.orderBy("ts").select("y").collect())[:, 0]) ** 2) == pytest.approx(min(by_ml))
    with pytest.raises(ValueError):
        ens.boosted_checkpoint(train, valid.limit(0), learner)


def test_forest_cuts_score_like_forests(spark, rows):
    """Whole forests predict alike; a shallower cut is close to a forest grown to that depth."""
    train, valid = parts(rows)
    model = ens._forest("y", 30, 8, 2, 1, 0).fit(train)
    nodes = ens.tree_nodes(spark, model)
    x = np.array([r["x"] for r in ens._vectors(valid, "y").collect()])
    y = np.array([r["y"] for r in ens._vectors(valid, "y").collect()])
    values = dict(nodes.values(x, [3, 8]))
    assert np.allclose(values[8].mean(axis=1), np.array(model.transform(valid).select("prediction").collect())[:, 0])
    same = np.array(valid.select(ens.forest_prediction(spark, model)).collect())[:, 0]
    assert np.allclose(same, values[8].mean(axis=1))
    shallow = np.array(ens._forest("y", 30, 3, 2, 1, 0).fit(train).transform(valid).select("prediction").collect())[:, 0]
    error = lambda p: np.mean((p - y) ** 2)
    assert error(values[3].mean(axis=1)) == pytest.approx(error(shallow), rel=0.15)
    assert error(values[3].mean(axis=1)) > error(values[8].mean(axis=1))
    cut = nodes.cut(20)
    assert ((cut.left < 0) >= (nodes.left < 0)).all() and (cut.left[nodes.count < 20] < 0).all()
    assert len(np.unique(dict(cut.values(x, [8]))[8])) < len(np.unique(values[8]))


def test_forest_grid(rows):
    grid = ens.ForestGrid(trees=(5, 12), depths=(2, 5), features=(2, 4), leaves=(1, 6), splits=(2, 30))
    folds = val.forward_folds(rows, "ts", n_splits=3, test_size=80, gap=5)
    table, best = ens.forest_grid(folds, grid)
    found = table.collect()
    assert len(found) == 2**5 * 3 and len({r["combo"] for r in found}) == 32
    means = {}
    for r in found:
        means.setdefault(r["combo"], []).append(r["r2"])
        assert r["mean_r2"] is not None and r["mean_r2"] <= max(x["mean_r2"] for x in found if x["best"])
    assert all(np.mean(v) == pytest.approx(next(r["mean_r2"] for r in found if r["combo"] == c)) for c, v in means.items())
    assert {tuple(r[k] for k in best) for r in found if r["best"]} == {tuple(best.values())} and best["depth"] == 5
    # one combination against its own fit and Spark's predictions
    fold = folds.where("fold = 1")
    model = ens._forest("y", 12, 5, 4, 6, 0).fit(fold.where("role = 'train'"))
    scored = model.transform(fold.where("role = 'test'")).toPandas()
    r2 = 1 - ((scored["y"] - scored["prediction"]) ** 2).sum() / ((scored["y"] - scored["y"].mean()) ** 2).sum()
    own = [r["r2"] for r in found if (r["trees"], r["depth"], r["features"], r["leaf"], r["split"], r["fold"]) == (12, 5, 4, 6, 2, 1)]
    assert own == [pytest.approx(r2, abs=0.02)]  # the bootstrap follows the order of rows in partitions


def test_boosted_grid(rows):
    folds = val.forward_folds(rows, "ts", n_splits=2, test_size=80, gap=5)
    table, best = ens.boosted_grid(folds, ens.BoostedGrid(rounds=(3, 8), depths=(2, 4), rates=(0.1, 0.5), columns=(0.5, 1.0)))
    found = table.collect()
    assert len(found) == 16 * 2 and sum(r["best"] for r in found) == 2
    top = max(r["mean_r2"] for r in found)
    assert all(r["best"] == (r["mean_r2"] == top) for r in found) and best["rate"] == 0.5
    fold = folds.where("fold = 1")
    model = GBTRegressor(labelCol="y", maxIter=3, maxDepth=2, stepSize=0.5, seed=0).fit(fold.where("role = 'train'"))
    scored = model.transform(fold.where("role = 'test'")).toPandas()
    r2 = 1 - ((scored["y"] - scored["prediction"]) ** 2).sum() / ((scored["y"] - scored["y"].mean()) ** 2).sum()
    own = [r["r2"] for r in found if (r["rounds"], r["depth"], r["rate"], r["columns"], r["fold"]) == (3, 2, 0.5, 1.0, 1)]
    assert own == [pytest.approx(r2, abs=1e-9)]


@pytest.mark.parametrize("kind", ["forest", "boosted"])
def test_fits_get_as_many_tasks_as_their_rows_need(rows, monkeypatch, kind):
    """A fit is dozens of jobs: rows that a join leaves in a partition for each of the session's must not stay there."""
    folds = val.forward_folds(rows, "ts", n_splits=2, test_size=80, gap=5)
    learner = ens.RandomForestRegressor if kind == "forest" else GBTRegressor
    seen, fit = [], learner.fit
    monkeypatch.setattr(learner, "fit", lambda self, train: (seen.append((train.rdd.getNumPartitions(), train.count())), fit(self, train))[1])
    tables = []
    for frame in (folds.repartition(40, "pos"), folds.repartition(8, "pos")):
        if kind == "forest":
            tables.append(ens.forest_grid(frame, ens.ForestGrid(trees=(3,), depths=(2,), features=(4,), leaves=(1,), splits=(2,)))[0])
        else:
            tables.append(ens.boosted_grid(frame, ens.BoostedGrid(rounds=(3,), depths=(2,), rates=(0.5,), columns=(1.0,)))[0])
    assert sorted(n for n, _ in seen) == [1, 1, 8, 8] and sorted(c for _, c in seen) == [435, 435, 515, 515]
    found = [[r["r2"] for r in t.orderBy("fold").collect()] for t in tables]
    assert len(found[0]) == 2 and (kind == "forest" or found[0] == pytest.approx(found[1], abs=1e-9))


def test_large_folds_keep_as_many_partitions_as_they_need(rows, monkeypatch):
    monkeypatch.setattr(ens, "TASK_ROWS", 50)
    folds = val.forward_folds(rows, "ts", n_splits=2, test_size=80, gap=5)
    dealt = ens._dealt(folds.repartition(40, "pos"))
    assert dealt.rdd.getNumPartitions() == -(-folds.count() // 50)
    assert sorted(map(str, dealt.collect())) == sorted(map(str, folds.collect()))
