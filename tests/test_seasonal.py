"""The additive seasonal model against a dense penalised fit, and on series that it describes."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketseries.operators import seasonal as sea

START = dt.datetime(2020, 1, 1)
SCHEMA = "series_id string, ts timestamp_ntz, y double, other int"


def dense(hours, seasons, start, end):
    """The design by a plain loop over columns."""
    at = (hours * 3600.0 - start) / (end - start)
    cols = [np.ones(len(hours)), at] + [np.maximum(at - seasons.reach * (i + 1) / (seasons.bends + 1), 0) for i in range(seasons.bends)]
    for length, n in seasons.waves:
        for k in range(1, n + 1):
            turn = 2 * np.pi * k * ((hours * 3600.0 + START.replace(tzinfo=dt.timezone.utc).timestamp()) % length) / length
            cols += [np.sin(turn), np.cos(turn)]
    return np.stack(cols, 1)


def test_equals_dense_fit_and_finds_seasons(spark):
    rng = np.random.default_rng(1)
    seasons = sea.Seasons(bends=4)
    hours = np.arange(24 * 60)
    series = {
        "a": 50 + 0.01 * hours + 5 * np.sin(2 * np.pi * hours / 24) + 2 * np.cos(2 * np.pi * hours / 168) + rng.normal(0, 0.1, len(hours)),
        "b": 10 + 3 * np.cos(4 * np.pi * hours / 24) + rng.normal(0, 1, len(hours)),
    }
    cut = 24 * 50
    rows = [(k, START + dt.timedelta(hours=int(h)), float(v), 1) for k, y in series.items() for h, v in zip(hours, y)]
    rows += [("c", START, 4.0, 1), ("c", START + dt.timedelta(hours=1), None, 1), ("d", None, 1.0, 1)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    split = F.lit(START + dt.timedelta(hours=cut)).cast("timestamp_ntz")
    model = sea.fit_seasonal(df.where(F.col("ts") < split), seasons=seasons).persist()
    assert {r["series_id"]: r["n"] for r in model.collect()} == {"a": cut, "b": cut, "c": 1}
    out = sea.predict_seasonal(df, model, seasons=seasons)
    assert out.columns == ["series_id", "ts", "y", "other", "prediction"]
    got = {(r["series_id"], r["ts"]): r["prediction"] for r in out.where("ts is not null").collect()}
    assert got["c", START] == pytest.approx(4.0)
    for k, y in series.items():
        x = dense(hours, seasons, 0.0, (cut - 1) * 3600.0)
        mean = y[:cut].mean()
        coef = np.linalg.solve(x[:cut].T @ x[:cut] + np.diag(np.array(seasons.penalties) + 1e-9), x[:cut].T @ (y[:cut] - mean))
        mine = np.array([got[k, START + dt.timedelta(hours=int(h))] for h in hours])
        assert np.allclose(mine, mean + x @ coef, atol=1e-6)
    error = np.abs(np.array([got["a", START + dt.timedelta(hours=int(h))] for h in hours[cut:]]) - series["a"][cut:])
    assert error.mean() < 0.5  # hold-out of ten days, noise of 0.1


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    model = sea.fit_seasonal(df)
    assert model.count() == 0 and sea.predict_seasonal(df, model).count() == 0
