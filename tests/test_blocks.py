"""Block-wise operators against plain pandas on the whole series."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marketseries.operators import indicators as ind
from marketseries.operators.blocks import (
    DecayedMean, average_rank, decayed_means, exact_quantiles, index_series, over_blocks, running_sum, top_n,
)


def make_series(n=700, keys=("a", "b"), seed=1, holes=0.3):
    rng = np.random.default_rng(seed)
    frames = []
    for k, key in enumerate(keys):
        days = [dt.date(2001, 1, 1) + dt.timedelta(days=i) for i in range(n) if rng.random() > holes]
        close = 100 * np.exp(np.cumsum(rng.normal(0, 0.02, len(days))))
        spread = np.abs(rng.normal(0, 1, len(days)))
        frames.append(pd.DataFrame({"ticker": key, "date": days, "close": close, "high": close + spread, "low": close - spread}))
    return pd.concat(frames).sample(frac=1, random_state=seed).reset_index(drop=True)


@pytest.fixture(scope="module")
def series(spark):
    pdf = make_series()
    return spark.createDataFrame(pdf), pdf.sort_values(["ticker", "date"]).reset_index(drop=True)


def in_order(df, *cols):
    return df.select("ticker", "date", *cols).toPandas().sort_values(["ticker", "date"]).reset_index(drop=True)


def test_positions(series):
    df, pdf = series
    got = in_order(index_series(df, ["ticker"], "date"), "pos", "n_obs")
    assert (got["pos"] == pdf.groupby("ticker").cumcount()).all()
    assert (got["n_obs"] == pdf.groupby("ticker")["date"].transform("size")).all()


@pytest.mark.parametrize("block", [3, 17, 64, 5000])
def test_blocks_equal_whole_window(series, block):
    df, pdf = series
    rows = index_series(df, ["ticker"], "date")

    def stage(ctx):
        return {
            "mean7": F.avg("close").over(ctx.w.rowsBetween(-7, -1)),
            "next2": F.lead("close", 2).over(ctx.w),
        }

    got = in_order(over_blocks(rows, ["ticker"], [stage], back=7, ahead=2, block=block), "mean7", "next2")
    by = pdf.groupby("ticker")["close"]
    assert np.allclose(got["mean7"], by.transform(lambda x: x.shift(1).rolling(7, min_periods=1).mean()), equal_nan=True)
    assert np.allclose(got["next2"], by.shift(-2), equal_nan=True)


@pytest.mark.parametrize("block", [50, 2048])
def test_smoothing_equals_recursion(series, block):
    df, pdf = series
    rows = index_series(df, ["ticker"], "date")
    got = in_order(ind.apply_indicators(rows, [ind.rsi(), ind.atr(), ind.macd()], block=block), "rsi", "atr", "macd")

    def wilder(x, n):
        return x.ewm(alpha=1 / n, adjust=True).mean()

    for _, part in pdf.groupby("ticker"):
        mine = got.loc[part.index]
        d = part["close"].diff()
        up, down = wilder(d.clip(lower=0), 20), wilder((-d).clip(lower=0), 20)
        rsi = (100 * up / (up + down)).where(np.arange(len(part)) >= 20)
        assert np.allclose(mine["rsi"], rsi, equal_nan=True)
        assert mine["rsi"].dropna().between(0, 100).all()
        prev = part["close"].shift()
        tr = pd.concat([part["high"] - part["low"], (part["high"] - prev).abs(), (part["low"] - prev).abs()], axis=1).max(axis=1)
        tr = tr.where(prev.notna())
        assert np.allclose(mine["atr"], wilder(tr, 14).where(np.arange(len(part)) >= 14), equal_nan=True)
        fast, slow = (part["close"].ewm(span=s, adjust=False).mean() for s in (12, 26))
        assert np.allclose(mine["macd"], (fast - slow).where(np.arange(len(part)) >= 25), equal_nan=True)


@pytest.mark.parametrize("block", [50, 2048])
@pytest.mark.parametrize("n", [1, 2, 3, 20])
def test_smoothing_over_flat_stretches_and_null_gaps(spark, block, n):
    """A long stretch without change keeps the share of rises; history is never cut at a block's border."""
    rng = np.random.default_rng(n)
    close = [float(x) for x in 100 + np.cumsum(rng.normal(0, 1, 300))]
    close += [close[-1]] * 5000 + [close[-1] + float(x) for x in np.cumsum(rng.normal(0, 1e-3, 50))]
    close += [None] * 3000 + [close[-1] + 1.0, close[-1] - 2.0, close[-1] - 1.0]
    days = [dt.date(1990, 1, 1) + dt.timedelta(days=i) for i in range(len(close))]
    df = spark.createDataFrame([("a", d, c) for d, c in zip(days, close)], "ticker string, date date, close double")
    got = in_order(ind.apply_indicators(index_series(df, ["ticker"], "date"), [ind.rsi(n=n)], block=block), "rsi")["rsi"]
    up = down = seen = 0
    before, gap, expected = None, 0, []
    for c in close:
        gap += 1
        change = None if c is None or before is None else c - before
        if change is not None:
            seen += 1
        if change:
            decay = (1 - 1 / n) ** gap
            up, down, gap = up * decay + max(change, 0), down * decay + max(-change, 0), 0
        expected.append(100 * up / (up + down) if seen >= n and up + down > 0 else np.nan)
        before = c
    assert np.allclose(got.astype(float), expected, equal_nan=True, atol=1e-6)


@pytest.mark.parametrize("run", [1, 3, 4096])
def test_states_carried_in_runs(spark, run):
    """Runs of blocks, empty ones between them, a start and a long middle without weight: as one recursion over all rows."""
    rng = np.random.default_rng(run)
    at = [*range(40), *range(400, 460), *range(9000, 9050)]  # blocks of 7 rows
    value = [None if i < 20 or 410 <= i < 440 else float(x) for i, x in zip(at, rng.normal(size=len(at)))]
    rows = [(key, i, None if v is None else v * (key + 1), 0.0 if i % 5 == 0 else 1.0 + key) for key in (0, 1) for i, v in zip(at, value)]
    df = spark.createDataFrame(rows, "key int, pos long, v double, w double")
    means = [DecayedMean(f"m{n}", F.col("v") * F.col("w"), F.when(F.col("v").isNotNull(), F.col("w")), 1 / n) for n in (2, 30)]
    got = decayed_means(df, ["key"], means, block=7, run=run).toPandas().sort_values(["key", "pos"])
    # where the lengths are known, a short series needs no second level, and the long ones come out alike
    known = df.withColumn("n_obs", F.lit(9050).cast("long")).unionByName(df.filter("key = 0 and pos < 7").selectExpr(
        "2 as key", "pos", "v", "w", "7L as n_obs"))
    again = decayed_means(known, ["key"], means, block=7, run=run).toPandas().sort_values(["key", "pos"])
    assert np.allclose(again.loc[again["key"] < 2, got.columns].astype(float), got.astype(float), equal_nan=True)
    assert (again["key"] == 2).sum() == 7
    for key, part in got.groupby("key"):
        mine = [r for r in rows if r[0] == key]
        for n in (2, 30):
            expected, seen = [], []
            for _, i, _, _ in mine:
                past = [(v, w, i - j) for _, j, v, w in mine if j <= i and v is not None]
                top = max((-gap for _, w, gap in past if w), default=0)
                share = [w * (1 - 1 / n) ** (gap + top) if w else 0.0 for _, w, gap in past]
                expected.append(sum(s * v for s, (v, _, _) in zip(share, past)) / sum(share) if sum(share) else np.nan)
                seen.append(len(past))
            assert np.allclose(part[f"m{n}"].astype(float), expected, equal_nan=True, atol=1e-9)
            assert part[f"m{n}_seen"].tolist() == seen


def test_future_rows_change_nothing(spark, series):
    _, pdf = series
    cut = dt.date(2002, 1, 1)
    chosen = [ind.moving_average(ns=(5,)), ind.rsi(), ind.bollinger(lag=1), ind.lagged({"l": "close"})]

    def run(frame):
        rows = index_series(spark.createDataFrame(frame), ["ticker"], "date")
        return in_order(ind.apply_indicators(rows, chosen), "ma_5", "rsi", "bb_low", "bb_mid", "bb_high", "l")

    whole, early = run(pdf), run(pdf[pdf["date"] < cut])
    pd.testing.assert_frame_equal(whole[whole["date"] < cut].reset_index(drop=True), early)
    bands = whole.dropna()
    assert (bands["bb_low"] <= bands["bb_mid"]).all() and (bands["bb_mid"] <= bands["bb_high"]).all()


def test_running_sum_with_nulls(spark):
    rows = [("a", dt.date(2001, 1, 1) + dt.timedelta(days=i), None if i % 5 == 0 else float(i)) for i in range(100)]
    df = spark.createDataFrame(rows, "ticker string, date date, v double")
    got = in_order(running_sum(df, ["ticker"], "date", {"s": F.col("v")}), "s")
    assert np.allclose(got["s"], np.cumsum([0 if i % 5 == 0 else i for i in range(100)]))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("xy"), st.one_of(st.none(), st.integers(-3, 3))), min_size=1, max_size=60))
def test_rank_and_quantiles_match_pandas(spark, rows):
    pdf = pd.DataFrame(rows, columns=["g", "v"]).astype({"v": float})
    df = spark.createDataFrame([(i, g, None if v is None else float(v)) for i, (g, v) in enumerate(rows)], "id int, g string, v double")
    ranked = average_rank(df, ["g"], "v", halvings=2).toPandas().sort_values("id")
    expected = pdf.groupby("g")["v"].rank(ascending=False)
    assert np.allclose(ranked["rank"].astype(float), expected, equal_nan=True)
    best = top_n(df, ["g"], "v", 4).toPandas()
    assert sorted(best["id"]) == sorted(expected[expected < 4].index)
    quantiles = exact_quantiles(df, ["g"], "v", {"a": 0.005, "b": 0.5, "c": 0.9}, halvings=2).toPandas().set_index("g")
    for g, part in pdf.dropna().groupby("g"):
        assert np.allclose(quantiles.loc[g, ["a", "b", "c"]].astype(float), part["v"].quantile([0.005, 0.5, 0.9]))


def test_one_value_held_by_most_rows(spark):
    df = spark.range(5000).select(
        F.lit("g").alias("g"), F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.col("id").cast("double")).alias("v")
    )
    pdf = df.toPandas()
    got = average_rank(df, ["g"], "v").toPandas().sort_values("v")
    assert np.allclose(got["rank"], pdf.sort_values("v")["v"].rank(ascending=False))
    q = exact_quantiles(df, ["g"], "v", {"m": 0.37}).first()["m"]
    assert q == pytest.approx(pdf["v"].quantile(0.37))
