"""Solvers and iterative operators against brute force."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from marketseries.operators import clusters, diagnostics, intraday, portfolio, regression
from marketseries.operators import validation as val


@pytest.mark.parametrize("tile", [1, 4, 8, 64])
def test_fifty_nested_columns_match_direct_fits(spark, tile):
    rng = np.random.default_rng(7)
    names = [f"z{i}" for i in range(50)]
    frames = []
    for g, n in (("a", 120), ("b", 400)):
        x = rng.normal(size=(n, 50)) @ (np.eye(50) + 0.1)
        if g == "b":
            x[:, 30] = x[:, 3] - 2 * x[:, 7]  # depends on columns before it: no fits from here on
        frames.append(pd.DataFrame(x, columns=names).assign(y=0.05 * x[:, :5].sum(axis=1) + rng.normal(size=n), g=g))
    data = pd.concat(frames)
    df = spark.createDataFrame(data)
    tiles = regression.gram_tiles(df, ["g"], [*names, "y"], tile)
    assert "Python" not in tiles._jdf.queryExecution().toString()
    out = {(r["g"], r["k"]): r for r in regression.nested_models(df, ["g"], "y", names, range(5, 51), tile).collect()}
    assert len(out) == 2 * 46
    for (g, k), r in out.items():
        own = data[data["g"] == g]
        x, y = own[names[:k]].to_numpy(), own["y"].to_numpy()
        if g == "b" and k > 30:
            assert r["ssr"] is None and r["aic"] is None
            continue
        ssr = np.linalg.lstsq(x, y, rcond=None)[1][0]
        assert r["n"] == len(y) and r["ssr"] == pytest.approx(ssr, rel=1e-8) and r["syy"] == pytest.approx(y @ y)
        assert r["bic"] == pytest.approx(k * np.log(len(y)) + len(y) * (np.log(2 * np.pi * ssr / len(y)) + 1))


def test_centred_nested_models_equal_fits_with_a_constant(spark):
    rng = np.random.default_rng(8)
    data = pd.DataFrame(rng.normal(size=(300, 12)) + 50, columns=[f"z{i}" for i in range(12)]).assign(g=rng.choice(["a", "b"], 300))
    data["y"] = data["z0"] - 2 * data["z5"] + rng.normal(size=300) + 7
    names = [f"z{i}" for i in range(12)]
    out = regression.nested_models(spark.createDataFrame(data).repartition(3), ["g"], "y", names, [1, 5, 12], 5, centred=True).collect()
    assert len(out) == 6
    for r in out:
        own = data[data["g"] == r["g"]]
        x = np.column_stack([np.ones(len(own)), own[names[: r["k"]]]])
        ssr = np.linalg.lstsq(x, own["y"], rcond=None)[1][0]
        assert r["n"] == len(own) and r["ssr"] == pytest.approx(ssr, rel=1e-7)
        assert r["syy"] == pytest.approx(((own["y"] - own["y"].mean()) ** 2).sum())


def test_rolling_betas_match_direct_fits(spark):
    rng = np.random.default_rng(3)
    rows = []
    for t, n in (("long", 40), ("short", 9), ("tiny", 6)):
        x = rng.normal(size=(n, 2))
        y = 0.5 + x @ [2.0, -1.0] + rng.normal(0, 0.3, n)
        for i in range(n):
            rows.append((t, dt.date(2000, 1, 1) + dt.timedelta(days=31 * i), *map(float, x[i]), float(y[i])))
    rows[5] = (*rows[5][:2], None, *rows[5][3:])
    df = spark.createDataFrame(rows, "ticker string, month_end date, a double, b double, r double")
    got = regression.rolling_ols(df, "r", ["a", "b"], window=24, min_obs=7).toPandas()
    pdf = pd.DataFrame(rows, columns=["ticker", "month_end", "a", "b", "r"])
    for t, part in pdf.groupby("ticker"):
        part = part.sort_values("month_end")
        mine = got[got["ticker"] == t].sort_values("month_end")
        w = min(24, len(part))
        for i in range(len(part)):
            frame = part.iloc[max(0, i - 23) : i + 1].dropna()
            value = mine.iloc[i][["beta_a", "beta_b"]].astype(float).to_numpy()
            if i + 1 < w or len(frame) < 7:
                assert np.isnan(value).all()
            else:
                x = np.column_stack([np.ones(len(frame)), frame[["a", "b"]]])
                assert np.allclose(value, np.linalg.lstsq(x, frame["r"], rcond=None)[0][1:])


def test_singular_window_is_null(spark):
    rows = [("t", dt.date(2000, 1, 1) + dt.timedelta(days=31 * i), float(i), 2.0 * i, float(i % 3)) for i in range(12)]
    df = spark.createDataFrame(rows, "ticker string, month_end date, a double, b double, r double")
    assert regression.rolling_ols(df, "r", ["a", "b"], min_obs=4).where("beta_a is not null").count() == 0


@pytest.mark.parametrize("p", [3, 14])
def test_grouped_and_nested_fits(spark, p):
    rng = np.random.default_rng(5)
    frames = []
    for g in range(3):
        x = rng.normal(size=(80, p))
        frame = pd.DataFrame(x, columns=[f"x{i}" for i in range(p)])
        frame["y"] = x[:, 0] * 2 + rng.normal(size=80)
        frame["g"] = g
        frames.append(frame)
    pdf = pd.concat(frames)
    df = spark.createDataFrame(pdf).repartition(5)
    xs = [f"x{i}" for i in range(p)]
    nested = regression.nested_models(df, ["g"], "y", xs, [1, 2, p]).toPandas()
    for g, part in pdf.groupby("g"):
        for m in (1, 2, p):
            x, y = part[xs[:m]].to_numpy(), part["y"].to_numpy()
            ssr = ((y - x @ np.linalg.lstsq(x, y, rcond=None)[0]) ** 2).sum()
            row = nested[(nested["g"] == g) & (nested["k"] == m)].iloc[0]
            n = len(y)
            assert row["ssr"] == pytest.approx(ssr)
            assert row["aic"] == pytest.approx(2 * m + n * (np.log(2 * np.pi * ssr / n) + 1))
            assert row["bic"] == pytest.approx(m * np.log(n) + n * (np.log(2 * np.pi * ssr / n) + 1))
            assert row["adj_r2"] == pytest.approx(1 - n / (n - m) * ssr / (y @ y))


def test_bic_keeps_the_true_model_most_often(spark):
    rng = np.random.default_rng(11)
    frames = []
    for g in range(60):
        x = rng.normal(size=(100, 8))
        frame = pd.DataFrame(x, columns=[f"x{i}" for i in range(8)])
        frame["y"] = 0.05 * x[:, :5].sum(axis=1) + rng.normal(size=100)
        frame["g"] = g
        frames.append(frame)
    df = spark.createDataFrame(pd.concat(frames))
    models = regression.nested_models(df, ["g"], "y", [f"x{i}" for i in range(8)], [5, 6, 7, 8])
    for row in regression.selection_frequency(models, ["g"], 5).collect():
        assert row["freq_bic"] >= row["freq_aic"] >= row["freq_adj_r2"]


def lloyd(x, centroids, rounds=100):
    c = np.array(centroids, dtype=float)
    for _ in range(rounds):
        label = ((x[:, None, :] - c[None]) ** 2).sum(axis=2).argmin(axis=1)
        new = np.array([x[label == j].mean(axis=0) if (label == j).any() else c[j] for j in range(len(c))])
        if np.array_equal(new, c):
            break
        c = new
    return ((x[:, None, :] - c[None]) ** 2).sum(axis=2).argmin(axis=1)


def test_seeded_clusters_equal_plain_lloyd(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"g": np.repeat([1, 2], 60), "id": range(120), "a": rng.normal(size=120), "b": rng.normal(size=120)})
    seeds = [[-1.0, 0.0], [0.0, 0.0], [1.0, 1.0], [90.0, 90.0]]  # the last one stays empty
    got = clusters.kmeans_grouped(spark.createDataFrame(pdf), ["g"], ["a", "b"], "id", start=seeds).toPandas()
    for g, part in pdf.groupby("g"):
        mine = got[got["g"] == g].sort_values("id")["cluster"].to_numpy()
        assert (mine == lloyd(part[["a", "b"]].to_numpy(), seeds)).all()
        assert 3 not in mine


def test_hashed_start_is_stable_and_small_groups_work(spark):
    df = spark.createDataFrame([(1, i, float(i)) for i in range(30)] + [(2, 1, 5.0), (2, 2, 6.0)], "g int, id int, a double")
    runs = []
    for n in (1, 5):
        points = df.withColumn("c", F.col("a")).repartition(n)
        runs.append(clusters.kmeans_grouped(points, ["g"], ["a", "c"], "id").orderBy("g", "id").collect())
    one, two = runs
    assert one == two and len(one) == 32


def inertia(part):
    return sum(((x.to_numpy() - x.to_numpy().mean(axis=0)) ** 2).sum() for _, x in part.groupby("cluster")[["a", "b"]])


def test_restarts_never_cost_more_than_a_single_start(spark):
    rng = np.random.default_rng(11)
    frames = [pd.DataFrame({"g": g, "id": range(60), "a": rng.normal(rng.integers(0, 6, 60), 0.4), "b": rng.normal(rng.integers(0, 3, 60), 0.4)}) for g in range(4)]
    df = spark.createDataFrame(pd.concat(frames))
    many = clusters.kmeans_grouped(df, ["g"], ["a", "b"], "id", k=5, restarts=6).toPandas()
    assert sorted(many.columns) == ["a", "b", "cluster", "g", "id"] and len(many) == 240
    points = df.select("g", "id", F.array("a", "b").alias("x"))
    gained = 0
    for run in range(6):
        start = clusters.hashed_start(points.withColumn("_run", F.lit(run)), ["g", "_run"], "id", 5, "_run")
        for row in start.collect():
            own = frames[row["g"]]
            label = lloyd(own[["a", "b"]].to_numpy(), row["centroids"], 1000)
            single = inertia(own.assign(cluster=label))
            best = inertia(many[many["g"] == row["g"]])
            assert best <= single + 1e-9
            gained += best < single - 1e-9
    assert gained > 0
    with pytest.raises(RuntimeError):
        clusters.kmeans_grouped(df, ["g"], ["a", "b"], "id", k=5, max_iter=1)


def sharpe(w, mu, cov, rf=0.02):
    return (w @ (mu - rf)) / np.sqrt(w @ cov @ w)


@pytest.mark.parametrize("seed", range(4))
def test_no_transfer_improves_sharpe(seed):
    rng = np.random.default_rng(seed)
    n = 15
    x = rng.normal(0.0004, 0.01, (252, n)) @ (np.eye(n) + 0.2)
    mu, cov = x.mean(axis=0) * 252, np.cov(x.T) * 252
    low, high = round(1 / (2 * n), 3), 0.1 + 0.3 * (seed % 2)
    w = portfolio.max_sharpe(mu, cov, low, high)
    assert w.sum() == pytest.approx(1) and w.min() >= low - 1e-9 and w.max() <= high + 1e-9
    base = sharpe(w, mu, cov)
    assert base >= sharpe(np.full(n, 1 / n), mu, cov)
    for i in range(n):
        for j in range(n):
            moved = w.copy()
            moved[i] += 1e-4
            moved[j] -= 1e-4
            if i != j and moved[i] <= high and moved[j] >= low:
                assert sharpe(moved, mu, cov) <= base + 1e-6


def test_infeasible_cap_gives_equal_weights(spark):
    days = [dt.date(2000, 1, 1) + dt.timedelta(days=i) for i in range(60)]
    rng = np.random.default_rng(1)
    reb = dt.date(2001, 1, 1)
    held = [(reb, f"t{k}") for k in range(9)]
    rets = [(reb, d, t, float(rng.normal(0.002, 0.01))) for _, t in held for d in days]
    h = spark.createDataFrame(held, "rebalance_date date, ticker string")
    r = spark.createDataFrame(rets, "rebalance_date date, date date, ticker string, ret double")
    nine = portfolio.max_sharpe_weights(h, r, upper=0.1).toPandas()
    assert (nine["method"] == "equal").all() and np.allclose(nine["weight"], 1 / 9)
    wide = portfolio.max_sharpe_weights(h, r, upper=0.4).toPandas()
    assert (wide["method"] == "max_sharpe").all() and wide["weight"].sum() == pytest.approx(1, abs=1e-4)


@pytest.mark.parametrize("size", [1, 3, 64])
def test_covariance_by_blocks_matches_pandas(spark, size):
    """Pairs of names with different days, in blocks of any size; two dates at once."""
    rng = np.random.default_rng(4)
    days = [dt.date(2000, 1, 1) + dt.timedelta(days=i) for i in range(40)]
    rows, wanted = [], {}
    for reb, n in ((dt.date(2001, 1, 1), 7), (dt.date(2001, 2, 1), 4)):
        x = rng.normal(size=(40, n))
        x[:, 1:] = np.where(rng.random((40, n - 1)) < 0.3, np.nan, x[:, 1:])
        x[1:, n - 1] = np.nan  # one day only
        x[:, 2] = np.where(np.arange(40) < 39, x[:, 2], np.nan)
        rows += [(reb, d, f"t{k}", float(x[i, k])) for i, d in enumerate(days) for k in range(n) if not np.isnan(x[i, k])]
        cov = pd.DataFrame(x).cov(min_periods=2) * 252
        wanted |= {(reb, f"t{i}", f"t{j}"): cov.iloc[i, j] for i in range(n) for j in range(i, n) if not np.isnan(cov.iloc[i, j])}
    r = spark.createDataFrame(rows, "rebalance_date date, date date, ticker string, ret double")
    found = portfolio.lookback_covariance(r, size)
    assert "Python" not in found._jdf.queryExecution().toString()
    got = {(c["rebalance_date"], c["ticker_i"], c["ticker_j"]): c["cov"] for c in found.collect()}
    assert set(got) == set(wanted) and np.allclose([got[k] for k in wanted], list(wanted.values()))


def test_covariance_of_five_thousand_names(spark):
    """No limit on names: all pairs of a wide date, against sums over the dense matrix."""
    n, days = 5000, 4
    rows = spark.range(n * days).select(
        F.lit(dt.date(2001, 1, 1)).alias("rebalance_date"), F.date_add(F.lit(dt.date(2000, 1, 1)), (F.col("id") % days).cast("int")).alias("date"),
        F.format_string("t%05d", (F.col("id") / days).cast("long")).alias("ticker"), (F.pmod(F.xxhash64("id"), F.lit(1000)) / 1e5).alias("ret"))
    x = np.array(rows.orderBy("ticker", "date").select("ret").collect()).reshape(n, days).T
    cov = np.cov(x.T) * 252
    total = portfolio.lookback_covariance(rows, 256).agg(
        F.count("cov"), F.sum("cov"), F.sum(F.when(F.col("ticker_i") == F.col("ticker_j"), F.col("cov")))).first()
    assert total[0] == n * (n + 1) // 2
    assert total[1] == pytest.approx(np.triu(cov).sum(), rel=1e-9) and total[2] == pytest.approx(np.trace(cov), rel=1e-9)


def test_weights_equal_a_solve_on_the_dense_matrix(spark):
    rng = np.random.default_rng(9)
    days = [dt.date(2000, 1, 1) + dt.timedelta(days=i) for i in range(60)]
    rows, held, wanted = [], [], {}
    for reb, n in ((dt.date(2001, 1, 1), 90), (dt.date(2001, 2, 1), 12)):
        names = [f"t{k:03d}" for k in range(n)]
        x = rng.normal(0.002, 0.01, (60, n))
        held += [(reb, t) for t in names]
        rows += [(reb, d, t, float(x[i, k])) for i, d in enumerate(days) for k, t in enumerate(names)]
        mu = np.exp(np.log1p(x).sum(axis=0) * 252 / 60) - 1
        wanted |= dict(zip(((reb, t) for t in names), portfolio.cleaned(portfolio.max_sharpe(mu, np.cov(x.T) * 252, round(1 / (2 * n), 3), 0.2))))
    held.append((dt.date(2001, 3, 1), "lonely"))  # without a lookback
    h = spark.createDataFrame(held, "rebalance_date date, ticker string")
    r = spark.createDataFrame(rows, "rebalance_date date, date date, ticker string, ret double")
    got = {(w["rebalance_date"], w["ticker"]): (w["weight"], w["method"]) for w in portfolio.max_sharpe_weights(h, r, upper=0.2).collect()}
    assert got.pop((dt.date(2001, 3, 1), "lonely")) == (1.0, "equal")
    assert set(got) == set(wanted) and all(m == "max_sharpe" for _, m in got.values())
    assert np.allclose([got[k][0] for k in wanted], list(wanted.values()), atol=1e-4)


def noise_series(spark, n=400, seed=8, phi=0.6):
    rng = np.random.default_rng(seed)
    y = [0.0]
    for _ in range(n - 1):
        y.append(phi * y[-1] + rng.normal() + 1)
    rows = [("s", dt.datetime(2001, 1, 1) + dt.timedelta(days=i), float(v)) for i, v in enumerate(y)]
    return spark.createDataFrame(rows, "series_id string, ts timestamp_ntz, y double"), np.array(y)


def test_adf_statistic_matches_direct_regression(spark):
    df, y = noise_series(spark)
    row = diagnostics.adf(df, max_lag=3).first()
    k = row["lags"]
    d = np.diff(y)
    t = np.arange(k, len(d))  # the chosen lag is fitted on all rows that it leaves
    x = np.column_stack([np.ones(len(t)), y[t], *[d[t - i] for i in range(1, k + 1)]])
    beta = np.linalg.lstsq(x, d[t], rcond=None)[0]
    s2 = ((d[t] - x @ beta) ** 2).sum() / (len(t) - x.shape[1])
    assert row["nobs"] == len(t)
    assert row["stat"] == pytest.approx(beta[1] / np.sqrt(s2 * np.linalg.inv(x.T @ x)[1, 1]), rel=1e-6)
    assert row["reject_5pct"]


def test_adf_of_a_series_does_not_depend_on_others(spark):
    df, _ = noise_series(spark)
    short = df.orderBy("ts").limit(60)
    rng = np.random.default_rng(5)
    walk = np.cumsum(rng.normal(size=4000))
    days = pd.date_range("1990-01-01", periods=4000)
    long = spark.createDataFrame([("walk", d.to_pydatetime(), float(v)) for d, v in zip(days, walk)], df.schema)
    alone = diagnostics.adf(short).first()
    both = {r["series_id"]: r for r in diagnostics.adf(short.unionByName(long)).collect()}
    mine = both[alone["series_id"]]
    assert (mine["lags"], mine["nobs"], mine["reject_5pct"]) == (alone["lags"], alone["nobs"], alone["reject_5pct"])
    assert mine["stat"] == pytest.approx(alone["stat"], rel=1e-9) and alone["p_value"] == pytest.approx(mine["p_value"])
    assert not both["walk"]["reject_5pct"] and both["walk"]["p_value"] > 0.05


def test_unit_root_p_values():
    found = [diagnostics.unit_root_p_value(x) for x in (-3.43, -2.86, -2.57, 0.0, 3.0, -20.0)]
    assert np.allclose(found, [0.01, 0.05, 0.10, 0.9585, 1.0, 0.0], atol=1e-3)


def test_arima_forecast_does_not_depend_on_chunks(spark):
    df, y = noise_series(spark)
    fit = diagnostics.arima_fit(df, 2, 1, 1)
    runs = [
        diagnostics.arima_forecast(fit, 50, chunk=c).orderBy("step").toPandas()["forecast"].to_numpy() for c in (7, 1000)
    ]
    assert len(runs[0]) == 50 and np.allclose(runs[0], runs[1])
    ar = diagnostics.arima_fit(df, 1, 0, 0).first()
    x = np.column_stack([np.ones(len(y) - 6), y[5:-1]])
    assert np.allclose(ar["coef"], np.linalg.lstsq(x, y[6:], rcond=None)[0])


def test_order_search_agrees_with_single_fit(spark):
    df, _ = noise_series(spark)
    table = diagnostics.order_search(df, [0, 1, 2], [0], [0, 2]).toPandas()
    one = diagnostics.arima_fit(df, 2, 0, 2).first()
    row = table[(table["p"] == 2) & (table["q"] == 2)].iloc[0]
    assert row["aic"] == pytest.approx(one["aic"]) and row["n"] == one["n"]


def best_variance(r):
    """Best (alpha, beta) and the next variance of one window, by a plain loop."""
    best, s2 = None, r.var()
    for x in intraday.ALPHAS:
        for z in intraday.BETAS:
            if x + z >= 1:
                continue
            h, loss = s2, 0.0
            for e in r:
                loss += np.log(h) + e * e / h
                h = s2 * (1 - x - z) + x * e * e + z * h
            if best is None or loss < best[0]:
                best = (loss, x, z, h)
    return best[1:]


@pytest.mark.parametrize("block", [7, 40, 1024])
def test_garch_grid_matches_plain_loop(spark, block):
    rng = np.random.default_rng(0)
    window, days = 30, [dt.date(2000, 1, 1) + dt.timedelta(days=i) for i in range(90)]
    series = {"a": rng.normal(0, 0.02, 90), "b": np.where(np.arange(90) < 60, 0.01, rng.normal(0, 0.01, 90)), "c": rng.normal(0, 1, 29)}
    rows = [(k, d, None if (k, i) == ("a", 0) else float(r), k) for k, x in series.items() for i, (d, r) in enumerate(zip(days, x))]
    df = spark.createDataFrame(rows, "asset string, date date, ret double, other string").repartition(3)
    out = intraday.garch_forecast(df, window, block=block)
    assert out.columns == ["asset", "date", "ret", "other", "alpha", "beta", "variance"]
    got = {(r["asset"], r["date"]): r for r in out.collect()}
    assert len(got) == 90 - window + 90 - window + 1
    for k in "ab":
        for i in range(window if k == "a" else window - 1, 90):
            r, w = got[k, days[i]], series[k][i - window + 1 : i + 1]
            if w.var() < 1e-30:  # no spread: rounding decides whether the variance is a true zero
                assert r["alpha"] is None or r["variance"] < 1e-3
                continue
            alpha, beta, variance = best_variance(w)
            assert (r["alpha"], r["beta"]) == (alpha, beta) and r["variance"] == pytest.approx(variance)


def test_windows_are_not_copied_to_other_tasks(spark):
    """Rows that are exchanged for the fit: each return once, and again only before the next block."""
    rows = spark.range(3000).select(F.lit("a").alias("asset"), F.date_add(F.lit(dt.date(2000, 1, 1)), F.col("id").cast("int")).alias("date"), (F.rand(1) - 0.5).alias("ret"))
    n, window, block = 3000, 180, 1024
    dealt = sum(min(n, (b + 1) * block) - max(0, b * block - (window - 1)) for b in range(-(-n // block)))
    assert dealt <= n * (1 + (window - 1) / block)
    assert intraday.garch_forecast(rows, window, block=block, alphas=(0.05,), betas=(0.9,)).count() == n - window + 1


def test_fold_bounds():
    bounds = val.fold_bounds(1000, 5, 100, 24)
    assert bounds[0] == (476, 500, 600) and bounds[-1] == (876, 900, 1000)
    with pytest.raises(ValueError, match="no training rows"):
        val.fold_bounds(520, 5, 100, 24)


def test_importances_sum_to_one(spark):
    rows = [(float(i), float(i % 7), float(3 * (i % 7))) for i in range(200)]
    df = val.assemble(spark.createDataFrame(rows, "a double, b double, y double"), ["a", "b"])
    table = val.importances(val.forest(trees=3, depth=3).fit(df), ["a", "b"]).toPandas().set_index("feature")
    assert table["importance"].sum() == pytest.approx(1) and table.loc["b", "importance"] > 0.9


def test_round_of_all_groups_equals_assign_and_update(spark):
    """Also with empty clusters, which keep their centroid; the vectors are summed before anything is shuffled."""
    rng = np.random.default_rng(12)
    rows = [(int(i % 3), i, "ab"[i % 2], rng.normal(size=30).tolist()) for i in range(200)]
    points = spark.createDataFrame(rows, "g int, id long, h string, x array<double>").repartition(3)
    state = clusters.hashed_start(points, ["g", "h"], "id", 4).withColumn(
        "centroids", F.concat(F.slice("centroids", 1, 3), F.array(F.array_repeat(F.lit(99.0), 30)))).localCheckpoint()
    old = clusters.update(clusters.assign(points, state, ["g", "h"]), state, ["g", "h"], 4, 30)
    new = clusters.moved(points, state, ["g", "h"], 4, 30)
    a, b = ({(r["g"], r["h"]): r for r in df.collect()} for df in (old, new))
    assert sorted(a) == sorted(b) and len(a) == 6
    for key in a:
        np.testing.assert_allclose(a[key]["centroids"], b[key]["centroids"], rtol=1e-12)
        assert a[key]["_old"] == b[key]["_old"] and b[key]["centroids"][3] == [99.0] * 30
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert plan.index("collect_list") < plan.index("MapInArrow")


def test_rows_of_a_replicate_stand_together_before_they_are_summed(spark, monkeypatch):
    from marketseries.sources import stand_ins as src

    rows = src.wide_replicates(spark, "/root/testdata/sf0.001", [f"z{i}" for i in range(1, 51)])
    plan = regression.gram_tiles(rows, ["rep"], ["y", "z1", "z50"], 3)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("partial_sum") :]
    assert "_share" in below[below.index("hashpartitioning(rep") :][:60]
    monkeypatch.setattr(src, "NEAR_ROWS", 100)
    many = src.wide_replicates(spark, "/root/testdata/sf0.001", ["z1"])
    assert many.count() == rows.count()
