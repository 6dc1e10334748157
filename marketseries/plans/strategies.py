"""Whole strategies and forecasts, end to end."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketseries.functions import metrics, scalar
from marketseries.operators import backtest, clusters, diagnostics, ensembles, features, forecast, intraday, portfolio
from marketseries.operators import indicators as ind
from marketseries.operators import regression
from marketseries.operators import validation as val
from marketseries.operators.blocks import index_series
from marketseries.session import cut_lineage
from marketseries.plans import models
from marketseries.plans.basics import HELD, HOLDINGS, TYPES, daily_log_returns, engagement_holdings
from marketseries.plans.registry import query, r, rounded, sql
from marketseries.plans.series import (
    GARMAN_SQL, NUMBERED, atr_sql, bands_sql, benchmark_returns, horizon_sql, macd_sql, rsi_sql,
)
from marketseries.sources import stand_ins as src

BENCH = """bret AS (SELECT * FROM (
  SELECT date, ln(adj_close) - ln(lag(adj_close) OVER (ORDER BY date)) AS benchmark_return FROM bench)
  WHERE benchmark_return IS NOT NULL)"""


def compound_sql(col: str) -> str:
    return f"""CASE WHEN {col} > -1 THEN
       exp(sum(CASE WHEN {col} > -1 THEN ln(1 + {col}) ELSE 0 END) OVER (ORDER BY date)) - 1 END"""


@query("engagement_rotation", sql(f"""
SELECT date, {r('portfolio_return')} AS portfolio_return, {r('benchmark_return')} AS benchmark_return,
       {r(compound_sql('portfolio_return'))} AS strategy_cum, {r(compound_sql('benchmark_return'))} AS benchmark_cum
FROM (SELECT date, avg(ret) AS portfolio_return FROM held GROUP BY date) JOIN bret USING (date)""",
    "bars", "sentiment", "bench", extra=[HOLDINGS, HELD, BENCH]))
def engagement_rotation(spark, root):
    """Each month hold the five names of the highest comment-to-like ratio; compounded against the benchmark."""
    held = engagement_holdings(spark, root)
    daily = backtest.equal_weight_returns(held, daily_log_returns(spark, root))
    out = backtest.compare_benchmark(daily, benchmark_returns(spark, root))
    return rounded(out.select("date", "portfolio_return", "benchmark_return", "strategy_cum", "benchmark_cum"))


UNIVERSE = 16
TARGETS = (47, 49, 51, 53)  # the stand-in prices hardly trend, so their oscillator stays near 50
_DAILY = "bars b JOIN rsi USING (ticker, date) JOIN atr USING (ticker, date) JOIN macd USING (ticker, date)"
_LAST = ("garman_klass", "rsi", "bb_low", "bb_mid", "bb_high", "atr", "macd")
_PANEL = [
    NUMBERED, rsi_sql("numbered", "rsi"), atr_sql("numbered", "atr"), macd_sql("numbered", "macd"),
    f"daily AS (SELECT b.*, rsi, atr, macd, {GARMAN_SQL} AS garman_klass, {bands_sql('bars', 0, 'bb', None)} FROM {_DAILY})",
    f"""agg AS (
  SELECT ticker, last_day(date) AS month_end, avg(adj_close * volume / 1e6) AS dollar_volume, arg_max(adj_close, date) AS adj_close,
         {', '.join(f'arg_max({c}, date) FILTER (WHERE {c} IS NOT NULL) AS {c}' for c in _LAST)}
  FROM daily GROUP BY 1, 2),
complete AS (
  SELECT *, dense_rank() OVER (ORDER BY month_end) AS grid FROM agg WHERE {' AND '.join(f'{c} IS NOT NULL' for c in _LAST)}),
rolled AS (
  SELECT * EXCLUDE (dollar_volume, grid), CASE WHEN count(*) OVER w >= 12 THEN avg(dollar_volume) OVER w END AS liquidity
  FROM complete WINDOW w AS (PARTITION BY ticker ORDER BY grid RANGE BETWEEN 59 PRECEDING AND CURRENT ROW)),
liquid AS (
  SELECT * EXCLUDE (liquidity, rk) FROM (
    SELECT *, rank() OVER (PARTITION BY month_end ORDER BY liquidity DESC)
              + (count(*) OVER (PARTITION BY month_end, liquidity) - 1) / 2.0 AS rk
    FROM rolled WHERE liquidity IS NOT NULL)
  WHERE rk < {UNIVERSE})""",
    horizon_sql("liquid", "panel"),
]


@query("monthly_feature_panel", sql(f"""
SELECT ticker, month_end, adj_close, {', '.join(f'{r(c, 5)} AS {c}' for c in (*_LAST, *features.RETURNS))}
FROM panel WHERE {' AND '.join(f'{c} IS NOT NULL' for c in features.RETURNS)}""", "bars", extra=_PANEL))
def monthly_feature_panel(spark, root):
    return rounded(features.monthly_feature_panel(src.bars(spark, root), UNIVERSE), 5)


@query("momentum_cluster_backtest")
def momentum_cluster_backtest(spark, root):
    """Monthly features and betas, seeded clusters, the high-momentum cluster held at best Sharpe weights."""
    bars = cut_lineage(src.bars(spark, root), "bars")
    table = features.with_factor_betas(
        features.monthly_feature_panel(bars, UNIVERSE), src.factors(spark, root)
    )
    names = features.CLUSTER_FEATURES
    labelled = clusters.kmeans_grouped(table, ["month_end"], names, "ticker", start=features.momentum_seeds(targets=TARGETS))
    held = cut_lineage(backtest.hold_next_month(labelled.where(F.col("cluster") == 3)), "holdings")
    looked = portfolio.lookback_returns(portfolio.lookback_prices(held, bars))
    weights = cut_lineage(portfolio.max_sharpe_weights(held, looked, upper=0.4), "weights")
    returns = ind.apply_indicators(index_series(bars, ["ticker"], "date"), [ind.log_return()])
    daily = backtest.weighted_returns(weights, returns)
    out = backtest.compare_benchmark(daily, benchmark_returns(spark, root))
    return rounded(out.select("date", "portfolio_return", "benchmark_return", "strategy_cum", "benchmark_cum"))


def _index(spark, root):
    return src.benchmark_prices(spark, root).select("date", F.col("adj_close").alias("close"))


_FEATURE_NAMES = [f"{t}_{c}" for t in TYPES for c in features.DIRECTION]
_INPUTS = [*_FEATURE_NAMES, "index_lag"]


def direction_windows(spark, root):
    """Scaled five-row windows of all tickers' features, 60/20/20 by time."""
    table = features.direction_features(src.bars_by_type(spark, root), _index(spark, root), TYPES)
    table = cut_lineage(table, "direction")  # read for the split, the scaler and the windows
    parts = forecast.fraction_split(table, [], "date", {"train": 0.6, "valid": 0.8, "test": 1.0})
    stats = forecast.scaler_fit(parts.where(F.col("split") == "train"), _INPUTS)
    scaled = forecast.scale(parts, stats, _INPUTS)
    return forecast.sliding_windows(scaled, ["split"], "date", _INPUTS, "next_rise")


def _dir_feature(c: str) -> str:
    if c.startswith("ma_"):
        n = int(c[3:])
        frame = f"(PARTITION BY ticker ORDER BY date ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
        return f"CASE WHEN count(*) OVER {frame} = {n} THEN avg(close) OVER {frame} END AS {c}"
    if c.startswith("bb_"):
        frame = "(PARTITION BY ticker ORDER BY date ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)"
        k = {"low": -2, "mid": 0, "high": 2}[c[3:]]
        return (f"CASE WHEN count(*) OVER {frame} = 20 THEN avg(ln(1 + close)) OVER {frame} "
                f"+ {k} * stddev_pop(ln(1 + close)) OVER {frame} END AS {c}")
    return {"rsi": "rsi", "volume_lag": "lag(volume) OVER (PARTITION BY ticker ORDER BY date) AS volume_lag"}[c]


_DIRECTION = [
    NUMBERED.replace("FROM bars", "FROM bars_type"), rsi_sql("numbered", "rsi"),
    f"feats AS (SELECT ticker, date, {', '.join(_dir_feature(c) for c in features.DIRECTION)} FROM bars_type JOIN rsi USING (ticker, date))",
    "wide AS (SELECT date, " + ", ".join(
        f"max({c}) FILTER (WHERE ticker = '{t}') AS {t}_{c}" for t in TYPES for c in features.DIRECTION
    ) + " FROM feats GROUP BY date)",
    """own AS (SELECT date, lag(adj_close) OVER w AS index_lag,
                CASE WHEN lead(adj_close) OVER w > adj_close THEN 1 ELSE 0 END AS next_rise FROM bench WINDOW w AS (ORDER BY date))""",
    "whole AS (SELECT *, row_number() OVER (ORDER BY date) - 1 AS pos, count(*) OVER () AS n FROM wide JOIN own USING (date) WHERE "
    + " AND ".join(f"{c} IS NOT NULL" for c in _INPUTS) + ")",
    "parted AS (SELECT *, CASE WHEN pos < floor(0.6 * n) THEN 'train' WHEN pos < floor(0.8 * n) THEN 'valid' ELSE 'test' END AS split FROM whole)",
    "fit AS (SELECT " + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _INPUTS) + " FROM parted WHERE split = 'train')",
    "scaled AS (SELECT date, split, next_rise, " + ", ".join(f"({c} - m_{c}) / s_{c} AS {c}" for c in _INPUTS) + " FROM parted, fit)",
]


@query("index_direction_dataset", sql(f"""
SELECT split, date, {len(_INPUTS)} * 5 AS n_values, {r('total')} AS total, {r('first_index')} AS first_index,
       {r('last_rsi')} AS last_rsi, next_rise AS label
FROM (
  SELECT split, date, next_rise, count(*) OVER w AS seen, sum({' + '.join(_INPUTS)}) OVER w AS total,
         lag(index_lag, 5) OVER v AS first_index, lag(ECONOMY_rsi) OVER v AS last_rsi
  FROM scaled WINDOW w AS (PARTITION BY split ORDER BY date ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING),
                     v AS (PARTITION BY split ORDER BY date))
WHERE seen = 5""", "bars_type", "bench", extra=_DIRECTION))
def index_direction_dataset(spark, root):
    out = direction_windows(spark, root).withColumn("flat", F.flatten("x"))
    return rounded(out.select(
        "split", "date", F.size("flat").alias("n_values"),
        F.aggregate("flat", F.lit(0.0), lambda a, v: a + v).alias("total"),
        F.get("flat", F.lit(len(_INPUTS) - 1)).alias("first_index"),
        F.get("flat", F.lit(4 * len(_INPUTS) + _INPUTS.index("ECONOMY_rsi"))).alias("last_rsi"),
        "label",
    ))


@query("index_direction_backtest")
def index_direction_backtest(spark, root):
    """Perceptron or logistic model, by accuracy on the validation part, and its long/short returns on the last fifth.

    Every row also carries which was chosen, and the accuracy and confusion matrix over the last fifth.
    """
    windows = cut_lineage(forecast.flatten_windows(direction_windows(spark, root)).drop("x"), "windows")
    train, valid, test = (windows.where(F.col("split") == s) for s in ("train", "valid", "test"))
    candidates = [val.window_classifier(5 * len(_INPUTS)), val.direction_baseline()]
    model, _, best = val.fit_best(train, valid, candidates)
    scored = model.transform(test).select("date", "label", scalar.positive_class().alias("pred"))
    preds = cut_lineage(scored, "predictions")
    out = backtest.signal_backtest(preds.join(_index(spark, root), "date"), "pred", "close")
    counted = preds.withColumn("pred", F.col("pred").cast("int"))
    right = counted.agg(metrics.accuracy("label", "pred")).first()[0]
    report = {"chosen": ("perceptron", "logistic")[best], "accuracy": right, **metrics.confusion(counted, "label", "pred").first().asDict()}
    return rounded(out.select("date", "pred", "label", "market_return", "strategy_return", "market_cum", "strategy_cum",
                              *[F.lit(v).alias(k) for k, v in report.items()]))


@query("load_feature_table", sql(f"""
SELECT k.ts, {r('k.y', 4)} AS y, CAST(hour(k.ts) AS INTEGER) AS hour, CAST(isodow(k.ts) - 1 AS INTEGER) AS dayofweek,
       CAST(quarter(k.ts) AS INTEGER) AS quarter, CAST(month(k.ts) AS INTEGER) AS month, CAST(year(k.ts) AS INTEGER) AS year,
       CAST(dayofyear(k.ts) AS INTEGER) AS dayofyear, {', '.join(f'{r(f"a{i}.y", 4)} AS lag{i}' for i in (1, 2, 3))},
       CASE WHEN k.ts < TIMESTAMP '2000-01-01' THEN 'train' ELSE 'test' END AS split
FROM kept k {' '.join(f"JOIN kept a{i} ON a{i}.ts = k.ts - INTERVAL {d} DAY" for i, d in ((1, 364), (2, 728), (3, 1092)))}""",
    "load_daily", extra=["kept AS (SELECT * FROM load_daily WHERE y > 1e5)"]))
def load_feature_table(spark, root):
    out = forecast.time_split(models.load_table(spark, root), models.HOLDOUT)
    return rounded(out.select("ts", "y", *scalar.CALENDAR, *models.YEAR_LAGS, "split"), 4)


@query("hourly_feature_table", sql(f"""
SELECT k.ts, {r('k.y', 4)} AS y, {', '.join(f'{r(f"a{i}.y", 4)} AS lag{i}' for i in (1, 2, 3))}
FROM kept k {' '.join(f"JOIN kept a{i} ON a{i}.ts = k.ts - INTERVAL {7 * i} DAY" for i in (1, 2, 3))}""",
    "load_hourly", extra=["kept AS (SELECT * FROM load_hourly WHERE y > 100)"]))
def hourly_feature_table(spark, root):
    out = features.load_features(src.load_hourly(spark, root), 100, {"lag1": 7, "lag2": 14, "lag3": 21})
    return rounded(out.select("ts", "y", "lag1", "lag2", "lag3"), 4)


@query("load_forecast_tuned")
def load_forecast_tuned(spark, root):
    """Folds, the whole grid, refit on all training rows; all hold-out rows and their MAPE."""
    scored = cut_lineage(models.forest_holdout(spark, root), "holdout")
    error = scored.agg(metrics.mape("y", "prediction").alias("mape"))
    return rounded(scored.withColumn("mape", error.scalar()), 4)


@query("load_forecast_simple")
def load_forecast_simple(spark, root):
    """Calendar features only; predictions joined back to the whole series with the hold-out RMSE."""
    load = forecast.above(src.load_daily(spark, root), "y", 1e5)
    train, valid, test = models.by_cuts(spark, root, scalar.CALENDAR, scalar.calendar_features(load))
    model, _ = ensembles.boosted_checkpoint(train, valid, val.boosted_trees(trees=models.ROUNDS, rate=models.RATE, depth=6))
    preds = model.transform(test).select("series_id", "ts", "y", "prediction")
    error = preds.agg(metrics.rmse("y", "prediction").alias("rmse"))
    joined = load.join(preds.drop("y"), ["series_id", "ts"], "left")
    return rounded(joined.withColumn("rmse", error.scalar()).select("ts", "y", "prediction", "rmse"), 2)


@query("load_window_forecast")
def load_window_forecast(spark, root):
    """Five scaled values to the next; the error is taken after undoing the scale."""
    model, _, test, stats = models.window_models(spark, root)
    scored = forecast.unscale(
        model.transform(test).select("ts", "label", "prediction"), stats, {"label": "y", "prediction": "y"}
    )
    error = scored.agg(metrics.mape("label", "prediction").alias("mape"))
    return rounded(scored.withColumn("mape", error.scalar()), 4)


def holdout_forecasts(train, test, best):
    """Forecasts of every hold-out row by its series' chosen order (``b``), and the MAPE of each series.

    One pass for each order that any series chose; there are no more than orders tried.
    """
    test = cut_lineage(index_series(test, ["series_id"], "ts").withColumn("step", (F.col("pos") + 1).cast("int")), "holdout")
    longest = test.agg(F.max("step")).first()[0] or 0
    found = None
    for r in best.select("b.p", "b.d", "b.q").distinct().collect():
        own = best.where((F.col("b.p") == r["p"]) & (F.col("b.d") == r["d"]) & (F.col("b.q") == r["q"])).select("series_id")
        fit = diagnostics.arima_fit(train.join(own, "series_id", "left_semi"), r["p"], r["d"], r["q"])
        ahead = diagnostics.arima_forecast(fit, longest) if longest else fit.select("series_id", F.lit(0).alias("step"), F.lit(0.0).alias("forecast")).limit(0)
        found = ahead if found is None else found.unionByName(ahead)
    steps = cut_lineage(test.join(found, ["series_id", "step"]).select("series_id", "ts", "step", "y", "forecast"), "forecasts")
    return steps, steps.groupBy("series_id").agg(metrics.mape("y", "forecast").alias("mape"))


@query("stationarity_report")
def stationarity_report(spark, root):
    """Unit-root test, forty (partial) autocorrelations, the best ARIMA order and its forecast of the hold-out.

    The unit-root test says whether the series is differenced; the other orders are chosen by AIC for that one, as
    criteria of different data can't be compared. Forecasts are rows by step, with the hold-out's MAPE.
    """
    train = models.train_load(spark, root)
    test = cut_lineage(diagnostics.adf(train), "unit-root")
    orders = diagnostics.order_search(train, range(6), [0, 1], range(3))
    orders = orders.join(test.select("series_id", F.when(F.col("reject_5pct"), 0).otherwise(1).alias("d")), ["series_id", "d"])
    best = orders.groupBy("series_id").agg(F.min_by(F.struct("p", "d", "q", "aic"), "aic").alias("b"))
    best = cut_lineage(best, "orders")
    steps, error = holdout_forecasts(train, models.test_load(spark, root), best)
    parts = [
        test.select(F.explode(F.array(
            F.struct(F.lit("adf_stat").alias("name"), F.lit(0).alias("lag"), F.col("stat").alias("value")),
            F.struct(F.lit("adf_lags").alias("name"), F.lit(0).alias("lag"), F.col("lags").cast("double").alias("value")),
            F.struct(F.lit("adf_p_value").alias("name"), F.lit(0).alias("lag"), F.col("p_value").alias("value")),
            F.struct(F.lit("adf_reject").alias("name"), F.lit(0).alias("lag"), F.col("reject_5pct").cast("double").alias("value")),
        ))).select("col.*"),
        diagnostics.acf(train, 40).select(F.lit("acf").alias("name"), "lag", F.col("acf").alias("value")),
        diagnostics.pacf(train, 40).select(F.lit("pacf").alias("name"), "lag", F.col("pacf").alias("value")),
        best.select(F.explode(F.array(*[
            F.struct(F.lit(f"best_{k}").alias("name"), F.lit(0).alias("lag"), F.col(f"b.{k}").cast("double").alias("value"))
            for k in ("p", "d", "q", "aic")
        ]))).select("col.*"),
        steps.select(F.lit("forecast").alias("name"), F.col("step").alias("lag"), F.col("forecast").alias("value")),
        error.select(F.lit("holdout_mape").alias("name"), F.lit(0).alias("lag"), F.col("mape").alias("value")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return rounded(out, 4)


@query("model_selection_report")
def model_selection_report(spark, root):
    """How often each criterion keeps the five-column model against every larger one, and the mean criteria."""
    nested = models.wide_models(spark, root)
    share = regression.selection_frequency(nested, ["rep"], 5)
    means = nested.groupBy(F.col("k").alias("m")).agg(
        F.avg("adj_r2").alias("mean_adj_r2"), F.avg("aic").alias("mean_aic"), F.avg("bic").alias("mean_bic")
    )
    return rounded(share.join(means, "m"), 4)


@query("intraday_mean_reversion")
def intraday_mean_reversion(spark, root):
    """Variance forecast, premium signal of the previous session, first agreeing tick, held to the close.

    The tables hold thirty days, so a session is an hour here: all three windows of 180 sessions are full.
    """
    ticks = cut_lineage(models.ticks(spark, root), "ticks")
    daily = intraday.rolling_variance(models.daily_returns_of(ticks, "hour"), 180, every="day")
    daily = cut_lineage(intraday.garch_forecast(daily, 180, every="day").drop("pos", "n_obs"), "variance")
    daily_signal = intraday.premium_signal(daily, n=180, every="day")
    signals = intraday.intraday_signal(ticks, low=48, high=52)
    trades = intraday.first_signal_of_day(intraday.attach_previous_signal(signals, daily_signal, session="hour"))
    return rounded(trades.select("asset", "date", "entry_ts", "side", "entry_close", "exit_close", "trade_return"))
