"""Window, indicator and time-order queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketseries.functions import scalar
from marketseries.operators import backtest, forecast, panel
from marketseries.operators import indicators as ind
from marketseries.operators.blocks import index_series, running_sum
from marketseries.operators.regression import rolling_ols
from marketseries.operators.validation import forward_folds
from marketseries.plans.basics import HOLDINGS, MONTHLY, monthly_engagement, monthly_returns
from marketseries.plans.registry import query, r, r_col, rounded, sql
from marketseries.sources import stand_ins as src


def indexed_bars(spark, root, ticker="p_brand"):
    return index_series(src.bars(spark, root, ticker), ["ticker"], "date")


def indicate(spark, root, *chosen):
    return ind.apply_indicators(indexed_bars(spark, root), list(chosen)).drop("pos", "n_obs")


@query("shift_lag", sql("""
SELECT ticker, date, lag(close) OVER w AS close_lag, lag(volume) OVER w AS volume_lag, lag(close, 5) OVER w AS close_lag5
FROM bars WINDOW w AS (PARTITION BY ticker ORDER BY date)""", "bars"))
def shift_lag(spark, root):
    out = indicate(
        spark, root, ind.lagged({"close_lag": "close", "volume_lag": "volume"}), ind.lagged({"close_lag5": "close"}, 5)
    )
    return out.select("ticker", "date", "close_lag", "volume_lag", "close_lag5")


@query("shift_lead", sql("""
SELECT ticker, date, lead(close) OVER (PARTITION BY ticker ORDER BY date) AS close_next FROM bars""", "bars"))
def shift_lead(spark, root):
    return indicate(spark, root, ind.led({"close_next": "close"})).select("ticker", "date", "close_next")


@query("label_next_rise", sql("""
SELECT ticker, date, CASE WHEN lead(close) OVER (PARTITION BY ticker ORDER BY date) > close THEN 1 ELSE 0 END AS next_rise
FROM bars""", "bars"))
def label_next_rise(spark, root):
    return indicate(spark, root, ind.next_rise()).select("ticker", "date", "next_rise")


def _ma_sql(n: int) -> str:
    frame = f"(PARTITION BY ticker ORDER BY date ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
    return r(f"CASE WHEN count(close) OVER {frame} = {n} THEN avg(close) OVER {frame} END", 5) + f" AS ma_{n}"


@query("moving_average", sql(f"""
SELECT ticker, date, {', '.join(_ma_sql(n) for n in (20, 50, 100))} FROM bars""", "bars"))
def moving_average(spark, root):
    out = indicate(spark, root, ind.moving_average())
    return rounded(out.select("ticker", "date", "ma_20", "ma_50", "ma_100"), 5)


@query("rolling_mean_min_periods", sql(f"""
SELECT ticker, month_end, {r('CASE WHEN count(*) OVER w >= 12 THEN avg(dollar_volume) OVER w END')} AS dollar_volume
FROM (
  SELECT ticker, month_end, dollar_volume, dense_rank() OVER (ORDER BY month_end) AS grid
  FROM (SELECT ticker, last_day(date) AS month_end, avg(adj_close * volume / 1e6) AS dollar_volume FROM bars GROUP BY 1, 2))
WINDOW w AS (PARTITION BY ticker ORDER BY grid RANGE BETWEEN 59 PRECEDING AND CURRENT ROW)""", "bars"))
def rolling_mean_min_periods(spark, root):
    daily = src.bars(spark, root).withColumn("dollar_volume", scalar.dollar_volume())
    monthly = panel.monthly_mean(daily, ["ticker"], ["dollar_volume"])
    out = panel.rolling_months(monthly, "dollar_volume", 60, 12)
    return rounded(out.select("ticker", "month_end", "dollar_volume"))


@query("log_return", sql(f"""
SELECT ticker, date, {r('ln(adj_close) - ln(lag(adj_close) OVER (PARTITION BY ticker ORDER BY date))')} AS ret
FROM bars""", "bars"))
def log_return(spark, root):
    return rounded(indicate(spark, root, ind.log_return()).select("ticker", "date", "ret"))


HORIZONS = (1, 2, 3, 6, 9, 12)


def horizon_sql(source: str, out: str) -> str:
    lags = ", ".join(f"adj_close / lag(adj_close, {k}) OVER w - 1 AS r{k}" for k in HORIZONS)
    bounds = ", ".join(f"quantile_cont(r{k}, 0.005) AS lo{k}, quantile_cont(r{k}, 0.995) AS hi{k}" for k in HORIZONS)
    final = ", ".join(
        f"CASE WHEN r{k} IS NOT NULL THEN power(1 + greatest(least(r{k}, hi{k}), lo{k}), 1.0 / {k}) - 1 END AS returns_{k}m"
        for k in HORIZONS
    )
    return f"""{out}_raw AS (SELECT *, {lags} FROM {source} WINDOW w AS (PARTITION BY ticker ORDER BY month_end)),
{out}_lim AS (SELECT ticker, {bounds} FROM {out}_raw GROUP BY ticker),
{out} AS (SELECT {out}_raw.* EXCLUDE ({', '.join(f'r{k}' for k in HORIZONS)}), {final} FROM {out}_raw JOIN {out}_lim USING (ticker))"""


@query("multi_horizon_returns", sql(f"""
SELECT ticker, month_end, {', '.join(f'{r(f"returns_{k}m")} AS returns_{k}m' for k in HORIZONS)} FROM hr""",
    "bars", extra=[MONTHLY, horizon_sql("monthly", "hr")]))
def multi_horizon_returns(spark, root):
    monthly = panel.monthly_last(src.bars(spark, root), ["ticker"], ["adj_close"])
    return rounded(ind.horizon_returns(monthly).drop("adj_close"))


def horizon_as_of_sql(source: str, out: str) -> str:
    lags = ", ".join(f"adj_close / lag(adj_close, {k}) OVER w - 1 AS r{k}" for k in HORIZONS)
    bounds = ", ".join(f"quantile_cont(r{k}, {p}) OVER w AS {n}{k}" for k in HORIZONS for n, p in (("lo", 0.005), ("hi", 0.995)))
    final = ", ".join(
        f"CASE WHEN r{k} IS NOT NULL THEN power(1 + greatest(least(r{k}, hi{k}), lo{k}), 1.0 / {k}) - 1 END AS returns_{k}m"
        for k in HORIZONS
    )
    return f"""{out}_raw AS (SELECT *, {lags} FROM {source} WINDOW w AS (PARTITION BY ticker ORDER BY month_end)),
{out}_lim AS (SELECT *, {bounds} FROM {out}_raw WINDOW w AS (PARTITION BY ticker ORDER BY month_end ROWS UNBOUNDED PRECEDING)),
{out} AS (SELECT ticker, month_end, {final} FROM {out}_lim)"""


@query("multi_horizon_returns_as_of", sql(f"""
SELECT ticker, month_end, {', '.join(f'{r(f"returns_{k}m")} AS returns_{k}m' for k in HORIZONS)} FROM hr""",
    "bars", extra=[MONTHLY, horizon_as_of_sql("monthly", "hr")]))
def multi_horizon_returns_as_of(spark, root):
    """Horizon returns clipped to the outer quantiles of those so far, so that no limit looks ahead."""
    monthly = panel.monthly_last(src.bars(spark, root), ["ticker"], ["adj_close"])
    return rounded(ind.horizon_returns(monthly, as_of=True).drop("adj_close"))


@query("cumulative_return", sql(f"""
SELECT date, {r('sum(ret) OVER w')} AS cum_sum,
       {r('CASE WHEN ret > -1 THEN exp(sum(CASE WHEN ret > -1 THEN ln(1 + ret) END) OVER w) - 1 END')} AS cum_return
FROM (SELECT date, ln(adj_close) - ln(lag(adj_close) OVER (ORDER BY date)) AS ret FROM bench)
WHERE ret IS NOT NULL WINDOW w AS (ORDER BY date)""", "bench"))
def cumulative_return(spark, root):
    ret = benchmark_returns(spark, root)
    sums = running_sum(ret, [], "date", {"cum_sum": F.col("benchmark_return")})
    out = backtest.compounded(sums, {"cum_return": "benchmark_return"})
    return rounded(out.select("date", "cum_sum", "cum_return"))


def benchmark_returns(spark, root):
    rows = index_series(src.benchmark_prices(spark, root), [], "date")
    ret = ind.apply_indicators(rows, [ind.log_return("adj_close", "benchmark_return")], keys=[])
    return ret.where(F.col("benchmark_return").isNotNull()).select("date", "benchmark_return")


@query("rank_average", sql("SELECT month_end, symbol, CAST(rank AS DOUBLE) AS rank FROM ranked", "bars", "sentiment",
    extra=[HOLDINGS]))
def rank_average(spark, root):
    return panel.average_rank(monthly_engagement(spark, root), ["month_end"], "engagement").select(
        "month_end", "symbol", "rank"
    )


@query("top_n_per_group", sql("""
SELECT month_end, symbol, CAST(rank AS DOUBLE) AS rank FROM ranked WHERE rank < 6""", "bars", "sentiment", extra=[HOLDINGS]))
def top_n_per_group(spark, root):
    return panel.top_n(monthly_engagement(spark, root), ["month_end"], "engagement", 6).select("month_end", "symbol", "rank")


@query("global_ordinal", sql("""
SELECT ticker, date, row_number() OVER (ORDER BY date, ticker) - 1 AS pos, count(*) OVER () AS n_obs FROM bars""", "bars"))
def global_ordinal(spark, root):
    return index_series(src.bars(spark, root), [], "date", tiebreak=["ticker"]).select("ticker", "date", "pos", "n_obs")


_SPLIT = "CASE WHEN ts < TIMESTAMP '1999-01-01' THEN 'train' WHEN ts < TIMESTAMP '2000-01-01' THEN 'valid' ELSE 'test' END"


@query("sliding_windows", sql(f"""
SELECT split, ts, x0, x1, x2, x3, x4, y AS label FROM (
  SELECT split, ts, y, {', '.join(f'lag(y, {5 - i}) OVER w AS x{i}' for i in range(5))}
  FROM (SELECT ts, y, {_SPLIT} AS split FROM load_daily) WINDOW w AS (PARTITION BY split ORDER BY ts))
WHERE x0 IS NOT NULL""", "load_daily"))
def sliding_windows(spark, root):
    cuts = {"train": "1999-01-01", "valid": "2000-01-01", "test": None}
    rows = forecast.time_split(src.load_daily(spark, root), cuts)
    out = forecast.sliding_windows(rows, ["series_id", "split"], "ts", ["y"], "y")
    return out.select("split", "ts", *[F.get(F.get("x", F.lit(i)), F.lit(0)).alias(f"x{i}") for i in range(5)], "label")


NUMBERED = """numbered AS (
  SELECT *, row_number() OVER w - 1 AS pos, lag(close) OVER w AS prev FROM bars
  WINDOW w AS (PARTITION BY ticker ORDER BY date))"""


def rsi_sql(source: str, out: str) -> str:
    return f"""{out} AS (
  SELECT a.ticker, a.date,
         CASE WHEN a.pos >= 20 THEN 100 * sum(power(0.95, a.pos - b.pos) * greatest(b.close - b.prev, 0))
           / nullif(sum(power(0.95, a.pos - b.pos) * abs(b.close - b.prev)), 0) END AS rsi
  FROM {source} a JOIN {source} b ON a.ticker = b.ticker AND b.pos <= a.pos GROUP BY a.ticker, a.date, a.pos)"""


@query("rsi", sql(f"SELECT ticker, date, {r('rsi')} AS rsi FROM rsi", "bars", extra=[NUMBERED, rsi_sql("numbered", "rsi")]))
def rsi(spark, root):
    return rounded(indicate(spark, root, ind.rsi()).select("ticker", "date", "rsi"))


def bands_sql(source: str, lag: int, prefix: str, digits: int | None = 6) -> str:
    frame = f"(PARTITION BY ticker ORDER BY date ROWS BETWEEN {19 + lag} PRECEDING AND {f'{lag} PRECEDING' if lag else 'CURRENT ROW'})"
    mid, sd, n = f"avg(ln(1 + close)) OVER {frame}", f"stddev_pop(ln(1 + close)) OVER {frame}", f"count(close) OVER {frame}"
    bands = {name: f"CASE WHEN {n} = 20 THEN {mid} + {k} * {sd} END" for name, k in (("low", -2), ("mid", 0), ("high", 2))}
    return ", ".join(f"{b if digits is None else r(b, digits)} AS {prefix}_{name}" for name, b in bands.items())


@query("bollinger", sql(f"""
SELECT ticker, date, {bands_sql('bars', 0, 'bb')}, {bands_sql('bars', 1, 'lagged')} FROM bars""", "bars"))
def bollinger(spark, root):
    out = indicate(spark, root, ind.bollinger(), ind.bollinger(lag=1, prefix="lagged"))
    names = [f"{p}_{s}" for p in ("bb", "lagged") for s in ("low", "mid", "high")]
    return rounded(out.select("ticker", "date", *names))


def atr_sql(source: str, out: str) -> str:
    return f"""{out}_tr AS (
  SELECT ticker, date, pos,
         CASE WHEN prev IS NOT NULL THEN greatest(high - low, abs(high - prev), abs(low - prev)) END AS tr FROM {source}),
{out}_raw AS (
  SELECT a.ticker, a.date, a.pos,
         CASE WHEN a.pos >= 14 THEN sum(power(13 / 14.0, a.pos - b.pos) * b.tr) / sum(power(13 / 14.0, a.pos - b.pos)) END AS atr
  FROM {out}_tr a LEFT JOIN {out}_tr b ON a.ticker = b.ticker AND b.pos <= a.pos AND b.tr IS NOT NULL
  GROUP BY a.ticker, a.date, a.pos),
{out} AS (
  SELECT ticker, date, (atr - avg(atr) OVER w) / stddev_samp(atr) OVER w AS atr FROM {out}_raw
  WINDOW w AS (PARTITION BY ticker))"""


@query("atr_z", sql(f"SELECT ticker, date, {r('atr')} AS atr FROM atr", "bars", extra=[NUMBERED, atr_sql("numbered", "atr")]))
def atr_z(spark, root):
    raw = indicate(spark, root, ind.atr()).select("ticker", "date", "atr")
    return rounded(panel.group_zscore(raw, ["ticker"], ["atr"]))


@query("true_range", sql("""
SELECT ticker, date, round(CASE WHEN prev IS NOT NULL
  THEN greatest(high - low, abs(high - prev), abs(low - prev)) END, 4) AS tr FROM numbered""", "bars", extra=[NUMBERED]))
def true_range(spark, root):
    one = ind.Indicator((lambda ctx: {"tr": ind.true_range_columns(ctx, "high", "low", "close")},), back=1)
    return rounded(indicate(spark, root, one).select("ticker", "date", "tr"), 4)


def _ema_sql(n: int) -> str:
    q = f"({n - 1} / {n + 1}.0)"
    return f"sum(power({q}, a.pos - b.pos) * b.close * CASE WHEN b.pos = 0 THEN 1 ELSE {2.0 / (n + 1)!r} END)"


def macd_sql(source: str, out: str) -> str:
    return f"""{out}_raw AS (
  SELECT a.ticker, a.date, CASE WHEN a.pos >= 25 THEN {_ema_sql(12)} - {_ema_sql(26)} END AS macd
  FROM {source} a JOIN {source} b ON a.ticker = b.ticker AND b.pos <= a.pos GROUP BY a.ticker, a.date, a.pos),
{out} AS (
  SELECT ticker, date, (macd - avg(macd) OVER w) / stddev_samp(macd) OVER w AS macd FROM {out}_raw
  WINDOW w AS (PARTITION BY ticker))"""


@query("macd_z", sql(f"SELECT ticker, date, {r('macd')} AS macd FROM macd", "bars", extra=[NUMBERED, macd_sql("numbered", "macd")]))
def macd_z(spark, root):
    raw = indicate(spark, root, ind.macd()).select("ticker", "date", "macd")
    return rounded(panel.group_zscore(raw, ["ticker"], ["macd"]))


GARMAN_SQL = "((ln(high) - ln(low)) ** 2 / 2 - (2 * ln(2) - 1) * (ln(adj_close) - ln(open)) ** 2)"


@query("garman_klass", sql(f"SELECT ticker, date, {r(GARMAN_SQL)} AS garman_klass FROM bars", "bars"))
def garman_klass(spark, root):
    return src.bars(spark, root).select("ticker", "date", r_col(scalar.garman_klass()).alias("garman_klass"))


@query("dollar_volume", sql(f"SELECT ticker, date, {r('adj_close * volume / 1e6', 9)} AS dollar_volume FROM bars", "bars"))
def dollar_volume(spark, root):
    return src.bars(spark, root).select("ticker", "date", r_col(scalar.dollar_volume(), 9).alias("dollar_volume"))


def factor_panel(spark, root):
    returns = monthly_returns(spark, root).where(F.col("returns_1m").isNotNull())
    joined = returns.join(F.broadcast(src.factors(spark, root)), "month_end")
    return panel.keep_min_obs(joined, "ticker", 10)


@query("rolling_ols_betas")
def rolling_ols_betas(spark, root):
    from marketseries.sources.readers import FACTORS

    out = rolling_ols(factor_panel(spark, root), "returns_1m", FACTORS)
    return rounded(out.select("ticker", "month_end", *[f"beta_{f}" for f in FACTORS]))


@query("rolling_beta_one_factor", sql(f"""
SELECT ticker, month_end, {r('CASE WHEN pos >= least(24, n) AND obs >= 7 THEN slope END')} AS beta_mkt_rf FROM (
  SELECT m.ticker, m.month_end, row_number() OVER (PARTITION BY ticker ORDER BY m.month_end) AS pos,
         count(*) OVER (PARTITION BY ticker) AS n, count(*) OVER w AS obs, regr_slope(returns_1m, mkt_rf) OVER w AS slope
  FROM monthly_ret m JOIN factors f ON m.month_end = f.month_end WHERE returns_1m IS NOT NULL
  WINDOW w AS (PARTITION BY ticker ORDER BY m.month_end ROWS BETWEEN 23 PRECEDING AND CURRENT ROW))""",
    "bars", "factors", extra=[MONTHLY]))
def rolling_beta_one_factor(spark, root):
    out = rolling_ols(factor_panel(spark, root), "returns_1m", ["mkt_rf"], min_obs=7)
    return rounded(out.select("ticker", "month_end", "beta_mkt_rf"))


@query("shift_month_forward", sql("""
SELECT DISTINCT CAST(last_day(date) + INTERVAL 1 DAY AS DATE) AS rebalance_date, ticker FROM bars""", "bars"))
def shift_month_forward(spark, root):
    months = src.bars(spark, root).select("ticker", F.last_day("date").alias("month_end")).distinct()
    return backtest.hold_next_month(months)


@query("signal_returns", sql(f"""
SELECT ticker, date, {r('market_return')} AS market_return, {r('strategy_return')} AS strategy_return,
       {r('sum(market_return) OVER v')} AS market_cum, {r('sum(strategy_return) OVER v')} AS strategy_cum
FROM (
  SELECT ticker, date, ln(lead(close) OVER w) - ln(close) AS market_return,
         CASE WHEN close > lag(close) OVER w THEN 1 ELSE -1 END * (ln(lead(close) OVER w) - ln(close)) AS strategy_return
  FROM bars WINDOW w AS (PARTITION BY ticker ORDER BY date))
WHERE market_return IS NOT NULL WINDOW v AS (PARTITION BY ticker ORDER BY date)""", "bars"))
def signal_returns(spark, root):
    rows = indicate(spark, root, ind.lagged({"_before": "close"}))
    rows = rows.withColumn("pred", F.coalesce(F.col("close") > F.col("_before"), F.lit(False)))
    out = backtest.signal_backtest(rows, "pred", "close", ("ticker",))
    return rounded(out.select("ticker", "date", "market_return", "strategy_return", "market_cum", "strategy_cum"))


@query("time_series_folds", sql("""
SELECT ts, pos, fold, CASE WHEN pos < n - (5 - fold) * 100 - 24 THEN 'train' ELSE 'test' END AS role
FROM (SELECT ts, row_number() OVER (ORDER BY ts) - 1 AS pos, count(*) OVER () AS n FROM load_daily),
     (SELECT CAST(unnest(range(5)) AS INTEGER) AS fold)
WHERE pos < n - (5 - fold) * 100 - 24 OR (pos >= n - (5 - fold) * 100 AND pos < n - (4 - fold) * 100)""", "load_daily"))
def time_series_folds(spark, root):
    return forward_folds(src.load_daily(spark, root), "ts", 5, 100, 24).select("ts", "pos", "fold", "role")
