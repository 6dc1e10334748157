"""Sources, projections, filters, joins, aggregations, sorts and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketseries.functions import metrics, scalar
from marketseries.operators import backtest, forecast, panel, portfolio
from marketseries.operators.blocks import index_series
from marketseries.operators.expanding import expanding_quantiles
from marketseries.operators.indicators import apply_indicators, lagged, log_return, next_rise
from marketseries.plans.registry import query, r, r_col, rounded, sql
from marketseries.session import cut_lineage, scratch_path
from marketseries.sources import readers
from marketseries.sources import stand_ins as src

# ---------------------------------------------------------------- sources


def _write_load(spark, df, ts_format):
    path = scratch_path(spark, "load-csv")
    df.select(F.date_format("ts", ts_format).alias("ts"), "y").write.option("header", True).csv(path)
    return path


@query("scan_load_csv", sql(f"SELECT 'load' AS series_id, ts, {r('y', 4)} AS y FROM load_daily", "load_daily"))
def scan_load_csv(spark, root):
    path = _write_load(spark, src.load_daily(spark, root), "yyyy-MM-dd HH:mm:ss")
    return rounded(readers.read_load(spark, path), 4)


@query("scan_csv_cast_ts", sql(f"SELECT 'load' AS series_id, ts, {r('y', 4)} AS y FROM load_hourly", "load_hourly"))
def scan_csv_cast_ts(spark, root):
    path = _write_load(spark, src.load_hourly(spark, root), "yyyy-MM-dd HH:mm:ss")
    return rounded(readers.read_load_text(spark, path), 4)


@query("scan_bars", sql("""
SELECT ticker, date, close, volume FROM bars
WHERE date >= DATE '1995-01-01' AND date < DATE '2001-01-01'""", "bars"))
def scan_bars(spark, root):
    path = scratch_path(spark, "bars")
    src.bars(spark, root).withColumn("year", F.year("date")).write.partitionBy("year").parquet(path)
    return readers.read_bars(spark, path, start="1995-01-01", end="2001-01-01").select("ticker", "date", "close", "volume")


@query("scan_universe", "SELECT DISTINCT replace(p_brand || '.' || p_type, '.', '-') AS symbol FROM part")
def scan_universe(spark, root):
    parts = src.table(spark, root, "part").select(F.concat_ws(".", "p_brand", "p_type").alias("raw"))
    return readers.universe(parts, "raw")


_PERCENT = "(avg(o_totalprice / 250000 - 1) FILTER (WHERE o_orderpriority = '{p}')) * 100"
_LAST = "arg_max({f}, date) FILTER (WHERE {f} IS NOT NULL) / 100"


@query("scan_factors", f"""
WITH daily AS (
  SELECT CAST(o_orderdate AS DATE) AS date,
         {', '.join(f'{_PERCENT.format(p=p)} AS {f}' for p, f in zip(src.PRIORITIES, readers.FACTORS))}
  FROM orders GROUP BY 1)
SELECT last_day(date) AS month_end, {', '.join(f'{r(_LAST.format(f=f))} AS {f}' for f in readers.FACTORS)}
FROM daily GROUP BY 1""")
def scan_factors(spark, root):
    return rounded(readers.monthly_factors(src.factor_rows(spark, root)))


@query("profile_schema", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) AS n_rows, count({c}) AS non_null FROM lineitem"
    for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
              "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")))
def profile_schema(spark, root):
    return readers.profile(src.table(spark, root, "lineitem")).select("column_name", "n_rows", "non_null")


# ------------------------------------------------- projections and filters


def with_features(spark, root):
    rows = index_series(src.bars(spark, root), ["ticker"], "date")
    return apply_indicators(
        rows, [log_return(), lagged({"close_lag": "close", "volume_lag": "volume"}), next_rise()]
    ).drop("pos", "n_obs")


_FEATURES = """f AS (
  SELECT *, ln(adj_close) - ln(lag(adj_close) OVER w) AS ret, lag(close) OVER w AS close_lag,
         lag(volume) OVER w AS volume_lag,
         CASE WHEN lead(close) OVER w > close THEN 1 ELSE 0 END AS next_rise
  FROM bars WINDOW w AS (PARTITION BY ticker ORDER BY date))"""


@query("project_by_position", sql(
    f"SELECT ticker, date, {r('ret')} AS ret, close_lag, volume_lag, next_rise FROM f", "bars", extra=[_FEATURES]))
def project_by_position(spark, root):
    """Keys and derived features; the raw price columns are left behind."""
    df = with_features(spark, root)
    raw = {"open", "high", "low", "close", "adj_close", "volume"}
    return rounded(df.select(*[c for c in df.columns if c not in raw]))


@query("project_columns", sql("SELECT ticker, date, close, volume FROM bars", "bars"))
def project_columns(spark, root):
    return src.bars(spark, root).select("ticker", "date", "close", "volume")


@query("drop_columns", sql("SELECT ticker, date, high, low, close, volume FROM bars", "bars"))
def drop_columns(spark, root):
    return src.bars(spark, root).drop("open", "adj_close")


@query("normalise_columns", sql(
    "SELECT ticker AS symbol, date, adj_close, volume AS traded_volume FROM bars", "bars"))
def normalise_columns(spark, root):
    shown = src.bars(spark, root).select(
        F.col("ticker").alias("Ticker"), F.col("date").alias("Date"), F.col("adj_close").alias("Adj Close"),
        F.col("volume").alias("Traded-Volume"),
    )
    return scalar.snake_columns(shown).withColumnRenamed("ticker", "symbol")


@query("filter_outliers", sql(f"""
SELECT series_id, ts, {r('y', 4)} AS y, CASE WHEN y > 100 THEN 'kept' ELSE 'outlier' END AS part
FROM load_hourly""", "load_hourly"))
def filter_outliers(spark, root):
    """The kept rows and the inspected low ones, told apart by the strict threshold."""
    load = src.load_hourly(spark, root)
    kept = forecast.above(load, "y", 100).withColumn("part", F.lit("kept"))
    low = load.where(F.col("y") <= 100).withColumn("part", F.lit("outlier"))
    return rounded(kept.unionByName(low), 4)


@query("filter_engagement", sql(
    "SELECT symbol, date, likes, comments FROM sentiment WHERE likes > 20 AND comments > 10", "sentiment"))
def filter_engagement(spark, root):
    return engaged(src.sentiment(spark, root))


def engaged(df):
    return df.where((F.col("likes") > 20) & (F.col("comments") > 10))


@query("split_by_time", sql(f"""
SELECT series_id, ts, {r('y', 4)} AS y,
       CASE WHEN ts < TIMESTAMP '1999-01-01' THEN 'train' WHEN ts < TIMESTAMP '2000-01-01' THEN 'valid' ELSE 'test' END AS split
FROM load_daily""", "load_daily"))
def split_by_time(spark, root):
    cuts = {"train": "1999-01-01", "valid": "2000-01-01", "test": None}
    return rounded(forecast.time_split(src.load_daily(spark, root), cuts), 4)


@query("split_by_fraction", sql("""
SELECT ticker, date, close,
       CASE WHEN pos < floor(0.6 * n) THEN 'train' WHEN pos < floor(0.8 * n) THEN 'valid' ELSE 'test' END AS split
FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date) - 1 AS pos, count(*) OVER (PARTITION BY ticker) AS n
      FROM bars)""", "bars"))
def split_by_fraction(spark, root):
    out = forecast.fraction_split(
        src.bars(spark, root), ["ticker"], "date", {"train": 0.6, "valid": 0.8, "test": 1.0}
    )
    return out.select("ticker", "date", "close", "split")


@query("drop_nulls", sql(f"""
SELECT ticker, date, {r('ret')} AS ret, close_lag FROM f WHERE ret IS NOT NULL AND close_lag IS NOT NULL""",
    "bars", extra=[_FEATURES]))
def drop_nulls(spark, root):
    df = with_features(spark, root).select("ticker", "date", "ret", "close_lag")
    return rounded(df.na.drop("any", subset=["ret", "close_lag"]))


@query("fill_group_mean", sql(f"""
SELECT ticker, date, {r('coalesce(ret, avg(ret) OVER (PARTITION BY ticker))')} AS ret FROM f""",
    "bars", extra=[_FEATURES]))
def fill_group_mean(spark, root):
    df = with_features(spark, root).select("ticker", "date", "ret")
    return rounded(panel.fill_group_mean(df, ["ticker"], ["ret"]))


@query("filter_cluster", "SELECT vec_id AS id, label AS cluster FROM embeddings WHERE label = 3")
def filter_cluster(spark, root):
    return src.vectors(spark, root).withColumnRenamed("grp", "cluster").where(F.col("cluster") == 3).select("id", "cluster")


@query("cross_section_at", sql("""
SELECT date, count(*) AS n_names, min(close) AS lowest, max(close) AS highest FROM bars GROUP BY date""", "bars"))
def cross_section_at(spark, root):
    """All dates at once: one grouped pass in place of a loop over dates."""
    return src.bars(spark, root).groupBy("date").agg(
        F.count(F.lit(1)).alias("n_names"), F.min("close").alias("lowest"), F.max("close").alias("highest")
    )


@query("conditional_value", sql(f"""
SELECT ticker, date, {r('CASE WHEN next_rise = 1 THEN ret ELSE -ret END')} AS signed_ret FROM f""",
    "bars", extra=[_FEATURES]))
def conditional_value(spark, root):
    signed = F.when(F.col("next_rise") == 1, F.col("ret")).otherwise(-F.col("ret"))
    return with_features(spark, root).select("ticker", "date", r_col(signed).alias("signed_ret"))


@query("threshold_probability", """
SELECT event_id, 1.0 / (1.0 + exp(-(value - 50) / 10)) > 0.5 AS pred FROM events""")
def threshold_probability(spark, root):
    """Class of a scored table: the probability vector cut strictly above one half."""
    from pyspark.ml.functions import array_to_vector

    p = 1.0 / (1.0 + F.exp(-(F.col("value") - 50) / 10))
    scored = src.table(spark, root, "events").withColumn("probability", array_to_vector(F.array(1.0 - p, p)))
    return scored.select("event_id", scalar.positive_class().alias("pred"))


# ------------------------------------------------------------------ joins


@query("join_benchmark", sql(f"""
SELECT b.ticker, b.date, b.close, {r('m.adj_close', 5)} AS benchmark FROM bars b JOIN bench m ON b.date = m.date""",
    "bars", "bench"))
def join_benchmark(spark, root):
    bench = src.benchmark_prices(spark, root).withColumnRenamed("adj_close", "benchmark")
    return rounded(src.bars(spark, root).select("ticker", "date", "close").join(bench, "date"), 5, ["benchmark"])


@query("join_predictions_back", sql(f"""
SELECT l.ts, {r('l.y', 4)} AS y, {r('p.pred', 4)} AS pred
FROM load_daily l LEFT JOIN (
  SELECT ts, avg(y) OVER (PARTITION BY year(ts), month(ts)) AS pred FROM load_daily WHERE ts >= TIMESTAMP '2000-01-01') p
ON l.ts = p.ts""", "load_daily"))
def join_predictions_back(spark, root):
    """Predictions of the last part joined to the whole series; earlier rows have none."""
    load = src.load_daily(spark, root)
    late = load.where(F.col("ts") >= F.lit("2000-01-01").cast("timestamp_ntz")).withColumn("m", F.trunc("ts", "month"))
    preds = late.join(late.groupBy("m").agg(F.avg("y").alias("pred")), "m").select("series_id", "ts", "pred")
    return rounded(load.join(preds, ["series_id", "ts"], "left").select("ts", "y", "pred"), 4)


def monthly_returns(spark, root):
    """Last adjusted close of each month and its change over one row."""
    last = panel.monthly_last(src.bars(spark, root), ["ticker"], ["adj_close"])
    rows = index_series(last, ["ticker"], "month_end", "year")
    return apply_indicators(rows, [lagged({"_before": "adj_close"})]).select(
        "ticker", "month_end", "adj_close", (F.col("adj_close") / F.col("_before") - 1).alias("returns_1m")
    )


MONTHLY = """monthly AS (
  SELECT ticker, last_day(date) AS month_end, arg_max(adj_close, date) AS adj_close FROM bars GROUP BY 1, 2),
monthly_ret AS (
  SELECT *, adj_close / lag(adj_close) OVER (PARTITION BY ticker ORDER BY month_end) - 1 AS returns_1m FROM monthly)"""


@query("join_factors_to_returns", sql(f"""
SELECT m.ticker, m.month_end, {r('returns_1m')} AS returns_1m, {r('mkt_rf')} AS mkt_rf, {r('cma')} AS cma
FROM monthly_ret m JOIN factors f ON m.month_end = f.month_end""", "bars", "factors", extra=[MONTHLY]))
def join_factors_to_returns(spark, root):
    joined = monthly_returns(spark, root).join(F.broadcast(src.factors(spark, root)), "month_end")
    return rounded(joined.select("ticker", "month_end", "returns_1m", "mkt_rf", "cma"))


@query("join_lagged_betas", sql(f"""
SELECT m.ticker, m.month_end, {r('returns_1m')} AS returns_1m, {r('b.beta_lag')} AS beta_lag
FROM monthly_ret m LEFT JOIN (
  SELECT ticker, month_end, lag(slope) OVER (PARTITION BY ticker ORDER BY month_end) AS beta_lag FROM (
    SELECT m.ticker, m.month_end,
           regr_slope(returns_1m, mkt_rf) OVER (PARTITION BY ticker ORDER BY m.month_end
                                                ROWS BETWEEN 23 PRECEDING AND CURRENT ROW) AS slope,
           count(*) OVER (PARTITION BY ticker ORDER BY m.month_end ROWS BETWEEN 23 PRECEDING AND CURRENT ROW) AS n
    FROM monthly_ret m JOIN factors f ON m.month_end = f.month_end WHERE returns_1m IS NOT NULL)
  WHERE n >= 24) b
ON m.ticker = b.ticker AND m.month_end = b.month_end""", "bars", "factors", extra=[MONTHLY]))
def join_lagged_betas(spark, root):
    from marketseries.operators.regression import rolling_ols

    returns = monthly_returns(spark, root)
    joined = returns.where(F.col("returns_1m").isNotNull()).join(F.broadcast(src.factors(spark, root)), "month_end")
    betas = rolling_ols(joined, "returns_1m", ["mkt_rf"], window=24, min_obs=7).where(F.col("beta_mkt_rf").isNotNull())
    rows = index_series(betas.select("ticker", "month_end", "beta_mkt_rf"), ["ticker"], "month_end", "year")
    lag = apply_indicators(rows, [lagged({"beta_lag": "beta_mkt_rf"})]).select("ticker", "month_end", "beta_lag")
    out = returns.join(lag, ["ticker", "month_end"], "left")
    return rounded(out.select("ticker", "month_end", "returns_1m", "beta_lag"))


TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")


@query("align_outer", sql(f"""
SELECT date, {', '.join(f"arg_max(close, date) FILTER (WHERE ticker = '{t}') AS {t.lower()}" for t in TYPES)}
FROM bars_type GROUP BY date
HAVING count(DISTINCT ticker) FILTER (WHERE ticker IN ({', '.join(f"'{t}'" for t in TYPES)})) = {len(TYPES)}""", "bars_type"))
def align_outer(spark, root):
    """Full outer alignment by date, then complete rows only."""
    wide = panel.to_wide(src.bars_by_type(spark, root), TYPES, "close").na.drop()
    return wide.select("date", *[F.col(t).alias(t.lower()) for t in TYPES])


@query("semi_join_min_obs", sql("""
SELECT ticker, month_end, adj_close FROM monthly
WHERE ticker IN (SELECT ticker FROM monthly GROUP BY ticker HAVING count(*) >= 10)""", "bars", extra=[MONTHLY]))
def semi_join_min_obs(spark, root):
    return panel.keep_min_obs(panel.monthly_last(src.bars(spark, root), ["ticker"], ["adj_close"]), "ticker", 10)


@query("anti_join_exclusions", sql("""
SELECT ticker, date, close FROM bars
WHERE ticker NOT IN (SELECT p_brand FROM part GROUP BY p_brand ORDER BY avg(p_retailprice) DESC, p_brand LIMIT 1)""", "bars"))
def anti_join_exclusions(spark, root):
    """Leaves out the name with the highest mean list price."""
    dearest = (
        src.table(spark, root, "part").groupBy(F.col("p_brand").alias("ticker")).agg(F.avg("p_retailprice").alias("p"))
        .orderBy(F.col("p").desc(), "ticker").limit(1).select("ticker")
    )
    return src.bars(spark, root).select("ticker", "date", "close").join(dearest, "ticker", "left_anti")


@query("lookup_exact_lag", sql(f"""
SELECT l.ts, {r('l.y', 4)} AS y, {', '.join(f'{r(f"a{i}.y", 4)} AS lag{i}' for i in (1, 2, 3))}
FROM load_daily l
{' '.join(f"LEFT JOIN load_daily a{i} ON a{i}.series_id = l.series_id AND a{i}.ts = l.ts - INTERVAL {d} DAY"
          for i, d in ((1, 364), (2, 728), (3, 1092)))}""", "load_daily"))
def lookup_exact_lag(spark, root):
    lags = forecast.date_lags(src.load_daily(spark, root), {"lag1": 364, "lag2": 728, "lag3": 1092})
    return rounded(lags.select("ts", "y", "lag1", "lag2", "lag3"), 4)


def monthly_engagement(spark, root):
    """Mean ratio per month and symbol; written, as ranking reads this small table twice."""
    rows = engaged(src.sentiment(spark, root)).withColumn("engagement", scalar.ratio(F.col("comments"), F.col("likes")))
    return cut_lineage(panel.monthly_mean(rows, ["symbol"], ["engagement"]), "engagement")


def engagement_holdings(spark, root, n=6):
    best = panel.top_n(monthly_engagement(spark, root), ["month_end"], "engagement", n)
    return backtest.hold_next_month(best, key="symbol").withColumnRenamed("symbol", "ticker")


def indexed_log_returns(spark, root):
    rows = index_series(src.bars(spark, root).select("ticker", "date", "adj_close"), ["ticker"], "date")
    return apply_indicators(rows, [log_return()])


def daily_log_returns(spark, root):
    return indexed_log_returns(spark, root).drop("pos", "n_obs")


HOLDINGS = """engagement AS (
  SELECT last_day(date) AS month_end, symbol, avg(CAST(comments AS DOUBLE) / likes) AS engagement
  FROM sentiment WHERE likes > 20 AND comments > 10 GROUP BY 1, 2),
ranked AS (
  SELECT *, rank() OVER (PARTITION BY month_end ORDER BY engagement DESC)
            + (count(*) OVER (PARTITION BY month_end, engagement) - 1) / 2.0 AS rank
  FROM engagement),
holdings AS (SELECT CAST(month_end + INTERVAL 1 DAY AS DATE) AS rebalance_date, symbol AS ticker FROM ranked WHERE rank < 6),
returns AS (
  SELECT ticker, date, adj_close, ln(adj_close) - ln(lag(adj_close) OVER (PARTITION BY ticker ORDER BY date)) AS ret
  FROM bars)"""

HELD = """held AS (
  SELECT h.rebalance_date, r.ticker, r.date, r.ret FROM returns r JOIN holdings h
  ON r.ticker = h.ticker AND r.date BETWEEN h.rebalance_date AND last_day(h.rebalance_date))"""


@query("join_holding_period", sql(
    f"SELECT rebalance_date, ticker, date, {r('ret')} AS ret FROM held", "bars", "sentiment", extra=[HOLDINGS, HELD]))
def join_holding_period(spark, root):
    held = backtest.held_returns(engagement_holdings(spark, root), daily_log_returns(spark, root))
    return rounded(held.select("rebalance_date", "ticker", "date", "ret"))


@query("join_lookback", sql("""
SELECT h.rebalance_date, h.ticker, b.date, b.adj_close AS price FROM holdings h JOIN bars b
ON b.ticker = h.ticker AND b.date >= h.rebalance_date - INTERVAL 12 MONTH AND b.date < h.rebalance_date""",
    "bars", "sentiment", extra=[HOLDINGS]))
def join_lookback(spark, root):
    out = portfolio.lookback_prices(engagement_holdings(spark, root), src.bars(spark, root))
    return out.select("rebalance_date", "ticker", "date", "price")


@query("join_weights", sql(f"""
SELECT h.rebalance_date, h.ticker, h.date, {r('h.ret / n.n')} AS weighted_return
FROM held h JOIN (SELECT rebalance_date, count(*) AS n FROM holdings GROUP BY 1) n USING (rebalance_date)""",
    "bars", "sentiment", extra=[HOLDINGS, HELD]))
def join_weights(spark, root):
    weights = portfolio.equal_weights(engagement_holdings(spark, root))
    held = backtest.held_returns(weights, daily_log_returns(spark, root))
    return held.select(
        "rebalance_date", "ticker", "date", r_col(F.col("ret") * F.col("weight")).alias("weighted_return")
    )


@query("semi_join_price_pruning", sql("""
SELECT ticker, date, close FROM bars
WHERE ticker IN (SELECT symbol FROM sentiment WHERE likes > 20 AND comments > 10)""", "bars", "sentiment"))
def semi_join_price_pruning(spark, root):
    """The bars are stored in folders by name once; the scan then reads those of the chosen names alone."""
    names = engaged(src.sentiment(spark, root)).select(F.col("symbol").alias("ticker"))
    store = readers.store_bars(src.bars(spark, root).select("ticker", "date", "close"), scratch_path(spark, "bars"))
    return readers.bars_of(store, names).select("ticker", "date", "close")


@query("complete_dates", sql("""
SELECT ticker, date, close FROM bars_type
WHERE date IN (SELECT date FROM bars_type GROUP BY date
               HAVING count(close) = (SELECT count(DISTINCT ticker) FROM bars_type))""", "bars_type"))
def complete_dates(spark, root):
    return panel.drop_incomplete_dates(src.bars_by_type(spark, root), "close").select("ticker", "date", "close")


# ----------------------------------------------------------- aggregations


@query("monthly_mean_by_symbol", sql(f"""
SELECT month_end, symbol, {r('engagement')} AS engagement FROM (
  SELECT last_day(date) AS month_end, symbol, avg(CAST(comments AS DOUBLE) / likes) AS engagement
  FROM sentiment WHERE likes > 20 AND comments > 10 GROUP BY 1, 2)""", "sentiment"))
def monthly_mean_by_symbol(spark, root):
    rows = engaged(src.sentiment(spark, root)).withColumn("engagement", scalar.ratio(F.col("comments"), F.col("likes")))
    return rounded(panel.monthly_mean(rows, ["symbol"], ["engagement"]).select("month_end", "symbol", "engagement"))


@query("resample_mean", sql(f"""
SELECT ticker, last_day(date) AS month_end, {r('avg(adj_close * volume / 1e6)')} AS dollar_volume
FROM bars GROUP BY 1, 2""", "bars"))
def resample_mean(spark, root):
    rows = src.bars(spark, root).withColumn("dollar_volume", scalar.dollar_volume())
    return rounded(panel.monthly_mean(rows, ["ticker"], ["dollar_volume"]))


@query("resample_last", sql(f"""
SELECT ticker, last_day(date) AS month_end,
       {r('arg_max(ret, date) FILTER (WHERE ret IS NOT NULL)')} AS ret,
       arg_max(close_lag, date) FILTER (WHERE close_lag IS NOT NULL) AS close_lag
FROM f GROUP BY 1, 2""", "bars", extra=[_FEATURES]))
def resample_last(spark, root):
    return rounded(panel.monthly_last(with_features(spark, root), ["ticker"], ["ret", "close_lag"]))


@query("count_having", sql("""
SELECT ticker, count(*) AS n_months FROM monthly GROUP BY ticker HAVING count(*) >= 10""", "bars", extra=[MONTHLY]))
def count_having(spark, root):
    months = src.bars(spark, root).select("ticker", F.last_day("date").alias("month_end")).distinct()
    return months.groupBy("ticker").agg(F.count(F.lit(1)).alias("n_months")).where(F.col("n_months") >= 10)


@query("portfolio_equal_weight", sql(
    f"SELECT date, {r('avg(ret)')} AS portfolio_return FROM held GROUP BY date", "bars", "sentiment", extra=[HOLDINGS, HELD]))
def portfolio_equal_weight(spark, root):
    return rounded(backtest.equal_weight_returns(engagement_holdings(spark, root), daily_log_returns(spark, root)))


def volume_weights(spark, root):
    """Weights by the dollar volume of the signal month, one row per held name."""
    month = panel.monthly_mean(src.bars(spark, root).withColumn("dv", scalar.dollar_volume()), ["ticker"], ["dv"])
    held = engagement_holdings(spark, root).withColumn("month_end", F.date_sub("rebalance_date", 1))
    sized = held.join(month, ["ticker", "month_end"])
    total = sized.groupBy("rebalance_date").agg(F.sum("dv").alias("total"))
    return sized.join(total, "rebalance_date").select(
        "rebalance_date", "ticker", (F.col("dv") / F.col("total")).alias("weight")
    )


@query("portfolio_weighted", sql(f"""
SELECT date, {r('sum(ret * weight)')} AS portfolio_return
FROM held JOIN (
  SELECT h.rebalance_date, h.ticker, dv / sum(dv) OVER (PARTITION BY h.rebalance_date) AS weight
  FROM holdings h JOIN (SELECT ticker, last_day(date) AS month_end, avg(adj_close * volume / 1e6) AS dv
                        FROM bars GROUP BY 1, 2) v
  ON v.ticker = h.ticker AND v.month_end = h.rebalance_date - INTERVAL 1 DAY) w USING (rebalance_date, ticker)
WHERE ret IS NOT NULL GROUP BY date""", "bars", "sentiment", extra=[HOLDINGS, HELD]))
def portfolio_weighted(spark, root):
    return rounded(backtest.weighted_returns(volume_weights(spark, root), daily_log_returns(spark, root)))


@query("distinct_values", sql("SELECT DISTINCT ticker, last_day(date) AS month_end FROM bars", "bars"))
def distinct_values(spark, root):
    return src.bars(spark, root).select("ticker", F.last_day("date").alias("month_end")).distinct()


@query("group_to_list", sql("""
SELECT rebalance_date, string_agg(ticker, ',' ORDER BY ticker) AS tickers FROM holdings GROUP BY 1""",
    "bars", "sentiment", extra=[HOLDINGS]))
def group_to_list(spark, root):
    lists = panel.holdings_list(engagement_holdings(spark, root))
    return lists.select("rebalance_date", F.array_join("tickers", ",").alias("tickers"))


def scored(spark, root):
    """Daily load with the previous day's value as the forecast, and the rise of both as classes."""
    rows = index_series(src.load_daily(spark, root), ["series_id"], "ts")
    lag = apply_indicators(rows, [lagged({"pred": "y"}), lagged({"pred2": "y"}, 2)], ["series_id"])
    return lag.na.drop("any", subset=["pred", "pred2"]).select(
        "ts", "y", "pred",
        (F.col("y") > F.col("pred")).cast("int").alias("label"),
        (F.col("pred") > F.col("pred2")).cast("int").alias("class"),
        (F.col("pred") / (F.col("pred") + F.col("pred2"))).alias("prob"),
    )


_SCORED = """scored AS (
  SELECT ts, y, pred, CAST(y > pred AS INTEGER) AS label, CAST(pred > pred2 AS INTEGER) AS class, pred / (pred + pred2) AS prob
  FROM (SELECT ts, y, lag(y) OVER (ORDER BY ts) AS pred, lag(y, 2) OVER (ORDER BY ts) AS pred2 FROM load_daily)
  WHERE pred2 IS NOT NULL)"""


@query("confusion_matrix", sql("""
SELECT count(*) FILTER (WHERE label = 0 AND class = 0) AS n_0_0, count(*) FILTER (WHERE label = 0 AND class = 1) AS n_0_1,
       count(*) FILTER (WHERE label = 1 AND class = 0) AS n_1_0, count(*) FILTER (WHERE label = 1 AND class = 1) AS n_1_1
FROM scored""", "load_daily", extra=[_SCORED]))
def confusion_matrix(spark, root):
    return metrics.confusion(scored(spark, root), "label", "class")


@query("accuracy", sql(f"""
SELECT {r('avg(CASE WHEN label = class THEN 1.0 ELSE 0.0 END)')} AS accuracy FROM scored""", "load_daily", extra=[_SCORED]))
def accuracy(spark, root):
    return rounded(scored(spark, root).agg(metrics.accuracy("label", "class").alias("accuracy")))


@query("rmse", sql(f"SELECT {r('sqrt(avg((y - pred) ** 2))', 3)} AS rmse FROM scored", "load_daily", extra=[_SCORED]))
def rmse(spark, root):
    return rounded(scored(spark, root).agg(metrics.rmse("y", "pred").alias("rmse")), 3)


@query("mape", sql(f"SELECT {r('avg(abs(y - pred) / abs(y))')} AS mape FROM scored", "load_daily", extra=[_SCORED]))
def mape(spark, root):
    return rounded(scored(spark, root).agg(metrics.mape("y", "pred").alias("mape")))


@query("losses", sql(f"""
SELECT {r('avg((y / 1e6 - pred / 1e6) ** 2)')} AS mse,
       {r('-avg(label * ln(least(greatest(prob, 1e-7), 1 - 1e-7)) + (1 - label) * ln(1 - least(greatest(prob, 1e-7), 1 - 1e-7)))')} AS log_loss
FROM scored""", "load_daily", extra=[_SCORED]))
def losses(spark, root):
    df = scored(spark, root).withColumns({"ys": F.col("y") / 1e6, "ps": F.col("pred") / 1e6})
    return rounded(df.agg(metrics.mse("ys", "ps").alias("mse"), metrics.log_loss("label", "prob").alias("log_loss")))


@query("five_number_by_part", sql(f"""
SELECT part_of, {', '.join(f'{r(f"quantile_cont(y, {p})", 6)} AS {n}' for n, p in
    (('q0', 0), ('q1', 0.25), ('q2', 0.5), ('q3', 0.75), ('q4', 1)))},
  {r('quantile_cont(y, 0.25) - 1.5 * (quantile_cont(y, 0.75) - quantile_cont(y, 0.25))', 6)} AS fence_low,
  {r('quantile_cont(y, 0.75) + 1.5 * (quantile_cont(y, 0.75) - quantile_cont(y, 0.25))', 6)} AS fence_high
FROM (SELECT 'hour ' || hour(ts) AS part_of, y FROM load_hourly
      UNION ALL SELECT 'month ' || month(ts), y FROM load_daily) GROUP BY 1""", "load_hourly", "load_daily"))
def five_number_by_part(spark, root):
    hours = src.load_hourly(spark, root).select(F.concat(F.lit("hour "), F.hour("ts")).alias("part_of"), "y")
    months = src.load_daily(spark, root).select(F.concat(F.lit("month "), F.month("ts")).alias("part_of"), "y")
    return rounded(metrics.five_numbers(hours.unionByName(months), ["part_of"], "y"), 6)


@query("scaler_fit", sql(f"""
SELECT {r('avg(close)', 4)} AS mean_close, {r('stddev_pop(close)', 4)} AS sd_close,
       {r('avg(volume)', 4)} AS mean_volume, {r('stddev_pop(volume)', 4)} AS sd_volume
FROM bars WHERE date < DATE '1999-01-01'""", "bars"))
def scaler_fit(spark, root):
    train = src.bars(spark, root).where(F.col("date") < F.lit("1999-01-01").cast("date"))
    return rounded(forecast.scaler_fit(train, ["close", "volume"]), 4)


@query("group_mean_std", sql(f"""
SELECT ticker, date, {r('(close - avg(close) OVER w) / stddev_samp(close) OVER w')} AS close
FROM bars WINDOW w AS (PARTITION BY ticker)""", "bars"))
def group_mean_std(spark, root):
    return rounded(panel.group_zscore(src.bars(spark, root).select("ticker", "date", "close"), ["ticker"], ["close"]))


LOOKBACK = """lookback AS (
  SELECT h.rebalance_date, h.ticker, b.date,
         b.adj_close / lag(b.adj_close) OVER (PARTITION BY h.rebalance_date, h.ticker ORDER BY b.date) - 1 AS ret
  FROM holdings h JOIN bars b
  ON b.ticker = h.ticker AND b.date >= h.rebalance_date - INTERVAL 12 MONTH AND b.date < h.rebalance_date)"""


def lookback(spark, root):
    return portfolio.lookback_returns(
        portfolio.lookback_prices(engagement_holdings(spark, root), src.bars(spark, root))
    )


@query("cross_products", sql(f"""
SELECT a.rebalance_date, a.ticker AS ticker_i, b.ticker AS ticker_j, {r('covar_samp(a.ret, b.ret) * 252', 4)} AS cov
FROM lookback a JOIN lookback b ON a.rebalance_date = b.rebalance_date AND a.date = b.date AND a.ticker <= b.ticker
WHERE a.ret IS NOT NULL AND b.ret IS NOT NULL
GROUP BY 1, 2, 3 HAVING count(*) >= 2""", "bars", "sentiment", extra=[HOLDINGS, LOOKBACK]))
def cross_products(spark, root):
    return rounded(portfolio.lookback_covariance(lookback(spark, root)), 4)


@query("annualised_return", sql(f"""
SELECT rebalance_date, ticker, {r('ln(1 + mu)', 5)} AS log_mu FROM (
  SELECT rebalance_date, ticker, exp(sum(ln(1 + ret)) * 252 / count(ret)) - 1 AS mu
  FROM lookback WHERE ret IS NOT NULL GROUP BY 1, 2)""", "bars", "sentiment", extra=[HOLDINGS, LOOKBACK]))
def annualised_return(spark, root):
    """Shown in logs: the made-up prices jump enough to give yearly rates of any size."""
    mu = portfolio.annualised_return(lookback(spark, root))
    return mu.select("rebalance_date", "ticker", r_col(F.log1p("mu"), 5).alias("log_mu"))


@query("group_mean_std_as_of", sql(f"""
SELECT ticker, date, {r('(close - avg(close) OVER w) / nullif(stddev_samp(close) OVER w, 0)')} AS close
FROM bars WINDOW w AS (PARTITION BY ticker ORDER BY date ROWS UNBOUNDED PRECEDING)""", "bars"))
def group_mean_std_as_of(spark, root):
    """The z-score of each row among the rows so far: nothing after a row is looked at."""
    bars = src.bars(spark, root).select("ticker", "date", "close")
    return rounded(panel.group_zscore(bars, ["ticker"], ["close"], as_of="date"))


@query("fill_group_mean_as_of", sql(f"""
SELECT ticker, date, {r('coalesce(high_ret, avg(high_ret) OVER w)')} AS high_ret FROM (
  SELECT ticker, date, CASE WHEN abs(ret) < 0.5 THEN ret END AS high_ret FROM f)
WINDOW w AS (PARTITION BY ticker ORDER BY date ROWS UNBOUNDED PRECEDING)""", "bars", extra=[_FEATURES]))
def fill_group_mean_as_of(spark, root):
    """Returns beyond a half are blanked and filled with the mean of those so far."""
    df = with_features(spark, root).select("ticker", "date", F.when(F.abs("ret") < 0.5, F.col("ret")).alias("high_ret"))
    return rounded(panel.fill_group_mean(df, ["ticker"], ["high_ret"], as_of="date"))


@query("quantiles_as_of", sql(f"""
SELECT ticker, date, {r('quantile_cont(close, 0.005) OVER w')} AS low, {r('quantile_cont(close, 0.5) OVER w')} AS middle,
       {r('quantile_cont(close, 0.995) OVER w')} AS high
FROM bars WINDOW w AS (PARTITION BY ticker ORDER BY date ROWS UNBOUNDED PRECEDING)""", "bars"))
def quantiles_as_of(spark, root):
    """Exact outer quantiles and median of the closes so far."""
    bars = src.bars(spark, root).select("ticker", "date", "close")
    out = expanding_quantiles(bars, ["ticker"], "close", "date", {"low": 0.005, "middle": 0.5, "high": 0.995})
    return rounded(out.drop("close"))


# --------------------------------------------- sorts, limits and reshaping


@query("sort_by_time", sql(f"SELECT ts, {r('y', 4)} AS y FROM load_hourly ORDER BY ts", "load_hourly"))
def sort_by_time(spark, root):
    return rounded(src.load_hourly(spark, root).select("ts", "y"), 4).orderBy("ts")


@query("sort_importance", sql(f"""
SELECT hour(ts) AS hour, {r('corr(y, 1.0 * day(ts))')} AS importance FROM load_hourly GROUP BY 1
ORDER BY importance, hour""", "load_hourly"))
def sort_importance(spark, root):
    """Hours of the day by how strongly their load moves with the day of the month."""
    out = src.load_hourly(spark, root).groupBy(F.hour("ts").cast("long").alias("hour")).agg(
        F.corr("y", F.dayofmonth("ts").cast("double")).alias("importance")
    )
    return rounded(out).orderBy("importance", "hour")


@query("head_n", sql(f"SELECT ts, {r('y', 4)} AS y FROM load_daily ORDER BY ts LIMIT 5", "load_daily"))
def head_n(spark, root):
    return rounded(src.load_daily(spark, root).select("ts", "y"), 4).orderBy("ts").limit(5)


@query("tail_n", sql(f"SELECT ts, {r('y', 4)} AS y FROM load_daily ORDER BY ts DESC LIMIT 100", "load_daily"))
def tail_n(spark, root):
    return rounded(src.load_daily(spark, root).select("ts", "y"), 4).orderBy(F.col("ts").desc()).limit(100)


@query("union_all", sql(f"""
SELECT series_id, ts, {r('y', 4)} AS y FROM load_daily UNION ALL SELECT series_id, ts, {r('y', 4)} FROM load_hourly""",
    "load_daily", "load_hourly"))
def union_all(spark, root):
    return rounded(src.load_daily(spark, root).unionByName(src.load_hourly(spark, root)), 4)


@query("unpivot_panel", sql(f"""
SELECT date, ticker, close FROM bars_type WHERE ticker IN ({', '.join(f"'{t}'" for t in TYPES)})""", "bars_type"))
def unpivot_panel(spark, root):
    wide = panel.to_wide(src.bars_by_type(spark, root), TYPES, "close")
    return panel.to_long(wide, "close").select("date", "ticker", "close")


@query("pivot_panel", sql(f"""
SELECT date, {', '.join(f"max(volume) FILTER (WHERE ticker = '{t}') AS {t.lower()}" for t in TYPES)}
FROM bars_type GROUP BY date""", "bars_type"))
def pivot_panel(spark, root):
    wide = panel.to_wide(src.bars_by_type(spark, root), TYPES, "volume")
    return wide.select("date", *[F.col(t).alias(t.lower()) for t in TYPES])


# -------------------------------------------------------- scalar functions


@query("calendar_features", sql("""
SELECT ts, CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS dayofweek,
       CAST(quarter(ts) AS INTEGER) AS quarter, CAST(month(ts) AS INTEGER) AS month, CAST(year(ts) AS INTEGER) AS year,
       CAST(dayofyear(ts) AS INTEGER) AS dayofyear FROM load_hourly""", "load_hourly"))
def calendar_features(spark, root):
    return scalar.calendar_features(src.load_hourly(spark, root)).select("ts", *scalar.CALENDAR)


@query("scalar_math", f"""
SELECT event_id, {r('ln(value)')} AS ln_v, {r('ln(1 + value)')} AS log1p_v, {r('exp(-value / 100)')} AS exp_v,
       {r('sqrt(value)')} AS sqrt_v, {r('value ** 2', 4)} AS sq_v, {r('power(1 + value, 1.0 / 3)')} AS root_v,
       {r('value', 1)} AS round_v, {r('greatest(least(value, 60), 20)')} AS clip_v, {r('abs(value - 50)')} AS abs_v
FROM events WHERE value > 0""")
def scalar_math(spark, root):
    v = F.col("value")
    events = src.table(spark, root, "events").where(v > 0)
    return rounded(events.select(
        "event_id", F.ln(v).alias("ln_v"), F.log1p(v).alias("log1p_v"), F.exp(-v / 100).alias("exp_v"),
        F.sqrt(v).alias("sqrt_v"), F.round(v * v, 4).alias("sq_v"), F.pow(1 + v, F.lit(1.0 / 3)).alias("root_v"),
        F.round(v, 1).alias("round_v"), scalar.clip(v, F.lit(20.0), F.lit(60.0)).alias("clip_v"),
        F.abs(v - 50).alias("abs_v"),
    ))


@query("ratio", sql(f"""
SELECT symbol, date, likes, comments, {r('CAST(comments AS DOUBLE) / nullif(likes, 0)')} AS engagement FROM sentiment""",
    "sentiment"))
def ratio(spark, root):
    return rounded(src.sentiment(spark, root).withColumn("engagement", scalar.ratio(F.col("comments"), F.col("likes"))))


@query("date_arithmetic", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, CAST(o_orderdate - INTERVAL 2920 DAY AS DATE) AS eight_years_before,
       CAST(CAST(o_orderdate AS DATE) - INTERVAL 12 MONTH AS DATE) AS year_before,
       last_day(CAST(o_orderdate AS DATE)) AS month_end,
       CAST(last_day(CAST(o_orderdate AS DATE)) + INTERVAL 1 DAY AS DATE) AS next_start,
       CAST(o_orderdate - INTERVAL 364 DAY AS TIMESTAMP) AS lag_ts FROM orders""")
def date_arithmetic(spark, root):
    day = F.to_date("o_orderdate")
    return src.table(spark, root, "orders").select(
        "o_orderkey", day.alias("day"), F.date_sub(day, 365 * 8).alias("eight_years_before"),
        F.add_months(day, -12).alias("year_before"), F.last_day(day).alias("month_end"),
        scalar.next_month_start(F.last_day(day)).alias("next_start"),
        F.expr("o_orderdate - INTERVAL 364 DAYS").alias("lag_ts"),
    )


@query("date_format", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders")
def date_format(spark, root):
    return src.table(spark, root, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))


@query("string_replace", "SELECT p_partkey, lower(replace(p_brand || '.' || p_type, '.', '-')) AS symbol FROM part")
def string_replace(spark, root):
    parts = src.table(spark, root, "part").withColumn("raw", F.concat_ws(".", "p_brand", "p_type"))
    return parts.select("p_partkey", F.lower(scalar.normalise_symbol("raw")).alias("symbol"))


@query("scale_apply", sql(f"""
SELECT ticker, date, {r('(close - m) / s')} AS close FROM bars,
  (SELECT avg(close) AS m, stddev_pop(close) AS s FROM bars WHERE date < DATE '1999-01-01')""", "bars"))
def scale_apply(spark, root):
    bars = src.bars(spark, root).select("ticker", "date", "close")
    stats = forecast.scaler_fit(bars.where(F.col("date") < F.lit("1999-01-01").cast("date")), ["close"])
    return rounded(forecast.scale(bars, stats, ["close"]))


@query("scale_inverse", sql(f"SELECT ticker, date, {r('close', 4)} AS close FROM bars", "bars"))
def scale_inverse(spark, root):
    """Scaling and undoing it gives the input back."""
    bars = src.bars(spark, root).select("ticker", "date", "close")
    stats = forecast.scaler_fit(bars.where(F.col("date") < F.lit("1999-01-01").cast("date")), ["close"])
    return rounded(forecast.unscale(forecast.scale(bars, stats, ["close"]), stats, {"close": "close"}), 4)
