"""Regression, clustering, portfolio, forecast-model, diagnostic and intraday queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketseries.functions import metrics, scalar
from marketseries.operators import clusters, diagnostics, ensembles, features, forecast, intraday, portfolio, regression, seasonal
from marketseries.operators import indicators as ind
from marketseries.operators import validation as val
from marketseries.operators.blocks import index_series
from marketseries.plans.basics import HOLDINGS, engagement_holdings, indexed_log_returns
from marketseries.plans.registry import query, r, rounded, sql
from marketseries.plans.series import rsi_sql
from marketseries.session import cut_lineage
from marketseries.sources import stand_ins as src

YEAR_LAGS = {"lag1": 364, "lag2": 728, "lag3": 1092}
CUTS = {"train": "1999-01-01", "valid": "2000-01-01", "test": None}
HOLDOUT = {"train": "2000-01-01", "test": None}
XS = ["x1", "x2", "x3", "x4", "x5", "x6"]


def load_table(spark, root):
    return features.load_features(src.load_daily(spark, root), 1e5, YEAR_LAGS)


def fit_inputs(spark, root, names):
    """Training and hold-out rows of the daily load with an assembled vector."""
    # every round of a learner reads these rows again
    rows = cut_lineage(val.assemble(forecast.time_split(load_table(spark, root), HOLDOUT), names), "features")
    return rows.where(F.col("split") == "train"), rows.where(F.col("split") == "test")


NAMES = [*scalar.CALENDAR, *YEAR_LAGS]


def _predictions(model, test):
    return rounded(model.transform(test).select("ts", "y", "prediction"), 2)


#: Fitted models and scores that several queries of a session use, by session, table folder and name. Nothing here reads
#: written tables again, which may be gone by then.
_shared: dict[tuple[str, str, str], tuple] = {}


def shared(spark, root, name, make):
    """What ``make`` returned for this session and folder; it is made once."""
    key = (spark.sparkContext.applicationId, root, name)
    if key not in _shared:
        _shared[key] = make()
    return _shared[key]


def by_cuts(spark, root, names, load=None):
    rows = load_table(spark, root) if load is None else load
    rows = cut_lineage(val.assemble(forecast.time_split(rows, CUTS), names), "features")
    return tuple(rows.where(F.col("split") == s) for s in CUTS)


def boosted_load(spark, root):
    """Boosted trees on calendar and lags, cut at the round that is best on the validation part; and the error curve."""

    def make():
        train, valid, _ = by_cuts(spark, root, NAMES)
        return ensembles.boosted_checkpoint(train, valid, val.boosted_trees(trees=ROUNDS, rate=RATE, depth=6))

    return shared(spark, root, "boosted", make)


#: A tenth of the original's 1000 rounds at ten times its rate of 0.01; trees of a forest likewise (500 and 1000).
ROUNDS, RATE = 100, 0.1
FOREST = ensembles.ForestGrid(trees=(50, 100))
#: As in the original: 800 and 1000 rounds, depths 4 and 8, rates 0.01, 0.05 and 0.1, 0.7 or all of the columns.
BOOSTED = ensembles.BoostedGrid()


@query("gbt_forecast")
def gbt_forecast(spark, root):
    return _predictions(boosted_load(spark, root)[0], by_cuts(spark, root, NAMES)[2])


@query("boosting_curve")
def boosting_curve(spark, root):
    """Validation error after every boosting round, and the round that is kept."""
    return rounded(boosted_load(spark, root)[1], 2)


def training_folds(spark, root):
    train, _ = fit_inputs(spark, root, NAMES)
    return val.forward_folds(train, "ts", n_splits=5, test_size=100, gap=24)


def forest_scores(spark, root):
    """Scores of 108 forests over five folds, and the best of them."""

    def make():
        return ensembles.forest_grid(training_folds(spark, root), FOREST)

    return shared(spark, root, "forest", make)


def best_forest(spark, root):
    """The best forest of the grid, fitted on all training rows, its split and the hold-out rows."""
    train, test = fit_inputs(spark, root, NAMES)
    _, best = forest_scores(spark, root)
    return ensembles.fit_forest(train, best), best["split"], test


def forest_holdout(spark, root):
    model, split, test = best_forest(spark, root)
    return test.withColumn("prediction", ensembles.forest_prediction(spark, model, split)).select("ts", "y", "prediction")


@query("rf_forecast")
def rf_forecast(spark, root):
    return rounded(forest_holdout(spark, root), 2)


@query("feature_importance")
def feature_importance(spark, root):
    return val.importances(best_forest(spark, root)[0], NAMES).orderBy(F.col("importance").desc())


@query("grid_search_cv")
def grid_search_cv(spark, root):
    """All combinations of a forest's trees, depth, features, leaves and splits over five folds."""
    return forest_scores(spark, root)[0]


@query("grid_search_boosted")
def grid_search_boosted(spark, root):
    """24 combinations of boosted trees over five folds."""
    return ensembles.boosted_grid(training_folds(spark, root), BOOSTED)[0]


def windowed_load(spark, root, size=5):
    """Five scaled values and the next one, inside each time split; scaled by the training part."""
    rows = forecast.time_split(src.load_daily(spark, root), CUTS)
    stats = forecast.scaler_fit(rows.where(F.col("split") == "train"), ["y"])
    windows = forecast.sliding_windows(forecast.scale(rows, stats, ["y"]), ["series_id", "split"], "ts", ["y"], "y", size)
    return cut_lineage(forecast.flatten_windows(windows).drop("x"), "windows"), stats


def window_models(spark, root):
    """Linear regression against boosted trees cut at their best round, the better on the validation part, saved.

    Returns the model, its place among the two, the test windows and the scale.
    """

    def make():
        train, valid = (windows.where(F.col("split") == s) for s in ("train", "valid"))
        trees, _ = ensembles.boosted_checkpoint(train, valid, val.boosted_trees("label", trees=ROUNDS, rate=RATE, depth=3))
        fitted = [val.window_regressor().fit(train), trees.stages[0]]
        model, _, best = val.keep_best(fitted, valid, score=-metrics.mse("label", "prediction"))
        return model, best

    windows, stats = windowed_load(spark, root)
    return *shared(spark, root, "windows", make), windows.where(F.col("split") == "test"), stats


@query("sink_model")
def sink_model(spark, root):
    """Best of two learners on the validation split, saved and loaded back, scored on the last split."""
    model, best, test, _ = window_models(spark, root)
    return rounded(model.transform(test).select("ts", "label", "prediction").withColumn("chosen", F.lit(best)))


@query("window_regressor")
def window_regressor(spark, root):
    windows, stats = windowed_load(spark, root)
    model = val.window_regressor().fit(windows.where(F.col("split") == "train"))
    scored = model.transform(windows.where(F.col("split") == "test")).select("ts", "label", "prediction")
    return rounded(forecast.unscale(scored, stats, {"label": "y", "prediction": "y"}), 2)


@query("window_classifier")
def window_classifier(spark, root):
    """Will the next value be higher: five-row windows, 60/20/20 by time."""
    rows = index_series(src.load_daily(spark, root), ["series_id"], "ts")
    rows = ind.apply_indicators(rows, [ind.next_rise("y")], ["series_id"]).drop("pos", "n_obs")
    parts = forecast.fraction_split(rows, ["series_id"], "ts", {"train": 0.6, "valid": 0.8, "test": 1.0})
    stats = forecast.scaler_fit(parts.where(F.col("split") == "train"), ["y"])
    windows = forecast.flatten_windows(
        forecast.sliding_windows(forecast.scale(parts, stats, ["y"]), ["series_id", "split"], "ts", ["y"], "next_rise")
    )
    windows = cut_lineage(windows.drop("x"), "windows")
    model = val.window_classifier(5).fit(windows.where(F.col("split") == "train"))
    scored = model.transform(windows.where(F.col("split") == "test"))
    return scored.select("ts", "label", scalar.positive_class().alias("pred"))


# --------------------------------------------------------------- clusters


def month_points(spark, root):
    """Month-end price level (log) and mean log dollar volume of every ticker."""
    daily = src.bars(spark, root)
    return daily.groupBy(F.last_day("date").alias("month_end"), "ticker").agg(
        F.round(F.ln(F.max_by("close", "date")), 4).alias("level"),
        F.round(F.avg(F.ln(F.col("close") * F.col("volume"))), 4).alias("turnover"),
    )


@query("kmeans_by_month")
def kmeans_by_month(spark, root):
    out = clusters.kmeans_grouped(month_points(spark, root), ["month_end"], ["level", "turnover"], "ticker", k=4, restarts=10)
    return out.select("month_end", "ticker", "level", "turnover", "cluster")


SEEDS = [[9.0, 12.0], [10.0, 13.0], [10.5, 14.0], [11.2, 15.0]]


@query("kmeans_seeded")
def kmeans_seeded(spark, root):
    out = clusters.kmeans_grouped(month_points(spark, root), ["month_end"], ["level", "turnover"], "ticker", start=SEEDS)
    return out.select("month_end", "ticker", "level", "turnover", "cluster")


@query("kmeans_vectors")
def kmeans_vectors(spark, root):
    return clusters.kmeans_grouped(src.vectors(spark, root), ["grp"], ["x"], "id", k=4).select("grp", "id", "cluster")


_POINTS = """points AS (
  SELECT last_day(date) AS month_end, ticker, round(ln(arg_max(close, date)), 4) AS level,
         round(avg(ln(close * volume)), 4) AS turnover FROM bars GROUP BY 1, 2),
seeds(cluster, a, b) AS (VALUES {}),
near AS (
  SELECT month_end, ticker, level, turnover,
         arg_min(cluster, ((level - a) ** 2 + (turnover - b) ** 2, cluster)) AS cluster
  FROM points, seeds GROUP BY ALL)""".format(", ".join(f"({i}, {a}, {b})" for i, (a, b) in enumerate(SEEDS)))


@query("kmeans_seeded_step", sql(f"""
SELECT m.month_end, s.cluster, {r('coalesce(n.level, s.a)', 9)} AS level, {r('coalesce(n.turnover, s.b)', 9)} AS turnover
FROM (SELECT DISTINCT month_end FROM points) m CROSS JOIN seeds s LEFT JOIN (
  SELECT month_end, cluster, avg(level) AS level, avg(turnover) AS turnover FROM near GROUP BY 1, 2) n
ON n.month_end = m.month_end AND n.cluster = s.cluster""", "bars", extra=[_POINTS]))
def kmeans_seeded_step(spark, root):
    """Centroids after one round from the given start."""
    points = month_points(spark, root).withColumn("x", F.array("level", "turnover"))
    start = clusters.fixed_start(points, ["month_end"], SEEDS)
    moved = clusters.update(clusters.assign(points, start, ["month_end"]), start, ["month_end"], 4, 2)
    out = moved.select("month_end", F.posexplode("centroids").alias("cluster", "c"))
    return rounded(out.select("month_end", "cluster", F.get("c", F.lit(0)).alias("level"), F.get("c", F.lit(1)).alias("turnover")), 9)


# -------------------------------------------------------------- portfolio


@query("max_sharpe_weights")
def max_sharpe_weights(spark, root):
    """Fifteen most engaged names a month; an upper bound of 0.4 leaves room for a solution."""
    held = engagement_holdings(spark, root, 16)
    returns = portfolio.lookback_returns(portfolio.lookback_prices(held, src.bars(spark, root)))
    return rounded(portfolio.max_sharpe_weights(held, returns, upper=0.4))


@query("equal_weights", sql(f"""
SELECT rebalance_date, ticker, {r('1.0 / count(*) OVER (PARTITION BY rebalance_date)')} AS weight FROM holdings""",
    "bars", "sentiment", extra=[HOLDINGS]))
def equal_weights(spark, root):
    return rounded(portfolio.equal_weights(engagement_holdings(spark, root)))


# ------------------------------------------------------------- regression


def centred_replicates(spark, root):
    rows = src.replicates(spark, root)
    cols = ["y", *XS]
    means = rows.groupBy("rep").agg(*[F.avg(c).alias(f"_{c}") for c in cols])
    return rows.join(means, "rep").select("rep", *[(F.col(c) - F.col(f"_{c}")).alias(c) for c in cols])


@query("ols_grouped")
def ols_grouped(spark, root):
    fit = regression.ols_grouped(src.replicates(spark, root), ["rep"], "y", XS, intercept=True)
    return rounded(fit.select("rep", "n", *[F.get("beta", F.lit(i)).alias(f"b{i}") for i in range(7)], "ssr"), 3)


@query("ols_grouped_single", f"""
SELECT l_suppkey AS rep, count(*) AS n, {r('regr_slope(l_extendedprice, l_quantity)', 4)} AS slope,
       {r('regr_intercept(l_extendedprice, l_quantity)', 4)} AS intercept
FROM lineitem GROUP BY 1""")
def ols_grouped_single(spark, root):
    fit = regression.ols_grouped(src.replicates(spark, root), ["rep"], "y", ["x1"], intercept=True)
    return rounded(fit.select("rep", "n", F.get("beta", F.lit(0)).alias("slope"), F.get("beta", F.lit(1)).alias("intercept")), 4)


_SUMS = """sums AS (
  SELECT l_suppkey AS rep, count(*) AS n, sum(y * y) AS syy, sum(x1 * y) AS s1y, sum(x1 * x1) AS s11,
         sum(x2 * y) AS s2y, sum(x2 * x2) AS s22, sum(x1 * x2) AS s12
  FROM (SELECT l_suppkey, l_extendedprice / 1e4 AS y, l_quantity AS x1, p_size AS x2
        FROM lineitem JOIN part ON l_partkey = p_partkey) GROUP BY 1),
ssr AS (
  SELECT rep, n, syy, 1 AS k, syy - s1y * s1y / s11 AS ssr FROM sums
  UNION ALL
  SELECT rep, n, syy, 2, syy - ((s22 * s1y - s12 * s2y) * s1y + (s11 * s2y - s12 * s1y) * s2y) / (s11 * s22 - s12 * s12) FROM sums),
crit AS (
  SELECT rep, n, k, 1 - (n / (n - k)) * ssr / syy AS adj_r2,
         2 * k + n * (ln(2 * pi()) + ln(ssr / n) + 1) AS aic, k * ln(n) + n * (ln(2 * pi()) + ln(ssr / n) + 1) AS bic
  FROM ssr)"""


def small_models(spark, root):
    rows = src.replicates(spark, root).select("rep", (F.col("y") / 1e4).alias("y"), "x1", F.col("x5").alias("x2"))
    return regression.nested_models(rows, ["rep"], "y", ["x1", "x2"], [1, 2])


@query("information_criteria", sql(f"""
SELECT rep, n, CAST(k AS INTEGER) AS k, {r('adj_r2')} AS adj_r2, {r('aic', 4)} AS aic, {r('bic', 4)} AS bic FROM crit""", extra=[_SUMS]))
def information_criteria(spark, root):
    out = small_models(spark, root).select("rep", "n", "k", "adj_r2", "aic", "bic")
    return rounded(rounded(out, 6, ["adj_r2"]), 4, ["aic", "bic"])


@query("selection_frequency", sql(f"""
SELECT CAST(b.k AS INTEGER) AS m, {r('avg(CASE WHEN a.adj_r2 > b.adj_r2 THEN 1.0 ELSE 0.0 END)')} AS freq_adj_r2,
       {r('avg(CASE WHEN a.aic < b.aic THEN 1.0 ELSE 0.0 END)')} AS freq_aic,
       {r('avg(CASE WHEN a.bic < b.bic THEN 1.0 ELSE 0.0 END)')} AS freq_bic
FROM crit a JOIN crit b ON a.rep = b.rep AND a.k = 1 AND b.k > 1 GROUP BY 1""", extra=[_SUMS]))
def selection_frequency(spark, root):
    return rounded(regression.selection_frequency(small_models(spark, root), ["rep"], 1))


def wide_models(spark, root):
    """Models of the first 5 to 50 of the predictors of each replicate."""
    names = [f"z{i}" for i in range(1, 51)]
    fits = regression.nested_models(src.wide_replicates(spark, root, names), ["rep"], "y", names, range(5, 51), centred=True)
    return cut_lineage(fits, "nested")


@query("nested_model_selection")
def nested_model_selection(spark, root):
    """How often each criterion keeps the first five columns against each of the 45 larger models."""
    return rounded(regression.selection_frequency(wide_models(spark, root), ["rep"], 5))


# ------------------------------------------------------------ diagnostics


def _split_load(spark, root, part):
    load = forecast.above(src.load_daily(spark, root), "y", 1e5)
    return forecast.time_split(load, HOLDOUT).where(F.col("split") == part).drop("split")


def train_load(spark, root):
    return _split_load(spark, root, "train")


def test_load(spark, root):
    return _split_load(spark, root, "test")


_TRAIN = """train AS (
  SELECT ts, y, row_number() OVER (ORDER BY ts) - 1 AS pos, y - avg(y) OVER () AS z
  FROM load_daily WHERE y > 1e5 AND ts < TIMESTAMP '2000-01-01')"""


@query("acf", sql(f"""
SELECT CAST(k AS INTEGER) AS lag, {r('(SELECT sum(a.z * b.z) FROM train a JOIN train b ON a.pos = b.pos + k) / (SELECT sum(z * z) FROM train)')} AS acf
FROM (SELECT unnest(range(41)) AS k)""", "load_daily", extra=[_TRAIN]))
def acf(spark, root):
    return rounded(diagnostics.acf(train_load(spark, root), 40).select("lag", "acf"))


@query("pacf", sql(f"""
SELECT CAST(lag AS INTEGER) AS lag, {r('v')} AS pacf FROM (
  SELECT unnest([0, 1, 2, 3]) AS lag,
         unnest([1.0, r1, (r2 - r1 ** 2) / (1 - r1 ** 2),
                 (r3 + r1 * r2 ** 2 + r1 ** 3 - 2 * r1 * r2 - r1 ** 2 * r3) / (1 + 2 * r1 ** 2 * r2 - r2 ** 2 - 2 * r1 ** 2)]) AS v
  FROM (SELECT sum(z * lag1) / sum(z * z) AS r1, sum(z * lag2) / sum(z * z) AS r2, sum(z * lag3) / sum(z * z) AS r3
        FROM (SELECT z, lag(z) OVER w AS lag1, lag(z, 2) OVER w AS lag2, lag(z, 3) OVER w AS lag3 FROM train WINDOW w AS (ORDER BY pos))))""",
    "load_daily", extra=[_TRAIN]))
def pacf(spark, root):
    return rounded(diagnostics.pacf(train_load(spark, root), 3).select("lag", "pacf"))


@query("dickey_fuller", sql(f"""
SELECT {r('b / sqrt(ssr / (n - 2) / sxx)', 5)} AS stat, b / sqrt(ssr / (n - 2) / sxx) < -2.86 AS reject_5pct, n AS nobs FROM (
  SELECT regr_slope(d, l) AS b, regr_sxx(d, l) AS sxx, regr_syy(d, l) - regr_slope(d, l) * regr_sxy(d, l) AS ssr, count(*) AS n
  FROM (SELECT z - lag(z) OVER (ORDER BY pos) AS d, lag(z) OVER (ORDER BY pos) AS l FROM train) WHERE l IS NOT NULL)""",
    "load_daily", extra=[_TRAIN]))
def dickey_fuller(spark, root):
    return rounded(diagnostics.adf(train_load(spark, root), max_lag=0).select("stat", "reject_5pct", "nobs"), 5)


@query("adf_test")
def adf_test(spark, root):
    return rounded(diagnostics.adf(train_load(spark, root)), 5)


@query("ar1_forecast", sql(f"""
SELECT CAST(h AS INTEGER) AS step, {r('c * (1 - phi ** h) / (1 - phi) + phi ** h * last_y', 2)} AS forecast
FROM (SELECT unnest(range(1, 13)) AS h), (
  SELECT regr_slope(y, l) AS phi, regr_intercept(y, l) AS c FROM (SELECT y, pos, lag(y) OVER (ORDER BY pos) AS l FROM train) WHERE pos >= 6),
  (SELECT arg_max(y, pos) AS last_y FROM train)""", "load_daily", extra=[_TRAIN]))
def ar1_forecast(spark, root):
    fit = diagnostics.arima_fit(train_load(spark, root), 1, 0, 0)
    return rounded(diagnostics.arima_forecast(fit, 12).select("step", "forecast"), 2)


@query("arima_hr")
def arima_hr(spark, root):
    """Order (5, 1, 1) fitted before 2000, forecast over the rows after it."""
    load = forecast.time_split(forecast.above(src.load_daily(spark, root), "y", 1e5), HOLDOUT)
    train, test = (load.where(F.col("split") == s).drop("split") for s in HOLDOUT)
    fit = diagnostics.arima_fit(train, 5, 1, 1)
    ahead = diagnostics.arima_forecast(fit, test.count())
    steps = index_series(test, ["series_id"], "ts").withColumn("step", (F.col("pos") + 1).cast("int"))
    return rounded(steps.join(ahead, ["series_id", "step"]).select("ts", "y", "step", "forecast"), 2)


@query("order_search")
def order_search(spark, root):
    out = diagnostics.order_search(train_load(spark, root), [0, 1, 2, 5], [0, 1], [0, 1, 2])
    return rounded(out, 3)


@query("per_hour_models")
def per_hour_models(spark, root):
    rows = src.load_hourly(spark, root).withColumn("hour", F.hour("ts"))
    fit = diagnostics.arima_fit(rows, 1, 0, 0, keys=("series_id", "hour"))
    return rounded(diagnostics.arima_forecast(fit, 3, ("series_id", "hour")), 3)


@query("seasonal_forecast")
def seasonal_forecast(spark, root):
    """Trend and daily and weekly seasons of the hourly load against its 24 hourly models, on the last fifth of the hours.

    Each hourly model forecasts its own hour, one step a day; both errors stand beside the predictions.
    """
    parts = cut_lineage(forecast.fraction_split(src.load_hourly(spark, root), ["series_id"], "ts", {"train": 0.8, "test": 1.0}), "parts")
    train, test = (parts.where(F.col("split") == s).drop("split") for s in ("train", "test"))
    own = seasonal.predict_seasonal(test, seasonal.fit_seasonal(train))
    keys = ("series_id", "hour")
    hourly = diagnostics.arima_fit(train.withColumn("hour", F.hour("ts")), 1, 0, 0, keys=keys)
    steps = index_series(test.withColumn("hour", F.hour("ts")), list(keys), "ts").withColumn("step", (F.col("pos") + 1).cast("int"))
    days = steps.agg(F.max("step")).first()[0] or 1
    by_hour = steps.join(diagnostics.arima_forecast(hourly, days, keys), [*keys, "step"]).select("series_id", "ts", F.col("forecast").alias("hourly"))
    out = cut_lineage(own.join(by_hour, ["series_id", "ts"], "left").select("series_id", "ts", "y", "prediction", "hourly"), "seasonal")
    errors = out.agg(metrics.mape("y", "prediction").alias("mape"), metrics.mape("y", "hourly").alias("mape_hourly"))
    errors = errors.select(F.struct("mape", "mape_hourly").alias("e"))
    return rounded(out.withColumn("_e", errors.scalar()).select("ts", "y", "prediction", "hourly", "_e.mape", "_e.mape_hourly"), 3)


# --------------------------------------------------------------- intraday


def ticks(spark, root):
    return src.five_minute_ticks(spark, root)


def daily_returns_of(ticks_df, session="day"):
    rows = index_series(intraday.daily_close(ticks_df, session), ["asset"], "date")
    return ind.apply_indicators(rows, [ind.log_return("close")], ["asset"])


@query("five_minute_bars", sql("SELECT asset, ts, open, high, low, close FROM ticks", "ticks"))
def five_minute_bars(spark, root):
    return ticks(spark, root)


@query("garch_rolling")
def garch_rolling(spark, root):
    out = intraday.garch_forecast(indexed_log_returns(spark, root), 180, key="ticker")
    return rounded(out.select("ticker", "date", "alpha", "beta", "variance"))


def with_premium(returns, key, short, long, n):
    """Short rolling variance as the forecast against the long one as the realised level."""
    rows = intraday.rolling_variance(returns, short, key=key).withColumnRenamed("realised", "variance")
    rows = intraday.rolling_variance(rows, long, key=key)
    return intraday.premium_signal(rows, n=n, key=key)


def premium_sql(returns: str, key: str, short: int, long: int, n: int, out: str) -> str:
    def frame(k):
        return f"(PARTITION BY {key} ORDER BY date ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW)"

    def rolling(fn, col, k):
        return f"CASE WHEN count({col}) OVER {frame(k)} = {k} THEN {fn}({col}) OVER {frame(k)} END"

    return f"""{out}_v AS (
  SELECT *, {rolling('var_samp', 'ret', short)} AS variance, {rolling('var_samp', 'ret', long)} AS realised
  FROM {returns} WHERE ret IS NOT NULL),
{out}_p AS (SELECT *, (variance - realised) / nullif(realised, 0) AS premium FROM {out}_v),
{out}_s AS (SELECT *, {rolling('stddev_samp', 'premium', n)} AS premium_sd FROM {out}_p),
{out} AS (SELECT *, CASE WHEN premium > premium_sd THEN 1 WHEN premium < -premium_sd THEN -1
                         WHEN premium_sd IS NOT NULL THEN 0 END AS signal_daily FROM {out}_s)"""


@query("prediction_premium_signal", sql(f"""
SELECT ticker, date, {r('premium')} AS premium, {r('premium_sd')} AS premium_sd, CAST(signal_daily AS INTEGER) AS signal_daily
FROM prem""", "bars", "sentiment", extra=[HOLDINGS, premium_sql("returns", "ticker", 5, 20, 30, "prem")]))
def prediction_premium_signal(spark, root):
    out = with_premium(indexed_log_returns(spark, root), "ticker", 5, 20, 30).where(F.col("ret").isNotNull())
    return rounded(out.select("ticker", "date", "premium", "premium_sd", "signal_daily"))


_TICK_DAYS = """days AS (SELECT asset, CAST(ts AS DATE) AS date, arg_max(close, ts) AS close FROM ticks GROUP BY 1, 2),
dret AS (SELECT *, ln(close) - ln(lag(close) OVER (PARTITION BY asset ORDER BY date)) AS ret FROM days)"""
_MERGED = """merged AS (
  SELECT t.*, s.date, s.signal_daily FROM ticks t JOIN (
    SELECT asset, date, lag(signal_daily) OVER (PARTITION BY asset ORDER BY date) AS signal_daily FROM prem) s
  ON s.asset = t.asset AND s.date = CAST(t.ts AS DATE))"""


def merged_ticks(spark, root, bars, frame=None):
    daily = with_premium(daily_returns_of(bars), "asset", 3, 5, 5)
    return intraday.attach_previous_signal(bars if frame is None else frame, daily)


@query("intraday_daily_merge", sql("""
SELECT asset, ts, date, close, CAST(signal_daily AS INTEGER) AS signal_daily FROM merged""",
    "ticks", extra=[_TICK_DAYS, premium_sql("dret", "asset", 3, 5, 5, "prem"), _MERGED]))
def intraday_daily_merge(spark, root):
    out = merged_ticks(spark, root, cut_lineage(ticks(spark, root), "ticks"))
    return out.select("asset", "ts", "date", "close", "signal_daily")


_TICK_SIGNAL = f"""tnum AS (
  SELECT asset AS ticker, ts AS date, close, row_number() OVER w - 1 AS pos, lag(close) OVER w AS prev FROM ticks
  WINDOW w AS (PARTITION BY asset ORDER BY ts)),
{rsi_sql('tnum', 'trsi')},
tband AS (
  SELECT asset, ts, CASE WHEN count(*) OVER w = 20 THEN avg(ln(1 + close)) OVER w END AS mid,
         stddev_pop(ln(1 + close)) OVER w AS sd
  FROM ticks WINDOW w AS (PARTITION BY asset ORDER BY ts ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)),
tsig AS (
  SELECT m.*, CASE WHEN rsi > 52 AND ln(1 + close) > mid + 2 * sd THEN 1
                   WHEN rsi < 48 AND ln(1 + close) < mid - 2 * sd THEN -1 ELSE 0 END AS signal_intraday
  FROM merged m JOIN trsi ON trsi.ticker = m.asset AND trsi.date = m.ts JOIN tband b ON b.asset = m.asset AND b.ts = m.ts),
agree AS (
  SELECT *, row_number() OVER (PARTITION BY asset, date ORDER BY ts) AS nth FROM tsig
  WHERE signal_daily = signal_intraday AND signal_intraday <> 0),
closing AS (SELECT asset, date, arg_max(close, ts) AS exit_close FROM tsig GROUP BY 1, 2)"""


@query("intraday_first_signal", sql(f"""
SELECT a.asset, a.date, a.ts AS entry_ts, a.close AS entry_close, CAST(-a.signal_intraday AS INTEGER) AS side, c.exit_close,
       {r('-a.signal_intraday * (ln(c.exit_close) - ln(a.close))')} AS trade_return
FROM agree a JOIN closing c ON c.asset = a.asset AND c.date = a.date WHERE nth = 1""",
    "ticks", extra=[_TICK_DAYS, premium_sql("dret", "asset", 3, 5, 5, "prem"), _MERGED, _TICK_SIGNAL]))
def intraday_first_signal(spark, root):
    bars = cut_lineage(ticks(spark, root), "ticks")
    signals = intraday.intraday_signal(bars, low=48, high=52)
    return rounded(intraday.first_signal_of_day(merged_ticks(spark, root, bars, signals)))
