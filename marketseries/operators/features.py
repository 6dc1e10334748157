"""Feature tables composed from the indicator, panel and forecast operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketseries.functions import scalar
from marketseries.operators import indicators as ind
from marketseries.operators import panel
from marketseries.operators.blocks import index_series, join_group_stats
from marketseries.operators.forecast import above, date_lags
from marketseries.operators.regression import rolling_ols
from marketseries.session import cut_lineage
from marketseries.sources.readers import FACTORS

TECHNICAL = ("garman_klass", "rsi", "bb_low", "bb_mid", "bb_high", "atr", "macd")
HORIZONS = (1, 2, 3, 6, 9, 12)
RETURNS = tuple(f"returns_{k}m" for k in HORIZONS)
ZSCORED = ("atr", "macd")


def daily_indicators(bars: DataFrame, every: str = "month") -> DataFrame:
    """All daily indicators in one pass over (ticker, block)."""
    rows = index_series(bars, ["ticker"], "date", every)
    rows = rows.withColumns({"garman_klass": scalar.garman_klass(), "dollar_volume": scalar.dollar_volume()})
    chosen = [ind.rsi("adj_close"), ind.bollinger("adj_close"), ind.atr(), ind.macd("adj_close")]
    return ind.apply_indicators(rows, chosen).drop("pos", "n_obs")


def monthly_panel(daily: DataFrame, as_of: bool = False) -> DataFrame:
    """Month-end values, mean dollar volume, and z-scores over the whole daily history, or ``as_of`` each month's end.

    A z-score is linear, so it is applied to the month-end value. Count, mean and
    squared deviations are kept per month and merged per ticker: the daily rows
    are aggregated once and never gathered by ticker.
    """
    aggs = [F.avg("dollar_volume").alias("dollar_volume")]
    aggs += [panel.last_present(c, "date").alias(c) for c in ("adj_close", *TECHNICAL)]
    for c in ZSCORED:
        aggs += [
            F.count(c).alias(f"_n_{c}"), F.avg(c).alias(f"_m_{c}"),
            (F.var_pop(c) * F.count(c)).alias(f"_q_{c}"),
        ]
    monthly = daily.groupBy("ticker", F.last_day("date").alias("month_end")).agg(*aggs)
    whole = Window.partitionBy("ticker")  # one row per month
    seen = whole.orderBy("month_end").rowsBetween(Window.unboundedPreceding, 0) if as_of else whole
    for c in ZSCORED:
        n, m, q = F.col(f"_n_{c}"), F.col(f"_m_{c}"), F.col(f"_q_{c}")
        # deviations are taken around the mean of all, which changes no result but keeps digits
        monthly = monthly.withColumn("_all", F.sum(n * m).over(whole) / F.nullif(F.sum(n).over(whole), F.lit(0)))
        gap = F.coalesce(m - F.col("_all"), F.lit(0.0))
        monthly = monthly.withColumns({
            "_k": F.sum(n).over(seen), "_s1": F.sum(n * gap).over(seen), "_s2": F.sum(F.coalesce(q, F.lit(0.0)) + n * gap * gap).over(seen)})
        sd = F.sqrt(F.try_divide(F.col("_s2") - F.try_divide(F.col("_s1") * F.col("_s1"), F.col("_k")), F.col("_k") - 1))
        mean = F.col("_all") + F.try_divide(F.col("_s1"), F.col("_k"))
        monthly = monthly.withColumn("_sd", sd).withColumn(c, F.try_divide(F.col(c) - mean, F.col("_sd")))
    extra = ["_all", "_k", "_s1", "_s2", "_sd", *[f"_{k}_{c}" for c in ZSCORED for k in "nmq"]]
    return monthly.drop(*extra).na.drop()


def monthly_feature_panel(
    bars: DataFrame, universe: int = 150, months: int = 60, min_periods: int = 12, every: str = "month", as_of: bool = False
) -> DataFrame:
    """Month-end features and horizon returns of the most liquid names (rank strictly below ``universe``).

    The monthly table and its liquid part are read several times further down;
    each is written once, so the daily rows are processed only once.
    """
    monthly = cut_lineage(monthly_panel(daily_indicators(bars, every), as_of), "monthly")
    rolled = cut_lineage(panel.rolling_months(monthly, "dollar_volume", months, min_periods), "rolled")
    liquid = panel.top_n(rolled, ["month_end"], "dollar_volume", universe).drop("dollar_volume", "rank")
    return ind.horizon_returns(cut_lineage(liquid, "liquid"), horizons=HORIZONS, as_of=as_of).na.drop()


def with_factor_betas(panel_df: DataFrame, factors: DataFrame, window: int = 24, min_months: int = 10, as_of: bool = False) -> DataFrame:
    """Add last month's rolling factor loadings; gaps get the ticker's own mean (``as_of``: that of the months so far),
    remaining gaps drop the row."""
    panel_df = cut_lineage(panel_df, "panel")
    returns = panel_df.select("ticker", "month_end", "returns_1m")
    joined = panel.keep_min_obs(join_group_stats(returns, factors, ["month_end"]), "ticker", min_months)
    names = [f"beta_{f}" for f in FACTORS]
    betas = rolling_ols(joined, "returns_1m", FACTORS, window).select("ticker", "month_end", *names)
    w = Window.partitionBy("ticker").orderBy("month_end")  # one row per month
    lagged = betas.withColumns({n: F.lag(n, 1).over(w) for n in names})
    out = cut_lineage(panel_df.join(lagged, ["ticker", "month_end"], "left"), "betas")
    return panel.fill_group_mean(out, ["ticker"], names, "month_end" if as_of else None, "year").drop("adj_close").na.drop()


CLUSTER_FEATURES = (*TECHNICAL, *RETURNS, *(f"beta_{f}" for f in FACTORS))


def momentum_seeds(features: Sequence[str] = CLUSTER_FEATURES, targets: Sequence[float] = (30, 45, 55, 70)) -> list[list[float]]:
    """Centroids at zero but for the momentum oscillator, which orders the clusters."""
    return [[float(t) if f == "rsi" else 0.0 for f in features] for t in targets]


DIRECTION = ("ma_20", "ma_50", "ma_100", "rsi", "bb_low", "bb_mid", "bb_high", "volume_lag")


def direction_features(bars: DataFrame, index: DataFrame, tickers: Sequence[str], every: str = "month") -> DataFrame:
    """One row per date: lagged features of every ticker, the index's own lag and whether it rises next.

    Only dates on which all of them are known remain. ``index`` is (date, close).
    """
    rows = index_series(bars, ["ticker"], "date", every)
    feats = ind.apply_indicators(
        rows,
        [ind.moving_average(), ind.rsi(), ind.bollinger(lag=1), ind.lagged({"volume_lag": "volume"})],
    )
    wide = feats.groupBy("date").pivot("ticker", list(tickers)).agg(*[F.first(c).alias(c) for c in DIRECTION])
    own = ind.apply_indicators(
        index_series(index, [], "date", every), [ind.lagged({"index_lag": "close"}), ind.next_rise()], keys=[]
    ).select("date", F.col("close").alias("index_close"), "index_lag", "next_rise")
    return wide.join(own, "date").na.drop()


def load_features(
    load: DataFrame, threshold: float, lags: dict[str, int], ts: str = "ts", y: str = "y"
) -> DataFrame:
    """Outlier filter, calendar parts and exact date lags; rows without all lags are dropped."""
    kept = above(load, y, threshold)
    return date_lags(scalar.calendar_features(kept, ts), lags, ts=ts, y=y).na.drop("any", subset=list(lags))
