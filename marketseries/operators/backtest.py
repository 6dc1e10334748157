"""From signals and weights to daily strategy returns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketseries.functions.scalar import month_start, next_month_start
from marketseries.operators.blocks import index_series, running_sum
from marketseries.operators.indicators import apply_indicators, led
from marketseries.session import cut_lineage


def hold_next_month(signals: DataFrame, key: str = "ticker", month: str = "month_end") -> DataFrame:
    """Names chosen at a month end are held from the first day of the next month."""
    return signals.select(next_month_start(month).alias("rebalance_date"), key).distinct()


def held_returns(holdings: DataFrame, returns: DataFrame, key: str = "ticker", date: str = "date") -> DataFrame:
    """Daily rows of each held name inside its holding month.

    A holding lasts one calendar month, so the date range is an equality on the
    first day of the month and the join hashes on (month, name).
    """
    daily = returns.withColumn("rebalance_date", month_start(date))
    return daily.join(holdings, ["rebalance_date", key])


def equal_weight_returns(holdings: DataFrame, returns: DataFrame, ret: str = "ret", date: str = "date") -> DataFrame:
    return held_returns(holdings, returns, date=date).groupBy(date).agg(F.avg(ret).alias("portfolio_return"))


def weighted_returns(weights: DataFrame, returns: DataFrame, ret: str = "ret", date: str = "date") -> DataFrame:
    """Sum of weight times return over the names present that day; weights are not rescaled."""
    held = held_returns(weights, returns.where(F.col(ret).isNotNull()), date=date)
    return held.groupBy(date).agg(F.sum(F.col(ret) * F.col("weight")).alias("portfolio_return"))


def log_compound(ret: Column) -> Column:
    """Growth in logs; null for a return at or under -1, which adds nothing to a sum."""
    return F.log1p(ret)


def compounded(df: DataFrame, cols: dict[str, str], date: str = "date", every: str = "year") -> DataFrame:
    """exp(running sum of ln(1+r)) - 1 for each named return column.

    A return of exactly -1 is a total loss: the result is -1 from there on. It is null where r is null or under -1.
    """
    sums = {name: log_compound(F.col(c)) for name, c in cols.items()}
    lost = {f"_lost_{name}": F.when(F.col(c) == -1, 1.0) for name, c in cols.items()}
    out = running_sum(df, [], date, {**sums, **lost}, every)
    return out.withColumns({
        n: F.when(F.col(c) >= -1, F.when(F.col(f"_lost_{n}") > 0, -1.0).otherwise(F.exp(n) - 1)) for n, c in cols.items()
    }).drop(*lost)


def compare_benchmark(portfolio: DataFrame, benchmark: DataFrame, date: str = "date") -> DataFrame:
    """Compounded strategy and benchmark over their common dates.

    The joined series has one row per date and is read twice by the running sum;
    it is written first, so the strategy behind it runs once.
    """
    both = cut_lineage(portfolio.join(benchmark, date), "strategy")
    return compounded(both, {"strategy_cum": "portfolio_return", "benchmark_cum": "benchmark_return"}, date)


def signal_backtest(
    df: DataFrame, pred: str, price: str, keys: tuple[str, ...] = (), date: str = "date", every: str = "month"
) -> DataFrame:
    """Long when the signal is up, short otherwise, on the next log return; last row of a series is dropped."""
    indexed = index_series(df, keys, date, every)
    ahead = apply_indicators(indexed, [led({"_next": price})], keys).drop("pos", "n_obs")
    legs = ahead.withColumn("market_return", F.ln("_next") - F.ln(price)).where(F.col("market_return").isNotNull())
    legs = legs.withColumn(
        "strategy_return", F.when(F.col(pred), F.col("market_return")).otherwise(-F.col("market_return"))
    ).drop("_next")
    return running_sum(
        legs, keys, date, {"market_cum": F.col("market_return"), "strategy_cum": F.col("strategy_return")}, every
    )
