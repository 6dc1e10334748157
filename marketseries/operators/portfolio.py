"""Lookback prices, moments and portfolio weights per rebalance date."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketseries.operators.blocks import join_group_stats
from marketseries.session import cut_lineage

TRADING_DAYS = 252
#: Names of a block of the covariance; a task multiplies two blocks.
BLOCK_NAMES = 64


def lookback_prices(holdings: DataFrame, prices: DataFrame, months: int = 12, price: str = "adj_close") -> DataFrame:
    """Prices of each held name in the ``months`` before its rebalance date.

    The short holdings table is spread over the months it looks back on; daily
    rows are not copied before the join, which is an equality on (ticker, month).
    """
    span = F.explode(F.sequence(F.lit(1), F.lit(months))).alias("_back")
    wanted = holdings.select("rebalance_date", "ticker", span).select(
        "rebalance_date", "ticker", F.add_months("rebalance_date", -F.col("_back")).alias("_month")
    )
    daily = prices.where(F.col(price).isNotNull()).select(
        "ticker", "date", F.col(price).alias("price"), F.trunc("date", "month").alias("_month")
    )
    return daily.join(wanted, ["ticker", "_month"]).drop("_month")


def lookback_returns(lookback: DataFrame) -> DataFrame:
    """Simple returns between the prices inside the window (a name has at most one per day of it)."""
    w = Window.partitionBy("rebalance_date", "ticker").orderBy("date")
    return lookback.withColumn("ret", F.col("price") / F.lag("price", 1).over(w) - 1).where(F.col("ret").isNotNull())


def annualised_return(returns: DataFrame) -> DataFrame:
    """Compound yearly rate per rebalance date and name."""
    growth = F.sum(F.log1p("ret")) * TRADING_DAYS / F.count("ret")
    return returns.groupBy("rebalance_date", "ticker").agg((F.exp(growth) - 1).alias("mu"))


def return_blocks(returns: DataFrame, size: int = BLOCK_NAMES) -> DataFrame:
    """(rebalance_date, parts, block, names): the names of a date dealt out by hash in blocks of about ``size``.

    ``names`` holds for each name its returns over all days of the date's window, in time order and null where it has
    none, whether it has all, and their sum. A name has at most one row per day of the window.
    """
    rows = returns.select("rebalance_date", "ticker", "date", "ret")
    held = rows.select("rebalance_date", "ticker").distinct()
    parts = held.groupBy("rebalance_date").agg(F.ceil(F.count(F.lit(1)) / size).alias("parts"))
    held = held.join(parts, "rebalance_date").withColumn("block", F.pmod(F.xxhash64("ticker"), F.col("parts")))
    days = rows.select("rebalance_date", "date").distinct()
    whole = held.join(days, "rebalance_date").join(rows, ["rebalance_date", "ticker", "date"], "left")
    series = F.transform(F.sort_array(F.collect_list(F.struct("date", "ret"))), lambda r: r["ret"])
    vectors = whole.groupBy("rebalance_date", "parts", "block", "ticker").agg(
        series.alias("x"), (F.count("ret") == F.count(F.lit(1))).alias("full"), F.sum("ret").alias("total"))
    names = F.sort_array(F.collect_list(F.struct("ticker", "x", "full", "total")))
    return vectors.groupBy("rebalance_date", "parts", "block").agg(names.alias("names"))


def _pair_covariance(a: Column, b: Column) -> Column:
    """Sample covariance of two names over the days that both have; null under two such days."""

    def finished(n: Column, x: Column, y: Column, xy: Column) -> Column:
        return F.when(n >= 2, (xy - x * y / n) / (n - 1))

    none = F.struct(*[F.lit(0.0).alias(c) for c in ("n", "x", "y", "xy")])
    pairs = F.zip_with(a["x"], b["x"], lambda x, y: F.struct(x.alias("x"), y.alias("y")))
    masked = F.aggregate(
        pairs, none,
        lambda s, v: F.when(v["x"].isNull() | v["y"].isNull(), s).otherwise(F.struct(
            (s["n"] + 1.0).alias("n"), (s["x"] + v["x"]).alias("x"), (s["y"] + v["y"]).alias("y"),
            (s["xy"] + v["x"] * v["y"]).alias("xy"))),
        lambda s: finished(s["n"], s["x"], s["y"], s["xy"]),
    )
    products = F.aggregate(F.zip_with(a["x"], b["x"], lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)
    whole = finished(F.size(a["x"]).cast("double"), a["total"], b["total"], products)
    return F.when(a["full"] & b["full"], whole).otherwise(masked)


def covariance_blocks(returns: DataFrame, size: int = BLOCK_NAMES) -> DataFrame:
    """Annualised covariance by blocks: rebalance_date, i, j, rows and columns (tickers) and cov, a matrix.

    One row for each pair of blocks i <= j of a date, found by an equality join on (date, i, j), so that the work and
    the memory of a task are those of two blocks, however many names a date has.
    """
    blocks = return_blocks(returns, size)
    left = blocks.select("rebalance_date", F.col("block").alias("i"), F.explode(F.sequence("block", F.col("parts") - 1)).alias("j"),
                         F.col("names").alias("a"))
    right = blocks.select("rebalance_date", F.explode(F.sequence(F.lit(0).cast("long"), "block")).alias("i"), F.col("block").alias("j"),
                          F.col("names").alias("b"))
    product = F.transform("a", lambda x: F.transform("b", lambda y: _pair_covariance(x, y) * TRADING_DAYS))
    return left.join(right, ["rebalance_date", "i", "j"]).select(
        "rebalance_date", "i", "j", F.col("a.ticker").alias("rows"), F.col("b.ticker").alias("columns"), product.alias("cov"))


def lookback_covariance(returns: DataFrame, size: int = BLOCK_NAMES) -> DataFrame:
    """Annualised covariance of the held names, one row per pair with ticker_i <= ticker_j; see :func:`covariance_blocks`."""
    blocks = covariance_blocks(cut_lineage(returns, "returns"), size)  # they are read for names, days and values
    lines = blocks.select("rebalance_date", "i", "j", "columns", F.explode(F.arrays_zip("rows", "cov")).alias("r"))
    cells = lines.select("rebalance_date", "i", "j", F.col("r.rows").alias("one"),
                         F.explode(F.arrays_zip(F.col("columns").alias("two"), F.col("r.cov").alias("cov"))).alias("c"))
    cells = cells.select("rebalance_date", "i", "j", "one", F.col("c.two").alias("two"), F.col("c.cov").alias("cov"))
    once = (F.col("i") < F.col("j")) | (F.col("one") <= F.col("two"))
    return cells.where(once & F.col("cov").isNotNull()).select(
        "rebalance_date", F.least("one", "two").alias("ticker_i"), F.greatest("one", "two").alias("ticker_j"), "cov")


def project_capped(v: np.ndarray, low: float, high: float, guess: np.ndarray | None = None):
    """Row by row the nearest point with entries in [low, high] that sums to one, and its shift.

    Newton steps on the common shift, held inside a shrinking bracket; ``guess``
    is the shift of a nearby problem.
    """
    top = v.max(axis=1, keepdims=True)
    v = v - top
    a, b = v.min(axis=1, keepdims=True) - high, np.full_like(top, -low)
    tolerance = 1e-13 * max(1.0, np.abs(v).max())
    shift = (v.sum(axis=1, keepdims=True) - 1) / v.shape[1] if guess is None else np.clip(guess - top, a, b)
    for _ in range(60):
        w = np.minimum(np.maximum(v - shift, low), high)
        over = w.sum(axis=1, keepdims=True) - 1
        if np.abs(over).max() < tolerance:
            break
        a, b = np.where(over > 0, shift, a), np.where(over > 0, b, shift)
        free = ((w > low) & (w < high)).sum(axis=1, keepdims=True)
        newton = shift + over / np.maximum(free, 1)
        inside = (free > 0) & (newton > a) & (newton < b)
        shift = np.where(inside, newton, (a + b) / 2)
    return w, shift + top


def _frontier(cov, excess, trades, low, high, start, steps=250):
    """Bounded mean-variance weights for each trade-off, by accelerated projected gradient."""
    step = 1.0 / np.linalg.norm(cov, 2)
    pull = np.outer(trades, excess)
    w = z = np.repeat(start[None, :], len(trades), axis=0)
    t, shift = 1.0, None
    for _ in range(steps):
        moved, shift = project_capped(z - step * (z @ cov - pull), low, high, shift)
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z = moved + (t - 1) / t_next * (moved - w)
        done = np.abs(moved - w).max() < 1e-9
        w, t = moved, t_next
        if done:
            break
    return w


def max_sharpe(mu: np.ndarray, cov: np.ndarray, low: float, high: float, risk_free: float = 0.02) -> np.ndarray | None:
    """Bounded weights of the highest Sharpe ratio, or None where there is no solution.

    The best portfolio lies on the mean-variance frontier, along which the ratio
    has one peak: a sweep over trade-offs is narrowed around its best point.
    """
    n = len(mu)
    excess = mu - risk_free
    if n * high < 1 or n * low > 1 or not np.all(np.isfinite(mu)) or not np.all(np.isfinite(cov)) or excess.max() <= 0:
        return None
    cov = cov + np.eye(n) * 1e-10 * np.trace(cov) / n
    best, peak = np.full(n, 1.0 / n), -np.inf
    centre = np.log10(np.trace(cov) / n / np.abs(excess).max())
    reach = 3.0
    for _ in range(4):
        trades = np.linspace(centre - reach, centre + reach, 13)
        w = _frontier(cov, excess, 10.0**trades, low, high, best)
        ratios = (w @ excess) / np.sqrt(np.einsum("ki,ij,kj->k", w, cov, w))
        at = int(np.argmax(ratios))
        if ratios[at] > peak:
            best, peak = w[at], ratios[at]
        centre, reach = trades[at], reach / 6
    return best if peak > 0 else None


def cleaned(w: np.ndarray) -> np.ndarray:
    return np.where(np.abs(w) < 1e-4, 0.0, np.round(w, 5))


def max_sharpe_weights(
    holdings: DataFrame,
    returns: DataFrame,
    upper: float = 0.1,
    risk_free: float = 0.02,
) -> DataFrame:
    """Weights per rebalance date; equal weights where no bounded solution exists.

    ``method`` tells which of both was used. Every held name gets a weight, also one without a lookback. Rates and
    covariances are made by Spark; the group of a date holds them alone, and only solves.
    """
    given = holdings.select("rebalance_date", "ticker").distinct()
    rows = cut_lineage(returns.join(given, ["rebalance_date", "ticker"], "left_semi"), "returns")
    rates = given.join(annualised_return(rows), ["rebalance_date", "ticker"], "left")
    blocks = covariance_blocks(rows).select("rebalance_date", "rows", "columns", "cov")
    # little data but long solves: keep the partitions apart, so that dates are solved side by side
    width = int(holdings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rates, blocks = (x.repartition(width, "rebalance_date") for x in (rates, blocks))

    def per_date(rates: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
        if rates.empty:
            return pd.DataFrame({"rebalance_date": [], "ticker": [], "weight": [], "method": []})
        rates = rates.sort_values("ticker")
        names, mu = rates["ticker"].to_numpy(), rates["mu"].to_numpy(dtype=float)
        n = len(names)
        weights = None
        if np.all(np.isfinite(mu)):
            at = {t: i for i, t in enumerate(names)}
            cov = np.full((n, n), np.nan)
            for one, two, part in zip(blocks["rows"], blocks["columns"], blocks["cov"]):
                i, j = [at[t] for t in one], [at[t] for t in two]
                part = np.array([np.asarray(line, dtype=float) for line in part])
                cov[np.ix_(i, j)] = part
                cov[np.ix_(j, i)] = part.T
            weights = max_sharpe(mu, cov, round(1 / (2 * n), 3), upper, risk_free)
        method = "equal" if weights is None else "max_sharpe"
        out = np.full(n, 1.0 / n) if weights is None else cleaned(weights)
        return pd.DataFrame({"rebalance_date": rates["rebalance_date"].iloc[0], "ticker": names, "weight": out, "method": method})

    return rates.groupBy("rebalance_date").cogroup(blocks.groupBy("rebalance_date")).applyInPandas(
        per_date, "rebalance_date date, ticker string, weight double, method string"
    )


def equal_weights(holdings: DataFrame) -> DataFrame:
    size = holdings.groupBy("rebalance_date").agg(F.count(F.lit(1)).alias("_n"))
    return join_group_stats(holdings, size, ["rebalance_date"]).select(
        "rebalance_date", "ticker", (F.lit(1.0) / F.col("_n")).alias("weight")
    )
