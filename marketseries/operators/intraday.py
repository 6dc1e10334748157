"""Daily variance forecasts, the premium signal and the first intraday trade of a day."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketseries.operators.blocks import ensure_index, index_series
from marketseries.operators.indicators import Indicator, apply_indicators, bollinger, full_window, rsi

ALPHAS = (0.02, 0.05, 0.10, 0.15, 0.20)
BETAS = (0.70, 0.75, 0.80, 0.85, 0.90, 0.94, 0.97)


def five_minute_bars(ticks: DataFrame, tiebreak: str, asset: str = "asset", ts: str = "ts", price: str = "price") -> DataFrame:
    """Open/high/low/close per asset and five minutes; partial sums first, so a busy asset stays cheap."""
    order = F.struct(ts, tiebreak)
    bucket = F.window(ts, "5 minutes")["start"].cast("timestamp_ntz")
    return ticks.groupBy(F.col(asset).alias("asset"), bucket.alias("ts")).agg(
        F.min_by(price, order).alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.max_by(price, order).alias("close"),
    )


def session_of(ts: str, session: str = "day") -> Column:
    """The trading session of a moment: its date, or the start of its hour or other unit."""
    return F.to_date(ts) if session == "day" else F.date_trunc(session, F.col(ts)).cast("timestamp_ntz")


def daily_close(bars: DataFrame, session: str = "day") -> DataFrame:
    return bars.groupBy("asset", session_of("ts", session).alias("date")).agg(F.max_by("close", "ts").alias("close"))


#: Rows of a block; each is sent to it once, and to the next one if a window there begins with it.
GARCH_BLOCK = 1024


def garch_windows(r: np.ndarray, window: int, alphas: Sequence[float] = ALPHAS, betas: Sequence[float] = BETAS):
    """Whether each window of ``r`` is complete (no NaN), its best (alpha, beta) under variance targeting, the next variance.

    Windows are views of ``r``; all pairs and windows take a step of the recursion together. Without spread: NaN.
    """
    w = np.lib.stride_tricks.sliding_window_view(r, window)
    full = ~np.isnan(w).any(axis=1)
    target = w.var(axis=1)
    target = np.where(target > 0, target, np.nan)
    pairs = np.array([(a, b, 1 - a - b) for a in alphas for b in betas if a + b < 1])
    a, b, c = pairs.T[:, :, None]
    v, loss = np.repeat(target[None], len(pairs), axis=0), np.zeros((len(pairs), len(w)))
    for t in range(window):
        square = w[:, t] ** 2
        loss += np.log(v) + square / v
        v = target * c + a * square + b * v
    best = loss.argmin(axis=0)
    there = np.isfinite(target)
    fitted = (np.where(there, x, np.nan) for x in (pairs[best, 0], pairs[best, 1], v[best, np.arange(len(w))]))
    return full, *fitted


def garch_forecast(
    returns: DataFrame,
    window: int = 180,
    key: str = "asset",
    date: str = "date",
    ret: str = "ret",
    every: str = "month",
    alphas: Sequence[float] = ALPHAS,
    betas: Sequence[float] = BETAS,
    block: int = GARCH_BLOCK,
) -> DataFrame:
    """One-day-ahead variance from the last ``window`` returns of each row, itself included.

    Rows without that many returns are left out; a window without spread has null estimates. Rows meet in blocks of
    consecutive positions, with the ``window`` - 1 rows before it: a return is sent once or twice, never once for each
    window it is in. Only the array of a block's returns goes to a worker, which looks at windows of it in place.
    """
    rows, added = ensure_index(returns, [key], date, every)
    last = F.expr(f"least(pos + {window - 1}, n_obs - 1) div {block}")
    dealt = rows.select(
        F.col(key).alias("_key"), F.explode(F.sequence(F.expr(f"pos div {block}"), last)).alias("_block"),
        F.struct("pos", F.col(ret).cast("double").alias("r"), F.struct(*returns.columns).alias("row")).alias("_row"))
    # at most block + window - 1 rows
    blocks = dealt.groupBy("_key", "_block").agg(F.sort_array(F.collect_list("_row")).alias("_rows"))

    @F.pandas_udf("full array<boolean>, alpha array<double>, beta array<double>, variance array<double>")
    def fit(series: pd.Series) -> pd.DataFrame:
        found = [garch_windows(np.asarray(r, dtype=float), window, alphas, betas) for r in series]
        return pd.DataFrame(found, columns=["full", "alpha", "beta", "variance"])

    blocks = blocks.where(F.size("_rows") >= window).withColumn("_g", fit(F.transform("_rows", lambda x: x["r"])))
    ends = F.slice("_rows", window, F.size("_rows")).alias("x")
    found = blocks.select("_block", F.explode(F.arrays_zip(
        ends, F.col("_g.full").alias("full"), F.col("_g.alpha").alias("alpha"), F.col("_g.beta").alias("beta"),
        F.col("_g.variance").alias("variance"))).alias("z"))
    found = found.where((F.col("z.x.pos") >= F.col("_block") * block) & F.col("z.full"))
    fitted = [F.nanvl(f"z.{c}", F.lit(None)).alias(c) for c in ("alpha", "beta", "variance")]
    return found.select("z.x.row.*", *fitted).drop(*[c for c in added if c not in returns.columns])


def premium_signal(
    df: DataFrame, forecast: str = "variance", realised: str = "realised", n: int = 180, key: str = "asset", date: str = "date", every: str = "month"
) -> DataFrame:
    """Forecast premium over realised variance, and -1/0/1 beyond its own rolling deviation."""
    rows, added = ensure_index(df, [key], date, every)
    rows = rows.withColumn(
        "premium", F.try_divide(F.col(forecast) - F.col(realised), F.col(realised))
    )

    def stage(ctx):
        frame = ctx.w.rowsBetween(-(n - 1), 0)
        return {"premium_sd": full_window(F.stddev_samp("premium").over(frame), F.count("premium").over(frame), n)}

    out = apply_indicators(rows, [Indicator((stage,), back=n - 1)], [key]).drop(*added)
    signal = (
        F.when(F.col("premium") > F.col("premium_sd"), 1).when(F.col("premium") < -F.col("premium_sd"), -1)
        .when(F.col("premium_sd").isNotNull(), 0)
    )
    return out.withColumn("signal_daily", signal)


def rolling_variance(df: DataFrame, n: int, key: str = "asset", date: str = "date", ret: str = "ret", every: str = "month") -> DataFrame:
    rows, added = ensure_index(df, [key], date, every)

    def stage(ctx):
        frame = ctx.w.rowsBetween(-(n - 1), 0)
        return {"realised": full_window(F.var_samp(ret).over(frame), F.count(ret).over(frame), n)}

    return apply_indicators(rows, [Indicator((stage,), back=n - 1)], [key]).drop(*added)


def attach_previous_signal(
    ticks: DataFrame, daily: DataFrame, signal: str = "signal_daily", ret: str = "ret", session: str = "day"
) -> DataFrame:
    """Each tick gets the signal of the session before its own; sessions without a return are left out."""
    rows, _ = ensure_index(daily, ["asset"], "date")
    shifted = apply_indicators(rows, [Indicator((lambda ctx: {"_s": F.lag(signal, 1).over(ctx.w)},), back=1)], ["asset"])
    usable = shifted.where(F.col(ret).isNotNull()).select("asset", "date", F.col("_s").alias(signal))
    return ticks.withColumn("date", session_of("ts", session)).join(usable, ["asset", "date"])


def intraday_signal(bars: DataFrame, length: int = 20, low: float = 30.0, high: float = 70.0) -> DataFrame:
    """1 where price is stretched upwards, -1 downwards, else 0."""
    rows = index_series(bars, ["asset"], "ts", "day")
    out = apply_indicators(rows, [rsi("close", length), bollinger("close", length)], ["asset"]).drop("pos", "n_obs")
    up = (F.col("rsi") > high) & (F.log1p("close") > F.col("bb_high"))
    down = (F.col("rsi") < low) & (F.log1p("close") < F.col("bb_low"))
    return out.withColumn("signal_intraday", F.when(up, 1).when(down, -1).otherwise(0))


def first_signal_of_day(ticks: DataFrame) -> DataFrame:
    """First tick of a day on which both signals agree, traded against and held to the close."""
    agree = (F.col("signal_daily") == F.col("signal_intraday")) & (F.col("signal_intraday") != 0)
    days = ticks.groupBy("asset", "date").agg(
        F.min(F.when(agree, F.col("ts"))).alias("entry_ts"),
        F.min_by(F.when(agree, F.col("close")), F.when(agree, F.col("ts"))).alias("entry_close"),
        F.min_by(F.when(agree, -F.col("signal_intraday")), F.when(agree, F.col("ts"))).alias("side"),
        F.max_by("close", "ts").alias("exit_close"),
    )
    return days.where(F.col("entry_ts").isNotNull()).withColumn(
        "trade_return", F.col("side") * (F.ln("exit_close") - F.ln("entry_close"))
    )
