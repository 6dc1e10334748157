"""Technical indicators on a bars panel.

Each indicator is a list of window stages with the history it needs; any set of
them runs in one pass over the same blocks. Input rows carry ``pos``/``n_obs``
from ``index_series``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketseries.functions.scalar import clip
from marketseries.operators.blocks import (
    BlockContext, DecayedMean, decay_block, decayed_means, exact_quantiles, index_series, join_group_stats, over_blocks,
)
from marketseries.operators.expanding import expanding_quantiles
from marketseries.session import cut_lineage

Stage = Callable[[BlockContext], dict[str, Column]]


@dataclass(frozen=True)
class Indicator:
    """Window stages, then decayed means over the whole history, then columns made of both."""

    stages: tuple[Stage, ...]
    back: int
    ahead: int = 0
    temps: tuple[str, ...] = ()
    means: tuple[DecayedMean, ...] = ()
    finish: tuple[tuple[str, Column], ...] = ()


def apply_indicators(
    df: DataFrame, indicators: Sequence[Indicator], keys: Sequence[str] = ("ticker",), block: int = 2048
) -> DataFrame:
    """Run all indicators over one set of blocks (a single exchange by key and block)."""
    depth = max(len(i.stages) for i in indicators)

    def merged(level: int) -> Stage:
        def stage(ctx: BlockContext) -> dict[str, Column]:
            cols: dict[str, Column] = {}
            for ind in indicators:
                if level < len(ind.stages):
                    cols.update(ind.stages[level](ctx))
            return cols

        return stage

    means = [m for i in indicators for m in i.means]
    block = decay_block(means, block) if means else block
    out = over_blocks(
        df,
        keys,
        [merged(level) for level in range(depth)],
        back=max(i.back for i in indicators),
        ahead=max(i.ahead for i in indicators),
        block=block,
        keep_block=bool(means),
    )
    if means:
        out = decayed_means(out, keys, means, block=block)
    out = out.withColumns({name: c for i in indicators for name, c in i.finish})
    return out.drop(*{t for i in indicators for t in i.temps}, *[n for m in means for n in (m.name, f"{m.name}_seen")])


def full_window(agg: Column, count: Column, n: int) -> Column:
    return F.when(count >= n, agg)


def moving_average(col: str = "close", ns: Sequence[int] = (20, 50, 100), prefix: str = "ma") -> Indicator:
    """Mean of the previous n values, only where all n exist."""

    def stage(ctx):
        out = {}
        for n in ns:
            frame = ctx.w.rowsBetween(-n, -1)
            out[f"{prefix}_{n}"] = full_window(F.avg(col).over(frame), F.count(col).over(frame), n)
        return out

    return Indicator((stage,), back=max(ns))


def lagged(cols: dict[str, str], n: int = 1) -> Indicator:
    """``cols`` maps the new name to the column it is taken from."""
    return Indicator((lambda ctx: {name: F.lag(c, n).over(ctx.w) for name, c in cols.items()},), back=n)


def led(cols: dict[str, str], n: int = 1) -> Indicator:
    return Indicator((lambda ctx: {name: F.lead(c, n).over(ctx.w) for name, c in cols.items()},), back=0, ahead=n)


def next_rise(col: str = "close", name: str = "next_rise") -> Indicator:
    """1 where the next value is higher, else 0; the last row is 0."""
    return Indicator(
        (lambda ctx: {name: F.when(F.lead(col, 1).over(ctx.w) > F.col(col), 1).otherwise(0)},), back=0, ahead=1
    )


def log_return(col: str = "adj_close", name: str = "ret") -> Indicator:
    return Indicator((lambda ctx: {name: F.ln(col) - F.ln(F.lag(col, 1).over(ctx.w))},), back=1)


def rsi(col: str = "close", n: int = 20, name: str = "rsi") -> Indicator:
    alpha = 1.0 / n
    delta = f"_d_{name}"

    def first(ctx):
        return {delta: F.col(col) - F.lag(col, 1).over(ctx.w)}

    d, mean = F.col(delta), f"_m_{name}"
    # rises among all changes: a stretch without change leaves the share as it is
    share = DecayedMean(mean, F.greatest(d, F.lit(0.0)), F.abs(d), alpha)
    out = full_window(100.0 * F.col(mean), F.col(f"{mean}_seen"), n)
    return Indicator((first,), back=1, temps=(delta,), means=(share,), finish=((name, out),))


def bollinger(col: str = "close", n: int = 20, k: float = 2.0, lag: int = 0, prefix: str = "bb") -> Indicator:
    """Bands of log1p(price): mean and population deviation over n rows ending ``lag`` rows ago."""
    x = f"_x_{prefix}"

    def first(ctx):
        return {x: F.log1p(col)}

    def second(ctx):
        frame = ctx.w.rowsBetween(-n + 1 - lag, -lag)
        seen = F.count(x).over(frame)
        mid, sd = F.avg(x).over(frame), F.stddev_pop(x).over(frame)
        return {
            f"{prefix}_low": full_window(mid - k * sd, seen, n),
            f"{prefix}_mid": full_window(mid, seen, n),
            f"{prefix}_high": full_window(mid + k * sd, seen, n),
        }

    return Indicator((first, second), back=n - 1 + lag, temps=(x,))


def true_range_columns(ctx: BlockContext, high: str, low: str, close: str) -> Column:
    before = F.lag(close, 1).over(ctx.w)
    spread = F.greatest(
        F.col(high) - F.col(low), F.abs(F.col(high) - before), F.abs(F.col(low) - before)
    )
    return F.when(before.isNotNull(), spread)


def atr(high: str = "high", low: str = "low", close: str = "close", n: int = 14, name: str = "atr") -> Indicator:
    """Wilder average of the true range, weights normalised over the rows present."""
    alpha = 1.0 / n
    tr = f"_tr_{name}"

    def first(ctx):
        return {tr: true_range_columns(ctx, high, low, close)}

    mean = f"_m_{name}"
    out = full_window(F.col(mean), F.col(f"{mean}_seen"), n)
    average = DecayedMean(mean, F.col(tr), F.when(F.col(tr).isNotNull(), 1.0), alpha)
    return Indicator((first,), back=1, temps=(tr,), means=(average,), finish=((name, out),))


def macd(col: str = "close", fast: int = 12, slow: int = 26, name: str = "macd") -> Indicator:
    """Difference of two exponential means, each started at the first value of the series."""

    def ema(which: str, length: int) -> DecayedMean:
        alpha = 2.0 / (length + 1)
        weight = F.when(F.col("pos") == 0, 1.0).otherwise(alpha)
        return DecayedMean(f"_m_{name}_{which}", F.col(col) * weight, weight, alpha)

    def stage(ctx):
        return {}

    means = (ema("fast", fast), ema("slow", slow))
    out = F.when(F.col("pos") >= slow - 1, F.col(means[0].name) - F.col(means[1].name))
    return Indicator((stage,), back=0, means=means, finish=((name, out),))


def horizon_returns(
    df: DataFrame,
    col: str = "adj_close",
    horizons: Sequence[int] = (1, 2, 3, 6, 9, 12),
    cutoff: float = 0.005,
    key: str = "ticker",
    order: str = "month_end",
    every: str = "year",
    as_of: bool = False,
) -> DataFrame:
    """Change over k rows, clipped to the key's own outer quantiles, as a rate per row.

    With ``as_of`` the quantiles are those of the changes up to each row, so that nothing later is looked at; a key then
    holds one row for each value of ``order``.
    """
    indexed = index_series(df, [key], order, every)
    names = {k: f"returns_{k}m" for k in horizons}
    raw = apply_indicators(
        indexed,
        [
            Indicator(
                (lambda ctx: {names[k]: F.col(col) / F.lag(col, k).over(ctx.w) - 1 for k in horizons},),
                back=max(horizons),
            )
        ],
        keys=[key],
    ).drop("pos", "n_obs")
    probs = {"_low": cutoff, "_high": 1 - cutoff}
    if as_of:
        raw = cut_lineage(raw, "returns")
        changes = raw.unpivot([key, order], list(names.values()), "_name", "_r")
        limits = expanding_quantiles(changes, [key, "_name"], "_r", order, probs, every)
    else:
        limits = exact_quantiles(raw.unpivot([key], list(names.values()), "_name", "_r"), [key, "_name"], "_r", probs)
    at = [key, order] if as_of else [key]
    wide = limits.groupBy(*at).agg(
        *[
            F.max(F.when(F.col("_name") == n, F.col(side))).alias(f"{side}_{n}")
            for n in names.values() for side in ("_low", "_high")
        ]
    )
    out = raw.join(wide, at, "left") if as_of else join_group_stats(raw, wide, at, "left")
    return out.withColumns(
        {
            n: F.pow(clip(F.col(n), F.col(f"_low_{n}"), F.col(f"_high_{n}")) + 1.0, F.lit(1.0 / k)) - 1.0
            for k, n in names.items()
        }
    ).drop(*[c for c in wide.columns if c not in at])
