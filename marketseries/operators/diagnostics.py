"""Autocorrelation, unit-root test and ARIMA by two-stage least squares.

Every statistic is a set of sums over lagged rows. The lags come from blocks of
positions, the sums from distributed aggregation, so one very long series is
spread like many short ones; per series only a small matrix is solved.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketseries.operators.blocks import index_series, join_group_stats, over_blocks
from marketseries.operators.regression import gram, ols_from_gram, solve_symmetric
from marketseries.session import cut_lineage

# Large-sample critical values of the unit-root t statistic with a constant.
ADF_CRITICAL = {0.01: -3.43, 0.05: -2.86, 0.10: -2.57}


def _lags(rows: DataFrame, keys: Sequence[str], lags: dict[str, Sequence[int]]) -> DataFrame:
    """Add ``{col}_lag{k}`` columns."""

    def stage(ctx):
        return {f"{c}_lag{k}": F.lag(c, k).over(ctx.w) for c, ks in lags.items() for k in ks}

    return over_blocks(rows, keys, [stage], back=max(k for ks in lags.values() for k in ks))


def _deviations(df: DataFrame, keys: Sequence[str], y: str, scaled: bool = False) -> DataFrame:
    stats = df.groupBy(*keys).agg(F.avg(y).alias("_mean"), F.stddev_pop(y).alias("_sd"))
    joined = join_group_stats(df, stats, keys)
    gap = F.col(y) - F.col("_mean")
    return joined.withColumn("_z", F.try_divide(gap, F.col("_sd")) if scaled else gap).drop("_mean", "_sd")


def acf(df: DataFrame, lags: int, keys: Sequence[str] = ("series_id",), ts: str = "ts", y: str = "y", every: str = "month") -> DataFrame:
    keys = list(keys)
    rows = index_series(_deviations(df, keys, y), keys, ts, every)
    lagged = _lags(rows, keys, {"_z": range(1, lags + 1)})
    sums = lagged.groupBy(*keys).agg(
        F.sum(F.col("_z") * F.col("_z")).alias("0"),
        *[F.sum(F.col("_z") * F.col(f"_z_lag{k}")).alias(str(k)) for k in range(1, lags + 1)],
    )
    values = F.array(*[
        F.struct(F.lit(k).alias("lag"), F.try_divide(F.col(str(k)), F.col("0")).alias("acf")) for k in range(lags + 1)
    ])
    return sums.select(*keys, F.explode(values).alias("_v")).select(*keys, "_v.lag", "_v.acf")


def pacf_from_acf(r: np.ndarray) -> np.ndarray:
    """Durbin-Levinson recursion on r[0..L]."""
    out = np.ones(len(r))
    phi = np.zeros(0)
    for k in range(1, len(r)):
        known = r[1:k]
        last = (r[k] - phi @ known[::-1]) / (1.0 - phi @ known)
        phi = np.append(phi - last * phi[::-1], last)
        out[k] = last
    return out


def pacf(df: DataFrame, lags: int, keys: Sequence[str] = ("series_id",), ts: str = "ts", y: str = "y", every: str = "month") -> DataFrame:
    keys = list(keys)

    @F.pandas_udf("array<double>")
    def partial(values: pd.Series) -> pd.Series:
        return values.map(lambda r: pacf_from_acf(np.asarray(r, dtype=float)).tolist())

    table = acf(df, lags, keys, ts, y, every)
    # lags + 1 entries per series
    ordered = table.groupBy(*keys).agg(F.transform(F.sort_array(F.collect_list(F.struct("lag", "acf"))), lambda s: s["acf"]).alias("_r"))
    return ordered.select(*keys, F.posexplode(partial("_r")).alias("lag", "pacf"))


#: Response surface of the unit-root statistic with a constant, and where it holds.
UNIT_ROOT_SMALL = (2.1659, 1.4412, 0.038269)
UNIT_ROOT_LARGE = (1.7339, 0.93202, -0.12745, -0.010368)
UNIT_ROOT_LEAST, UNIT_ROOT_BREAK, UNIT_ROOT_MOST = -18.83, -1.61, 2.74


def unit_root_p_value(stat: float) -> float:
    """Probability of a smaller statistic under a unit root."""
    if stat > UNIT_ROOT_MOST:
        return 1.0
    if stat < UNIT_ROOT_LEAST:
        return 0.0
    surface = UNIT_ROOT_SMALL if stat <= UNIT_ROOT_BREAK else UNIT_ROOT_LARGE
    return 0.5 * math.erfc(-sum(c * stat**k for k, c in enumerate(surface)) / math.sqrt(2))


def adf(
    df: DataFrame,
    keys: Sequence[str] = ("series_id",),
    ts: str = "ts",
    y: str = "y",
    max_lag: int | None = None,
    every: str = "month",
) -> DataFrame:
    """Unit-root regression with a constant; lag length by AIC over the sample that all lags share.

    Each series has its own longest lag, by its length (or ``max_lag``), and the chosen lag is fitted again on all rows
    that it leaves, so a series' result doesn't depend on the others. Scaling y does not change the statistic and keeps
    the sums well conditioned. The p-value is that of a published response surface.
    """
    keys = list(keys)
    rows = index_series(_deviations(df, keys, y, scaled=True), keys, ts, every)
    rows = cut_lineage(rows.select(*keys, "pos", "n_obs", "_z"), "levels")
    if max_lag is None:
        own = F.ceil(12.0 * F.pow(F.col("n_obs") / 100.0, F.lit(0.25))).cast("int")
        longest = rows.agg(F.max(own)).first()[0] or 0
    else:
        own, longest = F.lit(max_lag), max_lag
    rows = rows.withColumn("_limit", own)

    def level(ctx):
        return {"_y1": F.lag("_z", 1).over(ctx.w)}

    def change(ctx):
        return {"_d": F.when(F.col("pos") == 0, 0.0).otherwise(F.col("_z") - F.col("_y1"))}

    def lags(ctx):
        # zero before the start, so that lags beyond the series' own limit take no rows away
        return {f"_d{k}": F.lag("_d", k, 0.0).over(ctx.w) for k in range(1, longest + 1)}

    cols = ["_one", "_y1", *[f"_d{k}" for k in range(1, longest + 1)], "_d"]
    width = len(cols)

    def sums(some: DataFrame, taken: Column) -> DataFrame:
        lagged = over_blocks(some, keys, [level, change, lags], back=longest + 1).withColumn("_one", F.lit(1.0))
        return gram(lagged.filter(taken), keys, cols)

    def fitted(full: np.ndarray, k: int, count: int):
        pick = [*range(2 + k), width - 1]
        sub = full[np.ix_(pick, pick)]
        fit = ols_from_gram(sub)
        return None if fit is None or count <= k + 2 or fit[1] <= 0 else (sub, fit)

    @F.pandas_udf("int")
    def choose(flat: pd.Series, n: pd.Series, limit: pd.Series) -> pd.Series:
        out = []
        for values, count, most in zip(flat, n, limit):
            full = np.asarray(values, dtype=float).reshape(width, width)
            found = [(k, f) for k in range(int(most) + 1) if (f := fitted(full, k, count))]
            aic = [(count * (np.log(2 * np.pi) + np.log(f[1][1] / count) + 1.0) + 2.0 * (k + 2), k) for k, f in found]
            out.append(min(aic)[1] if aic else None)
        return pd.Series(out, dtype="object")

    @F.pandas_udf("stat double, p_value double")
    def test(flat: pd.Series, n: pd.Series, lag: pd.Series) -> pd.DataFrame:
        out = []
        for values, count, k in zip(flat, n, lag):
            found = fitted(np.asarray(values, dtype=float).reshape(width, width), int(k), count)
            if found is None:
                out.append((None, None))
                continue
            sub, fit = found
            unit = np.zeros(int(k) + 2)
            unit[1] = 1.0
            spread = solve_symmetric(sub[:-1, :-1], unit)[1] * fit[1] / (count - k - 2)
            stat = float(fit[0][1] / np.sqrt(spread))
            out.append((stat, unit_root_p_value(stat)))
        return pd.DataFrame(out, columns=["stat", "p_value"])

    limits = rows.groupBy(*keys).agg(F.max("_limit").alias("_most"))
    shared = sums(rows, F.col("pos") > F.col("_limit")).join(limits, keys)
    shared = cut_lineage(shared.withColumn("lags", choose("gram", "n", "_most")).filter("lags is not null").drop("_most"), "lags")
    # the rows that the chosen lag leaves and the longest one doesn't lie at the head of a series
    head = join_group_stats(rows.filter(F.col("pos") <= longest), shared.select(*keys, "lags"), keys)
    head = sums(head, (F.col("pos") > F.col("lags")) & (F.col("pos") <= F.col("_limit")))
    head = head.select(*keys, F.col("gram").alias("_gram"), F.col("n").alias("_n"))
    added = F.when(F.col("_n").isNull(), F.col("gram")).otherwise(F.zip_with("gram", "_gram", lambda x, y: x + y))
    done = shared.join(head, keys, "left").withColumns({"gram": added, "n": F.col("n") + F.coalesce("_n", F.lit(0))})
    done = done.withColumn("_t", test("gram", "n", "lags"))
    return done.select(
        *keys, "_t.stat", (F.col("_t.stat") < ADF_CRITICAL[0.05]).alias("reject_5pct"), "lags", F.col("n").alias("nobs"), "_t.p_value"
    )


def _differenced(df: DataFrame, keys: Sequence[str], ts: str, y: str, d: int, every: str) -> DataFrame:
    """Columns u0 (level) … u{d} (d-th difference), null where history is missing."""
    rows = index_series(df.withColumn("u0", F.col(y)), keys, ts, every)
    if d == 0:
        return rows

    def level(i):
        return lambda ctx: {f"u{i + 1}": F.col(f"u{i}") - F.lag(f"u{i}", 1).over(ctx.w)}

    return over_blocks(rows, keys, [level(i) for i in range(d)], back=d)


def _with_innovations(df, keys, ts, y, d, order, every) -> DataFrame:
    """Differenced rows with ``w``, its lags and the residual ``e`` of a long autoregression."""
    rows = _differenced(df, keys, ts, y, d, every).withColumn("w", F.col(f"u{d}"))
    lagged = _lags(rows, keys, {"w": range(1, order + 1)}).withColumn("_one", F.lit(1.0))
    xs = ["_one", *[f"w_lag{k}" for k in range(1, order + 1)]]
    width = len(xs) + 1

    @F.pandas_udf("array<double>")
    def solve(flat: pd.Series) -> pd.Series:
        out = []
        for values in flat:
            fit = ols_from_gram(np.asarray(values, dtype=float).reshape(width, width))
            out.append(None if fit is None else fit[0].tolist())
        return pd.Series(out, dtype=object)

    # one row per series, written so that the long regression runs only once
    coef = cut_lineage(gram(lagged, keys, [*xs, "w"]).select(*keys, solve("gram").alias("_ar")), "long-ar")
    fitted = sum((F.get("_ar", F.lit(i)) * F.col(x) for i, x in enumerate(xs)), F.lit(0.0))
    return join_group_stats(lagged, coef, keys, "left").withColumn("e", F.col("w") - fitted).drop("_ar")


def arima_fit(
    df: DataFrame,
    p: int,
    d: int,
    q: int,
    keys: Sequence[str] = ("series_id",),
    ts: str = "ts",
    y: str = "y",
    every: str = "month",
) -> DataFrame:
    """Two-stage (Hannan-Rissanen) estimates and the end state of every series, one row each."""
    keys = list(keys)
    rows = _with_innovations(df, keys, ts, y, d, max(p, q) + 5, every)
    if q:
        rows = _lags(rows, keys, {"e": range(1, q + 1)})
    xs = ["_one", *[f"w_lag{k}" for k in range(1, p + 1)], *[f"e_lag{k}" for k in range(1, q + 1)]]
    width = len(xs) + 1

    @F.pandas_udf("coef array<double>, ssr double")
    def solve(flat: pd.Series) -> pd.DataFrame:
        out = []
        for values in flat:
            fit = ols_from_gram(np.asarray(values, dtype=float).reshape(width, width))
            out.append((None, None) if fit is None else (fit[0].tolist(), fit[1]))
        return pd.DataFrame(out, columns=["coef", "ssr"])

    complete = rows.where(F.col("e").isNotNull()) if q == 0 else rows
    fits = gram(complete, keys, [*xs, "w"]).withColumn("_f", solve("gram")).select(
        *keys, "n", F.col("_f.coef").alias("coef"), F.col("_f.ssr").alias("ssr")
    )
    keep = max(p, q, 1)
    tail = rows.where(F.col("pos") >= F.col("n_obs") - keep)
    # at most max(p, q, 1) rows per series are listed
    state = tail.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("pos", "w", "e")), asc=False).alias("recent"),
        *[F.max_by(f"u{i}", "pos").alias(f"u{i}") for i in range(d)],
    )
    start = F.concat(
        F.transform(F.slice("recent", 1, p), lambda r: r["w"]) if p else F.array().cast("array<double>"),
        F.transform(F.slice("recent", 1, q), lambda r: r["e"]) if q else F.array().cast("array<double>"),
        F.array(*[F.col(f"u{i}") for i in range(d)]) if d else F.array().cast("array<double>"),
    )
    n, ssr = F.col("n"), F.col("ssr")
    k = 1 + p + q
    return fits.join(state, keys).select(
        *keys, F.lit(p).alias("p"), F.lit(d).alias("d"), F.lit(q).alias("q"), "coef", start.alias("state"), "n",
        (ssr / n).alias("sigma2"),
        (2.0 * k + n * (F.ln(F.lit(2 * np.pi)) + F.ln(ssr / n) + 1.0)).alias("aic"),
    )


def _transition(coef: np.ndarray, p: int, d: int, q: int) -> tuple[np.ndarray, np.ndarray]:
    """Matrix that moves [w…, e…, u…, 1] one step ahead, and the row that reads w."""
    size = p + q + d + 1
    w_row = np.zeros(size)
    w_row[:p] = coef[1 : 1 + p]
    w_row[p : p + q] = coef[1 + p :]
    w_row[-1] = coef[0]
    a = np.zeros((size, size))
    if p:
        a[0] = w_row
        for i in range(1, p):
            a[i, i - 1] = 1.0
    for i in range(1, q):
        a[p + i, p + i - 1] = 1.0
    for i in range(d):
        a[p + q + i] = w_row
        for j in range(i, d):
            a[p + q + i, p + q + j] += 1.0
    a[-1, -1] = 1.0
    return a, w_row


@F.udtf(returnType="step int, forecast double")
class _ForecastRows:
    """Table function: the steps first..last of a fitted model, from a matrix power of its transition."""

    def eval(self, p: int, d: int, q: int, coef: list, state: list, first: int, last: int):
        if coef is None or state is None:
            return
        a, w_row = _transition(np.asarray(coef, dtype=float), p, d, q)
        s = np.linalg.matrix_power(a, first - 1) @ np.append(np.asarray(state, dtype=float), 1.0)
        for step in range(first, last + 1):
            w = w_row @ s
            s = a @ s
            yield step, float(s[p + q] if d else w)


def arima_forecast(model: DataFrame, horizon: int, keys: Sequence[str] = ("series_id",), chunk: int = 1024) -> DataFrame:
    """``step`` 1..horizon and ``forecast`` per series, future shocks set to zero.

    A long horizon is cut into chunks; each starts from a matrix power of the transition, so the chunks of one series
    run in parallel. A lateral join of the chunks with a table function makes the rows.
    """
    keys = list(keys)
    starts = F.explode(F.sequence(F.lit(1), F.lit(horizon), F.lit(chunk))).alias("_from")
    work = model.where(F.col("coef").isNotNull()).select(*keys, "p", "d", "q", "coef", "state", starts)
    work = work.withColumn("_to", F.least(F.col("_from") + chunk - 1, F.lit(horizon))).repartition(*keys, "_from")
    steps = _ForecastRows(*[F.col(c).outer() for c in ("p", "d", "q", "coef", "state", "_from", "_to")])
    return work.lateralJoin(steps).select(*keys, "step", "forecast")


def order_search(
    df: DataFrame,
    ps: Sequence[int],
    ds: Sequence[int],
    qs: Sequence[int],
    keys: Sequence[str] = ("series_id",),
    ts: str = "ts",
    y: str = "y",
    every: str = "month",
) -> DataFrame:
    """AIC of every (p, d, q); all orders of one d come from a single matrix of sums."""
    keys = list(keys)
    big_p, big_q = max(ps), max(qs)
    tables = []
    for d in ds:
        rows = _with_innovations(df, keys, ts, y, d, max(big_p, big_q) + 5, every)
        if big_q:
            rows = _lags(rows, keys, {"e": range(1, big_q + 1)})
        cols = ["_one", *[f"w_lag{k}" for k in range(1, big_p + 1)], *[f"e_lag{k}" for k in range(1, big_q + 1)], "w"]
        tables.append(_score_orders(gram(rows, keys, cols), keys, len(cols), ps, d, qs, big_p))
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def _score_orders(sums: DataFrame, keys, width: int, ps, d: int, qs, big_p: int) -> DataFrame:
    @F.pandas_udf("array<struct<p int, q int, aic double>>")
    def score(flat: pd.Series, n: pd.Series) -> pd.Series:
        out = []
        for values, count in zip(flat, n):
            full = np.asarray(values, dtype=float).reshape(width, width)
            rows = []
            for p in ps:
                for q in qs:
                    pick = [0, *range(1, p + 1), *range(1 + big_p, 1 + big_p + q), width - 1]
                    fit = ols_from_gram(full[np.ix_(pick, pick)])
                    if fit is not None and fit[1] > 0:
                        aic = count * (np.log(2 * np.pi) + np.log(fit[1] / count) + 1.0) + 2.0 * (1 + p + q)
                        rows.append({"p": int(p), "q": int(q), "aic": float(aic)})
            out.append(rows)
        return pd.Series(out)

    return sums.select(*keys, "n", F.explode(score("gram", "n")).alias("_s")).select(
        *keys, "_s.p", F.lit(d).alias("d"), "_s.q", "n", "_s.aic"
    )
