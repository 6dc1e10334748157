"""Panel reshaping, monthly aggregation and cross-sectional helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketseries.operators.blocks import average_rank, join_group_stats, running_sum, top_n

__all__ = [
    "average_rank", "drop_incomplete_dates", "expanding_moments", "fill_group_mean", "group_moments", "group_zscore", "holdings_list",
    "keep_min_obs", "last_present", "monthly_last", "monthly_mean", "rolling_months", "to_long", "to_wide", "top_n",
]


def monthly_mean(df: DataFrame, keys: Sequence[str], cols: Sequence[str], date: str = "date") -> DataFrame:
    return df.groupBy(*keys, F.last_day(date).alias("month_end")).agg(*[F.avg(c).alias(c) for c in cols])


def last_present(col: str, order: str) -> Column:
    """Last non-null value; each column on its own."""
    return F.max_by(F.col(col), F.when(F.col(col).isNotNull(), F.col(order)))


def monthly_last(df: DataFrame, keys: Sequence[str], cols: Sequence[str], date: str = "date") -> DataFrame:
    return df.groupBy(*keys, F.last_day(date).alias("month_end")).agg(*[last_present(c, date).alias(c) for c in cols])


def rolling_months(
    df: DataFrame, col: str, months: int, min_periods: int, keys: Sequence[str] = ("ticker",), month: str = "month_end"
) -> DataFrame:
    """Mean over the last ``months`` grid months; the grid is every month present in the panel.

    The grid has one row per calendar month, so its size is bounded by the
    calendar and it is broadcast; a key holds at most one row per month.
    """
    grid = (
        df.select(month).distinct().select(month, F.row_number().over(Window.orderBy(month)).alias("_grid"))
    )
    frame = Window.partitionBy(*keys).orderBy("_grid").rangeBetween(-(months - 1), 0)
    return (
        df.join(F.broadcast(grid), month)
        .withColumn(col, F.when(F.count(col).over(frame) >= min_periods, F.avg(col).over(frame)))
        .drop("_grid")
    )


def group_moments(df: DataFrame, by: Sequence[str], cols: Sequence[str]) -> DataFrame:
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"_mean_{c}"), F.stddev_samp(c).alias(f"_sd_{c}")]
    return df.groupBy(*by).agg(*aggs)


def expanding_moments(
    df: DataFrame, by: Sequence[str], cols: Sequence[str], ts: str, every: str = "month", tiebreak: Sequence[str] = ()
) -> DataFrame:
    """Add ``_mean_c`` and ``_sd_c`` over the rows of the group up to and including each row, in time order.

    Counts, sums and squares are kept per time bucket, carried over the buckets and added up inside the row's own one,
    so no series is one task. They are taken around the group's mean, which changes no result but keeps digits.
    """
    by = list(by)
    centred = join_group_stats(df, df.groupBy(*by).agg(*[F.avg(c).alias(f"_c_{c}") for c in cols]), by)
    sums = {}
    for c in cols:
        gap = F.col(c) - F.col(f"_c_{c}")
        sums |= {f"_n_{c}": F.when(gap.isNotNull(), 1.0), f"_s1_{c}": gap, f"_s2_{c}": gap * gap}
    rows = running_sum(centred, by, ts, sums, every, tiebreak)
    out = {}
    for c in cols:
        n, s1, s2 = F.col(f"_n_{c}"), F.col(f"_s1_{c}"), F.col(f"_s2_{c}")
        out[f"_mean_{c}"] = F.when(n > 0, F.col(f"_c_{c}") + s1 / n)
        spread = s2 - s1 * s1 / n  # what rounding leaves of equal values is none
        out[f"_sd_{c}"] = F.when(n > 1, F.when(spread > s2 * 1e-12, F.sqrt(spread / (n - 1))).otherwise(0.0))
    return rows.withColumns(out).drop(*sums, *[f"_c_{c}" for c in cols])


def group_zscore(df: DataFrame, by: Sequence[str], cols: Sequence[str], as_of: str | None = None, every: str = "month") -> DataFrame:
    """(x - mean) / sample deviation over the whole history of the group, or with ``as_of`` over its rows so far.

    ``as_of`` names the time column; the result then looks at nothing after the row, and is null for the first one.
    """
    if as_of is None:
        joined = join_group_stats(df, group_moments(df, by, cols), by)
    else:
        joined = expanding_moments(df, by, cols, as_of, every)
    return joined.withColumns(
        {c: F.try_divide(F.col(c) - F.col(f"_mean_{c}"), F.col(f"_sd_{c}")) for c in cols}
    ).drop(*[f"_{p}_{c}" for c in cols for p in ("mean", "sd")])


def fill_group_mean(df: DataFrame, by: Sequence[str], cols: Sequence[str], as_of: str | None = None, every: str = "month") -> DataFrame:
    """Nulls become the group's mean, or with ``as_of`` the mean of the rows so far; none so far: the null stays."""
    if as_of is None:
        means = df.groupBy(*by).agg(*[F.avg(c).alias(f"_mean_{c}") for c in cols])
        joined = join_group_stats(df, means, by)
    else:
        joined = expanding_moments(df, by, cols, as_of, every).drop(*[f"_sd_{c}" for c in cols])
    return joined.withColumns({c: F.coalesce(F.col(c), F.col(f"_mean_{c}")) for c in cols}).drop(*[f"_mean_{c}" for c in cols])


def keep_min_obs(df: DataFrame, key: str, n: int) -> DataFrame:
    valid = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= n).select(key)
    return join_group_stats(df, valid, [key], "left_semi")


def drop_incomplete_dates(df: DataFrame, value: str, key: str = "ticker", date: str = "date") -> DataFrame:
    """Keep the dates on which every key of the panel has a value."""
    size = df.agg(F.count_distinct(key).alias("n")).select("n")
    full = df.groupBy(date).agg(F.count(value).alias("_n")).where(F.col("_n") == size.scalar()).select(date)
    return df.join(full, date, "left_semi")


def to_wide(df: DataFrame, values: Sequence, value: str, key: str = "ticker", date: str = "date") -> DataFrame:
    """One column per listed key; the list is explicit, so no extra pass looks for it."""
    return df.groupBy(date).pivot(key, list(values)).agg(F.first(value, ignorenulls=True))


def to_long(df: DataFrame, value: str, key: str = "ticker", date: str = "date") -> DataFrame:
    wide = [c for c in df.columns if c != date]
    return df.unpivot([date], wide, key, value).where(F.col(value).isNotNull())


def holdings_list(holdings: DataFrame, by: str = "rebalance_date", key: str = "ticker") -> DataFrame:
    return holdings.groupBy(by).agg(F.sort_array(F.collect_list(key)).alias("tickers"))
