"""Features, splits, scaling and windows for supervised forecasts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketseries.operators.blocks import index_series, over_blocks


def above(df: DataFrame, col: str, threshold: float) -> DataFrame:
    """Strictly above; a value equal to the threshold is dropped."""
    return df.where(F.col(col) > threshold)


def date_lags(
    df: DataFrame, days: dict[str, int], keys: Sequence[str] = ("series_id",), ts: str = "ts", y: str = "y"
) -> DataFrame:
    """Value at exactly ``ts`` minus n days; null where that moment is missing.

    Every row announces itself at the later moments that look back on it. Those
    messages are merged per moment before the join, so duplicate timestamps (the
    largest value wins) never multiply rows, and all lags cost one join on
    (key, ts), which spreads even a single long series.
    """
    keys = list(keys)
    serves = F.explode(F.array(*[F.struct(F.lit(n).alias("d"), F.lit(d).alias("days")) for n, d in days.items()]))
    sent = df.select(*keys, ts, y, serves.alias("_s")).select(
        *keys, F.expr(f"`{ts}` + make_dt_interval(_s.days)").alias(ts), F.col("_s.d").alias("_d"), F.col(y).alias("_y")
    )
    lags = sent.groupBy(*keys, ts).agg(*[F.max(F.when(F.col("_d") == n, F.col("_y"))).alias(n) for n in days])
    return df.join(lags, [*keys, ts], "left")


def time_split(df: DataFrame, cuts: dict[str, str | None], ts: str = "ts", name: str = "split") -> DataFrame:
    """Label half-open time ranges; ``cuts`` maps each label to its end, the last one to None."""
    label: Column | None = None
    for part, end in cuts.items():
        if end is None:
            label = F.lit(part) if label is None else label.otherwise(F.lit(part))
            break
        cond = F.col(ts) < F.lit(end).cast("timestamp_ntz")
        label = F.when(cond, part) if label is None else label.when(cond, part)
    return df.withColumn(name, label)


def fraction_split(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    fractions: dict[str, float],
    every: str = "month",
    name: str = "split",
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Chronological parts; ``fractions`` maps a label to the fraction of rows at which it ends."""
    rows = index_series(df, keys, ts, every, tiebreak)
    label: Column | None = None
    labels = list(fractions.items())
    for part, end in labels[:-1]:
        cond = F.col("pos") < F.floor(F.lit(end) * F.col("n_obs"))
        label = F.when(cond, part) if label is None else label.when(cond, part)
    return rows.withColumn(name, label.otherwise(labels[-1][0])).drop("pos", "n_obs")


def scaler_fit(train: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row of means and population deviations; a constant column keeps the divisor 1."""
    aggs = []
    for c in cols:
        sd = F.stddev_pop(c)
        aggs += [F.avg(c).alias(f"mean_{c}"), F.when(sd == 0, 1.0).otherwise(sd).alias(f"sd_{c}")]
    return train.agg(*aggs)


def _with_stats(df: DataFrame, stats: DataFrame) -> DataFrame:
    """The fitted row enters as one subquery: no join, nothing to broadcast but that row."""
    return df.withColumn("_stats", stats.select(F.struct(*stats.columns).alias("s")).scalar())


def scale(df: DataFrame, stats: DataFrame, cols: Sequence[str]) -> DataFrame:
    fitted = {c: (F.col(c) - F.col(f"_stats.mean_{c}")) / F.col(f"_stats.sd_{c}") for c in cols}
    return _with_stats(df, stats).withColumns(fitted).drop("_stats")


def unscale(df: DataFrame, stats: DataFrame, cols: dict[str, str]) -> DataFrame:
    """``cols`` maps a scaled column to the column whose statistics it was scaled with."""
    undone = {c: F.col(c) * F.col(f"_stats.sd_{o}") + F.col(f"_stats.mean_{o}") for c, o in cols.items()}
    return _with_stats(df, stats).withColumns(undone).drop("_stats")


def sliding_windows(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    features: Sequence[str],
    label: str,
    size: int = 5,
    every: str = "month",
    tiebreak: Sequence[str] = (),
    name: str = "x",
) -> DataFrame:
    """Rows i..i+size-1 as an array of feature arrays, labelled by row i+size of the same key.

    Put the split label in ``keys``: a window then never crosses a split.
    """
    rows = index_series(df, keys, ts, every, tiebreak)

    def stage(ctx):
        frame = ctx.w.rowsBetween(-size, -1)
        return {name: F.collect_list(F.array(*features)).over(frame)}

    out = over_blocks(rows, keys, [stage], back=size)
    return out.where(F.size(name) == size).select(*keys, ts, name, F.col(label).alias("label"))


def flatten_windows(df: DataFrame, name: str = "x", vector: str = "features") -> DataFrame:
    from pyspark.ml.functions import array_to_vector

    return df.withColumn(vector, array_to_vector(F.flatten(name)))
