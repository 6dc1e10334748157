"""Scores of a table with a label and a prediction; all are one aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketseries.operators.blocks import exact_quantiles


def mse(y: str, p: str) -> Column:
    return F.avg((F.col(y) - F.col(p)) * (F.col(y) - F.col(p)))


def rmse(y: str, p: str) -> Column:
    return F.sqrt(mse(y, p))


def mape(y: str, p: str) -> Column:
    return F.avg(F.try_divide(F.abs(F.col(y) - F.col(p)), F.abs(y)))


def accuracy(y: str, p: str) -> Column:
    return F.avg(F.when(F.col(y) == F.col(p), 1.0).otherwise(0.0))


def log_loss(y: str, p: str, floor: float = 1e-7) -> Column:
    bounded = F.greatest(F.least(F.col(p), F.lit(1.0 - floor)), F.lit(floor))
    return -F.avg(F.col(y) * F.ln(bounded) + (1 - F.col(y)) * F.ln(1 - bounded))


def r2(y: str, p: str) -> Column:
    """1 - SSE/SST; n times the population variance is the total sum of squares."""
    return 1 - F.try_divide(mse(y, p), F.var_pop(y))


def confusion(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Counts of all four cells, absent ones as zero."""
    cells = {
        f"{prefix}_{row}_{col}": F.count_if((F.col(label) == row) & (F.col(pred) == col))
        for prefix in ("n",) for row in (0, 1) for col in (0, 1)
    }
    return df.agg(*[c.alias(n) for n, c in cells.items()])


def five_numbers(df: DataFrame, by: Sequence[str], col: str) -> DataFrame:
    """Box-plot statistics with whisker fences at 1.5 interquartile ranges."""
    parts = {"q0": 0.0, "q1": 0.25, "q2": 0.5, "q3": 0.75, "q4": 1.0}
    box = exact_quantiles(df, by, col, parts)
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    return box.withColumns({"fence_low": F.col("q1") - reach, "fence_high": F.col("q3") + reach})
