"""Additive model of a series: a trend that may bend, and seasons of several lengths, fitted for all series at once."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketseries.operators.blocks import join_group_stats
from marketseries.operators.regression import array_gram_tiles

HOUR, DAY, WEEK, YEAR = 3600.0, 86400.0, 7 * 86400.0, 365.25 * 86400.0


@dataclass(frozen=True)
class Seasons:
    """Lengths of the seasons in seconds with the number of waves of each, bends of the trend, and the penalties.

    Bends lie evenly over the first ``reach`` of the training time. ``bend`` and ``wave`` are the penalties of a bend
    and of a wave against one unit of variance of the training rows' residuals; level and slope have none.
    """

    waves: tuple[tuple[float, int], ...] = ((DAY, 6), (WEEK, 3))
    bends: int = 10
    reach: float = 0.8
    bend: float = 20.0
    wave: float = 0.01

    @property
    def names(self) -> list[str]:
        waves = [f"_{f}_{i}_{k}" for i, (_, n) in enumerate(self.waves) for k in range(1, n + 1) for f in ("sin", "cos")]
        return ["_one", "_slope", *[f"_bend_{i}" for i in range(self.bends)], *waves]

    @property
    def penalties(self) -> list[float]:
        return [0.0, 0.0, *[self.bend] * self.bends, *[self.wave] * (len(self.names) - 2 - self.bends)]

    def design(self, seconds: Column, start: Column, end: Column) -> dict[str, Column]:
        """The columns of a moment; time runs from 0 to 1 over the training rows and on behind them."""
        at = F.try_divide(seconds - start, end - start)
        out = {"_one": F.lit(1.0), "_slope": F.coalesce(at, F.lit(0.0))}
        for i in range(self.bends):
            out[f"_bend_{i}"] = F.coalesce(F.greatest(at - self.reach * (i + 1) / (self.bends + 1), F.lit(0.0)), F.lit(0.0))
        for i, (length, n) in enumerate(self.waves):
            for k in range(1, n + 1):
                turn = F.pmod(seconds, F.lit(length)) * (2 * math.pi * k / length)
                out |= {f"_sin_{i}_{k}": F.sin(turn), f"_cos_{i}_{k}": F.cos(turn)}
        return out


def _with_design(df: DataFrame, limits: DataFrame, keys: Sequence[str], ts: str, seasons: Seasons) -> DataFrame:
    rows = join_group_stats(df, limits, keys)
    seconds = F.unix_micros(F.col(ts).cast("timestamp")) / 1e6
    return rows.withColumn("_x", F.array(*seasons.design(seconds, F.col("_start"), F.col("_end")).values()))


def fit_seasonal(
    train: DataFrame, keys: Sequence[str] = ("series_id",), ts: str = "ts", y: str = "y", seasons: Seasons = Seasons()
) -> DataFrame:
    """One row per series: keys, _start and _end of its training time, coef (null where there is no fit), n.

    Sums of products of the design are made in tiles for all series in one pass; only a series' penalised system, whose
    size the seasons set, is solved in Python. y is taken around its mean. Rows without ts or y are left out.
    """
    keys = list(keys)
    rows = train.where(F.col(ts).isNotNull() & F.col(y).isNotNull())
    seconds = F.unix_micros(F.col(ts).cast("timestamp")) / 1e6
    limits = rows.groupBy(*keys).agg(F.min(seconds).alias("_start"), F.max(seconds).alias("_end"), F.avg(y).alias("_level"))
    wide = _with_design(rows, limits, keys, ts, seasons)
    wide = wide.select(*keys, F.concat("_x", F.array(F.col(y) - F.col("_level"))).alias("_x"))
    names, penalties = seasons.names, np.array(seasons.penalties)
    width = len(names) + 1
    tile = 8

    @F.pandas_udf("array<double>")
    def solve(tiles: pd.Series) -> pd.Series:
        out = []
        for parts in tiles:
            size = tile * (1 + max(r["tj"] for r in parts))
            full = np.zeros((size, size))
            for r in parts:
                a, b, block = tile * r["ti"], tile * r["tj"], np.asarray(r["block"], dtype=float).reshape(tile, tile)
                full[a : a + tile, b : b + tile], full[b : b + tile, a : a + tile] = block, block.T
            system = full[: width - 1, : width - 1] + np.diag(penalties + 1e-9)
            fit = np.linalg.solve(system, full[: width - 1, width - 1]) if np.isfinite(full).all() else None
            out.append(None if fit is None else fit.tolist())
        return pd.Series(out, dtype=object)

    sums = array_gram_tiles(wide, keys, width, tile).groupBy(*keys).agg(
        F.max("n").alias("n"), F.collect_list(F.struct("ti", "tj", "block")).alias("_t"))
    return limits.join(sums.select(*keys, "n", solve("_t").alias("coef")), keys)


def predict_seasonal(
    df: DataFrame, model: DataFrame, keys: Sequence[str] = ("series_id",), ts: str = "ts", seasons: Seasons = Seasons()
) -> DataFrame:
    """``df`` with ``prediction``; series without a fit are left out. Each row is worked out on its own, in the JVM."""
    keys = list(keys)
    rows = _with_design(df, model.where(F.col("coef").isNotNull()), keys, ts, seasons)
    value = F.aggregate(F.zip_with("coef", "_x", lambda c, x: c * x), F.col("_level"), lambda s, v: s + v)
    return rows.withColumn("prediction", value).select(*df.columns, "prediction")
