"""Least squares from cross-products: Spark adds them up, tasks solve tiny systems.

Cross-products are distributed sums, so neither one huge group nor many small
ones reaches a single task; only the p x p systems are solved in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations_with_replacement

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WIDE_LIMIT = 12


def solve_symmetric(gram: np.ndarray, rhs: np.ndarray) -> np.ndarray | None:
    """Solve after scaling to a unit diagonal; None where the columns are dependent."""
    diag = np.diag(gram)
    if not np.all(np.isfinite(gram)) or np.any(diag <= 0):
        return None
    scale = 1.0 / np.sqrt(diag)
    unit = gram * np.outer(scale, scale)
    if np.linalg.cond(unit) > 1e12:
        return None
    return scale * np.linalg.solve(unit, rhs * scale)


def gram(df: DataFrame, by: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """One row per group: row count ``n`` and the flattened matrix of sums of products.

    Few columns are summed by Spark expressions. Many columns (lag regressions,
    dozens of predictors) are summed per batch in numpy, then merged by Spark.
    """
    by, cols = list(by), list(cols)
    p = len(cols)
    rows = df.select(*by, *cols).na.drop("any", subset=cols)
    upper = list(combinations_with_replacement(range(p), 2))
    if p <= WIDE_LIMIT:
        sums = rows.groupBy(*by).agg(
            F.count(F.lit(1)).alias("n"),
            *[F.sum(F.col(cols[i]) * F.col(cols[j])).alias(f"_{i}_{j}") for i, j in upper],
        )
        flat = F.array(*[F.col(f"_{min(i, j)}_{max(i, j)}") for i in range(p) for j in range(p)])
        return sums.select(*by, "n", flat.alias("gram"))

    left, right = np.array([i for i, _ in upper]), np.array([j for _, j in upper])

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            groups = batch.groupby(by, sort=False) if by else [((), batch)]
            for key, part in groups:
                x = part[cols].to_numpy(dtype=float)
                out = pd.DataFrame({"_at": [-1, *range(len(upper))], "_v": [float(len(x)), *(x.T @ x)[left, right]]})
                for name, value in zip(by, key):
                    out[name] = value
                yield out[[*by, "_at", "_v"]]

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name in by]
    summed = (
        rows.mapInPandas(partial, ", ".join([*fields, "_at int", "_v double"]))
        .groupBy(*by, "_at")
        .agg(F.sum("_v").alias("_v"))
    )
    # the list per group has one entry per pair of columns, whatever the number of rows
    entries = summed.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("_at", "_v"))).alias("_e"))
    where = {pair: k + 1 for k, pair in enumerate(upper)}
    index = F.expr(f"array({', '.join(str(where[min(i, j), max(i, j)]) for i in range(p) for j in range(p))})")
    return entries.select(
        *by,
        F.get("_e", F.lit(0))["_v"].cast("long").alias("n"),
        F.transform(index, lambda k: F.get("_e", k)["_v"]).alias("gram"),
    )




def ols_from_gram(matrix: np.ndarray) -> tuple[np.ndarray, float, float] | None:
    """Coefficients, squared residuals and sum of y² from the sums over [x…, y]."""
    beta = solve_symmetric(matrix[:-1, :-1], matrix[:-1, -1])
    if beta is None:
        return None
    return beta, float(matrix[-1, -1] - beta @ matrix[:-1, -1]), float(matrix[-1, -1])


def ols_grouped(df: DataFrame, by: Sequence[str], y: str, xs: Sequence[str], intercept: bool = False) -> DataFrame:
    """One regression per group: beta array, ssr, sum of squares of y, n and k.

    With an intercept (last entry of beta) the sums are taken around group means.
    """
    by, xs = list(by), list(xs)
    if not intercept:
        sums = gram(df, by, [*xs, y])
        solved = sums.withColumn("_fit", _solve_udf(len(xs) + 1)(F.col("gram")))
    else:
        rows = df.na.drop("any", subset=[*xs, y])
        cols = [*xs, y]
        aggs = [F.count(F.lit(1)).alias("n")] + [F.avg(c).alias(f"_m_{c}") for c in cols]
        aggs += [F.covar_pop(a, b).alias(f"_c_{a}_{b}") for a, b in combinations_with_replacement(cols, 2)]
        moments = rows.groupBy(*by).agg(*aggs)
        flat = [
            F.col("n") * F.col(f"_c_{cols[min(i, j)]}_{cols[max(i, j)]}") for i in range(len(cols)) for j in range(len(cols))
        ]
        solved = moments.withColumn("_fit", _solve_udf(len(cols))(F.array(*flat)))
        level = F.col(f"_m_{y}") - sum(
            (F.get("_fit.beta", F.lit(i)) * F.col(f"_m_{x}") for i, x in enumerate(xs)), F.lit(0.0)
        )
        solved = solved.withColumn(
            "_fit", F.struct(F.concat("_fit.beta", F.array(level)).alias("beta"), F.col("_fit.ssr"), F.col("_fit.syy"))
        )
    return solved.select(
        *by, "n", F.lit(len(xs) + int(intercept)).alias("k"), F.col("_fit.beta").alias("beta"),
        F.col("_fit.ssr").alias("ssr"), F.col("_fit.syy").alias("syy"),
    )


def _solve_udf(size: int):
    @F.pandas_udf("beta array<double>, ssr double, syy double")
    def solve(flat: pd.Series) -> pd.DataFrame:
        out = []
        for values in flat:
            fit = None
            if values is not None and not any(v is None for v in values):
                fit = ols_from_gram(np.asarray(values, dtype=float).reshape(size, size))
            out.append((None, None, None) if fit is None else (fit[0].tolist(), fit[1], fit[2]))
        return pd.DataFrame(out, columns=["beta", "ssr", "syy"])

    return solve


def log_likelihood(n: Column, ssr: Column) -> Column:
    return -n / 2.0 * (F.ln(F.lit(2.0 * np.pi)) + F.ln(ssr / n) + 1.0)


def information_criteria(df: DataFrame, n: str = "n", k: str = "k", ssr: str = "ssr", syy: str = "syy") -> DataFrame:
    """Adjusted R² without a constant, AIC and BIC; null where the residuals vanish."""
    nn, kk = F.col(n), F.col(k)
    good = F.when(F.col(ssr) > 0, F.col(ssr))
    llf = log_likelihood(nn, good)
    return df.withColumns(
        {
            "adj_r2": 1.0 - F.try_divide(nn * F.lit(1.0), nn - kk) * F.try_divide(good, F.col(syy)),
            "aic": 2.0 * kk - 2.0 * llf,
            "bic": kk * F.ln(nn) - 2.0 * llf,
        }
    )


#: Columns of a tile of the matrix of sums.
TILE = 8


def gram_tiles(df: DataFrame, by: Sequence[str], cols: Sequence[str], tile: int = TILE) -> DataFrame:
    """The matrix of sums of products of many columns by tiles: one row per group and tile (ti <= tj) with ``n`` and ``block``.

    A row of the data goes to every pair of tiles before the sums, which are made in part where it is read, so that an
    aggregation holds tile x tile sums whatever the number of columns, and nothing leaves the JVM. Rows with a null are
    left out.
    """
    cols = list(cols)
    rows = df.na.drop("any", subset=cols).select(*by, F.array(*[F.col(c).cast("double") for c in cols]).alias("_x"))
    return array_gram_tiles(rows, by, len(cols), tile)


def array_gram_tiles(df: DataFrame, by: Sequence[str], width: int, tile: int = TILE) -> DataFrame:
    """:func:`gram_tiles` of rows whose columns are the entries of an array ``_x`` without nulls."""
    by = list(by)
    count = -(-width // tile)
    padded = F.concat("_x", F.array(*[F.lit(0.0)] * (count * tile - width))) if count * tile > width else F.col("_x")
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("ti"), F.lit(j).alias("tj")) for i in range(count) for j in range(i, count)]))
    rows = df.select(*by, padded.alias("_x"), pairs.alias("_p"))
    left, right = (F.slice("_x", F.col(f"_p.{t}") * tile + 1, F.lit(tile)) for t in ("ti", "tj"))
    rows = rows.select(*by, F.col("_p.ti").alias("ti"), F.col("_p.tj").alias("tj"), left.alias("_l"), right.alias("_r"))
    sums = rows.groupBy(*by, "ti", "tj").agg(F.count(F.lit(1)).alias("n"), *[
        F.sum(F.get("_l", F.lit(a)) * F.get("_r", F.lit(b))).alias(f"_{a}_{b}") for a in range(tile) for b in range(tile)])
    return sums.select(*by, "ti", "tj", "n", F.array(*[F.col(f"_{a}_{b}") for a in range(tile) for b in range(tile)]).alias("block"))


def nested_ssr(full: np.ndarray, sizes: Sequence[int]) -> list[float | None]:
    """Squared residuals of the models with the first m columns, from the sums over [x…, y], by one Cholesky factor.

    The factor grows column by column; each new column takes the square of one entry of its forward solution off the
    residuals. From the first column that depends on those before it, there is no fit.
    """
    p = len(full) - 1
    diag = np.diag(full)[:p]
    good = np.isfinite(full).all() and (diag > 0).all()
    scale = 1 / np.sqrt(np.where(diag > 0, diag, 1.0))
    unit, rhs = full[:p, :p] * np.outer(scale, scale), full[:p, p] * scale
    low, solved, left = np.zeros((p, p)), np.zeros(p), full[p, p]
    out: dict[int, float] = {0: float(left)}
    for j in range(p if good else 0):
        for k in range(j):
            low[j, k] = (unit[j, k] - low[j, :k] @ low[k, :k]) / low[k, k]
        rest = unit[j, j] - low[j, :j] @ low[j, :j]
        if rest < 1e-10:
            break
        low[j, j] = np.sqrt(rest)
        solved[j] = (rhs[j] - low[j, :j] @ solved[:j]) / low[j, j]
        left -= solved[j] ** 2
        out[j + 1] = float(max(left, 0.0))
    return [out.get(m) for m in sizes]


def nested_models(
    df: DataFrame, by: Sequence[str], y: str, xs: Sequence[str], sizes: Sequence[int], tile: int = TILE, centred: bool = False
) -> DataFrame:
    """ssr of the models with the first m columns, for all m, from one matrix per group, which is summed in tiles.

    With ``centred`` all columns count less their mean in the group, which is taken off the sums, so that the rows are
    read once. Only the matrix of a group, whose size the columns set, meets in a task.
    """
    by, xs, sizes = list(by), list(xs), list(sizes)
    cols = [*xs, y, "_one"] if centred else [*xs, y]
    df = df.withColumn("_one", F.lit(1.0)) if centred else df
    width = len(cols)
    tile = min(tile, width)

    @F.pandas_udf("syy double, fits array<struct<k int, ssr double>>")
    def fit_all(tiles: pd.Series) -> pd.DataFrame:
        out = []
        for rows in tiles:
            size = tile * (1 + max(r["tj"] for r in rows))
            full = np.zeros((size, size))
            for r in rows:
                block = np.asarray(r["block"], dtype=float).reshape(tile, tile)
                a, b = tile * r["ti"], tile * r["tj"]
                full[a : a + tile, b : b + tile] = block
                full[b : b + tile, a : a + tile] = block.T
            full = full[:width, :width]
            if centred:
                total = full[-1, :-1]
                full = full[:-1, :-1] - np.outer(total, total) / full[-1, -1]
            out.append((full[-1, -1], [{"k": m, "ssr": v} for m, v in zip(sizes, nested_ssr(full, sizes))]))
        return pd.DataFrame(out, columns=["syy", "fits"])

    sums = gram_tiles(df, by, cols, tile).groupBy(*by).agg(
        F.max("n").alias("n"), F.collect_list(F.struct("ti", "tj", "block")).alias("_t"))
    fits = sums.select(*by, "n", fit_all("_t").alias("_f")).select(*by, "n", "_f.syy", F.explode("_f.fits").alias("f"))
    return information_criteria(fits.select(*by, "n", "syy", F.col("f.k").alias("k"), F.col("f.ssr").alias("ssr")))


def selection_frequency(models: DataFrame, by: Sequence[str], base: int) -> DataFrame:
    """Share of groups in which each criterion strictly prefers the base model over each larger one."""
    by = list(by)
    small = models.where(F.col("k") == base).select(
        *by, F.col("adj_r2").alias("_r"), F.col("aic").alias("_a"), F.col("bic").alias("_b")
    )
    wins = models.where(F.col("k") > base).join(small, by)

    def share(cond: Column) -> Column:
        return F.avg(F.when(cond, 1.0).otherwise(0.0))

    return wins.groupBy(F.col("k").alias("m")).agg(
        share(F.col("_r") > F.col("adj_r2")).alias("freq_adj_r2"),
        share(F.col("_a") < F.col("aic")).alias("freq_aic"),
        share(F.col("_b") < F.col("bic")).alias("freq_bic"),
    )


def rolling_ols(
    df: DataFrame,
    y: str,
    xs: Sequence[str],
    window: int = 24,
    min_obs: int | None = None,
    key: str = "ticker",
    order: str = "month_end",
    prefix: str = "beta_",
) -> DataFrame:
    """Slopes of a regression with constant over the last ``window`` rows of each key.

    For monthly rows: a key holds one row per month, so its size is bounded by
    the calendar. Co-moments are window aggregates (computed around the means);
    only the solve runs in Python. A shorter series uses its own length as the
    window; too few complete rows or dependent columns give nulls.
    """
    xs = list(xs)
    cols = [*xs, y]
    least = min_obs if min_obs is not None else len(xs) + 2
    w = Window.partitionBy(key).orderBy(order)
    frame = w.rowsBetween(-(window - 1), 0)
    complete = F.lit(True)
    for c in cols:
        complete = complete & F.col(c).isNotNull()
    rows = df.withColumns(
        {
            "_row": F.row_number().over(w),
            "_len": F.count(F.lit(1)).over(Window.partitionBy(key)),
            **{f"_v_{c}": F.when(complete, F.col(c)) for c in cols},
        }
    )
    pairs = list(combinations_with_replacement(range(len(cols)), 2))
    rows = rows.withColumns(
        {
            "_obs": F.count(f"_v_{y}").over(frame),
            **{f"_c_{i}_{j}": F.covar_pop(f"_v_{cols[i]}", f"_v_{cols[j]}").over(frame) for i, j in pairs},
        }
    )
    usable = (F.col("_row") >= F.least(F.lit(window), F.col("_len"))) & (F.col("_obs") >= least)
    flat = F.array(*[F.col(f"_c_{min(i, j)}_{max(i, j)}") for i in range(len(cols)) for j in range(len(cols))])
    rows = rows.withColumn("_fit", _solve_udf(len(cols))(F.when(usable, flat)))
    return rows.withColumns({f"{prefix}{x}": F.get("_fit.beta", F.lit(i)) for i, x in enumerate(xs)}).select(
        *df.columns, *[f"{prefix}{x}" for x in xs]
    )
