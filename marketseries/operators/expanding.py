"""Exact quantiles of the rows so far, without a whole series in one task.

Over a block of rows a quantile of the rows so far moves by few places among the values before the block, so a task
needs those few order statistics and the rows of its block alone. Which ones they are is found for all blocks at once:
values are ranked within the key, ranks are cut into leaves, and from the whole key down to a leaf every block goes to
the one of 16 parts that holds its place among the earlier rows.
"""

from __future__ import annotations

import math
from bisect import insort
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketseries.operators.blocks import BLOCK_ROWS, index_series, value_counts
from marketseries.session import cut_lineage

#: Ranks of a leaf, parts that a node is cut into, and blocks that one copy of a leaf serves.
LEAF, FAN, SERVED = 2048, 16, 256


def _ranked(rows: DataFrame, by: list[str], leaf: int) -> DataFrame:
    """(keys, _leaf, _of, _v, _n): how often the ranks of a leaf hold a value of block ``_of``; equal values go by block."""
    counts = rows.where("_v is not null").groupBy(*by, "_v", F.col("_block").alias("_of")).agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(*by, "_v").orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    below = value_counts(rows.select(*by, "_v"), by, "_v").select(*by, "_v", "_below")
    items = counts.withColumn("_same", F.sum("_n").over(earlier)).join(below, [*by, "_v"])
    items = items.withColumn("_start", F.col("_below") + F.coalesce("_same", F.lit(0)))
    items = items.withColumn("_leaf", F.expr(f"explode(sequence(_start div {leaf}, (_start + _n - 1) div {leaf}))"))
    inside = F.expr(f"least(_start + _n, (_leaf + 1) * {leaf}) - greatest(_start, _leaf * {leaf})")
    return items.select(*by, "_leaf", "_of", "_v", inside.alias("_n"))


def _descended(items: DataFrame, targets: DataFrame, by: list[str], levels: int) -> DataFrame:
    """Leaf (``_node``) that holds the ``_k``-th value before each target's block, and the values ``_under`` that leaf."""
    targets = targets.withColumns({"_node": F.lit(0).cast("long"), "_under": F.lit(0).cast("long")})
    before = Window.partitionBy(*by, "_node").orderBy("_block").rangeBetween(Window.unboundedPreceding, -1)
    for level in reversed(range(levels)):
        width = FAN**level
        part = F.expr(f"_leaf div {width} % {FAN}")
        sums = [F.sum(F.when(part == d, F.col("_n")).otherwise(0)).alias(f"_p{d}") for d in range(FAN)]
        parts = items.groupBy(*by, F.expr(f"_leaf div {width * FAN}").alias("_node"), F.col("_of").alias("_block")).agg(*sums)
        both = targets.unionByName(parts, allowMissingColumns=True)
        running = [F.coalesce(F.sum(f"_p{d}").over(before), F.lit(0)) for d in range(FAN)]
        both = both.withColumn("_run", F.array(*running)).where("_k is not null").drop(*[f"_p{d}" for d in range(FAN)])
        both = both.withColumn("_upto", F.expr("transform(_run, (x, i) -> aggregate(slice(_run, 1, i + 1), 0L, (a, y) -> a + y))"))
        both = both.withColumn("_at", F.expr("size(filter(_upto, x -> x <= _k - _under))"))
        targets = both.withColumns({
            "_node": F.expr(f"_node * {FAN} + _at"),
            "_under": F.expr("_under + if(_at > 0, get(_upto, _at - 1), 0L)")}).drop("_run", "_upto", "_at")
    return targets


def _order_statistics(rows: DataFrame, by: list[str], probs: Sequence[float], leaf: int) -> DataFrame:
    """(keys, _block, _i, _m, _under, _v, _n): the values before a block, ``_m`` of them, that the quantile with number
    ``_i`` can reach in the block; ``_under`` smaller ones are left out."""
    upto = Window.partitionBy(*by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)  # one row for each block
    sizes = rows.groupBy(*by, "_block").agg(F.count("_v").alias("_c")).withColumn("_m", F.sum("_c").over(upto))
    wanted = F.posexplode(F.array(*[F.lit(float(p)) for p in probs])).alias("_i", "_p")
    asked = sizes.where("_m > 0").select(*by, "_block", "_m", "_c", wanted)
    least = F.expr("greatest(floor(_p * (_m - 1) - (1 - _p) * _c) - 1, 0L)")
    most = F.expr("least(ceil(_p * (_m - 1) + _p * _c) + 1, _m - 1)")
    targets = asked.select(*by, "_block", "_i", "_m", F.explode(F.array(least, most)).alias("_k"))

    items = cut_lineage(_ranked(rows, by, leaf), "ranked")
    top, levels = items.agg(F.max("_leaf")).first()[0] or 0, 0
    while FAN**levels <= top:
        levels += 1
    leaves = _descended(items, targets, by, levels).groupBy(*by, "_block", "_i", "_m").agg(
        F.min("_node").alias("_first"), F.max("_node").alias("_last"), F.min("_under").alias("_under"))
    spans = leaves.withColumn("_leaf", F.explode(F.sequence("_first", "_last"))).drop("_first", "_last")
    spans = cut_lineage(spans, "spans")
    # a quantile that hardly moves asks one leaf for all blocks: such a leaf is copied
    copies = spans.groupBy(*by, "_leaf").agg(F.ceil(F.count("*") / SERVED).cast("int").alias("_copies"))
    each = F.explode(F.sequence(F.lit(0), F.col("_copies") - 1))
    served = items.join(copies, [*by, "_leaf"]).withColumn("_copy", each).drop("_copies")
    spans = spans.join(copies, [*by, "_leaf"]).withColumn("_copy", F.pmod(F.xxhash64("_block"), "_copies").cast("int")).drop("_copies")
    found = spans.join(served, [*by, "_leaf", "_copy"]).where("_of < _block")
    return found.select(*by, "_block", "_i", "_m", "_under", "_v", "_n")


def expanding_quantiles(
    df: DataFrame, by: Sequence[str], col: str, ts: str, probs: dict[str, float], every: str = "month",
    tiebreak: Sequence[str] = (), block: int = BLOCK_ROWS, leaf: int = LEAF,
) -> DataFrame:
    """Add linearly interpolated quantiles of ``col`` over the rows of the key up to and including each row.

    Nulls and NaN count as no value, but their rows get the quantile of the values so far; null where there is none.
    Rows of one time are taken in order of ``tiebreak``. Results are exact for any length of a series and any ties.
    """
    by = list(by)
    value = F.col(col).cast("double")
    keys = [F.col(k).alias(f"_key{i}") for i, k in enumerate(by)]
    names = [f"_key{i}" for i in range(len(by))]
    indexed = index_series(df, by, ts, every, tiebreak, pos="_pos", total="_total").drop("_total")
    indexed = cut_lineage(indexed.withColumn("_block", F.expr(f"_pos div {block}")), "indexed")
    rows = indexed.select(*keys, "_block", "_pos", F.when(~F.isnan(value), value).alias("_v"))
    shares = list(probs.values())

    def walk(own: pd.DataFrame, before: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("_pos", ignore_index=True)
        out = own[[*names, "_block", "_pos"]].copy()
        for i, p in enumerate(shares):
            part = before[before["_i"] == i]
            held = sorted(np.repeat(part["_v"].to_numpy(), part["_n"].to_numpy()).tolist())
            n, under = (int(part["_m"].iloc[0]), int(part["_under"].iloc[0])) if len(part) else (0, 0)
            column: list[float | None] = []
            for v in own["_v"].tolist():
                if v is not None and not math.isnan(v):
                    insort(held, v)
                    n += 1
                if n == 0:
                    column.append(None)
                    continue
                at = p * (n - 1)
                low = math.floor(at)
                a = held[low - under]
                column.append(a if at == low else a + (held[low + 1 - under] - a) * (at - low))
            out[f"_q{i}"] = pd.array(column, dtype="Float64")
        return out

    types = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = ", ".join([f"{c} {types[c]}" for c in (*names, "_block", "_pos")] + [f"_q{i} double" for i in range(len(shares))])
    before = _order_statistics(rows, names, shares, leaf)
    found = rows.groupBy(*names, "_block").cogroup(before.groupBy(*names, "_block")).applyInPandas(walk, schema)
    found = found.select(
        *[F.col(n).alias(k) for n, k in zip(names, by)], "_block", "_pos", *[F.col(f"_q{i}").alias(name) for i, name in enumerate(probs)])
    return indexed.join(found, [*by, "_block", "_pos"]).select(*df.columns, *probs)
