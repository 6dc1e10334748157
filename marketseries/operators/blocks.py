"""Order-dependent work that never puts a whole series or group in one task.

Row positions come from two levels: counts per (key, time bucket) are small and
are summed up over the buckets, rows are numbered only inside their bucket.
Windows then run over (key, block of consecutive positions); the rows a block
needs from its neighbours are copied to it, so the result equals a window over
the whole key while the largest task stays one block.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

BLOCK_ROWS = 2048
_BLOCK = "_ix_block"
_BUCKET = "_ix_bucket"
_RUN = "_ix_run"
#: Blocks whose states one task carries on, and the columns of a state.
RUN_BLOCKS = 4096
STATE = ("mean", "log", "had")


def index_series(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    every: str = "month",
    tiebreak: Sequence[str] = (),
    pos: str = "pos",
    total: str = "n_obs",
) -> DataFrame:
    """Add the 0-based row position in time order and the length of the series.

    ``every`` is the time bucket (``year`` … ``minute``); pick one that keeps a
    bucket of one key small enough for one task.
    """
    keys = list(keys)
    rows = df.withColumn(_BUCKET, F.date_trunc(every, F.col(ts)))
    by_key = Window.partitionBy(*keys).orderBy(_BUCKET)
    offsets = (
        rows.groupBy(*keys, _BUCKET)
        .agg(F.count(F.lit(1)).alias("_ix_n"))
        .select(
            *keys,
            _BUCKET,
            (F.sum("_ix_n").over(by_key.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_ix_n")).alias("_ix_before"),
            F.sum("_ix_n").over(Window.partitionBy(*keys)).alias(total),
        )
    )
    inside = Window.partitionBy(*keys, _BUCKET).orderBy(ts, *tiebreak)
    numbered = rows.withColumn("_ix_row", F.row_number().over(inside))
    return (
        numbered.join(offsets, [*keys, _BUCKET])
        .withColumn(pos, F.col("_ix_before") + F.col("_ix_row") - 1)
        .drop("_ix_before", "_ix_row", _BUCKET)
    )


def ensure_index(
    df: DataFrame, keys: Sequence[str], ts: str, every: str = "month", tiebreak: Sequence[str] = ()
) -> tuple[DataFrame, list[str]]:
    """Index a frame unless it already is, and the columns to drop again afterwards.

    Chained operators then number the rows once. Rows must not be filtered
    between indexing and the last operator that uses the positions.
    """
    if "pos" in df.columns and "n_obs" in df.columns:
        return df, []
    return index_series(df, keys, ts, every, tiebreak), ["pos", "n_obs"]


@dataclass(frozen=True)
class BlockContext:
    """What a stage may use: the window over one block."""

    w: WindowSpec
    pos: str
    block: int
    back: int


Stage = Callable[[BlockContext], dict[str, Column]]


@dataclass(frozen=True)
class DecayedMean:
    """Mean of ``value`` (of rows up to the current one) under ``weight`` times (1 - alpha) ** rows ago.

    Weights are not negative; rows whose value or weight is null add nothing. ``<name>_seen`` counts the others.
    """

    name: str
    value: Column
    weight: Column
    alpha: float

    @property
    def decay(self) -> float:
        return min(max(1.0 - self.alpha, 1e-20), 1.0 - 1e-12)


def _carry(part: pd.DataFrame, at: str, steps: dict[int, float]) -> Iterator[tuple[int, list, tuple]]:
    """Of each mean: the states before the entries of ``part``, which lie in order of ``at``, and the state after the last.

    A state is (mean, logarithm of the weight, rows seen); an entry further on takes one of ``steps`` from the logarithm.
    """
    places = part[at].tolist()
    for i, step in steps.items():
        mean, log, had, before, rows = 0.0, -math.inf, 0, None, []
        for place, own, weight, n in zip(places, *(part[f"_{c}{i}"].tolist() for c in STATE)):
            if before is not None:
                log += (place - before - 1) * step  # entries that are not there
            rows.append((mean, log, had))
            log, before, had = log + step, place, had + n
            if weight > -math.inf:
                both = float(np.logaddexp(log, weight))
                mean, log = mean + (own - mean) * math.exp(weight - both), both
        yield i, rows, (mean, log, had)


def _states_before(table: DataFrame, keys: Sequence[str], steps: dict[int, float], run: int) -> DataFrame:
    """States before each block from the states of the blocks alone, carried within runs and then between them.

    A key whose blocks (``_blocks``) fit into one run has nothing to carry between runs.
    """
    names = [f"_{c}{i}" for i in steps for c in STATE]
    types = {f.name: f.dataType.simpleString() for f in table.schema.fields}
    schema = lambda *others: ", ".join([*(f"`{k}` {types[k]}" for k in keys), *others, *(f"{n} {types[n]}" for n in names)])

    def states(part: pd.DataFrame, at: str, steps: dict[int, float]) -> pd.DataFrame:
        part = part.sort_values(at, ignore_index=True)
        out = part[[*keys, *(c for c in (_RUN, _BLOCK) if c in part)]].copy()
        for i, rows, _ in _carry(part, at, steps):
            for c, values in zip(STATE, zip(*rows)):
                out[f"_{c}{i}"] = values
        return out

    def close(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(_BLOCK, ignore_index=True)
        out = part[[*keys, _RUN]].head(1).copy()
        ahead = run - 1 - int(part[_BLOCK].iloc[-1]) % run
        for i, _, (mean, log, had) in _carry(part, _BLOCK, steps):
            out[f"_mean{i}"], out[f"_log{i}"], out[f"_had{i}"] = mean, log + ahead * steps[i], had
        return out

    runs = table.withColumn(_RUN, F.expr(f"`{_BLOCK}` div {run}"))
    inside = runs.groupBy(*keys, _RUN).applyInPandas(
        lambda part: states(part, _BLOCK, steps), schema(f"{_RUN} long", f"{_BLOCK} long"))
    ends = runs.filter(F.col("_blocks") > run).groupBy(*keys, _RUN).applyInPandas(close, schema(f"{_RUN} long"))
    starts = ends.groupBy(*keys).applyInPandas(
        lambda part: states(part, _RUN, {i: run * step for i, step in steps.items()}), schema(f"{_RUN} long"))
    out = inside.join(starts.select(*keys, _RUN, *[F.col(n).alias(f"_b{n}") for n in names]), [*keys, _RUN], "left")
    mixed = {}
    for i, step in steps.items():
        mean, log, had = (F.col(f"_{c}{i}") for c in STATE)
        old_mean, old_had = F.col(f"_b_mean{i}"), F.coalesce(f"_b_had{i}", F.lit(0))
        old = F.coalesce(f"_b_log{i}", F.lit(float("-inf"))) + F.pmod(_BLOCK, F.lit(run)) * step
        top = F.greatest(log, old)
        old_part, part = F.exp(old - top), F.exp(log - top)
        there, before = log > float("-inf"), old > float("-inf")
        mixed[f"_mean{i}"] = F.when(~before, mean).when(~there, old_mean).otherwise(
            (old_mean * old_part + mean * part) / (old_part + part))
        mixed[f"_log{i}"] = F.when(~(there & before), top).otherwise(top + F.log(old_part + part))
        mixed[f"_had{i}"] = had + old_had
    return out.withColumns(mixed).select(*keys, _BLOCK, *names)


def decayed_means(
    df: DataFrame, keys: Sequence[str], means: Sequence[DecayedMean], pos: str = "pos", block: int = BLOCK_ROWS,
    run: int = RUN_BLOCKS, total: str = "n_obs",
) -> DataFrame:
    """Add decayed means over the whole history of each series.

    Blocks kept by :func:`over_blocks` must be those of :func:`decay_block`. The state at the end of each block
    (mean, logarithm of the weight, rows seen) is carried over the small (key, block) table, one row for each block, so
    no history is cut; a mean keeps its value over a stretch without weight, however long. A task carries the states of
    ``run`` blocks, and another those between the runs of a key that ``total`` rows (where that is known) put in several.
    """
    keys = list(keys)
    size = decay_block(means, block)
    if _BLOCK not in df.columns:
        df = df.withColumn(_BLOCK, F.expr(f"`{pos}` div {size}"))
    df = df.withColumn("_off", F.col(pos) - F.col(_BLOCK) * size)
    ends, scaled = [], {}
    for i, m in enumerate(means):
        there = m.value.isNotNull() & m.weight.isNotNull()
        grown = F.pow(F.lit(m.decay), -F.col("_off"))
        df = df.withColumns({f"_v{i}": F.when(there, m.value * grown), f"_w{i}": F.when(there, m.weight * grown)})
        back = F.lit(m.decay ** (size - 1))
        v, w = F.sum(f"_v{i}") * back, F.sum(f"_w{i}") * back
        ends += [
            F.when(w > 0, v / w).otherwise(0.0).alias(f"_mean{i}"),
            F.when(w > 0, F.log(w)).otherwise(float("-inf")).alias(f"_log{i}"),
            F.count(f"_v{i}").alias(f"_had{i}"),
        ]
        scaled[i] = math.log(m.decay)
    blocks = F.max(F.col(total)) / size if total in df.columns else F.lit(float("inf"))
    states = _states_before(df.groupBy(*keys, _BLOCK).agg(*ends, blocks.alias("_blocks")), keys, {i: size * log for i, log in scaled.items()}, run)
    df = df.join(states, [*keys, _BLOCK])
    upto = Window.partitionBy(*keys, _BLOCK).orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    out = {}
    for i, m in enumerate(means):
        shrink = F.pow(F.lit(m.decay), F.col("_off"))
        v, w = F.sum(f"_v{i}").over(upto) * shrink, F.sum(f"_w{i}").over(upto) * shrink
        old = F.exp(F.col(f"_log{i}") + (F.col("_off") + 1) * scaled[i])
        mixed = (F.col(f"_mean{i}") * old + v) / (old + w)
        out[m.name] = F.when(w > 0, mixed).when(F.col(f"_log{i}") > float("-inf"), F.col(f"_mean{i}"))
        out[f"{m.name}_seen"] = F.count(f"_v{i}").over(upto) + F.col(f"_had{i}")
    temps = [f"_{c}{i}" for i in scaled for c in ("v", "w", "mean", "log", "had")]
    return df.withColumns(out).drop(_BLOCK, "_off", *temps)


def over_blocks(
    df: DataFrame,
    keys: Sequence[str],
    stages: Sequence[Stage],
    back: int = 0,
    ahead: int = 0,
    pos: str = "pos",
    total: str = "n_obs",
    block: int = BLOCK_ROWS,
    keep_block: bool = False,
) -> DataFrame:
    """Run windowed stages with ``back`` rows of history and ``ahead`` rows of future.

    All stages share one exchange on (keys, block); :func:`decayed_means` can use the blocks that are kept.
    """
    first = F.expr(f"greatest(`{pos}` - {ahead}, 0) div {block}")
    last = F.expr(f"least(`{pos}` + {back}, `{total}` - 1) div {block}")
    out = df.withColumn(_BLOCK, F.explode(F.sequence(first, last)))
    ctx = BlockContext(Window.partitionBy(*keys, _BLOCK).orderBy(pos), pos, block, back)
    for stage in stages:
        out = out.withColumns(stage(ctx))
    out = out.where(F.expr(f"`{pos}` div {block} = `{_BLOCK}`"))
    return out if keep_block else out.drop(_BLOCK)


def decay_block(means: Sequence[DecayedMean], block: int = BLOCK_ROWS) -> int:
    """Rows of a block over which no power of a decay leaves the range of doubles."""
    return max(1, min(block, *(int(600 / -math.log(m.decay)) for m in means)))


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    sums: dict[str, Column],
    every: str = "month",
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Running totals in time order: bucket totals carried forward plus a sum inside the bucket."""
    keys = list(keys)
    rows = df.withColumn(_BUCKET, F.date_trunc(every, F.col(ts)))
    earlier = Window.partitionBy(*keys).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(*keys, _BUCKET).agg(*[F.sum(c).alias(f"_t_{n}") for n, c in sums.items()])
    carried = totals.select(
        *keys, _BUCKET, *[F.coalesce(F.sum(f"_t_{n}").over(earlier), F.lit(0.0)).alias(f"_c_{n}") for n in sums]
    )
    inside = Window.partitionBy(*keys, _BUCKET).orderBy(ts, *tiebreak).rowsBetween(Window.unboundedPreceding, 0)
    return (
        rows.withColumns({f"_s_{n}": F.sum(c).over(inside) for n, c in sums.items()})
        .join(carried, [*keys, _BUCKET])
        .withColumns({n: F.col(f"_c_{n}") + F.coalesce(F.col(f"_s_{n}"), F.lit(0.0)) for n in sums})
        .drop(_BUCKET, *[f"_{p}_{n}" for n in sums for p in "sc"])
    )


def join_group_stats(
    df: DataFrame, stats: DataFrame, by: Sequence[str], how: str = "inner", salts: int = 32
) -> DataFrame:
    """Join a few values per group back to the rows of the group.

    ``stats`` holds one short row per group. It is copied to ``salts`` sub-groups
    over which the rows are spread by their hash, so a group with a third of all
    rows is worked on by many tasks. Where the copies turn out small, Spark
    broadcasts them instead.
    """
    by = list(by)
    copies = stats.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    spread = df.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(salts)).cast("int"))
    return spread.join(copies, [*by, "_salt"], how).drop("_salt")


def value_counts(df: DataFrame, by: Sequence[str], col: str, halvings: int = 8) -> DataFrame:
    """Distinct values per group with their counts and the count of rows below each.

    Equal values are merged first, so a value shared by most rows costs one row;
    a large group is cut into 2**halvings value ranges at approximate percentiles.
    """
    by = list(by)
    counts = df.where(F.col(col).isNotNull()).groupBy(*by, col).agg(F.count(F.lit(1)).alias("_n"))
    points = [i / 2**halvings for i in range(1, 2**halvings)]
    cuts = counts.groupBy(*by).agg(F.percentile_approx(col, points, 10 * 2**halvings).alias("_cuts"))
    ranged = join_group_stats(counts, cuts, by) if by else counts.withColumn("_cuts", cuts.select("_cuts").scalar())
    # number of cut points below the value, by halving the sorted list
    steps = F.array(*[F.lit(2**h) for h in reversed(range(halvings))])
    below = F.aggregate(
        steps, F.lit(0), lambda at, step: F.when(F.get("_cuts", at + step - 1) < F.col(col), at + step).otherwise(at)
    )
    ranged = ranged.withColumn("_range", below).drop("_cuts")
    per_range = ranged.groupBy(*by, "_range").agg(F.sum("_n").alias("_m"))
    order = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, 0)
    offsets = per_range.select(
        *by,
        "_range",
        (F.sum("_m").over(order) - F.col("_m")).alias("_before"),
        F.sum("_m").over(Window.partitionBy(*by)).alias("_total"),
    )
    inside = Window.partitionBy(*by, "_range").orderBy(col).rowsBetween(Window.unboundedPreceding, 0)
    return (
        ranged.withColumn("_upto", F.sum("_n").over(inside))
        .join(offsets, [*by, "_range"])
        .withColumn("_below", F.col("_before") + F.col("_upto") - F.col("_n"))
        .drop("_range", "_before", "_upto")
    )


def average_rank(
    df: DataFrame, by: Sequence[str], col: str, name: str = "rank", descending: bool = True, halvings: int = 8
) -> DataFrame:
    """Rank inside each group, ties share their mean rank, a null value has a null rank.

    Ranks come back by a plain join on group and value: there is about one rank for each row, so copies for salts would
    cost more than they save, and Spark splits the partition of a value that many rows share.
    """
    by = list(by)
    values = value_counts(df, by, col, halvings)
    smaller = F.col("_total") - F.col("_below") - F.col("_n") if descending else F.col("_below")
    ranks = values.select(*by, col, (smaller + (F.col("_n") + 1) / 2.0).alias(name))
    return df.join(ranks, [*by, col], "left").select(*df.columns, name)


def exact_quantiles(
    df: DataFrame, by: Sequence[str], col: str, probs: dict[str, float], halvings: int = 8
) -> DataFrame:
    """Linearly interpolated quantiles per group, exact for any group size."""
    by = list(by)
    values = value_counts(df, by, col, halvings)
    picks = []
    for name, p in probs.items():
        at = F.lit(float(p)) * (F.col("_total") - 1)
        for side, target in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            holds = (F.col("_below") <= target) & (target < F.col("_below") + F.col("_n"))
            picks.append(F.max(F.when(holds, F.col(col))).alias(f"_{side}_{name}"))
    picked = values.groupBy(*by).agg(F.max("_total").alias("_total"), *picks)

    def interpolate(name: str, p: float) -> Column:
        at = F.lit(float(p)) * (F.col("_total") - 1)
        low, high = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        return (low + (high - low) * (at - F.floor(at))).alias(name)

    return picked.select(*by, *[interpolate(n, p) for n, p in probs.items()])


def top_n(df: DataFrame, by: Sequence[str], col: str, n: int, name: str = "rank") -> DataFrame:
    """Rows whose descending average rank is below ``n``.

    Values are counted first, so each group is cut to n-1 distinct values before
    it is gathered; ties stay together and are judged by their mean rank.
    """
    by = list(by)
    order = Window.partitionBy(*by).orderBy(F.col(col).desc())
    counts = df.where(F.col(col).isNotNull()).groupBy(*by, col).agg(F.count(F.lit(1)).alias("_n"))
    leading = counts.withColumn("_place", F.row_number().over(order)).where(F.col("_place") < n)
    upto = F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, 0))
    ranks = leading.select(*by, col, (upto - F.col("_n") + (F.col("_n") + 1) / 2.0).alias(name))
    return join_group_stats(df, ranks.where(F.col(name) < n), [*by, col])
