"""Quantiles of the rows so far against a loop."""

import datetime as dt
import random

import numpy as np
import pytest

from marketseries.operators import indicators as ind
from marketseries.operators.expanding import expanding_quantiles

PROBS = {"least": 0.0, "low": 0.005, "quarter": 0.25, "middle": 0.5, "high": 0.995, "most": 1.0}
RNG = random.Random(11)
SERIES = {
    "noise": [RNG.gauss(0, 1) for _ in range(400)],
    "rising": [float(i) for i in range(300)],
    "falling": [float(-i) for i in range(300)],
    "tied": [RNG.choice([0.0, 0.0, RNG.random()]) for _ in range(400)],
    "flat": [3.0] * 200,
    "gaps": [RNG.choice([None, None, float("nan"), RNG.gauss(5, 2)]) for _ in range(300)],
    "late": [None] * 60 + [1.0, 2.0],
    "one": [4.0],
    "none": [None] * 5,
    "jump": [RNG.gauss(0, 1) for _ in range(150)] + [RNG.gauss(900, 1) for _ in range(150)] + [RNG.gauss(-900, 1) for _ in range(150)],
}


def loop(values):
    seen, out = [], []
    for v in values:
        if v is not None and v == v:
            seen.append(v)
        out.append(tuple(float(np.quantile(seen, p)) if seen else None for p in PROBS.values()))
    return out


def at(i):
    return dt.date(2001, 1, 1) + dt.timedelta(days=i)


@pytest.mark.parametrize("block,leaf", [(8, 4), (64, 16), (2048, 2048)])
def test_quantiles_so_far_equal_a_loop(spark, block, leaf):
    rows = [(k, at(i), v, i) for k, x in SERIES.items() for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "ticker string, date date, close double, _key0 int").repartition(5)
    out = expanding_quantiles(df, ["ticker"], "close", "date", PROBS, block=block, leaf=leaf)
    assert out.columns == [*df.columns, *PROBS]
    mine = {(r["ticker"], r["date"]): tuple(r[p] for p in PROBS) for r in out.collect()}
    assert len(mine) == len(rows)
    for k, x in SERIES.items():
        for i, want in enumerate(loop(x)):
            got = mine[k, at(i)]
            assert got == tuple(None if w is None else pytest.approx(w, abs=1e-9) for w in want), (k, i)


def test_one_series_without_keys_ties_in_time_and_empty(spark):
    rows = [(at(i // 3), i, float(i * 37 % 101)) for i in range(500)]
    df = spark.createDataFrame(rows, "date date, n int, close double").repartition(3)
    out = expanding_quantiles(df, [], "close", "date", {"middle": 0.5}, tiebreak=["n"], block=16, leaf=8)
    mine = [r["middle"] for r in sorted(out.collect(), key=lambda r: r["n"])]
    assert mine == pytest.approx([float(np.quantile([v for *_, v in rows[: i + 1]], 0.5)) for i in range(500)])
    assert expanding_quantiles(df.limit(0), [], "close", "date", {"middle": 0.5}).collect() == []


def test_horizon_returns_so_far_ignore_later_rows(spark):
    rng = random.Random(2)
    prices = [("a", at(31 * i), 10 + rng.random()) for i in range(40)]
    late = prices + [("a", at(31 * i), 10_000.0 * i) for i in range(40, 44)]
    make = lambda rows: spark.createDataFrame(rows, "ticker string, month_end date, adj_close double")
    one, two = (
        {r["month_end"]: r for r in ind.horizon_returns(make(x), cutoff=0.1, as_of=True).collect()} for x in (prices, late))
    assert len(one) == 40 and len(two) == 44 and all(two[d] == r for d, r in one.items())
    raw = [None] + [b / a - 1 for (*_, a), (*_, b) in zip(prices, prices[1:])]
    for i in range(1, 40):
        low, high = np.quantile(raw[1 : i + 1], [0.1, 0.9])
        assert one[at(31 * i)]["returns_1m"] == pytest.approx(min(max(raw[i], low), high))
