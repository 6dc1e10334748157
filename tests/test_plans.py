"""The physical plans that the operators are meant to get."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from marketseries.operators import indicators as ind
from marketseries.operators import panel
from marketseries.operators.blocks import index_series
from marketseries.sources import readers

ROOT = "/root/testdata/sf0.01"


def plan_of(df, mode="simple"):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode)
    return text.getvalue()


@pytest.fixture(scope="module")
def bars(spark, tmp_path_factory):
    """A landed bars table, large enough joins being shuffled as on big data."""
    from marketseries.sources import stand_ins

    path = str(tmp_path_factory.mktemp("bars") / "t")
    stand_ins.bars(spark, ROOT).write.parquet(path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield path
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_scan_gets_filters_and_columns(spark, bars):
    plan = plan_of(readers.read_bars(spark, bars, ["Brand#1"], "1997-01-01", "1998-01-01").select("ticker", "close"), "formatted")
    pushed = re.search(r"PushedFilters: \[(.*?)\]", plan).group(1)
    assert "In(ticker" in pushed or "EqualTo(ticker" in pushed
    assert "GreaterThanOrEqual(date" in pushed and "LessThan(date" in pushed
    assert "ReadSchema: struct<ticker:string,date:date,close:double>" in plan


def exchanges(df):
    """Exchanges of the plan that ran; those that are used again count once."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    plan = plan_of(df).split("+- == Initial Plan ==")[0]
    return re.findall(r"(?<!Reused)Exchange hashpartitioning\((.*?), \d+\)", plan)


def test_all_indicators_share_one_exchange(spark, bars):
    rows = index_series(spark.read.parquet(bars), ["ticker"], "date")
    base = plan_of(rows).count("Exchange hashpartitioning")
    windows = [ind.moving_average(), ind.bollinger(), ind.log_return(), ind.next_rise()]
    smoothed = [ind.rsi(), ind.atr(), ind.macd()]
    assert plan_of(ind.apply_indicators(rows, windows)).count("Exchange hashpartitioning") == base + 1
    # smoothing reads the rows once more for the states, and adds the exchanges of a table with one row for each block
    assert len(exchanges(ind.apply_indicators(rows, windows + smoothed))) <= 2 * (base + 1) + 2
    plan = plan_of(ind.apply_indicators(rows, windows + smoothed))
    assert "SinglePartition" not in plan
    # rows are numbered and windowed by (ticker, bucket) and (ticker, block), never by ticker alone
    for keys in re.findall(r"Window \[.*?\], \[(.*?)\], \[", plan):
        assert "," in keys or "sum(" in plan


def test_no_rows_are_gathered_by_ticker(spark, bars):
    rows = index_series(spark.read.parquet(bars), ["ticker"], "date")
    alone = [e for e in exchanges(ind.apply_indicators(rows, [ind.rsi()])) if re.fullmatch(r"ticker#\d+", e)]
    # only the bucket counts (in both readings), one row per ticker and month, and the states, one row per block, meet by ticker
    assert 2 <= len(alone) <= 3


def test_top_n_is_limited_before_the_shuffle(spark, bars):
    df = spark.read.parquet(bars).groupBy("ticker", F.last_day("date").alias("m")).agg(F.avg("close").alias("v"))
    assert "WindowGroupLimit" in plan_of(panel.top_n(df, ["m"], "v", 6))


def test_aggregates_are_partial_first(spark, bars):
    from marketseries.sources import stand_ins

    plan = plan_of(stand_ins.bars(spark, ROOT))
    assert "partial_max" in plan and "partial_min_by" in plan
