"""One small frame per rule on nulls, ties, order and bounds."""

import datetime as dt
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from marketseries.functions import metrics, scalar
from marketseries.operators import backtest, forecast, panel
from marketseries.operators import indicators as ind
from marketseries.operators.blocks import index_series
from marketseries.session import shared_dir
from marketseries.sources import readers


def day(i):
    return dt.date(2001, 1, 1) + dt.timedelta(days=i)


def prices(spark, values, ticker="a"):
    return spark.createDataFrame([(ticker, day(i), v) for i, v in enumerate(values)], "ticker string, date date, close double")


def test_last_row_has_no_rise_and_no_return(spark):
    rows = index_series(prices(spark, [1.0, 2.0, 1.5]), ["ticker"], "date")
    out = ind.apply_indicators(rows, [ind.next_rise()]).orderBy("date").collect()
    assert [r["next_rise"] for r in out] == [1, 0, 0]
    back = backtest.signal_backtest(prices(spark, [1.0, 2.0, 1.0]).withColumn("up", F.lit(True)), "up", "close", ("ticker",))
    got = back.orderBy("date").collect()
    assert len(got) == 2 and got[-1]["market_cum"] == pytest.approx(0)


def test_null_inside_a_full_window_gives_null(spark):
    rows = index_series(prices(spark, [1.0, None, 3.0, 4.0, 5.0, 6.0]), ["ticker"], "date")
    out = ind.apply_indicators(rows, [ind.moving_average(ns=(3,))]).orderBy("date").collect()
    assert [r["ma_3"] for r in out] == [None] * 5 + [4.0]


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(None,), (5.0,), (0.0,)], "x double")
    got = [r[0] for r in df.select(scalar.clip(F.col("x"), F.lit(1.0), F.lit(2.0))).collect()]
    assert got == [None, 2.0, 1.0]


def test_zero_likes_give_null(spark):
    df = spark.createDataFrame([(3, 0), (4, 2)], "a int, b int")
    assert [r[0] for r in df.select(scalar.ratio(F.col("a"), F.col("b"))).collect()] == [None, 2.0]


def test_threshold_is_strict(spark):
    df = spark.createDataFrame([(19000.0,), (19000.1,)], "y double")
    assert forecast.above(df, "y", 19000).count() == 1


def test_monday_is_zero(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1),), (dt.datetime(2024, 1, 7),)], "ts timestamp_ntz")
    assert [r["dayofweek"] for r in scalar.calendar_features(df).orderBy("ts").collect()] == [0, 6]


def test_month_end_in_a_leap_year(spark):
    df = spark.createDataFrame([("a", dt.date(2024, 2, 10), 1.0)], "ticker string, date date, v double")
    monthly = panel.monthly_mean(df, ["ticker"], ["v"])
    assert monthly.first()["month_end"] == dt.date(2024, 2, 29)
    assert backtest.hold_next_month(monthly).first()["rebalance_date"] == dt.date(2024, 3, 1)


def test_last_present_per_column(spark):
    df = spark.createDataFrame([("a", day(0), 1.0, 5.0), ("a", day(1), None, 6.0)], "ticker string, date date, v double, u double")
    row = panel.monthly_last(df, ["ticker"], ["v", "u"]).first()
    assert (row["v"], row["u"]) == (1.0, 6.0)


def test_duplicate_timestamps_do_not_multiply_rows(spark):
    t0 = dt.datetime(2001, 1, 1)
    rows = [("s", t0, 1.0), ("s", t0, 3.0), ("s", t0 + dt.timedelta(days=7), 5.0)]
    df = spark.createDataFrame(rows, "series_id string, ts timestamp_ntz, y double")
    got = forecast.date_lags(df, {"lag": 7}).orderBy("ts", "y").collect()
    assert [r["lag"] for r in got] == [None, None, 3.0]


def test_gap_months_are_skipped_on_the_grid(spark):
    months = [dt.date(2001, m, 28) for m in (1, 2, 6)]
    df = spark.createDataFrame([("a", m, float(i)) for i, m in enumerate(months)], "ticker string, month_end date, v double")
    got = panel.rolling_months(df, "v", 2, 2).orderBy("month_end").collect()
    assert [r["v"] for r in got] == [None, 0.5, 1.5]


def test_months_needed_to_stay(spark):
    rows = [("nine", i) for i in range(9)] + [("ten", i) for i in range(10)]
    df = spark.createDataFrame(rows, "ticker string, i int")
    assert {r["ticker"] for r in panel.keep_min_obs(df, "ticker", 10).collect()} == {"ten"}


def test_fill_leaves_a_group_without_values_empty(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", None)], "ticker string, v double")
    got = panel.fill_group_mean(df, ["ticker"], ["v"]).orderBy("ticker", "v").collect()
    assert [r["v"] for r in got] == [1.0, 1.0, None]


def test_constant_column_scales_by_one(spark):
    df = spark.createDataFrame([(2.0, 1.0), (2.0, 3.0)], "a double, b double")
    stats = forecast.scaler_fit(df, ["a", "b"])
    got = forecast.scale(df, stats, ["a", "b"]).orderBy("b").collect()
    assert [tuple(r) for r in got] == [(0.0, -1.0), (0.0, 1.0)]
    back = forecast.unscale(forecast.scale(df, stats, ["b"]), stats, {"b": "b"}).orderBy("b").collect()
    assert [r["b"] for r in back] == [1.0, 3.0]


def test_short_series_has_no_window(spark):
    df = prices(spark, [float(i) for i in range(5)]).unionByName(prices(spark, [float(i) for i in range(7)], "b"))
    got = forecast.sliding_windows(df, ["ticker"], "date", ["close"], "close", 5).orderBy("date").collect()
    assert [(r["ticker"], r["label"], r["x"][0][0], r["x"][4][0]) for r in got] == [("b", 5.0, 0.0, 4.0), ("b", 6.0, 1.0, 5.0)]


def test_weights_are_not_rescaled_for_missing_names(spark):
    weights = spark.createDataFrame(
        [(dt.date(2001, 1, 1), "a", 0.5), (dt.date(2001, 1, 1), "b", 0.5)], "rebalance_date date, ticker string, weight double"
    )
    rets = spark.createDataFrame([("a", day(3), 0.1), ("b", day(3), None)], "ticker string, date date, ret double")
    assert backtest.weighted_returns(weights, rets).first()["portfolio_return"] == pytest.approx(0.05)
    assert backtest.equal_weight_returns(weights, rets).first()["portfolio_return"] == pytest.approx(0.1)


def test_compounding_skips_total_losses(spark):
    df = spark.createDataFrame([(day(0), 0.1), (day(1), -1.5), (day(2), 0.1)], "date date, r double")
    got = [x["c"] for x in backtest.compounded(df, {"c": "r"}).orderBy("date").collect()]
    assert got[1] is None and got[2] == pytest.approx(1.1**2 - 1)


def test_all_four_cells(spark):
    df = spark.createDataFrame([(1, 1), (1, 1)], "y int, p int")
    assert metrics.confusion(df, "y", "p").first().asDict() == {"n_0_0": 0, "n_0_1": 0, "n_1_0": 0, "n_1_1": 2}


def test_log_loss_is_bounded(spark):
    df = spark.createDataFrame([(1, 0.0)], "y int, p double")
    assert df.agg(metrics.log_loss("y", "p")).first()[0] == pytest.approx(-math.log(1e-7))


def test_symbols_use_a_literal_dot(spark):
    df = spark.createDataFrame([("BRK.B",), ("BRK.B",), ("AXB",)], "s string")
    assert {r[0] for r in readers.universe(df, "s").collect()} == {"BRK-B", "AXB"}


def test_malformed_timestamps_become_null(spark, tmp_path):
    (tmp_path / "load.csv").write_text("ts,y\n2001-01-01 00:00:00,1.5\nnot a time,2.5\n")
    got = readers.read_load_text(spark, str(tmp_path)).orderBy("y").collect()
    assert [r["ts"] for r in got] == [dt.datetime(2001, 1, 1), None]


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_total_loss_is_for_good(spark):
    from marketseries.operators import backtest

    rows = [(dt.date(2000, 1, 1) + dt.timedelta(days=200 * i), r) for i, r in enumerate([0.1, -1.0, 0.2, None, -1.5, 0.3])]
    df = spark.createDataFrame(rows, "date date, r double")
    found = [x["c"] for x in backtest.compounded(df, {"c": "r"}).orderBy("date").collect()]
    assert found[0] == pytest.approx(0.1) and found[1:] == [-1.0, -1.0, None, None, -1.0]


def test_statistics_so_far_equal_a_loop(spark):
    """Moments of the rows up to each one, with nulls, a flat stretch and values far from zero."""
    rng = random.Random(4)
    series = {"a": [1e6 + rng.gauss(0, 1) if rng.random() < 0.8 else None for _ in range(150)], "b": [5.0] * 40 + [6.0, None, 7.0], "c": [None, 2.0]}
    rows = [(k, day(i), v) for k, x in series.items() for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "ticker string, date date, close double").repartition(4)
    z = {(r["ticker"], r["date"]): r["close"] for r in panel.group_zscore(df, ["ticker"], ["close"], as_of="date").collect()}
    filled = {(r["ticker"], r["date"]): r["close"] for r in panel.fill_group_mean(df, ["ticker"], ["close"], as_of="date").collect()}
    assert len(z) == len(rows) == len(filled)
    for k, x in series.items():
        for i, v in enumerate(x):
            so_far = [y for y in x[: i + 1] if y is not None]
            mean = statistics.fmean(so_far) if so_far else None
            assert filled[k, day(i)] == (pytest.approx(mean if v is None else v) if so_far else None)
            sd = statistics.stdev(so_far) if len(so_far) > 1 else 0
            assert z[k, day(i)] == (pytest.approx((v - mean) / sd, abs=1e-5) if v is not None and sd else None)


def test_statistics_so_far_ignore_later_rows(spark):
    early = prices(spark, [1.0, 2.0, 4.0, 3.0])
    late = prices(spark, [1.0, 2.0, 4.0, 3.0, 900.0, -50.0])
    one, two = (panel.group_zscore(d, ["ticker"], ["close"], as_of="date").orderBy("date").limit(4).collect() for d in (early, late))
    assert [r["close"] for r in one][1:] == pytest.approx([r["close"] for r in two][1:]) and one[0]["close"] is None


def scanned_rows(df):
    """Rows that the scans of a plan without adaptive execution gave, after it has run."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().get("numOutputRows").get().value() for i in range(leaves.size()) if "FileScan" in leaves.apply(i).toString())


def test_scan_of_stored_bars_is_pruned(spark, tmp_path):
    bars = spark.range(20_000).select(
        F.format_string("t%03d", F.col("id") % 200).alias("ticker"), F.date_add(F.lit(day(0)), (F.col("id") / 200).cast("int")).alias("date"),
        F.col("id").cast("double").alias("close"))
    store = readers.store_bars(bars, f"{tmp_path}/store")
    spark.createDataFrame([(f"t{i:03d}", i) for i in range(200)], "ticker string, likes int").write.parquet(f"{tmp_path}/names")
    names = spark.read.parquet(f"{tmp_path}/names").where("likes < 3")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = readers.bars_of(store, names)
        assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString().lower()
        read, whole = scanned_rows(found), scanned_rows(store)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert whole == 20_000 and read < whole / 5
    wanted = bars.where(F.col("ticker").isin("t000", "t001", "t002"))
    assert sorted(map(tuple, found.select(bars.columns).collect())) == sorted(map(tuple, wanted.collect()))
    assert readers.bars_of(store, names.limit(0)).count() == 0
