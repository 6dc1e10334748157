"""Market-like inputs derived by Spark from the star-schema tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations_with_replacement
from operator import mul

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketseries.operators.blocks import join_group_stats
from marketseries.sources.readers import FACTORS


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def _shipped(spark: SparkSession, root: str) -> DataFrame:
    lines = table(spark, root, "lineitem")
    parts = table(spark, root, "part")
    return lines.join(parts, lines.l_partkey == parts.p_partkey)


def _cents(amount: str | Column) -> Column:
    """Sum of amounts in cents, free of the noise that the order of adding leaves."""
    return F.round(F.sum(amount), 2)


def bars(spark: SparkSession, root: str, ticker: str = "p_brand") -> DataFrame:
    """Daily open/high/low/close/volume; partial aggregation keeps a hot ticker cheap."""
    order = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    price = F.col("l_extendedprice")
    return (
        _shipped(spark, root)
        .groupBy(F.col(ticker).alias("ticker"), F.to_date("l_shipdate").alias("date"))
        .agg(
            F.min_by(price, order).alias("open"),
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            F.max_by(price, order).alias("close"),
            F.sum("l_quantity").alias("volume"),
        )
        .withColumn("adj_close", F.col("close"))
    )


def bars_by_type(spark: SparkSession, root: str) -> DataFrame:
    return bars(spark, root, "p_type")


def sentiment(spark: SparkSession, root: str) -> DataFrame:
    return _shipped(spark, root).select(
        F.col("p_brand").alias("symbol"),
        F.to_date("l_shipdate").alias("date"),
        F.col("l_quantity").cast("int").alias("likes"),
        (F.col("l_partkey") % 50).cast("int").alias("comments"),
    )


def benchmark_prices(spark: SparkSession, root: str) -> DataFrame:
    orders = table(spark, root, "orders")
    return orders.groupBy(F.to_date("o_orderdate").alias("date")).agg((_cents("o_totalprice") / F.count("o_totalprice")).alias("adj_close"))


PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


def factor_rows(spark: SparkSession, root: str) -> DataFrame:
    """Five factors in percent on each order date."""
    orders = table(spark, root, "orders")
    level = (F.col("o_totalprice") / 250000 - 1) * 100
    return orders.groupBy(F.to_date("o_orderdate").alias("date")).agg(
        *[F.avg(F.when(F.col("o_orderpriority") == p, level)).alias(f) for p, f in zip(PRIORITIES, FACTORS)]
    )


def factors(spark: SparkSession, root: str) -> DataFrame:
    orders = table(spark, root, "orders")
    priced = {p: F.when(F.col("o_orderpriority") == p, F.col("o_totalprice")) for p in PRIORITIES}
    return (
        orders.groupBy(F.last_day(F.to_date("o_orderdate")).alias("month_end"))
        .agg(*[
            (F.try_divide(_cents(priced[p]), F.count(priced[p])) / 250000 - 1).alias(f)
            for p, f in zip(PRIORITIES, FACTORS)
        ])
        .na.drop()
    )


def load_daily(spark: SparkSession, root: str) -> DataFrame:
    orders = table(spark, root, "orders")
    day = F.to_date("o_orderdate").cast("timestamp_ntz")
    return orders.groupBy(day.alias("ts")).agg(_cents("o_totalprice").alias("y")).select(
        F.lit("orders").alias("series_id"), "ts", "y"
    )


def load_hourly(spark: SparkSession, root: str) -> DataFrame:
    events = table(spark, root, "events")
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz")
    return events.groupBy(hour.alias("ts")).agg(_cents("value").alias("y")).select(
        F.lit("events").alias("series_id"), "ts", "y"
    )


def five_minute_ticks(spark: SparkSession, root: str) -> DataFrame:
    from marketseries.operators.intraday import five_minute_bars

    events = table(spark, root, "events").where(F.col("value") > 0)
    return five_minute_bars(
        events.select(F.col("event_type").alias("asset"), "ts", F.col("value").alias("price"), "event_id"), "event_id"
    )


def replicates(spark: SparkSession, root: str) -> DataFrame:
    return _shipped(spark, root).select(
        F.col("l_suppkey").alias("rep"),
        F.col("l_extendedprice").alias("y"),
        F.col("l_quantity").alias("x1"),
        F.col("l_discount").alias("x2"),
        F.col("l_tax").alias("x3"),
        F.col("l_linenumber").cast("double").alias("x4"),
        F.col("p_size").cast("double").alias("x5"),
        F.col("p_retailprice").alias("x6"),
    )


#: Rows of a replicate that one task takes.
NEAR_ROWS = 500_000


def wide_replicates(spark: SparkSession, root: str, names: Sequence[str]) -> DataFrame:
    """rep, y and as many predictors as names: the six of :func:`replicates`, then their products, of two and then of
    three, all centred and scaled within the replicate before they are multiplied; the products are not centred again.

    The rows of a replicate stand in one partition, so that its sums of products are made where they are before they
    are shuffled; those of a replicate with over :data:`NEAR_ROWS` rows stand in several. Only the columns that the
    products are made of are sent.
    """
    base = [f"x{i}" for i in range(1, 7)]
    products = [c for size in (1, 2, 3) for c in combinations_with_replacement(base, size)]
    if len(names) > len(products):
        raise ValueError(f"at most {len(products)} predictors")
    rows = replicates(spark, root)
    moments = rows.groupBy("rep").agg(
        F.count(F.lit(1)).alias("_n"), F.avg("y").alias("_m_y"), *[F.avg(c).alias(f"_m_{c}") for c in base],
        *[F.when(F.stddev_pop(c) > 0, F.stddev_pop(c)).otherwise(1.0).alias(f"_s_{c}") for c in base])
    unit = join_group_stats(rows, moments, ["rep"])
    share = F.pmod(F.xxhash64("y", *base), F.ceil(F.col("_n") / NEAR_ROWS)).alias("_share")
    unit = unit.select("rep", share, (F.col("y") - F.col("_m_y")).alias("y"), *[((F.col(c) - F.col(f"_m_{c}")) / F.col(f"_s_{c}")).alias(c) for c in base])
    unit = unit.repartition("rep", "_share")
    return unit.select("rep", "y", *[reduce(mul, map(F.col, p)).alias(n) for n, p in zip(names, products)])


def vectors(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "embeddings").select(
        F.col("label").alias("grp"), F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("x")
    )
