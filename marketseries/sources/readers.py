"""Readers with fixed schemas for landed files, and small clean-up steps on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketseries.functions.scalar import normalise_symbol
from marketseries.operators.panel import last_present

LOAD_SCHEMA = "ts TIMESTAMP_NTZ, y DOUBLE"
TEXT_LOAD_SCHEMA = "ts STRING, y DOUBLE"
FACTORS = ("mkt_rf", "smb", "hml", "rmw", "cma")


def read_load(spark: SparkSession, path: str, fmt: str = "yyyy-MM-dd HH:mm:ss", series_id: str = "load") -> DataFrame:
    """Headed CSV of one series; the timestamp is parsed by the scan itself."""
    rows = spark.read.schema(LOAD_SCHEMA).option("header", True).option("timestampNTZFormat", fmt).csv(path)
    return rows.select(F.lit(series_id).alias("series_id"), "ts", "y")


def read_load_text(spark: SparkSession, path: str, fmt: str = "yyyy-MM-dd HH:mm:ss", series_id: str = "load") -> DataFrame:
    """Same file with the timestamp read as text and cast afterwards; a malformed one becomes null."""
    rows = spark.read.schema(TEXT_LOAD_SCHEMA).option("header", True).csv(path)
    ts = F.try_to_timestamp(F.col("ts"), F.lit(fmt)).cast("timestamp_ntz")
    return rows.select(F.lit(series_id).alias("series_id"), ts.alias("ts"), "y")


def read_bars(
    spark: SparkSession, path: str, tickers: Sequence[str] | None = None, start: str | None = None, end: str | None = None
) -> DataFrame:
    """Bars between two dates (end excluded); all conditions reach the parquet scan."""
    bars = spark.read.parquet(path)
    if tickers is not None:
        bars = bars.where(F.col("ticker").isin(list(tickers)))
    if start is not None:
        bars = bars.where(F.col("date") >= F.lit(start).cast("date"))
    if end is not None:
        bars = bars.where(F.col("date") < F.lit(end).cast("date"))
    return bars


#: Folders that a store of bars is dealt out to by name.
BUCKETS = 64


def _bucket(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def store_bars(bars: DataFrame, path: str, key: str = "ticker", date: str = "date") -> DataFrame:
    """Writes bars in folders by a hash of the name, sorted by name and date, and returns the store.

    Rows of a folder are dealt to tasks by name and month, so that no name is one task.
    """
    rows = bars.withColumn("bucket", _bucket(key)).repartition("bucket", F.trunc(date, "year"))
    rows.sortWithinPartitions("bucket", key, date).write.partitionBy("bucket").parquet(path)
    return bars.sparkSession.read.parquet(path)


def bars_of(store: DataFrame, names: DataFrame, key: str = "ticker") -> DataFrame:
    """Bars of the listed names: the folders of other names are left out of the scan when the names are known."""
    wanted = names.select(key).distinct().withColumn("bucket", _bucket(key))
    return store.join(wanted, ["bucket", key], "left_semi").drop("bucket")


def universe(df: DataFrame, col: str) -> DataFrame:
    return df.select(normalise_symbol(col).alias("symbol")).distinct()


def monthly_factors(df: DataFrame, date: str = "date", percent: bool = True) -> DataFrame:
    """Last value of each factor in a month, stamped at month end, as a fraction."""
    scale = 100.0 if percent else 1.0
    return df.groupBy(F.last_day(date).alias("month_end")).agg(
        *[(last_present(c, date) / scale).alias(c) for c in FACTORS]
    )


def profile(df: DataFrame) -> DataFrame:
    """Type, rows and non-null rows of every column, counted in one pass."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(c) for c in df.columns]
    ).unpivot(["_rows"], list(df.columns), "column_name", "non_null")
    types = F.create_map(*[F.lit(x) for name, kind in df.dtypes for x in (name, kind)])
    return counts.select("column_name", types[F.col("column_name")].alias("type"), F.col("_rows").alias("n_rows"), "non_null")
