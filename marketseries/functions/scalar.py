"""Column expressions; everything stays inside the JVM."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def calendar_features(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Hour, weekday (Monday = 0), quarter, month, year and day of year."""
    return df.withColumns(
        {
            "hour": F.hour(ts),
            "dayofweek": F.weekday(ts),
            "quarter": F.quarter(ts),
            "month": F.month(ts),
            "year": F.year(ts),
            "dayofyear": F.dayofyear(ts),
        }
    )


CALENDAR = ("hour", "dayofweek", "quarter", "month", "year", "dayofyear")


def clip(x: Column, low: Column, high: Column) -> Column:
    """Bound x; a null stays null (``greatest`` alone would turn it into the bound)."""
    return F.when(x.isNotNull(), F.greatest(F.least(x, high), low))


def ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a, b)


def garman_klass(open: str = "open", high: str = "high", low: str = "low", close: str = "adj_close") -> Column:
    spread = F.ln(high) - F.ln(low)
    drift = F.ln(close) - F.ln(open)
    return spread * spread / 2.0 - F.lit(2.0 * math.log(2.0) - 1.0) * drift * drift


def dollar_volume(price: str = "adj_close", volume: str = "volume") -> Column:
    return F.col(price) * F.col(volume) / 1e6


def month_start(date: str | Column) -> Column:
    return F.trunc(date, "month")


def next_month_start(month_end: str | Column) -> Column:
    return F.date_add(month_end, 1)


def normalise_symbol(col: str) -> Column:
    return F.replace(F.col(col), F.lit("."), F.lit("-"))


def snake_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip().lower().replace(" ", "_").replace("-", "_") for c in df.columns])


def positive_class(probability: str = "probability", threshold: float = 0.5) -> Column:
    from pyspark.ml.functions import vector_to_array

    return vector_to_array(probability)[1] > threshold
