"""Named queries with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

_SHIPPED = "lineitem JOIN part ON l_partkey = p_partkey"
_ORDER = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice"


def _bars_sql(ticker: str) -> str:
    return f"""
  SELECT {ticker} AS ticker, CAST(l_shipdate AS DATE) AS date,
         first(l_extendedprice ORDER BY {_ORDER}) AS open,
         max(l_extendedprice) AS high, min(l_extendedprice) AS low,
         last(l_extendedprice ORDER BY {_ORDER}) AS close,
         last(l_extendedprice ORDER BY {_ORDER}) AS adj_close,
         sum(l_quantity) AS volume
  FROM {_SHIPPED} GROUP BY 1, 2"""


_FACTOR = (
    "round(sum(o_totalprice) FILTER (WHERE o_orderpriority = '{p}'), 2)"
    " / count(*) FILTER (WHERE o_orderpriority = '{p}') / 250000 - 1"
)
_FACTOR_COLS = dict(zip(
    ("mkt_rf", "smb", "hml", "rmw", "cma"), ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
))

CTES: dict[str, str] = {
    "bars": _bars_sql("p_brand"),
    "bars_type": _bars_sql("p_type"),
    "sentiment": f"""
  SELECT p_brand AS symbol, CAST(l_shipdate AS DATE) AS date, CAST(l_quantity AS INTEGER) AS likes,
         CAST(l_partkey % 50 AS INTEGER) AS comments
  FROM {_SHIPPED}""",
    "bench": """
  SELECT CAST(o_orderdate AS DATE) AS date, round(sum(o_totalprice), 2) / count(*) AS adj_close FROM orders GROUP BY 1""",
    "factors": f"""
  SELECT * FROM (
    SELECT last_day(CAST(o_orderdate AS DATE)) AS month_end,
           {', '.join(f'{_FACTOR.format(p=p)} AS {f}' for f, p in _FACTOR_COLS.items())}
    FROM orders GROUP BY 1)
  WHERE {' AND '.join(f'{f} IS NOT NULL' for f in _FACTOR_COLS)}""",
    "load_daily": """
  SELECT 'orders' AS series_id, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS ts, round(sum(o_totalprice), 2) AS y
  FROM orders GROUP BY 1, 2""",
    "load_hourly": """
  SELECT 'events' AS series_id, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS ts, round(sum(value), 2) AS y
  FROM events GROUP BY 1, 2""",
    "ticks": """
  SELECT event_type AS asset, time_bucket(INTERVAL 5 MINUTE, ts) AS ts,
         first(value ORDER BY ts, event_id) AS open, max(value) AS high, min(value) AS low,
         last(value ORDER BY ts, event_id) AS close
  FROM events WHERE value > 0 GROUP BY 1, 2""",
}


def sql(body: str, *ctes: str, extra: Sequence[str] = ()) -> str:
    parts = [f"{name} AS ({CTES[name]})" for name in ctes] + list(extra)
    return (f"WITH {', '.join(parts)}\n" if parts else "") + body.strip()


def r(expr: str, digits: int = 6) -> str:
    """Rounded SQL expression without a negative zero."""
    return f"(round({expr}, {digits}) + 0.0)"


def rounded(df: DataFrame, digits: int = 6, only: Sequence[str] | None = None) -> DataFrame:
    """Round every double column, as the SQL side does."""
    doubles = {f.name for f in df.schema.fields if f.dataType.typeName() == "double"}
    chosen = doubles if only is None else doubles & set(only)
    return df.select(*[r_col(F.col(c), digits).alias(c) if c in chosen else F.col(c) for c in df.columns])


def r_col(c: Column, digits: int = 6) -> Column:
    return F.round(c, digits) + F.lit(0.0)


def query(key: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if key in QUERIES:
            raise ValueError(f"duplicate query {key}")
        QUERIES[key] = fn
        if oracle is not None:
            ORACLES[key] = oracle
        return fn

    return register
