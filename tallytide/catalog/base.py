"""Registration of queries and the series views over the benchmark tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallytide.schema import PLACEHOLDER
from tallytide.series import SeriesSpec
from tallytide.session import prepare

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)

        _QUERIES[name] = run
        if sql is not None:
            _SQL[name] = sql
        return fn

    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r(x: Column | str, digits: int = 6) -> Column:
    """Rounded, because sums of doubles depend on the order of the rows."""
    return F.round(F.col(x) if isinstance(x, str) else x, digits)


# Events: many short series with an observation in about one row of five.
EVENTS = SeriesSpec("user_id", ("ts", "event_id"), "obs")

EVENTS_SQL = """
ev AS (
  SELECT user_id, ts, event_id,
         CASE WHEN event_type = 'purchase' THEN value END AS obs,
         value AS speed,
         CAST(regexp_extract(props, '(-?[0-9]+)', 1) AS DOUBLE) AS power,
         CASE WHEN event_type = 'error' THEN '-' ELSE event_type END AS stop_name
  FROM events
)"""

FILLED_SQL = EVENTS_SQL + """,
filled AS (
  SELECT user_id, ts, event_id, speed, power, obs,
         obs IS NOT NULL AS is_obs,
         last_value(obs IGNORE NULLS) OVER w AS x,
         coalesce(last_value(nullif(stop_name, '-') IGNORE NULLS) OVER w, '-') AS stop_name
  FROM ev
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
)"""

LAGGED_SQL = FILLED_SQL + """,
own AS (
  SELECT event_id,
         lag(obs, 1) OVER w AS l1, lag(obs, 3) OVER w AS l3, lag(obs, 5) OVER w AS l5
  FROM ev WHERE obs IS NOT NULL
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
),
lagged AS (
  SELECT f.*,
         last_value(l1 IGNORE NULLS) OVER w AS pax_stop_lag_1,
         last_value(l3 IGNORE NULLS) OVER w AS pax_stop_lag_3,
         last_value(l5 IGNORE NULLS) OVER w AS pax_stop_lag_5
  FROM filled f LEFT JOIN own USING (event_id)
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
)"""


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        "user_id",
        F.col("ts").cast("timestamp").alias("ts"),
        "event_id",
        F.when(kind == "purchase", F.col("value")).alias("obs"),
        F.col("value").alias("speed"),
        F.get_json_object("props", "$.k").cast("double").alias("power"),
        F.when(kind == "error", PLACEHOLDER).otherwise(kind).alias("stop_name"),
    )


# Line items: long series without gaps. The pair of order and line number is not
# unique, so the order uses all columns.
_LINE_ORDER = (
    "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus",
)
LINES = SeriesSpec("l_suppkey", _LINE_ORDER, "l_quantity")
LINE_ORDER_SQL = ", ".join(_LINE_ORDER)


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))
