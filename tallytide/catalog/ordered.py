"""Fills, windows and time-series diagnostics."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallytide.catalog.base import (
    EVENTS,
    EVENTS_SQL,
    FILLED_SQL,
    LAGGED_SQL,
    LINE_ORDER_SQL,
    LINES,
    events,
    lines,
    query,
    r,
)
from tallytide.catalog.unit_root import COUNTS_SQL, QUANTITY_SQL, adf_sql, stationarity_sql
from tallytide.operators import diagnostics, forecast
from tallytide.operators.fill import drop_unobserved, fill_sparse_columns, forward_fill, interpolate
from tallytide.operators.layout import plan_layout
from tallytide.plans.hourly import evaluate_forecast, forecast_hours, hourly_series
from tallytide.operators.windows import (
    context_windows,
    event_lag,
    first_difference,
    lag_leak_audit,
    last_rows,
    observation_index,
    rolling_stats,
)
from tallytide.scale import released_checkpoint
from tallytide.series import SeriesSpec


@query("ffill", "WITH " + FILLED_SQL + " SELECT event_id, x FROM filled WHERE x IS NOT NULL")
def ffill(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = forward_fill(events(spark, sf_dir), EVENTS)
    return drop_unobserved(filled, "obs").select("event_id", F.col("obs").alias("x"))


@query("ffill_placeholder", "WITH " + FILLED_SQL + """
SELECT event_id, x, stop_name, CAST(is_obs AS INTEGER) AS is_obs FROM filled""")
def ffill_placeholder(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = fill_sparse_columns(events(spark, sf_dir), EVENTS, ["stop_name"])
    return filled.select(
        "event_id", F.col("obs").alias("x"), "stop_name", F.col("is_stop_event").cast("int").alias("is_obs")
    )


@query("event_lag", "WITH " + LAGGED_SQL + """
SELECT event_id, x, pax_stop_lag_1, pax_stop_lag_3, pax_stop_lag_5 FROM lagged""")
def lagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = events(spark, sf_dir)
    layout = plan_layout(ev, EVENTS)
    out = event_lag(fill_sparse_columns(ev, EVENTS, layout=layout), EVENTS, layout=layout)
    return out.select("event_id", F.col("obs").alias("x"), "pax_stop_lag_1", "pax_stop_lag_3", "pax_stop_lag_5")


@query("lag_leak_audit", "WITH " + LAGGED_SQL + """,
dense AS (SELECT x, lag(x, 1) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS d, pax_stop_lag_1 AS e FROM lagged),
counted AS (
  SELECT 'dense' AS kind, count(*) AS rows, count(*) FILTER (d = x) AS rows_equal FROM dense WHERE d IS NOT NULL AND x IS NOT NULL
  UNION ALL
  SELECT 'event', count(*), count(*) FILTER (e = x) FROM dense WHERE e IS NOT NULL AND x IS NOT NULL)
SELECT kind, rows, rows_equal, round(rows_equal / rows, 6) AS share_equal FROM counted""")
def leak_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = fill_sparse_columns(events(spark, sf_dir), EVENTS)
    return lag_leak_audit(filled, EVENTS, rows=1).withColumn("share_equal", r("share_equal"))


def _rolling_sql() -> str:
    parts = []
    for column, prefix in (("l_quantity", "speed"), ("l_extendedprice", "power")):
        for w in (60, 300):
            parts.append(
                f"CASE WHEN count({column}) OVER w{w} = {w} THEN round(avg({column}) OVER w{w}, 4) END AS {prefix}_roll_mean_{w}, "
                f"CASE WHEN count({column}) OVER w{w} = {w} THEN round(stddev_samp({column}) OVER w{w}, 2) END AS {prefix}_roll_std_{w}"
            )
    frames = ", ".join(
        f"w{w} AS (PARTITION BY l_suppkey ORDER BY {LINE_ORDER_SQL} ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW)"
        for w in (60, 300)
    )
    return (
        "SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, l_extendedprice, "
        + ", ".join(parts) + f" FROM lineitem WINDOW {frames}"
    )


@query("rolling_stats", _rolling_sql())
def rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rolling_stats(lines(spark, sf_dir), LINES, {"l_quantity": "speed", "l_extendedprice": "power"})
    stats = [
        r(f"{p}_roll_{s}_{w}", 4 if s == "mean" else 2).alias(f"{p}_roll_{s}_{w}")
        for p in ("speed", "power") for w in (60, 300) for s in ("mean", "std")
    ]
    return out.select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", *stats)


@query("first_difference", f"""
SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, l_extendedprice,
       round(l_quantity - lag(l_quantity) OVER (PARTITION BY l_suppkey ORDER BY {LINE_ORDER_SQL}), 6) AS acceleration
FROM lineitem""")
def difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = first_difference(lines(spark, sf_dir), LINES)
    return out.select(
        "l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice",
        r("acceleration").alias("acceleration"),
    )


@query("stop_index", "WITH " + EVENTS_SQL + """
SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS stop_index
FROM ev WHERE obs IS NOT NULL""")
def stop_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observation_index(events(spark, sf_dir), EVENTS).select("event_id", "stop_index")


_NEIGHBOURS_SQL = EVENTS_SQL + """,
ix AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pos FROM ev),
nb AS (
  SELECT *, last_value(CASE WHEN obs IS NOT NULL THEN pos END IGNORE NULLS) OVER before AS p0,
            last_value(obs IGNORE NULLS) OVER before AS v0,
            first_value(CASE WHEN obs IS NOT NULL THEN pos END IGNORE NULLS) OVER after AS p1,
            first_value(obs IGNORE NULLS) OVER after AS v1
  FROM ix
  WINDOW before AS (PARTITION BY user_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         after AS (PARTITION BY user_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
)"""


@query("interpolate", "WITH " + _NEIGHBOURS_SQL + """
SELECT event_id, round(CASE WHEN obs IS NOT NULL THEN obs
  WHEN p0 IS NOT NULL AND p1 IS NOT NULL THEN v0 + (v1 - v0) / (p1 - p0) * (pos - p0)
  ELSE coalesce(v0, v1, 0.0) END, 8) AS interpolated FROM nb""")
def interpolated(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = interpolate(events(spark, sf_dir), EVENTS)
    return out.select("event_id", r("interpolated", 8).alias("interpolated"))


# Contexts of the filled quantity of each supplier.
_CONTEXTS_SQL = f"""
ix AS (SELECT l_suppkey, l_quantity AS x,
              row_number() OVER (PARTITION BY l_suppkey ORDER BY {LINE_ORDER_SQL}) - 1 AS pos FROM lineitem),
size AS (SELECT l_suppkey, count(*) AS n FROM ix GROUP BY 1),
ends AS (SELECT l_suppkey, unnest(range(64, n, 60)) AS target_index FROM size),
ctx AS (
  SELECT e.l_suppkey, target_index, count(*) AS size, sum(x) AS total, sum(x * (pos - greatest(0, target_index - 512) + 1)) AS checksum,
         avg(x) AS mean, max_by(x, pos) AS last
  FROM ends e JOIN ix ON ix.l_suppkey = e.l_suppkey AND pos < target_index AND pos >= target_index - 512
  GROUP BY 1, 2)"""


@query("context_windows", "WITH " + _CONTEXTS_SQL + """
SELECT c.l_suppkey, target_index, size, round(total, 4) AS total, round(checksum, 4) AS checksum, ix.x AS target
FROM ctx c JOIN ix ON ix.l_suppkey = c.l_suppkey AND pos = target_index""")
def contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = context_windows(lines(spark, sf_dir), LINES, fill_gaps=False)
    c = F.col("context")
    weighted = F.transform(c, lambda x, i: x * (i + 1))
    return out.select(
        "l_suppkey", "target_index", F.size(c).cast("long").alias("size"),
        r(F.aggregate(c, F.lit(0.0), lambda a, x: a + x), 4).alias("total"),
        r(F.aggregate(weighted, F.lit(0.0), lambda a, x: a + x), 4).alias("checksum"),
        "target",
    )


_GAPS_SQL = _NEIGHBOURS_SQL + """,
size AS (SELECT user_id, count(*) AS n FROM ix GROUP BY 1),
ends AS (SELECT user_id, unnest(range(8, n, 4)) AS target_index FROM size),
member AS (
  SELECT e.user_id, target_index, pos,
         p0 IS NOT NULL AND p0 >= target_index - 16 AS has0, p1 IS NOT NULL AND p1 < target_index AS has1,
         obs, p0, v0, p1, v1
  FROM ends e JOIN nb ON nb.user_id = e.user_id AND pos < target_index AND pos >= target_index - 16),
val AS (
  SELECT user_id, target_index, pos, CASE WHEN obs IS NOT NULL THEN obs
    WHEN has0 AND has1 THEN v0 + (v1 - v0) / (p1 - p0) * (pos - p0)
    WHEN has0 THEN v0 WHEN has1 THEN v1 ELSE 0.0 END AS x
  FROM member)"""


@query("context_gaps", "WITH " + _GAPS_SQL + """
SELECT user_id, target_index, count(*) AS size, round(sum(x), 8) AS total FROM val GROUP BY 1, 2""")
def context_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = context_windows(events(spark, sf_dir), EVENTS, length=16, stride=4, minimum=8)
    c = F.col("context")
    return out.select(
        "user_id", "target_index", F.size(c).cast("long").alias("size"),
        r(F.aggregate(c, F.lit(0.0), lambda a, x: a + x), 8).alias("total"),
    )


@query("last_n_per_key", f"""
WITH ranked AS (
  SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY {LINE_ORDER_SQL}) AS pos,
         count(*) OVER (PARTITION BY l_suppkey) AS n FROM lineitem)
SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, l_quantity FROM ranked WHERE pos > n - 200 AND n >= 64""")
def last_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = last_rows(lines(spark, sf_dir), LINES, 200, at_least=64)
    return kept.select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


# --- diagnostics --------------------------------------------------------------------------

_DEVIATIONS_SQL = f"""
d AS (
  SELECT l_suppkey, l_quantity - avg(l_quantity) OVER (PARTITION BY l_suppkey) AS d,
         count(*) OVER (PARTITION BY l_suppkey) AS n,
         row_number() OVER (PARTITION BY l_suppkey ORDER BY {LINE_ORDER_SQL}) AS pos FROM lineitem)"""

_ACF_LAGS = 20


@query("acf", "WITH " + _DEVIATIONS_SQL + f""",
g0 AS (SELECT l_suppkey, any_value(n) AS n, sum(d * d) AS g FROM d GROUP BY 1),
lags AS (SELECT l_suppkey, n, g, unnest(range(1, least({_ACF_LAGS}, n // 2 - 1) + 1)) AS lag FROM g0),
gk AS (
  SELECT l_suppkey, lag, sum(a.d * b.d) AS g
  FROM d a JOIN lags USING (l_suppkey) JOIN d b USING (l_suppkey) WHERE b.pos = a.pos - lag GROUP BY 1, 2)
SELECT l_suppkey, l.n, l.lag, round(gk.g / l.g, 6) AS acf, round(1.96 / sqrt(l.n), 6) AS bound,
       CAST(abs(gk.g / l.g) > 1.96 / sqrt(l.n) AS INTEGER) AS significant
FROM lags l JOIN gk USING (l_suppkey, lag)""")
def acf(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = diagnostics.acf(lines(spark, sf_dir), LINES, _ACF_LAGS)
    return out.select(
        "l_suppkey", "n", F.col("lag").cast("long").alias("lag"), r("acf").alias("acf"), r("bound").alias("bound"),
        F.col("significant").cast("int").alias("significant"),
    )


@query("pacf", "WITH RECURSIVE " + _DEVIATIONS_SQL + f""",
g0 AS (SELECT l_suppkey, any_value(n) AS n, sum(d * d) AS g FROM d GROUP BY 1),
lags AS (SELECT l_suppkey, unnest(range(1, least({_ACF_LAGS}, n // 2 - 1) + 1)) AS lag FROM g0),
gk AS (
  SELECT l_suppkey, lag, sum(a.d * b.d) AS g
  FROM d a JOIN lags USING (l_suppkey) JOIN d b USING (l_suppkey) WHERE b.pos = a.pos - lag GROUP BY 1, 2),
r AS (SELECT l_suppkey, any_value(g0.n) AS n, list(gk.g / g0.g ORDER BY lag) AS r FROM gk JOIN g0 USING (l_suppkey) GROUP BY 1),
step AS (
  SELECT l_suppkey, n, r, 1 AS lag, [r[1]] AS phi, 1 - r[1] * r[1] AS v, r[1] AS k FROM r
  UNION ALL
  SELECT l_suppkey, n, r, lag + 1,
         list_append(list_transform(range(1, lag + 1), lambda i: phi[i] - kk * phi[lag + 1 - i]), kk), v * (1 - kk * kk), kk
  FROM (SELECT *, (r[lag + 1] - list_sum(list_transform(range(1, lag + 1), lambda i: phi[i] * r[lag + 1 - i]))) / v AS kk
        FROM step WHERE lag < len(r)))
SELECT l_suppkey, n, CAST(lag AS BIGINT) AS lag, round(k, 6) AS pacf, round(1.96 / sqrt(n), 6) AS bound,
       CAST(abs(k) > 1.96 / sqrt(n) AS INTEGER) AS significant
FROM step""")
def pacf(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = diagnostics.pacf(lines(spark, sf_dir), LINES, _ACF_LAGS)
    return out.select(
        "l_suppkey", "n", F.col("lag").cast("long").alias("lag"), r("pacf").alias("pacf"), r("bound").alias("bound"),
        F.col("significant").cast("int").alias("significant"),
    )


@query("kpss", "WITH " + _DEVIATIONS_SQL + """,
g0 AS (SELECT l_suppkey, any_value(n) AS n, sum(d * d) / any_value(n) AS g FROM d GROUP BY 1),
early AS (
  SELECT l_suppkey, k, sum(a.d * b.d) / any_value(a.n) AS g
  FROM d a JOIN (SELECT l_suppkey, unnest(range(1, CAST(floor(pow(n, 2.0 / 9) + 1e-9) AS BIGINT) + 1)) AS k FROM g0) USING (l_suppkey)
       JOIN d b USING (l_suppkey) WHERE b.pos = a.pos - k GROUP BY 1, 2),
rate AS (
  SELECT l_suppkey, 2 * sum(k * e.g) / (any_value(g0.g) + 2 * sum(e.g)) AS s, any_value(n) AS n, any_value(g0.g) AS g
  FROM early e JOIN g0 USING (l_suppkey) GROUP BY 1),
lags AS (
  SELECT l_suppkey, n, g, CAST(least(floor(1.1447 * pow(s * s, 1.0 / 3) * pow(n, 1.0 / 3)), n - 1) AS BIGINT) AS m FROM rate),
late AS (
  SELECT l_suppkey, k, sum(a.d * b.d) / any_value(a.n) * (1 - k / (any_value(m) + 1)) AS g
  FROM d a JOIN (SELECT l_suppkey, m, unnest(range(1, m + 1)) AS k FROM lags) USING (l_suppkey)
       JOIN d b USING (l_suppkey) WHERE b.pos = a.pos - k GROUP BY 1, 2),
run AS (SELECT l_suppkey, sum(d) OVER (PARTITION BY l_suppkey ORDER BY pos) AS s FROM d),
eta AS (SELECT l_suppkey, sum(s * s) AS e FROM run GROUP BY 1),
stat AS (
  SELECT l_suppkey, n, m, e / (n * n * (g + 2 * coalesce((SELECT sum(late.g) FROM late WHERE late.l_suppkey = lags.l_suppkey), 0))) AS eta
  FROM lags JOIN eta USING (l_suppkey) WHERE n >= 20)
SELECT l_suppkey, n, m AS kpss_lag, round(eta, 6) AS kpss_stat,
       round(CASE WHEN eta <= 0.347 THEN 0.10 WHEN eta <= 0.463 THEN 0.10 - (eta - 0.347) * 0.05 / 0.116
            WHEN eta <= 0.574 THEN 0.05 - (eta - 0.463) * 0.025 / 0.111
            WHEN eta <= 0.739 THEN 0.025 - (eta - 0.574) * 0.015 / 0.165 ELSE 0.01 END, 6) AS kpss_p
FROM stat""")
def kpss(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = diagnostics.kpss(lines(spark, sf_dir), LINES)
    return out.select(
        "l_suppkey", "n", F.col("kpss_lag").cast("long").alias("kpss_lag"),
        r("kpss_stat").alias("kpss_stat"), r("kpss_p").alias("kpss_p"),
    )


@query("adf", "WITH RECURSIVE " + QUANTITY_SQL.format(p="q_") + "," + adf_sql("q_") + """
SELECT l_suppkey, n, round(adf_stat, 6) AS adf_stat, round(adf_p, 6) AS adf_p, adf_lag FROM q_adf""")
def adf(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = diagnostics.adf(lines(spark, sf_dir), LINES)
    return out.withColumns({"adf_stat": r("adf_stat"), "adf_p": r("adf_p"), "adf_lag": F.col("adf_lag").cast("long")})


@query("stationarity_verdict", "WITH RECURSIVE " + QUANTITY_SQL.format(p="q_") + "," + stationarity_sql("q_")
       + COUNTS_SQL + "FROM q_verdict")
def stationarity_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return diagnostics.verdict_counts(diagnostics.stationarity(lines(spark, sf_dir), LINES))


@query("retest_differences", "WITH RECURSIVE " + QUANTITY_SQL.format(p="q_") + """,
s_y AS (SELECT l_suppkey, pos, sum(y - 25.5) OVER (PARTITION BY l_suppkey ORDER BY pos) AS y FROM q_y),""" + stationarity_sql("s_") + """,
d_y AS (
  SELECT l_suppkey, pos - 1 AS pos, y - before AS y
  FROM (SELECT *, lag(y) OVER (PARTITION BY l_suppkey ORDER BY pos) AS before FROM s_y)
       SEMI JOIN (SELECT l_suppkey FROM s_verdict WHERE verdict IN ('NON-STATIONARY', 'TREND-STATIONARY')) USING (l_suppkey)
  WHERE before IS NOT NULL),""" + stationarity_sql("d_") + """
SELECT l_suppkey, n, round(adf_stat, 4) AS adf_stat, adf_lag, round(kpss_stat, 4) AS kpss_stat, verdict FROM d_verdict""")
def retest_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The running sums of the quantities wander; their differences do not."""
    upto = Window.partitionBy(*LINES.key).orderBy(*LINES.order_by)
    sums = lines(spark, sf_dir).select(
        *LINES.key, F.row_number().over(upto).alias("at"), F.sum(F.col("l_quantity") - 25.5).over(upto).alias("level"))
    # both rounds of tests pass over the sums many times: they are made and shuffled once, without the columns of the order
    sums, levels = released_checkpoint(sums), SeriesSpec(LINES.key, "at", "level")
    out = diagnostics.retest_differences(sums, levels, diagnostics.stationarity(sums, levels), diagnostics.MIN_TEST_ROWS)
    return out.select(
        "l_suppkey", "n", r("adf_stat", 4).alias("adf_stat"), F.col("adf_lag").cast("long").alias("adf_lag"),
        r("kpss_stat", 4).alias("kpss_stat"), "verdict",
    )


@query("ar_order_search")
def ar_order_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = forecast.order_search(lines(spark, sf_dir), LINES)
    return found.select("l_suppkey", "n", "p", "d", "q", r("aic", 3).alias("aic"), r("sigma2", 4).alias("sigma2"))


@query("ar_forecast")
def ar_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    models = forecast.order_search(lines(spark, sf_dir), LINES)
    return forecast.forecast(models, LINES.key, 10).withColumn("forecast", r("forecast", 4))


@query("hourly_forecast")
def hourly_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = hourly_series(events(spark, sf_dir), EVENTS, "ts")
    compared = forecast_hours(hours, datetime(2024, 1, 22, tzinfo=timezone.utc))
    return compared.select(
        F.date_format("hour", "yyyy-MM-dd HH").alias("hour"), r("mean_pax").alias("mean_pax"),
        r("forecast", 4).alias("forecast"), "truth", "predicted",
    )


@query("hourly_forecast_metrics")
def hourly_forecast_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = hourly_series(events(spark, sf_dir), EVENTS, "ts")
    metrics = evaluate_forecast(hours, datetime(2024, 1, 22, tzinfo=timezone.utc))
    return metrics.select(r("macro_f1").alias("macro_f1"), r("balanced_accuracy").alias("balanced_accuracy"))


@query("ffill_nan", "WITH " + FILLED_SQL + """
SELECT event_id, is_obs, round(x, 6) AS x FROM filled""")
def ffill_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    missing_as_nan = events(spark, sf_dir).withColumn("obs", F.coalesce("obs", F.lit(float("nan"))))
    filled = fill_sparse_columns(missing_as_nan, EVENTS, ["stop_name"], "is_obs")
    return filled.select("event_id", "is_obs", r("obs").alias("x"))
