"""Aggregates of the exploratory tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallytide.catalog.base import EVENTS, EVENTS_SQL, FILLED_SQL, events, lines, orders, query, r, table
from tallytide.functions import scalars as S
from tallytide.operators import diagnostics, stats
from tallytide.operators.fill import forward_fill
from tallytide.plans.hourly import hourly_series

_LINE_NUMBERS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query("calendar_counts", """
SELECT 'hour' AS unit, CAST(hour(ts) AS BIGINT) AS value, count(*) AS rows FROM events GROUP BY 2
UNION ALL SELECT 'dayofweek', CAST(isodow(ts) - 1 AS BIGINT), count(*) FROM events GROUP BY 2
UNION ALL SELECT 'month', CAST(month(ts) AS BIGINT), count(*) FROM events GROUP BY 2""")
def calendar_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = S.calendar_features(events(spark, sf_dir).select("ts"), "ts")
    return stats.counts_by(dated, ["hour", "dayofweek", "month"])


def _profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = S.calendar_features(events(spark, sf_dir).select("ts", "speed"), "ts")
    flag = F.col("is_weekend").cast("int").alias("is_weekend")
    return stats.mean_by(dated, [flag, "hour"], "speed", "mean_value")


_PROFILE_SQL = """
SELECT CAST(isodow(ts) >= 6 AS INTEGER) AS is_weekend, hour(ts) AS hour, avg(value) AS mean_value FROM events GROUP BY 1, 2"""


@query("hourly_profile", f"SELECT is_weekend, hour, round(mean_value, 6) AS mean_value FROM ({_PROFILE_SQL})")
def hourly_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _profile(spark, sf_dir).withColumn("mean_value", r("mean_value"))


@query("peak_hour", f"""
SELECT is_weekend, hour AS peak_hour, round(mean_value, 6) AS peak_mean
FROM (SELECT *, row_number() OVER (PARTITION BY is_weekend ORDER BY mean_value DESC, hour) AS k FROM ({_PROFILE_SQL}))
WHERE k = 1""")
def peak_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.peak(_profile(spark, sf_dir), ["is_weekend"], "hour", "mean_value").withColumn("peak_mean", r("peak_mean"))


@query("monthly_mean", """
SELECT strftime(o_orderdate, '%Y-%m') AS year_month, round(avg(o_totalprice), 4) AS mean_price FROM orders GROUP BY 1""")
def monthly_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    month = S.year_month(F.col("o_orderdate")).alias("year_month")
    return stats.mean_by(orders(spark, sf_dir), [month], "o_totalprice", "mean_price").withColumn(
        "mean_price", r("mean_price", 4)
    ).orderBy("year_month")


@query("group_topk", """
SELECT p_brand, round(avg(p_retailprice), 4) AS mean FROM part WHERE p_brand <> '-'
GROUP BY 1 ORDER BY avg(p_retailprice) DESC, p_brand LIMIT 25""")
def group_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.top_groups(table(spark, sf_dir, "part"), "p_brand", "p_retailprice", 25).withColumn("mean", r("mean", 4))


@query("group_distribution", """
WITH ev AS (SELECT CASE WHEN event_type = 'error' THEN '-' ELSE event_type END AS stop_name, value AS speed FROM events)
SELECT stop_name, count(speed) AS n, round(avg(speed), 6) AS mean, min(speed) AS min, max(speed) AS max,
       round(quantile_cont(speed, 0.25), 6) AS q25, round(quantile_cont(speed, 0.5), 6) AS median,
       round(quantile_cont(speed, 0.75), 6) AS q75
FROM ev WHERE stop_name <> '-' GROUP BY 1""")
def group_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = stats.group_distribution(events(spark, sf_dir), "stop_name", "speed")
    q = F.col("q")
    return out.select(
        "stop_name", "n", r("mean").alias("mean"), "min", "max",
        r(q[0]).alias("q25"), r(q[1]).alias("median"), r(q[2]).alias("q75"),
    )


@query("door_means", """
SELECT round(avg(l_quantity) FILTER (l_returnflag <> 'R'), 6) AS l_quantity_off,
       round(avg(l_quantity) FILTER (l_returnflag = 'R'), 6) AS l_quantity_on,
       round(avg(l_extendedprice) FILTER (l_returnflag <> 'R'), 4) AS l_extendedprice_off,
       round(avg(l_extendedprice) FILTER (l_returnflag = 'R'), 4) AS l_extendedprice_on,
       count(*) FILTER (l_returnflag = 'R') AS rows_on,
       round(count(*) FILTER (l_returnflag = 'R') / count(*) * 100, 6) AS pct_on
FROM lineitem""")
def door_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = lines(spark, sf_dir).withColumn("returned", (F.col("l_returnflag") == "R").cast("int"))
    out = stats.mean_by_flag(flagged, "returned", ["l_quantity", "l_extendedprice"])
    return out.select(
        r("l_quantity_off").alias("l_quantity_off"), r("l_quantity_on").alias("l_quantity_on"),
        r("l_extendedprice_off", 4).alias("l_extendedprice_off"), r("l_extendedprice_on", 4).alias("l_extendedprice_on"),
        "rows_on", r("pct_on").alias("pct_on"),
    )


@query("summary_stats", """
SELECT min(value) AS min, round(avg(value), 6) AS mean, round(quantile_cont(value, 0.5), 6) AS median,
       max(value) AS max, round(skewness(value), 6) AS skew FROM events""")
def summary_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = stats.summary(events(spark, sf_dir), "speed")
    return out.select("min", r("mean").alias("mean"), r("median").alias("median"), "max", r("skew").alias("skew"))


@query("terciles", "WITH " + EVENTS_SQL + """
SELECT round(quantile_cont(obs, 1/3), 6) AS q1, round(quantile_cont(obs, 2/3), 6) AS q2 FROM ev""")
def terciles(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = stats.exact_quantiles(events(spark, sf_dir), "obs", [1 / 3, 2 / 3])
    return q.select(r(F.col("q")[0]).alias("q1"), r(F.col("q")[1]).alias("q2"))


@query("class_distribution", """
WITH c AS (SELECT CASE WHEN l_quantity <= 17 THEN 'low' ELSE 'high' END AS label FROM lineitem)
SELECT label, count(c.label) AS rows FROM (VALUES ('low'), ('medium'), ('high')) v(label) LEFT JOIN c USING (label) GROUP BY 1""")
def class_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    # boundaries that leave no room for the middle class
    labelled = lines(spark, sf_dir).select(S.demand_class(F.col("l_quantity"), 17.0, 17.0).alias("label"))
    return stats.class_distribution(labelled, "label")


@query("missing_stats", "WITH " + EVENTS_SQL + """,
c AS (SELECT count(*) AS n, count(*) FILTER (obs IS NULL) AS g_obs, count(*) FILTER (power IS NULL) AS g_power,
             count(*) FILTER (stop_name IS NULL) AS g_stop, count(*) FILTER (stop_name = '-') AS d_stop FROM ev)
SELECT 'obs' AS "column", g_obs AS nan_count, round_even(g_obs / n * 100, 2) AS nan_pct, CAST(0 AS BIGINT) AS dash_count, 0.0 AS dash_pct FROM c
UNION ALL SELECT 'power', g_power, round_even(g_power / n * 100, 2), 0, 0.0 FROM c
UNION ALL SELECT 'stop_name', g_stop, round_even(g_stop / n * 100, 2), d_stop, round_even(d_stop / n * 100, 2) FROM c""")
def missing_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.missing_stats(events(spark, sf_dir).select("obs", "power", "stop_name"))


def _corr_sql() -> str:
    parts = [
        f"SELECT '{a}' AS a, '{b}' AS b, " + ("1.0" if a == b else f"round(corr({a}, {b}), 6)") + " AS r FROM lineitem"
        + (" LIMIT 1" if a == b else "")
        for a in _LINE_NUMBERS for b in _LINE_NUMBERS
    ]
    return " UNION ALL ".join(f"({p})" for p in parts)


@query("corr_matrix", _corr_sql())
def corr_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.correlation_matrix(lines(spark, sf_dir), _LINE_NUMBERS).withColumn("r", r("r"))


@query("corr_rank", """
SELECT feature, round(v, 6) AS r FROM (
  SELECT 'l_extendedprice' AS feature, corr(l_extendedprice, l_quantity) AS v FROM lineitem
  UNION ALL SELECT 'l_discount', corr(l_discount, l_quantity) FROM lineitem
  UNION ALL SELECT 'l_tax', corr(l_tax, l_quantity) FROM lineitem)
ORDER BY abs(v) DESC, feature LIMIT 2""")
def corr_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.correlation_rank(lines(spark, sf_dir), _LINE_NUMBERS, "l_quantity", 2).withColumn("r", r("r"))


@query("histogram", """
WITH m AS (SELECT min(value) AS low, max(value) AS high FROM events),
b AS (SELECT CAST(least(49, floor((value - low) / ((high - low) / 50))) AS INTEGER) AS bin FROM events, m)
SELECT CAST(g AS INTEGER) AS bin, round(any_value(low) + g * (any_value(high) - any_value(low)) / 50, 6) AS bin_low,
       round(any_value(low) + (g + 1) * (any_value(high) - any_value(low)) / 50, 6) AS bin_high, count(b.bin) AS rows
FROM m, (SELECT unnest(range(50)) AS g) LEFT JOIN b ON b.bin = g GROUP BY g""")
def histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = stats.histogram(events(spark, sf_dir), "speed")
    return out.select("bin", r("bin_low").alias("bin_low"), r("bin_high").alias("bin_high"), "rows")


@query("histogram_density", """
WITH e AS (SELECT CAST(isodow(ts) >= 6 AS INTEGER) AS flag, value FROM events),
m AS (SELECT flag, min(value) AS low, (max(value) - min(value)) / 50 AS w, count(*) AS n FROM e GROUP BY 1),
b AS (SELECT flag, CAST(least(49, floor((value - low) / w)) AS INTEGER) AS bin, w, n FROM e JOIN m USING (flag))
SELECT flag, bin, count(*) AS rows, round(count(*) / (any_value(n) * any_value(w)), 8) AS density FROM b GROUP BY 1, 2""")
def histogram_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = S.calendar_features(events(spark, sf_dir).select("ts", "speed"), "ts")
    flagged = dated.select(F.col("is_weekend").cast("int").alias("flag"), "speed")
    return stats.density_histogram(flagged, "speed", "flag").withColumn("density", r("density", 8))


@query("qcut_means", """
WITH q AS (SELECT list_sort(list_distinct(quantile_cont(l_discount, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) AS e FROM lineitem),
b AS (SELECT len(list_filter(e[2:len(e) - 1], lambda x: x < l_discount)) AS bin, l_quantity FROM lineitem, q)
SELECT CAST(bin AS INTEGER) AS bin, count(*) AS rows, round(avg(l_quantity), 6) AS mean FROM b GROUP BY 1""")
def qcut_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.quantile_bins(lines(spark, sf_dir), "l_discount", "l_quantity").withColumn("mean", r("mean"))


@query("hourly_series", """
WITH a AS (SELECT user_id, date_trunc('hour', ts) AS h, avg(value) AS m FROM events WHERE event_type = 'purchase' GROUP BY 1, 2)
SELECT strftime(h, '%Y-%m-%d %H') AS hour, round(avg(m), 6) AS mean_pax FROM a GROUP BY 1""")
def hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = hourly_series(events(spark, sf_dir), EVENTS, "ts")
    return out.select(F.date_format("hour", "yyyy-MM-dd HH").alias("hour"), r("mean_pax").alias("mean_pax"))


@query("series_gaps", "WITH " + EVENTS_SQL + """,
g AS (SELECT user_id, obs, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS gap
      FROM ev WHERE obs IS NOT NULL)
SELECT user_id, count(*) AS n, round(avg(obs), 6) AS mean, round(stddev_samp(obs), 5) AS std, min(obs) AS low,
       max(obs) AS high, round(quantile_cont(gap, 0.5) / 1e6, 4) AS gap_median_s, round(max(gap) / 1e6, 4) AS gap_max_s
FROM g GROUP BY 1""")
def series_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    stops = events(spark, sf_dir).filter(F.col("obs").isNotNull())
    out = diagnostics.gap_stats(stops, EVENTS, "ts")
    return out.select(
        "user_id", "n", r("mean").alias("mean"), r("std", 5).alias("std"), "low", "high",
        r("gap_median_s", 4).alias("gap_median_s"), r("gap_max_s", 4).alias("gap_max_s"),
    )


@query("distinct_counts", """
SELECT 'l_suppkey' AS "column", count(DISTINCT l_suppkey) AS distinct_values FROM lineitem
UNION ALL SELECT 'l_partkey', count(DISTINCT l_partkey) FROM lineitem
UNION ALL SELECT 'l_returnflag', count(DISTINCT l_returnflag) FROM lineitem""")
def distinct_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.distinct_counts(lines(spark, sf_dir), ["l_suppkey", "l_partkey", "l_returnflag"])


@query("fill_coverage", "WITH " + FILLED_SQL + """
SELECT count(*) AS rows, count(obs) AS rows_before, round(count(obs) / count(*) * 100, 6) AS pct_before,
       count(x) AS rows_after, round(count(x) / count(*) * 100, 6) AS pct_after, count(*) - count(x) AS rows_dropped
FROM filled""")
def fill_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = forward_fill(events(spark, sf_dir).withColumn("x", F.col("obs")), EVENTS.of("x"))
    out = stats.fill_coverage(both, "obs", "x")
    return out.withColumns({"pct_before": r("pct_before"), "pct_after": r("pct_after")})
