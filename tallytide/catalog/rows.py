"""Projections, filters, joins and scans."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallytide.catalog.base import EVENTS, EVENTS_SQL, LAGGED_SQL, events, orders, query, r, table
from tallytide.functions import scalars as S
from tallytide.operators import encode, joins, sampling, stats
from tallytide.operators.fill import fill_sparse_columns, observations
from tallytide.operators.models import complete_rows
from tallytide.operators.windows import event_lag
from tallytide.scale import shared_folder
from tallytide.sources.daily_index import densify
from tallytide.sources.telemetry import read_metadata, read_mission, read_missions

CUTOFF = datetime(1995, 9, 1, tzinfo=timezone.utc)

# Weekly means of the order value serve as the external index, scaled to 0..100.
_WEEKLY_SQL = """
weekly AS (
  SELECT CAST(date_trunc('week', o_orderdate) AS DATE) AS date,
         round(avg(o_totalprice) / 5000, 3) AS stringency
  FROM orders GROUP BY 1
)"""
_DAILY_SQL = _WEEKLY_SQL + """,
days AS (
  SELECT CAST(unnest(generate_series(min(date)::TIMESTAMP, max(date)::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS date
  FROM weekly
),
daily AS (
  SELECT d.date, coalesce(last_value(w.stringency IGNORE NULLS)
           OVER (ORDER BY d.date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0.0) AS stringency
  FROM days d LEFT JOIN weekly w USING (date)
)"""


def weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = orders(spark, sf_dir)
    week = F.to_date(F.date_trunc("week", F.col("o_orderdate"))).alias("date")
    return o.groupBy(week).agg(F.round(F.avg("o_totalprice") / 5000, 3).alias("stringency"))


@query("unit_conversions", """
SELECT event_id, round(speed - 273.15, 6) AS temp_c, round(degrees(power / 100), 6) AS lat_deg,
       round(degrees(speed / 100), 6) AS lon_deg, round(speed * 3.6, 6) AS speed_kmh
FROM (WITH """ + EVENTS_SQL + " SELECT * FROM ev)")
def unit_conversions(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = events(spark, sf_dir).select(
        "event_id",
        F.col("speed").alias("temperature_ambient"),
        (F.col("power") / 100).alias("gnss_latitude"),
        (F.col("speed") / 100).alias("gnss_longitude"),
        F.col("speed").alias("odometry_vehicleSpeed"),
    )
    converted = S.unit_conversions(readings)
    return converted.select(
        "event_id", r("temp_C").alias("temp_c"), r("lat_deg").alias("lat_deg"),
        r("lon_deg").alias("lon_deg"), r("speed_kmh").alias("speed_kmh"),
    )


@query("calendar_features", """
SELECT event_id, hour(ts) AS hour, isodow(ts) - 1 AS dayofweek, month(ts) AS month, year(ts) AS year,
       CAST(isodow(ts) >= 6 AS INTEGER) AS is_weekend,
       CAST(isodow(ts) < 6 AND (hour(ts) IN (7, 8) OR hour(ts) IN (16, 17, 18)) AS INTEGER) AS is_rush_hour
FROM events""")
def calendar_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = S.calendar_features(events(spark, sf_dir), "ts")
    return c.select(
        "event_id", "hour", "dayofweek", "month", "year",
        F.col("is_weekend").cast("int").alias("is_weekend"), F.col("is_rush_hour").cast("int").alias("is_rush_hour"),
    )


@query("meta_duration", """
SELECT o_custkey, round((epoch(max(o_orderdate)) - epoch(min(o_orderdate))) / 3600, 6) AS duration_hours
FROM orders GROUP BY 1""")
def meta_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = orders(spark, sf_dir).groupBy("o_custkey").agg(
        F.unix_timestamp(F.min("o_orderdate")).alias("a"), F.unix_timestamp(F.max("o_orderdate")).alias("b")
    )
    return spans.select("o_custkey", r(S.duration_hours(F.col("a"), F.col("b"))).alias("duration_hours"))


@query("demand_class", """
WITH """ + EVENTS_SQL + """,
q AS (SELECT quantile_cont(obs, 1/3) AS q1, quantile_cont(obs, 2/3) AS q2 FROM ev)
SELECT event_id, CASE WHEN obs IS NULL THEN NULL WHEN obs <= q1 THEN 'low'
                      WHEN obs <= q2 THEN 'medium' ELSE 'high' END AS demand_class
FROM ev, q""")
def demand_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = events(spark, sf_dir)
    low, high = stats.tercile_boundaries(ev, "obs")
    return ev.select("event_id", S.demand_class(F.col("obs"), low, high).alias("demand_class"))


@query("stop_events", "WITH " + EVENTS_SQL + " SELECT event_id, user_id, obs FROM ev WHERE obs IS NOT NULL")
def stop_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observations(events(spark, sf_dir), "obs").select("event_id", "user_id", "obs")


@query("complete_rows", "WITH " + LAGGED_SQL + """
SELECT event_id, x, pax_stop_lag_1, pax_stop_lag_3, pax_stop_lag_5 FROM lagged
WHERE x IS NOT NULL AND pax_stop_lag_1 IS NOT NULL AND pax_stop_lag_3 IS NOT NULL AND pax_stop_lag_5 IS NOT NULL""")
def complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    lagged = event_lag(fill_sparse_columns(events(spark, sf_dir), EVENTS), EVENTS)
    features = ["pax_stop_lag_1", "pax_stop_lag_3", "pax_stop_lag_5"]
    return complete_rows(lagged, features, "obs").select("event_id", F.col("obs").alias("x"), *features)


@query("daily_index", "WITH " + _DAILY_SQL + """
SELECT strftime(date, '%Y-%m-%d') AS day, round(stringency, 3) AS stringency FROM daily""")
def daily_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = densify(weekly(spark, sf_dir))
    return days.select(F.date_format("date", "yyyy-MM-dd").alias("day"), r("stringency", 3).alias("stringency"))


@query("external_index", "WITH " + _DAILY_SQL + """
SELECT o_orderkey, round(coalesce(stringency, 0.0) / 100.0, 6) AS covid_intensity,
       CAST(coalesce(stringency, 0.0) > 50.0 AS INTEGER) AS covid_flag
FROM orders LEFT JOIN daily ON date = CAST(o_orderdate AS DATE)""")
def external_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    indexed = joins.attach_index(orders(spark, sf_dir), densify(weekly(spark, sf_dir)), "o_orderdate", 50.0)
    return indexed.select("o_orderkey", r("covid_intensity").alias("covid_intensity"), "covid_flag")


@query("asof_weekly", "WITH " + _WEEKLY_SQL + """
SELECT o_orderkey, round(coalesce(stringency, 0.0), 3) AS stringency
FROM orders o ASOF LEFT JOIN weekly w ON CAST(o.o_orderdate AS DATE) >= w.date""")
def asof_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = weekly(spark, sf_dir)
    points = points.unionByName(points.withColumn("stringency", F.col("stringency") - 1))  # repeated dates
    found = joins.index_as_of(orders(spark, sf_dir), points, "o_orderdate")
    return found.select("o_orderkey", r("stringency", 3).alias("stringency"))


@query("attach_vectors", """
SELECT c_custkey, """ + ", ".join(f"round(CAST(embedding[{i + 1}] AS DOUBLE), 6) AS tfm_emb_{i}" for i in range(64)) + """
FROM customer LEFT JOIN embeddings ON c_custkey = vec_id""")
def attach_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").withColumnRenamed("vec_id", "c_custkey")
    customers = table(spark, sf_dir, "customer").select("c_custkey")
    joined = joins.attach_vectors(customers, vectors, "c_custkey")
    return joined.select("c_custkey", *[r(f"tfm_emb_{i}").alias(f"tfm_emb_{i}") for i in range(64)])


@query("vector_coverage", """
SELECT count(*) AS series, count(vec_id) AS with_vector, count(*) - count(vec_id) AS without_vector
FROM (SELECT DISTINCT o_custkey FROM orders) LEFT JOIN embeddings ON o_custkey = vec_id""")
def vector_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").withColumnRenamed("vec_id", "o_custkey")
    rows = orders(spark, sf_dir).select("o_orderkey", "o_custkey")
    joined = joins.attach_vectors(rows, vectors, "o_custkey", spread_by=["o_orderkey"])
    return joins.vector_coverage(joined, "o_custkey")


@query("vector_mean_pool", """
SELECT label, i - 1 AS i, round(avg(CAST(embedding[i] AS DOUBLE)), 5) AS mean
FROM embeddings, (SELECT unnest(range(1, 65)) AS i) GROUP BY 1, 2""")
def vector_mean_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("label", F.col("embedding").cast("array<double>").alias("embedding"))
    pooled = joins.mean_pool(vectors, ["label"])
    return pooled.select("label", F.posexplode("embedding").alias("i", "mean")).withColumn("mean", r("mean", 5))


@query("temporal_split", """
WITH meta AS (SELECT o_custkey, min(o_orderdate) AS start FROM orders GROUP BY 1)
SELECT o_orderkey, CASE WHEN start < TIMESTAMP '1995-09-01' THEN 'train' ELSE 'test' END AS part
FROM orders JOIN meta USING (o_custkey)""")
def temporal_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = orders(spark, sf_dir)
    meta = rows.groupBy("o_custkey").agg(F.min("o_orderdate").alias("start"))
    train, test = sampling.temporal_split(rows.select("o_orderkey", "o_custkey"), meta, "o_custkey", "start", CUTOFF)
    return train.select("o_orderkey", F.lit("train").alias("part")).unionByName(
        test.select("o_orderkey", F.lit("test").alias("part"))
    )


@query("group_split", """
WITH keys AS (SELECT DISTINCT o_custkey AS k FROM orders),
ranked AS (SELECT k, row_number() OVER (ORDER BY md5(k || '|42')) AS rank, count(*) OVER () AS n FROM keys)
SELECT o_orderkey, CASE WHEN rank <= ceil(n / 5) THEN 'test' ELSE 'train' END AS part
FROM orders JOIN ranked ON k = o_custkey""")
def group_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = sampling.group_split(orders(spark, sf_dir).select("o_orderkey", "o_custkey"), "o_custkey")
    return train.select("o_orderkey", F.lit("train").alias("part")).unionByName(
        test.select("o_orderkey", F.lit("test").alias("part"))
    )


@query("union_all", """
SELECT o_orderkey AS id, o_totalprice AS amount FROM orders
UNION ALL SELECT l_orderkey, l_extendedprice FROM lineitem""")
def union_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = orders(spark, sf_dir).select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("amount"))
    second = table(spark, sf_dir, "lineitem").select(
        F.col("l_extendedprice").alias("amount"), F.col("l_orderkey").alias("id")
    )
    return first.unionByName(second)


@query("stratified_sample", """
WITH s AS (
  SELECT c_custkey, c_mktsegment, md5(c_custkey || '|42') AS h,
         row_number() OVER (PARTITION BY c_mktsegment ORDER BY md5(c_custkey || '|42')) AS rank,
         count(*) OVER (PARTITION BY c_mktsegment) AS c, count(*) OVER () AS n
  FROM customer)
SELECT c_custkey, c_mktsegment FROM s
WHERE rank <= greatest(1, round_even(150 * c / n, 0)) ORDER BY h LIMIT 150""")
def stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return sampling.stratified_sample(customers, "c_custkey", "c_mktsegment", 150)


@query("uniform_sample", """
SELECT event_id, value FROM events ORDER BY md5(event_id || '|42') LIMIT 5000""")
def uniform_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.uniform_sample(table(spark, sf_dir, "events").select("event_id", "value"), ["event_id"])


@query("one_hot", """
SELECT event_id, CAST(event_type = 'error' AS INTEGER) AS route_error,
       CAST(event_type = 'purchase' AS INTEGER) AS route_purchase,
       CAST(event_type = 'signup' AS INTEGER) AS route_signup, CAST(event_type = 'view' AS INTEGER) AS route_view
FROM events""")
def one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", "event_type")
    return encode.fit_one_hot(rows, "event_type", "route").apply(rows)


@query("topn_bucket", """
WITH top AS (SELECT p_type FROM part GROUP BY 1 ORDER BY count(*) DESC, p_type LIMIT 3)
SELECT CASE WHEN p_type IN (FROM top) THEN p_type ELSE '__other__' END AS bucket, count(*) AS rows
FROM part GROUP BY 1""")
def topn_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_type")
    return encode.bucket_rare(parts, "p_type", 3).groupBy(F.col("p_type").alias("bucket")).agg(
        F.count(F.lit(1)).alias("rows")
    )


# The summed value of each event type stands for the importance of a feature.
_NAMES = {"click": "hour", "error": "route_83", "purchase": "pax_stop_lag_1", "signup": "speed_kmh", "view": "tfm_emb_0"}


@query("feature_groups", """
SELECT CASE event_type WHEN 'click' THEN 'Temporal' WHEN 'error' THEN 'Categorical' WHEN 'purchase' THEN 'Lag'
                       WHEN 'signup' THEN 'Operational' ELSE 'Unknown' END AS "group",
       round(sum(value), 4) AS importance FROM events GROUP BY 1""")
def feature_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.create_map(*[F.lit(x) for pair in _NAMES.items() for x in pair])
    rows = table(spark, sf_dir, "events")
    importances = rows.groupBy(names[F.col("event_type")].alias("feature")).agg(F.sum("value").alias("importance"))
    return encode.group_importance(importances).withColumn("importance", r("importance", 4))


@query("run_compare", """
WITH a AS (SELECT event_type AS model, round(avg(value), 6) AS f FROM events WHERE hour(ts) < 12 GROUP BY 1),
     b AS (SELECT event_type AS model, round(avg(value), 6) AS f FROM events WHERE hour(ts) >= 12 GROUP BY 1)
SELECT model, a.f AS f1_before, b.f AS f1_after, round(b.f - a.f, 6) AS f1_delta FROM a JOIN b USING (model)""")
def run_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events")

    def result(part: DataFrame) -> DataFrame:
        return part.groupBy(F.col("event_type").alias("model")).agg(r(F.avg("value")).alias("macro_f1"))

    compared = joins.compare_runs(result(rows.filter(F.hour("ts") < 12)), result(rows.filter(F.hour("ts") >= 12)))
    return compared.withColumn("f1_delta", r("f1_delta")).orderBy("model")


# --- scans: the orders of each nation written as one CSV series, then read back -------------

_SERIES = T.StructType(
    [T.StructField("time_unix", T.LongType()), T.StructField("amount", T.DoubleType()),
     T.StructField("status", T.StringType())]
)


def _write_series(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    base = f"{shared_folder(spark)}/series-{uuid.uuid4().hex}"
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    rows = orders(spark, sf_dir).join(customers, "o_custkey").select(
        F.unix_timestamp("o_orderdate").alias("time_unix"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderstatus").alias("status"),
        F.format_string("N%02d", "c_nationkey").alias("mission_name"),
    )
    rows.write.partitionBy("mission_name").option("header", True).csv(f"{base}/series")
    meta = rows.groupBy(F.col("mission_name").alias("name")).agg(
        F.min("time_unix").alias("startTime_unix"), F.max("time_unix").alias("endTime_unix"),
        (F.sum("time_unix") % 100).cast("int").alias("busNumber"),
    )
    meta.coalesce(1).write.option("header", True).csv(f"{base}/meta")
    return f"{base}/series", f"{base}/meta"


_NATION_SERIES = """
s AS (SELECT 'N' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS mission_name,
             CAST(epoch(o_orderdate) AS BIGINT) AS time_unix, o_totalprice AS amount, o_orderstatus AS status
      FROM orders JOIN customer ON c_custkey = o_custkey)"""


@query("scan_missions", "WITH " + _NATION_SERIES + """,
m AS (SELECT mission_name, CAST(sum(time_unix) % 100 AS INTEGER) AS "busNumber" FROM s GROUP BY 1)
SELECT mission_name, time_unix, amount, "busNumber" FROM s JOIN m USING (mission_name)""")
def scan_missions(spark: SparkSession, sf_dir: str) -> DataFrame:
    series, meta = _write_series(spark, sf_dir)
    return read_missions(spark, series, read_metadata(spark, meta), ["time_unix", "amount"], schema=_SERIES)


@query("scan_mission", "WITH " + _NATION_SERIES + """
SELECT time_unix, amount, status FROM s WHERE mission_name = (SELECT min(mission_name) FROM s)""")
def scan_mission(spark: SparkSession, sf_dir: str) -> DataFrame:
    series, meta = _write_series(spark, sf_dir)
    first = read_metadata(spark, meta).agg(F.min("name")).first()[0]
    return read_mission(spark, f"{series}/mission_name={first}", ["time_unix", "amount", "status"], _SERIES)
