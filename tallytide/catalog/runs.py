"""Sources, results of runs and model inputs."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallytide.catalog.base import EVENTS, EVENTS_SQL, events, lines, query, r, table
from tallytide.catalog.rows import _DAILY_SQL, _WEEKLY_SQL, weekly
from tallytide.functions import scalars as S
from tallytide.operators import joins, models
from tallytide.operators.evaluate import confusion, evaluate
from tallytide.plans.features import FeatureColumns, FittedFeatures
from tallytide.plans.hourly import first_hours, hourly_series
from tallytide.scale import shared_folder
from tallytide.sources.daily_index import densify, read_daily_index
from tallytide.sources.registry import Registry, append_rows, write_table


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query("zone_fix", """
SELECT event_id, CAST(epoch(date_trunc('second', ts)) AS BIGINT) - CASE WHEN event_id % 2 = 0 THEN 7200 ELSE 0 END AS utc_s FROM events""")
def zone_fix(spark: SparkSession, sf_dir: str) -> DataFrame:
    zone = F.when(F.col("event_id") % 2 == 0, "+02:00").otherwise("")
    text = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), zone)
    return table(spark, sf_dir, "events").select("event_id", F.unix_timestamp(S.as_utc(text)).alias("utc_s"))


@query("missing_class", "WITH " + EVENTS_SQL + """,
c AS (SELECT CASE WHEN obs <= 20 THEN 'low' WHEN obs <= 60 THEN 'medium' WHEN obs IS NOT NULL THEN 'high' END AS c FROM ev)
SELECT coalesce(c, 'low') AS missing_low, coalesce(c, 'high') AS missing_high, count(*) AS rows FROM c GROUP BY 1, 2""")
def missing_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A missing forecast counts as low for windows and as high for hours."""
    value = F.col("obs")
    return events(spark, sf_dir).groupBy(
        S.demand_class(value, 20.0, 60.0, on_missing="low").alias("missing_low"),
        S.demand_class(value, 20.0, 60.0, on_missing="high").alias("missing_high"),
    ).agg(F.count(F.lit(1)).alias("rows"))


@query("known_pairs", "WITH " + EVENTS_SQL + """
SELECT CASE WHEN obs <= 20 THEN 'low' WHEN obs <= 60 THEN 'medium' ELSE 'high' END AS truth,
       CASE WHEN power <= 20 THEN 'low' WHEN power <= 60 THEN 'medium' WHEN power IS NOT NULL THEN 'high' END AS prediction, count(*) AS rows
FROM ev WHERE obs IS NOT NULL GROUP BY 1, 2""")
def known_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = events(spark, sf_dir).select(
        S.demand_class(F.col("obs"), 20.0, 60.0).alias("t"), S.demand_class(F.col("power"), 20.0, 60.0).alias("p"))
    return confusion(pairs, "t", "p")


@query("model_matrix", """
SELECT CASE WHEN l_quantity <= 17 THEN 'low' WHEN l_quantity <= 34 THEN 'medium' ELSE 'high' END AS demand_class,
       CAST(l_extendedprice AS DOUBLE) AS l_extendedprice, CAST(l_discount AS DOUBLE) AS l_discount,
       CASE WHEN l_quantity <= 17 THEN 1.0::DOUBLE WHEN l_quantity <= 34 THEN 2.0::DOUBLE ELSE 0.0::DOUBLE END AS label,
       CASE WHEN l_quantity <= 17 THEN 'low' WHEN l_quantity <= 34 THEN 'medium' ELSE 'high' END AS decoded
FROM lineitem WHERE l_extendedprice IS NOT NULL AND l_discount IS NOT NULL""")
def model_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw columns dropped, features next to the target, labels encoded and decoded again."""
    fitted = FittedFeatures(FeatureColumns(dropped=("l_tax",)), (), 17.0, 34.0)
    rows = fitted.apply(lines(spark, sf_dir).select("l_quantity", "l_extendedprice", "l_discount", "l_tax"), "l_quantity")
    features = [c for c in rows.columns if c not in ("l_quantity", "demand_class")]
    indexer, _, _, back = models.build_stages(features, models.model_configs()["decision_tree"]).getStages()
    encoded = indexer.transform(models.select_matrix(rows, features))
    decoded = back.transform(encoded.withColumn("prediction", F.col(indexer.getOutputCol())))
    return decoded.select(
        "demand_class", *features, F.col("prediction").alias("label"), F.col(back.getOutputCol()).alias("decoded"))


@query("shared_columns", """
SELECT user_id, value FROM events WHERE hour(ts) < 12 UNION ALL SELECT user_id, value FROM events WHERE hour(ts) >= 12""")
def shared_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events")
    train = rows.filter(F.hour("ts") < 12).select("value", "user_id", "event_id", "props")
    test = rows.filter(F.hour("ts") >= 12).select("event_id", "event_type", "user_id", "value")
    both = joins.shared_features(train, test, ["event_id"])
    return train.select(*both).unionByName(test.select(*both))


@query("first_hours", "WITH " + EVENTS_SQL + """,
m AS (SELECT user_id, date_trunc('hour', ts) AS hour, avg(obs) AS m FROM ev WHERE obs IS NOT NULL GROUP BY 1, 2)
SELECT strftime(hour, '%Y-%m-%d %H') AS hour, round(avg(m), 6) AS mean_pax FROM m GROUP BY 1 ORDER BY 1 LIMIT 200""")
def hours_at_the_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = first_hours(hourly_series(events(spark, sf_dir), EVENTS, "ts"))
    return hours.select(F.date_format("hour", "yyyy-MM-dd HH").alias("hour"), r("mean_pax").alias("mean_pax"))


@query("index_from_csv", "WITH " + _DAILY_SQL + " SELECT date, stringency FROM daily")
def index_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weekly means written as a file of daily values of two countries, then read for one."""
    path = _folder(spark, "index")
    points = weekly(spark, sf_dir).withColumn("country", F.explode(F.array(F.lit("CHE"), F.lit("XXX"))))
    value = F.when(F.col("country") == "CHE", F.col("stringency")).otherwise(-1.0)
    points.select(
        F.col("country").alias("CountryCode"), F.date_format("date", "yyyyMMdd").alias("Date"),
        value.alias("StringencyIndex_Average"),
    ).write.option("header", True).csv(path)
    return read_daily_index(spark, path, "CHE")


@query("index_back_fill", "WITH " + _WEEKLY_SQL + """,
days AS (SELECT CAST(unnest(generate_series(TIMESTAMP '1991-12-01', TIMESTAMP '1999-01-31', INTERVAL 1 DAY)) AS DATE) AS date),
filled AS (
  SELECT d.date, last_value(stringency IGNORE NULLS) OVER (ORDER BY d.date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS before,
         first_value(stringency IGNORE NULLS) OVER (ORDER BY d.date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS after
  FROM days d LEFT JOIN weekly w USING (date))
SELECT date, coalesce(before, after, 0.0) AS stringency FROM filled""")
def index_back_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return densify(weekly(spark, sf_dir), date(1991, 12, 1), date(1999, 1, 31), back_fill=True)


# --- runs ----------------------------------------------------------------------------------

_HALVES = ("before noon", "after noon")
_HALF_SQL = """
h AS (SELECT CASE WHEN hour(ts) < 12 THEN 'before noon' ELSE 'after noon' END AS framework, event_type AS model, value FROM events)"""


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    half = F.when(F.hour("ts") < 12, _HALVES[0]).otherwise(_HALVES[1])
    return table(spark, sf_dir, "events").groupBy(half.alias("framework"), F.col("event_type").alias("model")).agg(
        r(F.avg("value")).alias("macro_f1"), r(F.max("value")).alias("balanced_accuracy"))


@query("run_registry", "WITH " + _HALF_SQL + """,
s AS (SELECT framework, model, round(avg(value), 6) AS macro_f1, round(max(value), 6) AS balanced_accuracy FROM h GROUP BY 1, 2)
SELECT row_number() OVER (ORDER BY framework, macro_f1 DESC, model) AS place, * FROM s""")
def run_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recorded twice, of which the later counts, then compared in order."""
    registry, scores = Registry(spark, _folder(spark, "runs")), _scores(spark, sf_dir)
    registry.record("one", scores.withColumn("macro_f1", F.lit(0.0)))
    registry.record("other", scores.withColumn("macro_f1", F.lit(1.0)))
    registry.record("one", scores)
    rows = registry.comparison("one").withColumn("at", F.monotonically_increasing_id())  # the order it comes in
    place = F.row_number().over(Window.orderBy("at")).cast("long").alias("place")  # a row for each model
    return rows.select(place, "framework", "model", "macro_f1", "balanced_accuracy")


@query("run_pending", """
SELECT event_type AS model FROM events GROUP BY 1 HAVING avg(value) <= (SELECT avg(value) FROM events)""")
def run_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The models without a result: those above the mean have one."""
    registry, rows = Registry(spark, _folder(spark, "runs")), table(spark, sf_dir, "events")
    by_model = rows.groupBy(F.col("event_type").alias("model")).agg(F.avg("value").alias("macro_f1"))
    mean = rows.agg(F.avg("value")).first()[0]
    registry.record("one", by_model.filter(F.col("macro_f1") > F.lit(mean)).withColumn("framework", F.lit("all")))
    wanted = [x["model"] for x in by_model.select("model").orderBy("model").collect()]  # event types
    return spark.createDataFrame([(m,) for m in registry.pending("one", "all", wanted)], "model string")


@query("result_table", "WITH " + _HALF_SQL + """
SELECT framework, model, CAST(round(avg(value), 6) AS DOUBLE) AS macro_f1, CAST(round(max(value), 6) AS DOUBLE) AS balanced_accuracy
FROM h GROUP BY 1, 2""")
def result_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One half written in order, the other appended with its columns in another order."""
    path, scores = _folder(spark, "table"), _scores(spark, sf_dir)
    write_table(scores.filter(F.col("framework") == _HALVES[0]), path, [F.desc("macro_f1"), "model"])
    append_rows(scores.filter(F.col("framework") == _HALVES[1]).select(*reversed(scores.columns)), path)
    kinds = "framework string, model string, macro_f1 double, balanced_accuracy double"
    return spark.read.option("header", True).schema(kinds).csv(path)


@query("run_metrics", """
WITH p AS (SELECT CASE WHEN l_quantity <= 17 THEN 'low' WHEN l_quantity <= 34 THEN 'medium' ELSE 'high' END AS t,
                  CASE WHEN l_extendedprice <= 30000 THEN 'low' WHEN l_extendedprice <= 60000 THEN 'medium' ELSE 'high' END AS p
           FROM lineitem),
k AS (SELECT unnest(['low', 'medium', 'high']) AS c)
SELECT c AS label, count(*) FILTER (t = c) AS support,
       round(2 * count(*) FILTER (t = c AND p = c) / (count(*) FILTER (t = c) + count(*) FILTER (p = c)), 6) AS f1
FROM p, k GROUP BY 1""")
def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of a run, with nested columns, through the registry."""
    pairs = lines(spark, sf_dir).select(
        S.demand_class(F.col("l_quantity"), 17.0, 34.0).alias("t"), S.demand_class(F.col("l_extendedprice"), 30000.0, 60000.0).alias("p"))
    registry = Registry(spark, _folder(spark, "runs"))
    registry.record("one", evaluate(pairs, "t", "p").withColumns({"framework": F.lit("all"), "model": F.lit("price")}))
    each = registry.results("one").select(F.explode("per_class").alias("label", "m"))
    return each.select("label", F.col("m.support").alias("support"), r("m.f1").alias("f1"))
