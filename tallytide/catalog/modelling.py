"""Feature sets, models, scores and metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallytide.catalog.base import EVENTS, LAGGED_SQL, LINES, events, lines, query, r, table
from tallytide.catalog.ordered import _CONTEXTS_SQL
from tallytide.functions import scalars as S
from tallytide.operators import boosting, encode, models, sampling, stats
from tallytide.operators.evaluate import evaluate
from tallytide.operators.fill import drop_unobserved, fill_sparse_columns
from tallytide.operators.layout import plan_layout
from tallytide.operators.windows import context_windows, event_lag
from tallytide.plans.features import FeatureColumns, feature_names, fit_features, numeric_features, prepare_rows
from tallytide.scale import dimension_join
from tallytide.schema import LABELS, SEED
from tallytide.sources.daily_index import densify

COLUMNS = FeatureColumns(
    time="ts", speed="speed", power="power", route="segment", stop="stop_name",
    dropped=("ts", "is_stop_event", "speed"),
)
WINDOWS = (5, 20)


def demand_by_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filled rows with event lags and terciles: size, means and leak per demand class."""
    ev = events(spark, sf_dir)
    layout = plan_layout(ev, EVENTS)
    filled = drop_unobserved(fill_sparse_columns(ev, EVENTS, layout=layout), "obs")
    lagged = event_lag(filled, EVENTS, layout=layout)
    low, high = stats.tercile_boundaries(ev, "obs")
    labelled = lagged.withColumn("demand_class", S.demand_class(F.col("obs"), low, high))
    known = F.col("pax_stop_lag_1").isNotNull()
    same = F.count_if(known & (F.col("pax_stop_lag_1") == F.col("obs")))
    return labelled.groupBy("demand_class").agg(
        F.count(F.lit(1)).alias("rows"),
        r(F.avg("pax_stop_lag_1")).alias("mean_lag_1"),
        r(F.avg("pax_stop_lag_5")).alias("mean_lag_5"),
        r(same / F.count("pax_stop_lag_1")).alias("share_same"),
    )


query("demand_by_lag", "WITH " + LAGGED_SQL + """,
q AS (SELECT quantile_cont(obs, 1/3) AS q1, quantile_cont(obs, 2/3) AS q2 FROM ev)
SELECT CASE WHEN x <= q1 THEN 'low' WHEN x <= q2 THEN 'medium' ELSE 'high' END AS demand_class, count(*) AS rows,
       round(avg(pax_stop_lag_1), 6) AS mean_lag_1, round(avg(pax_stop_lag_5), 6) AS mean_lag_5,
       round(count(*) FILTER (pax_stop_lag_1 = x) / count(pax_stop_lag_1), 6) AS share_same
FROM lagged, q WHERE x IS NOT NULL GROUP BY 1""")(demand_by_lag)


def _prepared(spark: SparkSession, sf_dir: str, lags: bool = True) -> DataFrame:
    ev = events(spark, sf_dir)
    segments = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("segment")
    )
    with_route = dimension_join(ev, segments, ["user_id"], "left", spread_by=["ts", "event_id"])
    layout = plan_layout(with_route, EVENTS)
    rows = prepare_rows(with_route, EVENTS, COLUMNS, layout)
    week = F.to_date(F.date_trunc("week", F.col("ts"))).alias("date")
    points = ev.groupBy(week).agg(F.round(F.avg("speed"), 3).alias("stringency"))
    features = numeric_features(rows, EVENTS, densify(points), COLUMNS, WINDOWS, (1, 3, 5) if lags else None, layout)
    return features.persist()  # the fits and the result read it several times


_FEATURES_SQL = "WITH " + LAGGED_SQL + """,
kept AS (SELECT * FROM lagged WHERE x IS NOT NULL),
rolled AS (
  SELECT *, speed - lag(speed) OVER o AS acceleration,
         CASE WHEN count(speed) OVER w5 = 5 THEN avg(speed) OVER w5 END AS speed_roll_mean_5,
         CASE WHEN count(power) OVER w20 = 20 THEN stddev_samp(power) OVER w20 END AS power_roll_std_20
  FROM kept
  WINDOW o AS (PARTITION BY user_id ORDER BY ts, event_id),
         w5 AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW),
         w20 AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)
),
q AS (SELECT quantile_cont(x, 1/3) AS q1, quantile_cont(x, 2/3) AS q2 FROM kept),
weekly AS (SELECT date_trunc('week', ts) AS week, round(avg(speed), 3) AS v FROM ev GROUP BY 1)
SELECT event_id, hour(ts) AS hour, isodow(ts) - 1 AS dayofweek,
       round(CASE WHEN CAST(ts AS DATE) <= (SELECT max(week) FROM weekly) THEN v ELSE 0 END / 100, 6) AS covid_intensity,
       round(speed_roll_mean_5, 4) AS speed_roll_mean_5, round(power_roll_std_20, 4) AS power_roll_std_20,
       round(acceleration, 4) AS acceleration, pax_stop_lag_1, pax_stop_lag_3, pax_stop_lag_5,
       CAST(coalesce(c_mktsegment = 'MACHINERY', false) AS INTEGER) AS "route_MACHINERY",
       CAST(stop_name = 'view' AS INTEGER) AS stop_view,
       CASE WHEN x <= q1 THEN 'low' WHEN x <= q2 THEN 'medium' ELSE 'high' END AS demand_class
FROM rolled LEFT JOIN customer ON c_custkey = user_id LEFT JOIN weekly ON week = date_trunc('week', ts), q"""


@query("feature_set", _FEATURES_SQL)
def feature_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _prepared(spark, sf_dir)
    fitted = fit_features(rows, "obs", COLUMNS)
    out = fitted.apply(rows, "obs")
    rounded = {c: r(c, 4) for c in ("speed_roll_mean_5", "power_roll_std_20", "acceleration")}
    return out.withColumns(rounded).select(
        "event_id", "hour", "dayofweek", r("covid_intensity").alias("covid_intensity"), *rounded, "pax_stop_lag_1", "pax_stop_lag_3",
        "pax_stop_lag_5", "route_MACHINERY", "stop_view", "demand_class",
    )


@query("classification_metrics", """
WITH p AS (SELECT CASE WHEN l_quantity <= 17 THEN 'low' WHEN l_quantity <= 34 THEN 'medium' ELSE 'high' END AS t,
                  CASE WHEN l_extendedprice <= 30000 THEN 'low' WHEN l_extendedprice <= 60000 THEN 'medium' ELSE 'high' END AS p
           FROM lineitem),
k AS (SELECT unnest(['low', 'medium', 'high']) AS c),
s AS (SELECT c, count(*) FILTER (t = c AND p = c) AS tp, count(*) FILTER (t = c) AS n, count(*) FILTER (p = c) AS g FROM p, k GROUP BY 1),
m AS (SELECT c, n, CASE WHEN g > 0 THEN tp / g ELSE 0 END AS precision, CASE WHEN n > 0 THEN tp / n ELSE 0 END AS recall,
             CASE WHEN n + g > 0 THEN 2.0 * tp / (n + g) ELSE 0 END AS f1 FROM s)
SELECT c AS label, n AS support, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
       round(avg(f1) OVER (), 6) AS macro_f1, round(sum(recall) OVER () / count(*) FILTER (n > 0) OVER (), 6) AS balanced_accuracy
FROM m""")
def classification_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = lines(spark, sf_dir).select(
        S.demand_class(F.col("l_quantity"), 17.0, 34.0).alias("truth"),
        S.demand_class(F.col("l_extendedprice"), 30000.0, 60000.0).alias("predicted"),
    )
    return _per_class(evaluate(pairs, "truth", "predicted"))


def _per_class(metrics: DataFrame) -> DataFrame:
    each = metrics.select("macro_f1", "balanced_accuracy", F.explode("per_class").alias("label", "m"))
    return each.select(
        "label", F.col("m.support").alias("support"), r("m.precision").alias("precision"), r("m.recall").alias("recall"),
        r("m.f1").alias("f1"), r("macro_f1").alias("macro_f1"), r("balanced_accuracy").alias("balanced_accuracy"),
    )


@query("score_windows", "WITH " + _CONTEXTS_SQL + """,
q AS (SELECT quantile_cont(l_quantity, 1/3) AS q1, quantile_cont(l_quantity, 2/3) AS q2 FROM lineitem),
s AS (SELECT CASE WHEN ix.x <= q1 THEN 'low' WHEN ix.x <= q2 THEN 'medium' ELSE 'high' END AS t,
             CASE WHEN mean <= q1 THEN 'low' WHEN mean <= q2 THEN 'medium' ELSE 'high' END AS p
      FROM ctx JOIN ix ON ix.l_suppkey = ctx.l_suppkey AND pos = target_index, q)
SELECT t AS truth, p AS prediction, count(*) AS rows FROM s GROUP BY 1, 2""")
def score_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lines(spark, sf_dir)
    low, high = stats.tercile_boundaries(rows, "l_quantity")
    contexts = context_windows(rows, LINES, fill_gaps=False)
    scored = models.score_windows(contexts, models.window_mean, low, high)
    truth = S.demand_class(F.col("target"), low, high).alias("truth")
    return scored.select(truth, F.col(models.PREDICTED).alias("prediction")).groupBy("truth", "prediction").agg(
        F.count(F.lit(1)).alias("rows")
    )


@query("pca_project")
def pca_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("embedding")
    )
    train, _ = sampling.group_split(vectors, "vec_id")
    reduced = models.fit_reduction(train, 32).apply(vectors)
    return reduced.select("vec_id", *[r(F.get("embedding", i), 5).alias(f"c{i}") for i in range(32)])


@query("pca_full_rank", """
WITH keys AS (SELECT vec_id, row_number() OVER (ORDER BY md5(vec_id || '|42')) AS rank, count(*) OVER () AS n FROM embeddings),
long AS (SELECT e.vec_id, rank > ceil(n / 5) AS train, i, CAST(embedding[i] AS DOUBLE) AS x
         FROM embeddings e JOIN keys USING (vec_id), (SELECT unnest(range(1, 65)) AS i)),
mean AS (SELECT i, avg(x) AS m FROM long WHERE train GROUP BY 1),
first AS (SELECT i, x - m AS f FROM long JOIN mean USING (i) WHERE vec_id = (SELECT min(vec_id) FROM embeddings))
SELECT vec_id, round(sum((x - m) * (x - m)), 4) AS square, round(sum((x - m) * f), 4) AS with_first
FROM long JOIN mean USING (i) JOIN first USING (i) GROUP BY 1""")
def pca_full_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With all components a reduction is a turn about the training mean: lengths and products stay."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    train, _ = sampling.group_split(vectors, "vec_id")
    reduced = models.fit_reduction(train, 64).apply(vectors)
    first = F.array(*[F.lit(x) for x in reduced.agg(F.min_by("embedding", "vec_id")).first()[0]])  # one vector

    def dot(other: Column) -> Column:
        products = F.zip_with("embedding", other, lambda x, y: x * y)
        return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)

    return reduced.select(
        "vec_id", r(dot(F.col("embedding")), 4).alias("square"), r(dot(first), 4).alias("with_first"))


def _matrices(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, list[str]]:
    """Train and test rows with the names of their features."""
    train, test = sampling.group_split(_prepared(spark, sf_dir), "user_id")
    fitted = fit_features(train, "obs", COLUMNS)
    train, test = fitted.apply(train, "obs"), fitted.apply(test, "obs")
    return train, test, feature_names(train, test, EVENTS)


def _fit_and_score(spark: SparkSession, sf_dir: str, name: str, **sizes: int) -> DataFrame:
    train, test, features = _matrices(spark, sf_dir)
    config = models.model_configs(**sizes)[name]
    model = models.fit_model(train, features, config)
    return _per_class(evaluate(models.predict(model, test, features), models.TARGET, models.PREDICTED))


_SUPPORT_SQL = "WITH " + LAGGED_SQL + """,
full_rows AS (
  SELECT *, lag(speed) OVER o AS before, count(speed) OVER w20 AS ns, count(power) OVER w20 AS np
  FROM lagged WHERE x IS NOT NULL
  WINDOW o AS (PARTITION BY user_id ORDER BY ts, event_id),
         w20 AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)),
keys AS (SELECT user_id, row_number() OVER (ORDER BY md5(user_id || '|42')) AS rank, count(*) OVER () AS n
         FROM (SELECT DISTINCT user_id FROM full_rows)),
q AS (SELECT quantile_cont(x, 1/3) AS q1, quantile_cont(x, 2/3) AS q2 FROM full_rows JOIN keys USING (user_id) WHERE rank > ceil(n / 5)),
k AS (SELECT unnest(['low', 'medium', 'high']) AS label),
test AS (
  SELECT CASE WHEN x <= q1 THEN 'low' WHEN x <= q2 THEN 'medium' ELSE 'high' END AS label
  FROM full_rows JOIN keys USING (user_id), q
  WHERE rank <= ceil(n / 5) AND ns = 20 AND np = 20 AND before IS NOT NULL AND pax_stop_lag_5 IS NOT NULL)
SELECT label, (SELECT count(*) FROM test t WHERE t.label = k.label) AS support FROM k"""


@query("fit_support", _SUPPORT_SQL)
def fit_support(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each class that a model was scored on: split, boundaries of the training part, complete rows."""
    return _fit_and_score(spark, sf_dir, "decision_tree").select("label", "support")


@query("fit_tree")
def fit_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fit_and_score(spark, sf_dir, "decision_tree")


@query("fit_forest")
def fit_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fit_and_score(spark, sf_dir, "random_forest", trees=20, max_depth=10)


@query("fit_boosted")
def fit_boosted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three-class softmax boosting at full size: 500 rounds of depth-6 trees, step 0.05, rows and features 0.8."""
    train, test, features = _matrices(spark, sf_dir)
    model = boosting.fit(train, features, models.TARGET, sorted(LABELS), rounds=500, depth=6, step=0.05,
                         row_rate=0.8, col_rate=0.8, seed=SEED)
    scored = model.predict(models.select_matrix(test, features), models.TARGET, models.PREDICTED)
    return _per_class(evaluate(scored, models.TARGET, models.PREDICTED))


@query("feature_importance")
def feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _, features = _matrices(spark, sf_dir)
    model = models.fit_model(train, features, models.model_configs()["decision_tree"])
    ranked = encode.feature_groups(models.importances(model, features))
    return ranked.withColumn("importance", r("importance")).orderBy(F.desc("importance"), "feature").limit(20)
