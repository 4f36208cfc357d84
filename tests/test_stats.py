from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallytide.operators import encode, evaluate, joins, quantiles, sampling, stats
from tallytide.scale import dimension_join
from tallytide.sources import daily_index


@pytest.fixture(scope="module")
def values(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"g": rng.choice(["a", "b", "c"], 3000, p=[0.8, 0.19, 0.01]), "x": rng.normal(size=3000).round(2)})
    pdf.loc[::50, "x"] = np.nan
    return pdf, spark.createDataFrame(pdf).withColumn("x", F.nanvl("x", F.lit(None).cast("double"))).repartition(5)


@pytest.mark.parametrize("limit", [None, 200])
def test_quantiles_are_exact(values, small_tasks, limit):
    pdf, df = values
    if limit:
        small_tasks(limit)
    probs = [0.0, 1 / 3, 0.5, 2 / 3, 0.99, 1.0]
    assert quantiles.quantile_values(df, "x", probs) == pytest.approx(pdf["x"].quantile(probs).tolist())
    got = {r["g"]: r["q"] for r in quantiles.exact_quantiles(df, "x", probs, ["g"]).collect()}
    for g, part in pdf.groupby("g"):
        assert got[g] == pytest.approx(part["x"].quantile(probs).tolist())


def test_one_frequent_value(spark, small_tasks):
    small_tasks(50)
    df = spark.range(1000).select(F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.col("id").cast("double")).alias("x"))
    want = df.toPandas()["x"].quantile([0.1, 0.5, 0.9]).tolist()
    assert quantiles.quantile_values(df, "x", [0.1, 0.5, 0.9]) == pytest.approx(want)


def test_empty_quantiles(spark):
    assert quantiles.quantile_values(spark.createDataFrame([(None,)], "x double"), "x", [0.5]) == []


def test_smallest_hash(spark):
    keys = spark.range(500).select(F.md5(F.col("id").cast("string")).alias("d"))
    ordered = sorted(r[0] for r in keys.collect())
    for k in (1, 17, 499, 500):
        assert quantiles.smallest_hash(keys, "d", k) == ordered[k - 1]
        assert quantiles.smallest_hash(keys, "d", k, small=0) == ordered[k - 1]
    repeated = keys.union(keys.limit(1)).union(keys.limit(1))
    assert quantiles.smallest_hash(repeated, "d", 502, small=1) == ordered[-1]


@pytest.mark.parametrize("split", [False, True])
def test_dimension_join_with_a_hot_key(spark, small_tasks, split):
    fact = spark.range(300).select("id", F.when(F.col("id") < 250, 1).otherwise(F.col("id")).alias("k"))
    dim = spark.createDataFrame([(1, "hot"), (260, "cold"), (999, "unused")], "k long, v string")
    if split:
        small_tasks(20, 1)
    out = dimension_join(fact, dim, ["k"], "left", spread_by=["id"])
    assert out.count() == 300
    assert {r["v"]: r["count"] for r in out.groupBy("v").count().collect()} == {"hot": 250, "cold": 1, None: 49}
    assert dimension_join(fact, dim, ["k"], "left_semi", ["id"]).count() == 251
    assert dimension_join(fact, dim, ["k"], "left_anti", ["id"]).count() == 49


def test_missing_stats(spark):
    rows = [(None if 3 <= i <= 7 else 1.0, "-" if i < 5 else "83", float("nan") if i == 0 else 2.0) for i in range(20)]
    out = {r["column"]: r for r in stats.missing_stats(spark.createDataFrame(rows, "lat double, route string, p double")).collect()}
    assert (out["lat"]["nan_count"], out["lat"]["nan_pct"], out["lat"]["dash_count"]) == (5, 25.0, 0)
    assert (out["route"]["dash_count"], out["route"]["dash_pct"], out["route"]["nan_count"]) == (5, 25.0, 0)
    assert out["p"]["nan_count"] == 1
    empty = stats.missing_stats(spark.createDataFrame([], "lat double")).first()
    assert (empty["nan_count"], empty["nan_pct"]) == (0, 0.0)


def test_class_distribution_has_zeros(spark):
    df = spark.createDataFrame([("low",)] * 10 + [("medium",)] * 10 + [(None,)], "label string")
    assert {r["label"]: r["rows"] for r in stats.class_distribution(df, "label").collect()} == {"low": 10, "medium": 10, "high": 0}


def test_correlations_match_pandas(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame(rng.normal(size=(60, 3)), columns=["a", "b", "c"])
    pdf.loc[3:9, "b"] = np.nan
    df = spark.createDataFrame(pdf).replace(float("nan"), None)
    got = {(r["a"], r["b"]): r["r"] for r in stats.correlation_matrix(df, ["a", "b", "c"]).collect()}
    want = pdf.corr()
    for (a, b), r in got.items():
        assert r == pytest.approx(want.loc[a, b])
    best = stats.correlation_rank(df, ["a", "b", "c"], "a", 1).first()
    assert best["feature"] == want["a"].drop("a").abs().idxmax()


def test_skew_matches_pandas(values):
    pdf, df = values
    assert df.agg(stats.skewness("x")).first()[0] == pytest.approx(pdf["x"].skew())


def test_quantile_bins_match_qcut(spark):
    pdf = pd.DataFrame({"b": [0.0] * 40 + list(np.linspace(0, 1, 60)), "y": np.arange(100.0)})
    want = pdf.groupby(pd.qcut(pdf["b"], 10, duplicates="drop", labels=False))["y"].mean()
    got = {r["bin"]: r["mean"] for r in stats.quantile_bins(spark.createDataFrame(pdf), "b", "y").collect()}
    assert got == pytest.approx(want.to_dict())


def test_histogram_matches_numpy(values):
    pdf, df = values
    want, edges = np.histogram(pdf["x"].dropna(), bins=50)
    rows = stats.histogram(df, "x").orderBy("bin").collect()
    assert sum(r["rows"] for r in rows) == want.sum()
    assert abs(np.array([r["rows"] for r in rows]) - want).max() <= 2  # values on an edge
    assert rows[0]["bin_low"] == pytest.approx(edges[0]) and rows[-1]["bin_high"] == pytest.approx(edges[-1])
    area = stats.density_histogram(df, "x", "g", 10).groupBy("g").agg(F.sum("density").alias("d"))
    widths = pdf.groupby("g")["x"].agg(lambda x: (x.max() - x.min()) / 10)
    for r in area.collect():
        assert r["d"] * widths[r["g"]] == pytest.approx(1.0)


def test_mean_of_means_is_not_pooled(spark):
    rows = [("A", "2020-01-01 08:10:00", 0.0)] * 3 + [("B", "2020-01-01 08:50:00", 12.0), ("B", "2020-01-01 09:00:00", None)]
    df = spark.createDataFrame(rows, "k string, t string, x double").withColumn("t", F.to_timestamp("t"))
    out = stats.mean_of_means(df, ["k"], F.date_trunc("hour", "t"), "x").collect()
    assert [r["mean_pax"] for r in out] == [6.0]


def test_flag_means_and_peak(spark):
    df = spark.createDataFrame([(1, 2.0, 8), (0, 4.0, 9), (0, 6.0, 10)], "door int, v double, hour int")
    row = stats.mean_by_flag(df, "door", ["v"]).first()
    assert (row["v_on"], row["v_off"], row["rows_on"]) == (2.0, 5.0, 1)
    assert row["pct_on"] == pytest.approx(100 / 3)
    tied = spark.createDataFrame([(8, 3.0), (7, 3.0), (9, 1.0)], "hour int, m double").withColumn("g", F.lit(1))
    assert stats.peak(tied, ["g"], "hour", "m").first()["peak_hour"] == 7


# --- sampling and splits ------------------------------------------------------------------


def _meta(spark):
    return spark.createDataFrame([(f"m{i}", r) for i, r in enumerate(["83", "31", "33", "83", "83"])], "name string, busRoute string")


def test_stratified_sample(spark):
    meta = _meta(spark)
    assert sampling.stratified_sample(meta, "name", "busRoute", 3).count() == 3
    assert sampling.stratified_sample(meta, "name", "busRoute", 99).count() == 5
    once = sorted(r[0] for r in sampling.stratified_sample(meta, "name", "busRoute", 3).collect())
    again = sorted(r[0] for r in sampling.stratified_sample(meta.repartition(3), "name", "busRoute", 3).collect())
    assert once == again


def test_first_per_group_matches_a_plain_rank(spark):
    df = spark.range(2000).select("id", F.when(F.col("id") % 10 < 7, 1).otherwise(F.col("id") % 10).alias("g"))
    hashed = df.withColumn("_hash", sampling.seeded_hash("id"))
    quotas = spark.createDataFrame([(1, 10), (7, 200), (8, 300), (9, 1)], "g long, _quota int")
    got = sampling.first_per_group(hashed, "g", quotas, "id")
    ranked = hashed.toPandas().sort_values("_hash")
    want = {i for g, q in ((1, 10), (7, 200), (8, 300), (9, 1)) for i in ranked[ranked["g"] == g].head(q)["id"]}
    assert {r["id"] for r in got.collect()} == want


def test_uniform_sample_on_a_large_table(spark, small_tasks):
    df = spark.range(1000)
    whole = sorted(r[0] for r in sampling.uniform_sample(df, ["id"], 100).collect())
    small_tasks(50)
    assert sorted(r[0] for r in sampling.uniform_sample(df, ["id"], 100).collect()) == whole
    assert sampling.uniform_sample(df, ["id"], 5000).count() == 1000


def test_group_split(spark):
    df = spark.createDataFrame([(g, i) for g in "abcd" for i in range(50)], "g string, i int")
    train, test = sampling.group_split(df, "g", 0.2)
    train_groups, test_groups = ({r[0] for r in part.select("g").distinct().collect()} for part in (train, test))
    assert not train_groups & test_groups
    assert len(test_groups) == 1 and train.count() + test.count() == 200
    assert "Exchange" not in train._jdf.queryExecution().executedPlan().toString()
    bigger = spark.range(100).withColumnRenamed("id", "g")
    assert sampling.group_split(bigger, "g", 0.2)[1].count() == 20


def test_temporal_split(spark):
    meta = spark.createDataFrame([("a", "2021-12-31T23:59:59Z"), ("b", "2022-01-01T00:00:00Z")], "name string, s string")
    meta = meta.withColumn("s", F.to_timestamp("s"))
    df = spark.createDataFrame([("a", 1), ("b", 2), ("zz", 3)], "mission string, i int")
    train, test = sampling.temporal_split(df, meta, "mission", "s", meta_key="name")
    assert [r["i"] for r in train.collect()] == [1] and [r["i"] for r in test.collect()] == [2]


# --- encodings ----------------------------------------------------------------------------


def test_one_hot_drops_the_first(spark):
    df = spark.createDataFrame([("83", 1), ("33", 2)] * 10, "route string, i int")
    encoder = encode.fit_one_hot(df, "route", "route")
    out = encoder.apply(df)
    assert out.columns == ["i", "route_83"]
    assert {(r["i"], r["route_83"]) for r in out.collect()} == {(1, 1), (2, 0)}
    unseen = encoder.apply(spark.createDataFrame([("99", 1), (None, 2)], "route string, i int"))
    assert [r["route_83"] for r in unseen.collect()] == [0, 0]


def test_top_n(spark):
    df = spark.createDataFrame([("A",)] * 5 + [("B",)] * 3 + [("C",)] * 3, "stop string")
    assert encode.fit_top_n(df, "stop", "stop", 1).dummies == ["stop___other__"]
    two = encode.fit_top_n(df, "stop", "stop", 2)
    assert two.kept == ("A", "B") and two.dummies == ["stop_B", "stop___other__"]
    row = two.apply(spark.createDataFrame([("C",)], "stop string")).first()
    assert row["stop___other__"] == 1
    assert encode.fit_top_n(df, "stop", "stop", 20).dummies == ["stop_B", "stop_C"]
    lower = encode.fit_top_n(spark.createDataFrame([("a",), ("a",), ("Z",), ("-",)], "s string"), "s", "s", 1)
    assert lower.categories == ("__other__", "a")


def test_feature_groups(spark):
    df = spark.createDataFrame([("hour", 0.2), ("route_83", 0.3), ("stop_X", 0.1), ("tfm_emb_0", 0.4)], "feature string, importance double")
    got = {r["group"]: r["importance"] for r in encode.group_importance(df).collect()}
    assert got == pytest.approx({"Temporal": 0.2, "Categorical": 0.4, "Unknown": 0.4})


# --- metrics ------------------------------------------------------------------------------


def test_metrics(spark):
    pairs = list(zip(["low", "medium", "high", "low", "medium", "high"], ["low", "medium", "high", "low", "low", "high"]))
    row = evaluate.evaluate(spark.createDataFrame([*pairs, (None, "low")], "t string, p string"), "t", "p").first()
    assert row["balanced_accuracy"] == pytest.approx((1 + 0.5 + 1) / 3)
    assert row["confusion_matrix"] == [[2, 0, 0], [1, 1, 0], [0, 0, 2]]
    assert row["macro_f1"] == pytest.approx((0.8 + 2 / 3 + 1) / 3)
    assert row["per_class"]["medium"]["recall"] == 0.5


def test_metrics_with_an_absent_class(spark):
    row = evaluate.evaluate(spark.createDataFrame([("low", "low"), ("medium", "low")], "t string, p string"), "t", "p").first()
    assert row["per_class"]["high"]["support"] == 0 and row["per_class"]["high"]["f1"] == 0
    assert row["macro_f1"] == pytest.approx((2 / 3) / 3)
    assert row["balanced_accuracy"] == pytest.approx(0.5)


# --- vectors and index --------------------------------------------------------------------


def test_vectors(spark):
    vectors = spark.createDataFrame([("A", [1.0] * 32), ("B", [2.0] * 32)], "m string, embedding array<double>")
    df = spark.createDataFrame([("A", 1), ("A", 2), ("B", 3), ("C", 4)], "m string, i int")
    out = joins.attach_vectors(df, vectors, "m")
    rows = {r["i"]: r for r in out.collect()}
    assert len(out.columns) == 34 and len(rows) == 4
    assert rows[1]["tfm_emb_31"] == 1 and rows[3]["tfm_emb_0"] == 2 and rows[4]["tfm_emb_0"] is None
    row = joins.vector_coverage(out, "m").first()
    assert (row["series"], row["with_vector"], row["without_vector"]) == (3, 2, 1)
    pooled = joins.mean_pool(spark.createDataFrame([("A", [1.0, 3.0]), ("A", [3.0, 5.0])], "m string, embedding array<double>"), ["m"])
    assert pooled.first()["embedding"] == [2.0, 4.0]


def test_index_dates(spark):
    texts = ["2018-01-01", "2019-06-15", "2020-03-20", "2020-11-16", "2022-06-10", "2023-06-01"]
    naive = spark.createDataFrame([(t, t) for t in texts], "d string, t string").withColumn("time_iso", F.to_timestamp("t"))
    zoned = naive.withColumn("time_iso", F.to_timestamp(F.concat("t", F.lit("T12:00:00Z"))))
    index = daily_index.load_daily_index(spark)
    for df in (naive, zoned):
        got = {r["d"]: (r["covid_intensity"], r["covid_flag"]) for r in joins.attach_index(df, index).collect()}
        assert got["2018-01-01"] == (0, 0) and got["2019-06-15"] == (0, 0) and got["2023-06-01"] == (0, 0)
        assert got["2020-03-20"][1] == 1 and got["2020-11-16"] == (pytest.approx(0.7222), 1)
        assert got["2022-06-10"] == (0, 0)
    strict = joins.attach_index(naive.filter("d = '2020-11-16'"), index, flag_above=80.0)
    assert strict.first()["covid_flag"] == 0


def test_fallback_covers_all_days(spark):
    rows = daily_index.fallback_index(spark).orderBy("date").collect()
    assert len(rows) == 1461 and str(rows[0]["date"]) == "2019-01-01" and str(rows[-1]["date"]) == "2022-12-31"
    by_day = {str(r["date"]): r["stringency"] for r in rows}
    assert by_day["2020-03-01"] == 0 and by_day["2020-03-02"] == 5.56 and by_day["2021-01-11"] == 79.63
    assert by_day["2022-04-03"] == 2.78 and by_day["2022-04-04"] == 0


def test_densify_and_as_of_agree(spark):
    points = spark.createDataFrame([("2020-01-03", 5.0), ("2020-01-10", 7.0)], "date string, stringency double").withColumn("date", F.to_date("date"))
    days = spark.createDataFrame([(f"2020-01-{i:02d}",) for i in range(1, 15)], "t string").withColumn("t", F.to_timestamp("t"))
    as_of = [r["stringency"] for r in joins.index_as_of(days, points, "t").orderBy("t").collect()]
    assert as_of == [0, 0] + [5] * 7 + [7] * 5
    start, end = (pd.Timestamp(f"2020-01-{d}").date() for d in ("01", "14"))
    dense = daily_index.densify(points, start, end)
    assert [r["stringency"] for r in dense.orderBy("date").collect()] == as_of
    filled = daily_index.densify(points, start, end, back_fill=True).orderBy("date").first()
    assert filled["stringency"] == 5


def test_run_compare(spark):
    old = spark.createDataFrame([("rf", 0.6), ("dt", 0.5)], "model string, macro_f1 double")
    new = spark.createDataFrame([("rf", 0.8), ("xgb", 0.7)], "model string, macro_f1 double")
    rows = joins.compare_runs(old, new).collect()
    assert len(rows) == 1 and math.isclose(rows[0]["f1_delta"], 0.2)
