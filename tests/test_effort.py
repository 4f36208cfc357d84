"""Work that must not grow with the models tried or with the passes over a table."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallytide import SeriesSpec
from tallytide.operators import diagnostics as D
from tallytide.operators import forecast as A
from tallytide.operators import models as M


def _gram(w, depth, level=None):
    """Cross products of 1, [level,] w(t), w(t-1), ..., w(t-depth)."""
    t = np.arange(depth, len(w))
    columns = [np.ones(len(t))] + ([level[t]] if level is not None else []) + [w[t - i] for i in range(depth + 1)]
    z = np.column_stack(columns)
    return z.T @ z, len(t)


def _counted(monkeypatch, module):
    calls = []
    solve = D.least_squares
    monkeypatch.setattr(module, "least_squares", lambda *a: calls.append(1) or solve(*a))
    return calls


SERIES = {
    "noise": lambda rng: rng.normal(size=700) * 9 + 25,
    "ar": lambda rng: np.convolve(rng.normal(size=700), 0.8 ** np.arange(40))[:700],
    "offset": lambda rng: np.cumsum(rng.normal(size=700)) + 1e4,
}


@pytest.mark.parametrize("kind", SERIES)
def test_order_search_solves_only_the_best(monkeypatch, kind):
    gram, used = _gram(np.diff(SERIES[kind](np.random.default_rng(3))), 30)
    with monkeypatch.context() as m:
        m.setattr(A, "nested_residuals", lambda *a: None)  # every regression on its own
        full = A._search(gram, used, 20, 5, 1)
    calls = _counted(monkeypatch, A)
    found = A._search(gram, used, 20, 5, 1)
    assert (found["p"], found["q"], found["aic"]) == (full["p"], full["q"], full["aic"])
    assert found["phi"].tolist() == full["phi"].tolist() and found["theta"].tolist() == full["theta"].tolist()
    assert len(calls) < 10


@pytest.mark.parametrize("kind", SERIES)
def test_unit_root_lag_solves_only_the_best(monkeypatch, kind):
    y = SERIES[kind](np.random.default_rng(4))
    gram, used = _gram(np.diff(y), 20, y)
    with monkeypatch.context() as m:
        m.setattr(D, "nested_residuals", lambda *a: None)
        full = D._fit_adf(gram, used, 20, y[:21])
    calls = _counted(monkeypatch, D)
    assert D._fit_adf(gram, used, 20, y[:21]) == full
    assert len(calls) < 10


def test_dependent_columns_are_left_to_the_pseudo_inverse():
    x = np.random.default_rng(5).normal(size=(50, 2))
    z = np.column_stack([x, x[:, 0] + x[:, 1], x[:, 0]])
    gram = z.T @ z
    assert D.nested_residuals(gram, 3, [0, 1, 2]) is None
    assert D.nested_residuals(np.zeros((3, 3)), 2, [0, 1]) is None
    y = np.column_stack([x, x[:, 0] + np.arange(50)])
    gram = y.T @ y
    assert D.nested_residuals(gram, 2, [0, 1])[1:] == pytest.approx(
        [D.least_squares(gram, 2, [0])[1], D.least_squares(gram, 2, [0, 1])[1]])


def test_retest_reads_the_verdicts_once(spark):
    spec = SeriesSpec("k", "t", "y")
    rng = np.random.default_rng(42)
    pdf = pd.concat([pd.DataFrame({"k": k, "t": range(80), "y": np.cumsum(rng.normal(size=80))}) for k in "abc"])
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def verdict(_):
        read.add(1)
        return D.NON_STATIONARY

    results = spark.createDataFrame([(k,) for k in "abc"], "k string").withColumn("verdict", verdict.asNondeterministic()("k"))
    assert D.retest_differences(spark.createDataFrame(pdf), spec, results).count() == 3
    assert read.value == 3


def test_a_tree_is_fitted_on_few_partitions(spark, monkeypatch):
    seen = []

    class Stages:
        def fit(self, df):
            seen.append((df.rdd.getNumPartitions(), sorted(map(tuple, df.collect()))))

    monkeypatch.setattr(M, "build_stages", lambda *a: Stages())
    rows = [("low", 1.0), ("high", 2.0), ("medium", None), ("other", 3.0)] * 25
    train = spark.createDataFrame(rows, "demand_class string, x double").repartition(40)
    want = sorted([("low", 1.0), ("high", 2.0)] * 25)
    M.fit_model(train, ["x"], M.model_configs()["decision_tree"])
    M.fit_model(train, ["x"], M.model_configs()["random_forest"])
    monkeypatch.setattr(M, "ROWS_PER_TASK", 20)
    M.fit_model(train, ["x"], M.model_configs()["decision_tree"])
    assert seen == [(1, want), (40, want), (3, want)]


def test_retest_query_makes_the_sums_once(spark, monkeypatch):
    from tallytide.catalog import ordered

    rng = np.random.default_rng(8)
    rows = [(int(10 * s + i % 7), i, s, i % 4, float(rng.integers(1, 51)), 1.0, 0.0, 0.0, "A", "F", i // 3)
            for s in range(3) for i in range(60)]
    read = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(x):
        read.add(1)
        return x

    table = spark.createDataFrame(
        rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
              "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate long")
    want = [tuple(r) for r in ordered.retest_differences(_lines(monkeypatch, ordered, table), "").orderBy("l_suppkey").collect()]
    _lines(monkeypatch, ordered, table.withColumn("l_quantity", counted.asNondeterministic()("l_quantity")))
    got = [tuple(r) for r in ordered.retest_differences(spark, "").orderBy("l_suppkey").collect()]
    assert got == want and len(got) > 0
    assert read.value == len(rows)


def _lines(monkeypatch, module, table):
    monkeypatch.setattr(module, "lines", lambda *_: table)
    return table.sparkSession
