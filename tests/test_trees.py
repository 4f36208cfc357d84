"""The full tree against Spark's own, node by node, and the number of jobs it takes."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.sql import functions as F

from tallytide.operators import models, trees
from tallytide.schema import LABELS


def noisy(spark, n, seed=1, parts=3):
    rng = np.random.default_rng(seed)
    a, b, c = rng.random(n), rng.integers(0, 5, n), np.round(rng.normal(size=n), 2)
    y = np.where(rng.random(n) < 0.6, (a * 3).astype(int), rng.integers(0, 3, n))
    rows = [(LABELS[k], float(i), float(j), float(z), 1.0) for k, i, j, z in zip(y, a, b, c)]
    rows += rows[: n // 10] + [("low", *r[1:]) for r in rows[: n // 20]]  # repeats, and repeats of another label
    return spark.createDataFrame(rows, "demand_class string, a double, b double, c double, same double").repartition(parts)


def nodes_of(model):
    return model.stages[2].toDebugString.split("\n", 1)[1], model.stages[2].featureImportances.toArray().tolist()


def fit(df, features=("a", "b", "c", "same"), plain=False, **params):
    config = models.model_configs()["decision_tree"]
    kept = {k.name: v for k, v in config.estimator.extractParamMap().items() if config.estimator.isSet(k)}
    kind = DecisionTreeClassifier if plain else type(config.estimator)
    config = models.ModelConfig(kind(**{**kept, **params}), config.params)
    return models.build_stages(features, config).fit(df)


@pytest.mark.parametrize("limit", [100_000, 150, 10])
@pytest.mark.parametrize("params", [{}, {"maxDepth": 3}, {"maxDepth": 0}, {"minInstancesPerNode": 7, "minInfoGain": 0.01, "maxBins": 8}])
def test_nodes_are_those_of_spark(spark, monkeypatch, limit, params):
    monkeypatch.setattr(trees, "ROWS_PER_TASK", limit)
    df = noisy(spark, 400).cache()
    got, want = fit(df, **params), fit(df, plain=True, **params)
    assert nodes_of(got) == nodes_of(want)
    pair = [[tuple(r) for r in m.transform(df).select("a", "rawPrediction", "probability").orderBy("a", "rawPrediction").collect()]
            for m in (got, want)]
    assert pair[0] == pair[1]
    assert got.stages[2].getMaxDepth() == want.stages[2].getMaxDepth() and got.stages[2].numClasses == want.stages[2].numClasses


def test_thresholds_from_a_sample(spark):
    """Above 10,000 rows Spark looks for thresholds in a sample; the same one is drawn."""
    df = noisy(spark, 14_000, seed=3).localCheckpoint()
    assert nodes_of(fit(df)) == nodes_of(fit(df, plain=True))


@pytest.mark.parametrize("rows", [
    [("low", 1.0, 2.0)], [("low", 1.0, 2.0)] * 5, [("low", 1.0, 2.0), ("high", 1.0, 2.0), ("high", 1.0, 2.0)],
    [("low", 1.0, 2.0), ("high", 1.0, 3.0)], [("low", -0.0, 2.0), ("high", 0.0, 2.0), ("medium", 1e300, 2.0)],
])
def test_few_rows(spark, rows):
    df = spark.createDataFrame(rows, "demand_class string, a double, b double").coalesce(1)
    assert nodes_of(fit(df, ("a", "b"))) == nodes_of(fit(df, ("a", "b"), plain=True))


def test_left_to_spark(spark):
    df = noisy(spark, 200).withColumn("w", F.col("a") + 1)
    assert nodes_of(fit(df, weightCol="w")) == nodes_of(fit(df, plain=True, weightCol="w"))
    assert nodes_of(fit(df, impurity="entropy")) == nodes_of(fit(df, plain=True, impurity="entropy"))


def test_jobs_do_not_follow_the_depth(spark):
    df = noisy(spark, 3000, seed=5).cache()
    jobs = {}
    for depth in (4, 30):
        spark.sparkContext.setJobGroup(f"depth-{depth}", "")
        model = fit(df, maxDepth=depth)
        jobs[depth] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"depth-{depth}"))
        spark.sparkContext.setJobGroup("", "")
        assert depth == 4 or model.stages[2].depth > 12
    assert jobs[30] <= jobs[4] + 2
