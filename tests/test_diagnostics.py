from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallytide import SeriesSpec
from tallytide.operators import diagnostics as D
from tallytide.operators import forecast as A
from tallytide.operators.evaluate import evaluate
from tallytide.plans import hourly

SPEC = SeriesSpec("k", "t", "y")


def _autoregression(rng, n, c):
    x = [0.0]
    for e in rng.normal(size=n - 1):
        x.append(c * x[-1] + e)
    return np.array(x)


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(42)
    values = {
        "noise": rng.normal(size=500) + 3,
        "walk": np.cumsum(rng.normal(size=500)),
        "ar": _autoregression(rng, 300, 0.7),
        "short": rng.normal(size=12),
    }
    pdf = pd.concat([pd.DataFrame({"k": k, "t": range(len(v)), "y": v}) for k, v in values.items()])
    return values, spark.createDataFrame(pdf).repartition(4).persist()


@pytest.fixture(params=["whole", "split"])
def mode(request, small_tasks):
    if request.param == "split":
        small_tasks(101)


def reference_acf(y, lags):
    d = y - y.mean()
    return [float(d[k:] @ d[: len(d) - k] / (d @ d)) for k in range(1, lags + 1)]


def test_acf(data, mode):
    values, df = data
    rows = D.acf(df, SPEC, 10, min_rows=20).orderBy("k", "lag").collect()
    for k in ("noise", "walk", "ar"):
        assert [r["acf"] for r in rows if r["k"] == k] == pytest.approx(reference_acf(values[k], 10))
    assert not [r for r in rows if r["k"] == "short"]
    assert all(r["significant"] for r in rows if r["k"] == "walk")
    limited = D.acf(df.filter("k = 'short'"), SPEC, 10).collect()
    assert sorted(r["lag"] for r in limited) == [1, 2, 3, 4, 5]


def test_many_lags_use_blocks(data, mode):
    values, df = data
    rows = D.acf(df.filter("k = 'walk'"), SPEC, 90).orderBy("lag").collect()
    assert [r["acf"] for r in rows] == pytest.approx(reference_acf(values["walk"], 90))


def test_pacf_solves_yule_walker(data):
    values, df = data
    out = D.pacf(df, SPEC, 6, min_rows=20)
    rows = [r["pacf"] for r in out.filter("k = 'ar'").orderBy("lag").collect()]
    r = [1.0, *reference_acf(values["ar"], 6)]
    for p in range(1, 7):
        toeplitz = np.array([[r[abs(i - j)] for j in range(p)] for i in range(p)])
        assert rows[p - 1] == pytest.approx(np.linalg.solve(toeplitz, r[1 : p + 1])[-1])
    assert {x["k"]: x["p"] for x in D.suggested_order(out, ["k"]).collect()}["ar"] >= 1


def reference_kpss(y):
    n, d = len(y), y - y.mean()
    g = [float(d[k:] @ d[: n - k] / n) for k in range(n)]
    m = int(n ** (2 / 9))
    s0, s1 = g[0] + 2 * sum(g[1 : m + 1]), 2 * sum(i * g[i] for i in range(1, m + 1))
    lag = min(int(1.1447 * ((s1 / s0) ** 2) ** (1 / 3) * n ** (1 / 3)), n - 1)
    long_run = g[0] + 2 * sum(g[i] * (1 - i / (lag + 1)) for i in range(1, lag + 1))
    return float((np.cumsum(d) ** 2).sum() / (n**2 * long_run)), lag


def reference_adf(y):
    """Ordinary least squares on the design itself, lag by AIC."""
    step, n = np.diff(y), len(y)
    top = min(int(np.ceil(12 * (n / 100) ** 0.25)), n // 2 - 2)

    def fit(lag, first):
        t = np.arange(first, len(step))
        x = np.column_stack([np.ones(len(t)), y[t], *[step[t - i] for i in range(1, lag + 1)]])
        beta, *_ = np.linalg.lstsq(x, step[t], rcond=None)
        e = step[t] - x @ beta
        return x, beta, e

    def aic(lag):
        x, _, e = fit(lag, top)
        return len(e) * np.log(e @ e / len(e)) + 2 * x.shape[1]

    lag = min(range(top + 1), key=aic)
    x, beta, e = fit(lag, lag)
    cov = e @ e / (len(e) - x.shape[1]) * np.linalg.inv(x.T @ x)
    return float(beta[1] / np.sqrt(cov[1, 1])), lag


def test_tests_and_verdicts(data, mode):
    values, df = data
    rows = {r["k"]: r for r in D.stationarity(df, SPEC).collect()}
    assert set(rows) == {"noise", "walk", "ar"}
    for k, r in rows.items():
        stat, lag = reference_kpss(values[k])
        assert (r["kpss_stat"], r["kpss_lag"]) == (pytest.approx(stat), lag)
        stat, lag = reference_adf(values[k])
        assert (r["adf_stat"], r["adf_lag"]) == (pytest.approx(stat), lag)
    assert rows["noise"]["verdict"] == D.STATIONARY
    assert rows["walk"]["verdict"] == D.NON_STATIONARY


def test_retest_of_differences(data):
    _, df = data
    again = {r["k"]: r["verdict"] for r in D.retest_differences(df, SPEC, D.stationarity(df, SPEC)).collect()}
    assert again == {"walk": D.STATIONARY}


def test_p_values():
    assert D.mackinnon_p(-2.86) == pytest.approx(0.05, abs=0.002)
    assert D.mackinnon_p(-3.43) == pytest.approx(0.01, abs=0.001)
    assert D.mackinnon_p(3.0) == 1.0 and D.mackinnon_p(-20.0) == 0.0


def test_kpss_p_values(spark):
    df = spark.createDataFrame([(x,) for x in (0.1, 0.347, 0.405, 0.463, 0.9, None)], "s double")
    got = [r[0] for r in df.select(D.kpss_p_value(F.col("s"))).collect()]
    assert got[:5] == pytest.approx([0.10, 0.10, 0.075, 0.05, 0.01]) and got[5] is None


def test_verdict_table(spark):
    df = spark.createDataFrame([(0.01, 0.1), (0.5, 0.01), (0.01, 0.01), (0.5, 0.1)], "a double, k double")
    out = df.select(D.verdict(F.col("a"), F.col("k")).alias("verdict"))
    assert [r[0] for r in out.collect()] == [D.STATIONARY, D.NON_STATIONARY, D.TREND_STATIONARY, D.INCONCLUSIVE]
    row = D.verdict_counts(out).first()
    assert (row["stationary"], row["non_stationary"], row["inconclusive"]) == (1, 2, 1)


def test_order_search_and_forecast(data, mode):
    values, df = data
    models = A.order_search(df, SPEC, d=0, max_p=3, max_q=0)
    row = models.filter("k = 'ar'").first()
    assert row["p"] >= 1
    # a pure autoregression can be refitted directly
    y = values["ar"]
    t = np.arange(3, len(y))
    x = np.column_stack([np.ones(len(t)), *[y[t - i] for i in range(1, row["p"] + 1)]])
    beta, *_ = np.linalg.lstsq(x, y[t], rcond=None)
    assert row["phi"] == pytest.approx(beta[1:].tolist(), rel=1e-6)
    path = [r["forecast"] for r in A.forecast(models, SPEC.key, 4).filter("k = 'ar'").orderBy("step").collect()]
    tail, want = list(y), []
    for _ in range(4):
        tail.append(beta[0] + sum(b * tail[-1 - i] for i, b in enumerate(beta[1:])))
        want.append(tail[-1])
    assert path == pytest.approx(want, rel=1e-6)


def test_moving_average_is_found(spark):
    rng = np.random.default_rng(1)
    e = rng.normal(size=2001)
    y = e[1:] + 0.8 * e[:-1]
    df = spark.createDataFrame(pd.DataFrame({"k": "ma", "t": range(2000), "y": np.cumsum(y)}))
    row = A.order_search(df, SPEC, d=1, max_p=2, max_q=2).first()
    assert row["q"] >= 1 and np.isfinite(row["aic"])
    assert A.forecast(A.order_search(df, SPEC), SPEC.key, 5).count() == 5


def test_gaps(spark):
    rows = [("a", i, f"2020-01-01 0{h}:00:00", float(h)) for i, h in enumerate((1, 2, 5))]
    df = spark.createDataFrame(rows, "k string, t int, time string, y double").withColumn("time", F.to_timestamp("time"))
    row = D.gap_stats(df, SPEC, "time").first()
    assert (row["n"], row["gap_median_s"], row["gap_max_s"]) == (3, 7200.0, 10800.0)


def test_hourly_forecast(spark):
    hours = pd.date_range("2021-12-01", periods=900, freq="h")
    rng = np.random.default_rng(0)
    level = 10 + 5 * np.sin(np.arange(900) / 24 * 2 * np.pi) + rng.normal(size=900)
    df = spark.createDataFrame(pd.DataFrame({"k": "m", "t": hours, "y": level}))
    series = hourly.hourly_series(df, SPEC, "t")
    assert series.count() == 900
    compared = hourly.forecast_hours(series, pd.Timestamp("2022-01-01", tz="UTC").to_pydatetime(), max_p=4, max_q=1)
    assert compared.count() == 900 - 31 * 24
    assert compared.filter("forecast is null or truth is null").count() == 0
    assert hourly.first_hours(compared, 20).count() == 20
    score = evaluate(compared, "truth", "predicted").first()
    assert 0 <= score["macro_f1"] <= 1
