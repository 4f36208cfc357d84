from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallytide import SeriesSpec
from tallytide.operators import fill, layout, windows

SPEC = SeriesSpec("k", "t", "x")


def series(spark, values: dict[str, list], column="x", kind="double"):
    rows = [(k, t, v) for k, vs in values.items() for t, v in enumerate(vs)]
    return spark.createDataFrame(rows, f"k string, t int, {column} {kind}").repartition(3)


def collect(df, column, key="k"):
    out: dict[str, list] = {}
    for row in df.orderBy(key, "t").collect():
        out.setdefault(row[key], []).append(row[column])
    return out


def test_chunks_cover_and_order(spark, small_tasks):
    small_tasks(4)
    df = series(spark, {"a": list(map(float, range(40))), "b": [1.0, 2.0]})
    plan = layout.plan_layout(df, SPEC)
    assert plan.split
    tagged = layout.tag_chunks(df, plan)
    assert tagged.count() == 42
    chunks = collect(tagged, layout.CHUNK)
    assert chunks["a"] == sorted(chunks["a"]) and len(set(chunks["a"])) >= 5
    assert set(chunks["b"]) == {0}
    assert max(chunks["a"].count(c) for c in set(chunks["a"])) <= 8


def test_positions(spark, layout_mode):
    df = series(spark, {"a": [1.0] * 11, "b": [2.0] * 2})
    out = layout.positions(df, layout.plan_layout(df, SPEC), "pos", "n")
    assert collect(out, "pos") == {"a": list(range(11)), "b": [0, 1]}
    assert collect(out, "n") == {"a": [11] * 11, "b": [2] * 2}


def test_forward_fill(spark, layout_mode):
    n = None
    df = series(spark, {"a": [n, n, 15.0, n, n, 25.0, n, n, n, n, n, 7.0], "b": [n, 1.0, n]})
    out = collect(fill.forward_fill(df, SPEC), "x")
    assert out["a"] == [n, n, 15, 15, 15, 25, 25, 25, 25, 25, 25, 7]
    assert out["b"] == [n, 1, 1]


def test_backward_fill(spark, layout_mode):
    n = None
    df = series(spark, {"a": [n, n, 15.0, n, n, n, n, n, n, 25.0, n, n]})
    assert collect(fill.backward_fill(df, SPEC), "x")["a"] == [15, 15, 15] + [25] * 7 + [n, n]


def test_stop_columns(spark, layout_mode):
    rows = [("a", t, p, s) for t, (p, s) in enumerate([
        (None, "-"), (None, "-"), (15.0, "A"), (None, "-"), (None, "-"), (25.0, "B"), (None, "-")])]
    df = spark.createDataFrame(rows, "k string, t int, x double, stop string")
    out = fill.fill_sparse_columns(df, SPEC, ["stop", "absent"])
    assert collect(out, "is_stop_event")["a"] == [False, False, True, False, False, True, False]
    assert collect(out, "x")["a"] == [None, None, 15, 15, 15, 25, 25]
    assert collect(out, "stop")["a"] == ["-", "-", "A", "A", "A", "B", "B"]


def test_interpolation(spark, layout_mode):
    n = None
    df = series(spark, {"a": [n, 1.0, n, 3.0, n], "b": [n, n], "c": [4.0] + [n] * 6 + [n, 12.0]})
    out = collect(fill.interpolate(df, SPEC), "interpolated")
    assert out["a"] == [1, 1, 2, 3, 3]
    assert out["b"] == [0, 0]
    assert out["c"] == pytest.approx(np.linspace(4, 12, 9).tolist())


def lag_frame(spark):
    pax = [None] * 16
    for t, v in ((2, 10.0), (5, 20.0), (9, 15.0), (13, 30.0)):
        pax[t] = v
    return fill.fill_sparse_columns(series(spark, {"a": pax, "b": [None, 5.0, None, 6.0]}), SPEC)


def test_event_lag(spark, layout_mode):
    out = windows.event_lag(lag_frame(spark), SPEC)
    one, three = collect(out, "pax_stop_lag_1"), collect(out, "pax_stop_lag_3")
    assert one["a"] == [None] * 5 + [10] * 4 + [20] * 4 + [15] * 3
    assert three["a"] == [None] * 13 + [10] * 3
    assert collect(out, "pax_stop_lag_5")["a"] == [None] * 16
    assert one["b"] == [None, None, None, 5]


def test_event_lag_needs_the_marker(spark):
    with pytest.raises(ValueError, match="is_stop_event"):
        windows.event_lag(series(spark, {"a": [1.0]}), SPEC)


def test_event_lag_shuffles_once(spark):
    df = series(spark, {"a": [1.0, None, 2.0]})
    plan = layout.plan_layout(df, SPEC)
    out = windows.event_lag(fill.fill_sparse_columns(df, SPEC, layout=plan), SPEC, layout=plan)
    executed = out._jdf.queryExecution().executedPlan().toString()
    assert executed.count("Exchange hashpartitioning") == 1


def test_leak_audit(spark, layout_mode):
    rows = {r["kind"]: r for r in windows.lag_leak_audit(lag_frame(spark), SPEC, rows=1).collect()}
    assert rows["dense"]["share_equal"] > 0.7
    assert rows["event"]["rows_equal"] == 0


@pytest.mark.parametrize("w", [(5,), (2, 7)])
def test_rolling_is_exact(spark, layout_mode, w):
    rng = np.random.default_rng(7)
    values = {"a": (1e6 + np.cumsum(rng.normal(size=23))).tolist(), "b": [1.0, 2.0, 4.0], "c": [None if i == 6 else float(i) for i in range(15)]}
    out = windows.rolling_stats(series(spark, values), SPEC, {"x": "speed", "absent": "power"}, w)
    for size in w:
        for stat in ("mean", "std"):
            got = collect(out, f"speed_roll_{stat}_{size}")
            for k, v in values.items():
                # window by window: pandas' own running update loses digits at this level
                fn = np.mean if stat == "mean" else lambda x: np.std(x, ddof=1)
                v = np.array(v, dtype=float)
                want = [fn(v[i - size + 1 : i + 1]) if i >= size - 1 else np.nan for i in range(len(v))]
                np.testing.assert_allclose(np.array(got[k], dtype=float), want, rtol=1e-9)


def test_difference_does_not_cross_series(spark, layout_mode):
    df = series(spark, {"a": [0.0, 2.0, 5.0, 10.0], "b": [10.0, 5.0, 2.0, 0.0]})
    out = collect(windows.first_difference(df, SPEC), "acceleration")
    assert out == {"a": [None, 2, 3, 5], "b": [None, -5, -3, -2]}


def test_observation_index(spark, layout_mode):
    df = series(spark, {"a": [None, 1.0, None, 2.0, 3.0, None, 4.0, 5.0]})
    assert collect(windows.observation_index(df, SPEC), "stop_index")["a"] == [0, 1, 2, 3, 4]


def test_last_rows(spark, layout_mode):
    df = series(spark, {"a": list(map(float, range(12))), "b": [1.0, 2.0]})
    assert collect(windows.last_rows(df, SPEC, 4, at_least=3), "x") == {"a": [8, 9, 10, 11]}


def reference_contexts(values, length, stride, minimum):
    out = []
    for end in range(minimum, len(values), stride):
        context = np.array([np.nan if v is None else v for v in values[max(0, end - length) : end]], dtype=float)
        known = ~np.isnan(context)
        at = np.arange(len(context))
        context = np.interp(at, at[known], context[known]) if known.any() else np.zeros(len(context))
        out.append((end, context.tolist()))
    return out


@pytest.mark.parametrize("shape", [(512, 60, 64), (16, 4, 8), (10, 7, 3)])
def test_contexts(spark, small_tasks, shape):
    rng = np.random.default_rng(3)
    values = [None if rng.random() < 0.6 else float(round(rng.random(), 3)) for _ in range(200)]
    small = {"a": values, "b": values[:5], "c": [None] * 30}
    for limit in (None, 50):
        if limit:
            small_tasks(limit)
        out = windows.context_windows(series(spark, small), SPEC, *shape)
        got: dict[str, list] = {}
        for row in out.orderBy("k", "target_index").collect():
            got.setdefault(row["k"], []).append((row["target_index"], row["context"]))
        for k, v in small.items():
            want = reference_contexts(v, *shape)
            assert [e for e, _ in got.get(k, [])] == [e for e, _ in want]
            for (_, a), (_, b) in zip(got.get(k, []), want):
                assert a == pytest.approx(b)


def test_context_targets_and_labels(spark):
    df = series(spark, {"a": [float(i) for i in range(200)]}).withColumn("label", F.concat(F.lit("L"), "t"))
    rows = windows.context_windows(df, SPEC, label="label", fill_gaps=False).orderBy("target_index").collect()
    assert [r["target_index"] for r in rows] == [64, 124, 184]
    assert [len(r["context"]) for r in rows] == [64, 124, 184]
    assert [r["target"] for r in rows] == [64, 124, 184]
    assert [r["label"] for r in rows] == ["L64", "L124", "L184"]
