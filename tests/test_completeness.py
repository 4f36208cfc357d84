"""No row, group or category is lost: short series, NULL keys and strata, NaN, many categories, repeated dates."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallytide.operators import diagnostics, encode, fill, joins, quantiles, sampling, stats, windows
from tallytide.operators.forecast import forecast, order_search, orders_for
from tallytide.operators.layout import plan_layout, shared, tag_chunks
from tallytide.plans.hourly import evaluate_forecast, forecast_hours
from tallytide.scale import BROADCAST_BYTES, dimension_join, reliable_checkpoint, shared_folder
from tallytide.series import SeriesSpec
from tallytide.sources.registry import append_rows, write_table

SPEC = SeriesSpec("k", "t", "x")
NAN = float("nan")


def walk(n, seed=0):
    return np.cumsum(np.random.default_rng(seed).normal(size=n)).tolist()


def test_every_series_has_a_model_and_a_forecast(spark):
    lengths = [200, 90, 60, 30, 12, 5, 3, 2, 1]
    rows = [(f"s{n}", t, x) for n in lengths for t, x in enumerate(walk(n, n))] + [("flat", t, 4.0) for t in range(40)]
    df = spark.createDataFrame(rows, "k string, t int, x double")
    for d in (0, 1, 2):
        models = order_search(df, SPEC, d=d).collect()
        assert {m["k"] for m in models} == {f"s{n}" for n in lengths} | {"flat"}
        paths = forecast(order_search(df, SPEC, d=d), SPEC.key, 4).collect()
        assert len(paths) == 4 * (len(lengths) + 1) and all(np.isfinite(p["forecast"]) for p in paths)
    flat = [p["forecast"] for p in forecast(order_search(df, SPEC), SPEC.key, 3).filter("k = 'flat'").collect()]
    assert flat == pytest.approx([4.0] * 3)


def test_orders_of_short_series():
    assert orders_for(30, 20, 5) == (20, 5)
    for depth in range(1, 30):
        p, q = orders_for(depth, 20, 5)
        assert 1 <= p and p + 2 * q <= depth


def test_first_order_fallback_is_least_squares(spark):
    x = walk(7, 3)
    df = spark.createDataFrame([("a", t, v) for t, v in enumerate(x)], "k string, t int, x double")
    model = order_search(df, SPEC, d=1).first()
    w = np.diff(x)
    assert (model["p"], model["d"], model["q"]) == (1, 1, 0)
    assert model["phi"][0] == pytest.approx(np.clip(w[1:] @ w[:-1] / (w[:-1] @ w[:-1]), -1, 1))


def test_a_short_train_part_still_gives_a_forecast(spark):
    start = datetime(2024, 1, 1, tzinfo=timezone.utc)
    hours = [(start + timedelta(hours=i), 10 + 5 * float(np.sin(i / 3))) for i in range(100)]
    frame = spark.createDataFrame(hours, "hour timestamp, mean_pax double")
    found = forecast_hours(frame, start + timedelta(hours=48))
    assert found.count() == 52 and found.filter("forecast is null").count() == 0
    assert evaluate_forecast(frame, start + timedelta(hours=48)).first()["macro_f1"] is not None


def test_many_categories_become_a_sparse_vector(spark, monkeypatch):
    monkeypatch.setattr(encode, "MAX_CATEGORIES", 10)
    names = [f"c{i:05d}" for i in range(200)]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)] + [(900, None), (901, "other")], "i long, c string")
    fitted = encode.fit_one_hot(df.filter("c <> 'other'"), "c", "c_")
    got = {r["i"]: r["c_"] for r in fitted.apply(df).collect()}
    assert len(got) == 202 and got[0].size == 199
    for i in range(200):
        assert got[i].indices.tolist() == ([] if i == 0 else [i - 1])
    assert got[900].numNonzeros() == got[901].numNonzeros() == 0


def test_twenty_thousand_categories(spark):
    df = spark.range(20_000).select(F.concat(F.lit("c"), "id").alias("c"), "id")
    fitted = encode.fit_one_hot(df, "c", "v")
    assert fitted.dummies == ["v"] and fitted.apply(df.limit(3)).first()["v"].size == 19_999


def test_null_is_a_stratum(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, None)], "k long, s string")
    assert sampling.stratified_sample(df, "k", "s", 10).count() == 4
    assert {r["s"] for r in sampling.stratified_sample(df, "k", "s", 2).collect()} == {"a", None}


def test_vectors_are_attached_whole(spark):
    vectors = spark.createDataFrame([("a", [float(i) for i in range(64)])], "k string, embedding array<double>")
    rows = spark.createDataFrame([("a",), ("b",)], "k string")
    got = joins.attach_vectors(rows, vectors, "k")
    assert len(got.columns) == 65 and got.filter("k = 'a'").first()["tfm_emb_63"] == 63.0
    with pytest.raises(ValueError, match="64 elements"):
        joins.attach_vectors(rows, vectors, "k", size=32)


def test_pooling_weighs_windows_equally(spark):
    rows = [("m", 1, [0.0, 2.0]), ("m", 1, [2.0, 4.0]), ("m", 1, [4.0, 6.0]), ("m", 2, [10.0, 0.0]), ("m", 3, None)]
    vectors = spark.createDataFrame(rows, "k string, w int, embedding array<double>")
    assert joins.mean_pool(vectors, ["k"], window=["w"]).first()["embedding"] == [6.0, 2.0]
    assert joins.mean_pool(vectors, ["k"]).first()["embedding"] == [4.0, 3.0]


def test_repeated_dates_do_not_multiply_rows(spark):
    days = [(i, datetime(2020, 1, 1) + timedelta(days=i)) for i in range(14)]
    df = spark.createDataFrame(days, "i int, t timestamp")
    points = spark.createDataFrame(
        [(date(2020, 1, 5), 10.0), (date(2020, 1, 5), 7.0), (date(2020, 1, 10), 20.0), (None, 99.0)], "date date, stringency double")
    got = {r["i"]: r["stringency"] for r in joins.index_as_of(df, points, "t").collect()}
    assert got == {i: 0.0 if i < 4 else 10.0 if i < 9 else 20.0 for i in range(14)}


def test_rows_are_appended_by_name(spark, tmp_path):
    path = str(tmp_path / "comparison")
    write_table(spark.createDataFrame([("tree", 0.5)], "model string, f1 double"), path, ["model"])
    append_rows(spark.createDataFrame([(0.7, "forest")], "f1 double, model string"), path)
    got = {r["model"]: r["f1"] for r in spark.read.option("header", True).csv(path).collect()}
    assert got == {"tree": "0.5", "forest": "0.7"}
    with pytest.raises(ValueError, match="do not match"):
        append_rows(spark.createDataFrame([(0.7,)], "f2 double"), path)


def test_null_keys_are_spread(spark, small_tasks):
    small_tasks(20)
    rows = spark.createDataFrame([(None, t) for t in range(250)] + [("a", t) for t in range(5)], "k string, t int")
    layout = plan_layout(rows, SeriesSpec("k", "t", "t"))
    assert tag_chunks(rows, layout).filter("k is null").select("_chunk").distinct().count() > 3
    small_tasks(20, 1)
    dim = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    joined = dimension_join(rows, dim, ["k"])
    assert joined.count() == 255 and joined.filter("k is null and v is not null").count() == 0
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        parts = joined.filter("k is null").select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert parts > 1


def test_the_size_check_moves_counts_only(spark):
    dim = spark.range(1000)
    seen = []
    frame = SimpleNamespace(sparkSession=spark, schema=dim.schema, count=lambda: seen.append(1) or dim.count())
    from tallytide.scale import fits_broadcast

    assert fits_broadcast(frame) and seen == [1]
    spark.conf.set(BROADCAST_BYTES, "100")
    assert not fits_broadcast(dim)
    spark.conf.unset(BROADCAST_BYTES)


def test_a_missed_bracket_is_widened(spark):
    values = np.random.default_rng(1).normal(size=3000).tolist()
    df = spark.createDataFrame([(v,) for v in values], "_v double")
    got = quantiles._bracketed(df, [0.1, 0.5, 0.9], [], "q", 50, 1e-9).first()["q"]
    assert got == pytest.approx(np.quantile(values, [0.1, 0.5, 0.9]).tolist())


def test_a_cluster_needs_a_shared_folder():
    def session(master, named=None):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
        return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda *_: named))

    assert shared_folder(session("local[4]")) and shared_folder(session("yarn", "hdfs://x/y/")) == "hdfs://x/y"
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="share"):
            shared_folder(session(master))


# --- NaN is missing -----------------------------------------------------------------------

VALUES = [NAN, 1.0, NAN, NAN, 2.0, 4.0, NAN, 8.0, 16.0, 32.0, 64.0, 128.0]


@pytest.fixture(params=["nan", "null"])
def gaps(spark, request, layout_mode):
    missing = NAN if request.param == "nan" else None
    rows = [("a", t, missing if np.isnan(x) else x) for t, x in enumerate(VALUES)]
    return spark.createDataFrame(rows, "k string, t int, x double")


def column(df, name):
    return [np.nan if r[name] is None else r[name] for r in df.orderBy("t").collect()]


def test_fill_and_lag_with_gaps(gaps):
    s = pd.Series(VALUES)
    filled = fill.fill_sparse_columns(gaps, SPEC)
    assert column(filled, "x") == pytest.approx(s.ffill().tolist(), nan_ok=True)
    assert column(filled, "is_stop_event") == s.notna().tolist()
    assert column(fill.backward_fill(gaps, SPEC), "x") == pytest.approx(s.bfill().tolist(), nan_ok=True)
    own = s.dropna().shift(1).reindex(s.index)
    first = s.dropna().index[1]
    want = own.where(own.notna()).ffill().where(s.index >= first)
    assert column(windows.event_lag(filled, SPEC, [1]), "pax_stop_lag_1") == pytest.approx(want.tolist(), nan_ok=True)
    assert fill.drop_unobserved(gaps, "x").count() == fill.observations(gaps, "x").count() == int(s.notna().sum())


def test_rolling_and_interpolation_with_gaps(gaps):
    s = pd.Series(VALUES)
    rolled = windows.rolling_stats(gaps, SPEC, {"x": "x"}, [2, 3])
    for w in (2, 3):
        assert column(rolled, f"x_roll_mean_{w}") == pytest.approx(s.rolling(w).mean().tolist(), nan_ok=True)
        assert column(rolled, f"x_roll_std_{w}") == pytest.approx(s.rolling(w).std().tolist(), nan_ok=True)
    assert column(windows.first_difference(gaps, SPEC), "acceleration") == pytest.approx(s.diff().tolist(), nan_ok=True)
    want = s.interpolate().bfill().ffill()
    assert column(fill.interpolate(gaps, SPEC), "interpolated") == pytest.approx(want.tolist())


def test_statistics_with_gaps(gaps):
    s = pd.Series(VALUES)
    got = stats.summary(gaps, "x").first()
    assert [got[c] for c in ("min", "mean", "median", "max", "skew")] == pytest.approx(
        [s.min(), s.mean(), s.median(), s.max(), s.skew()])
    assert sum(r["rows"] for r in stats.histogram(gaps, "x").collect()) == s.notna().sum()
    known = s.dropna().to_numpy() - s.mean()
    found = diagnostics.autocovariances(gaps, SPEC, 2).first()
    want = [float(known[k:] @ known[: len(known) - k]) / len(known) for k in range(3)]
    assert found["n"] == s.notna().sum() and found["gamma"] == pytest.approx(want)


def test_a_chain_on_cut_series_reads_its_input_once(spark, small_tasks):
    spec = SeriesSpec("k", "t", "v")
    rows = spark.createDataFrame(
        [(k, t, float((t * 7 + k) % 11) if t % 3 == 0 else None, float(t * t % 13)) for k in range(3) for t in range(200)],
        "k int, t int, v double, speed double")
    reads = spark.sparkContext.accumulator(0)

    def counted(frames):
        for pdf in frames:
            reads.add(len(pdf))
            yield pdf

    def chain(source):
        layout = plan_layout(rows, spec)
        out, layout = shared(source, layout)
        before = reads.value
        out = windows.rolling_stats(out, spec, {"speed": "speed"}, [5, 20], layout)
        out = windows.first_difference(out, spec.of("speed"), layout=layout)
        out = windows.event_lag(out, spec, layout=layout)
        return out, layout, before

    filled = fill.fill_sparse_columns(rows, spec)
    want = {(r["k"], r["t"]): r for r in chain(filled)[0].collect()}
    small_tasks(40)
    source = reliable_checkpoint(filled).mapInPandas(counted, filled.schema)
    out, layout, before = chain(source)
    got = out.collect()
    assert layout.split and before == reads.value == 600  # written out once, never read again
    assert len(got) == 600
    for r in got:
        for name, value in want[r["k"], r["t"]].asDict().items():
            assert r[name] == pytest.approx(value, abs=1e-9)
