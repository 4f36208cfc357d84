from __future__ import annotations

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tallytide.functions import scalars as S


def _times(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "t string").select(F.to_timestamp("t").alias("time_iso"))


def test_units(spark):
    df = spark.createDataFrame([(283.15, 0.8267, 0.1491, 12.0)],
                               "temperature_ambient double, gnss_latitude double, gnss_longitude double, odometry_vehicleSpeed double")
    row = S.unit_conversions(df).first()
    assert row["temp_C"] == pytest.approx(10.0)
    assert row["lat_deg"] == pytest.approx(47.37, abs=0.1)
    assert row["lon_deg"] == pytest.approx(8.54, abs=0.1)
    assert row["speed_kmh"] == pytest.approx(43.2)


def test_units_skip_absent_and_keep_missing(spark):
    out = S.unit_conversions(spark.createDataFrame([(None, 1)], "odometry_vehicleSpeed double, other int"))
    assert out.columns == ["odometry_vehicleSpeed", "other", "speed_kmh"]
    assert out.first()["speed_kmh"] is None


def test_calendar(spark):
    row = S.calendar_features(_times(spark, "2019-04-30T03:18:56Z")).first()
    assert (row["hour"], row["dayofweek"], row["month"], row["year"]) == (3, 1, 4, 2019)
    assert row["is_weekend"] is False and row["is_rush_hour"] is False


def test_rush_hours_and_weekend(spark):
    texts = [f"2019-05-01T{h}Z" for h in ("06:59:00", "07:00:00", "08:59:00", "09:00:00", "15:59:00", "16:00:00", "18:59:00", "19:00:00")]
    rows = S.calendar_features(_times(spark, *texts)).orderBy("time_iso").collect()
    assert [r["is_rush_hour"] for r in rows] == [False, True, True, False, False, True, True, False]
    saturday = S.calendar_features(_times(spark, "2019-05-04T08:00:00Z")).first()
    assert saturday["is_weekend"] and not saturday["is_rush_hour"]


def test_zone_text(spark):
    df = spark.createDataFrame([("2022-01-01T00:30:00+01:00",), ("2021-12-31T23:30:00Z",), ("2021-12-31T23:30:00",)], "t string")
    assert df.select(S.as_utc(F.col("t")).alias("t")).distinct().count() == 1


def test_class_edges(spark):
    df = spark.createDataFrame([(x,) for x in (5.0, 10.0, 15.0, 20.0, 25.0, None)], "x double")
    got = [r[0] for r in df.select(S.demand_class(F.col("x"), 10.0, 20.0)).collect()]
    assert got == ["low", "low", "medium", "medium", "high", None]


@pytest.mark.parametrize("rule", [None, "low", "high"])
def test_missing_forecast_rule(spark, rule):
    df = spark.createDataFrame([(float("nan"),), (None,)], "x double")
    assert [r[0] for r in df.select(S.demand_class(F.col("x"), 1.0, 2.0, rule)).collect()] == [rule, rule]


def test_index_expressions(spark):
    df = spark.createDataFrame([(20.0,), (20.01,), (0.0,)], "s double")
    rows = df.select(S.index_flag(F.col("s")), S.index_intensity(F.col("s"))).collect()
    assert [r[0] for r in rows] == [0, 1, 0]
    assert rows[0][1] == pytest.approx(0.2)


def test_duration(spark):
    df = spark.createDataFrame([(0, 19524)], "a long, b long")
    assert df.select(S.duration_hours(F.col("a"), F.col("b"))).first()[0] == pytest.approx(19524 / 3600)
    assert datetime(2022, 1, 1, tzinfo=timezone.utc).year == 2022
