"""Hourly mean series, its forecast, and how well the forecast classes fit."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallytide.functions.scalars import demand_class
from tallytide.operators.evaluate import evaluate
from tallytide.operators.forecast import MAX_P, MAX_Q, forecast, order_search
from tallytide.operators.layout import positions, plan_layout
from tallytide.operators.stats import mean_of_means, tercile_boundaries
from tallytide.scale import reliable_checkpoint
from tallytide.series import SeriesSpec

HOURLY = SeriesSpec("series", "hour", "mean_pax")


def hourly_series(df: DataFrame, spec: SeriesSpec, time: str) -> DataFrame:
    """(hour, mean_pax): the mean over series of the mean of their observations in each hour."""
    return mean_of_means(df, spec.key, F.date_trunc("hour", F.col(time)), spec.value)


def forecast_hours(
    hours: DataFrame, cutoff: datetime, d: int = 1, max_p: int = MAX_P, max_q: int = MAX_Q
) -> DataFrame:
    """(hour, mean_pax, forecast, truth, predicted) for the hours from the cutoff on.

    Order and boundaries come from the hours before it. The hourly series has
    one row per calendar hour; it is written out, so that the data behind it is read once.
    """
    keyed = reliable_checkpoint(hours.withColumn("series", F.lit("hourly")))
    train, test = keyed.filter(F.col("hour") < F.lit(cutoff)), keyed.filter(F.col("hour") >= F.lit(cutoff))
    low, high = tercile_boundaries(train, "mean_pax")
    models = order_search(train, HOURLY, d, max_p, max_q)
    numbered = positions(test, plan_layout(test, HOURLY), "step").withColumn("step", (F.col("step") + 1).cast("int"))
    path = forecast(models, HOURLY.key, test.count())
    joined = numbered.join(path, ["series", "step"])
    return joined.select(
        "hour", "mean_pax", "forecast",
        demand_class(F.col("mean_pax"), low, high, on_missing="high").alias("truth"),
        demand_class(F.col("forecast"), low, high, on_missing="high").alias("predicted"),
    )


def evaluate_forecast(hours: DataFrame, cutoff: datetime, **search: int) -> DataFrame:
    """Class metrics of the hourly forecast."""
    return evaluate(forecast_hours(hours, cutoff, **search), "truth", "predicted")


def first_hours(compared: DataFrame, n: int = 200) -> DataFrame:
    """The first n compared hours."""
    return compared.orderBy("hour").limit(n)
