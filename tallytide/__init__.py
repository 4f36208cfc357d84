"""Sparse-observation time series on Spark: features, labels, evaluation."""

from tallytide.series import SeriesSpec

__all__ = ["SeriesSpec"]
