"""From raw series to a table that compares models: pooled and temporal splits, with lags and vectors."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallytide.operators.joins import attach_vectors
from tallytide.operators.layout import plan_layout
from tallytide.operators.models import ModelConfig, fit_reduction, train_models
from tallytide.operators.sampling import group_split, temporal_split
from tallytide.plans.features import FeatureColumns, feature_names, fit_features, numeric_features, prepare_rows
from tallytide.scale import reliable_checkpoint
from tallytide.schema import EVENT_LAGS, ROLLING_WINDOWS, SEED, TEMPORAL_CUTOFF, VECTOR_SIZE
from tallytide.series import SeriesSpec
from tallytide.sources.registry import Registry

POOLED, TEMPORAL = "pooled", "temporal"


def with_reduced_vectors(
    train: DataFrame, test: DataFrame, vectors: DataFrame, key: str, vector: str = "embedding", size: int = VECTOR_SIZE
) -> tuple[DataFrame, DataFrame]:
    """Both parts with the principal components of their series' vectors, fitted on the training series only."""
    known = vectors.join(train.select(key).distinct(), key, "left_semi")
    reduced = reliable_checkpoint(fit_reduction(known, size, vector).apply(vectors.select(key, vector), vector))
    return attach_vectors(train, reduced, key, vector, size), attach_vectors(test, reduced, key, vector, size)


def run_training(
    raw: DataFrame,
    spec: SeriesSpec,
    daily_index: DataFrame,
    meta: DataFrame,
    registry: Registry,
    run: str,
    configs: dict[str, ModelConfig],
    columns: FeatureColumns = FeatureColumns(),
    windows: Sequence[int] = ROLLING_WINDOWS,
    lags: Sequence[int] | None = EVENT_LAGS,
    vectors: DataFrame | None = None,
    vector_size: int = VECTOR_SIZE,
    meta_key: str = "name",
    start: str = "startTime_iso",
    cutoff: datetime = TEMPORAL_CUTOFF,
    test_share: float = 0.2,
    seed: int = SEED,
) -> DataFrame:
    """Fill, build features, split, fit and score every model; the comparison table of the run.

    The pooled split holds out whole series by hash, the temporal split those that start at or
    after the cutoff. Boundaries, categories and vector components are learned from the training
    part of each split. A model with a recorded result in this run is not fitted again.
    """
    key = spec.key[0]
    layout = plan_layout(raw, spec)
    rows = prepare_rows(raw, spec, columns, layout)
    built = reliable_checkpoint(numeric_features(rows, spec, daily_index, columns, windows, lags, layout))
    splits = {
        POOLED: group_split(built, key, test_share, seed),
        TEMPORAL: temporal_split(built, meta, key, start, F.lit(cutoff), meta_key),
    }
    for framework, (train, test) in splits.items():
        if not registry.pending(run, framework, list(configs)):
            continue
        if vectors is not None:
            train, test = with_reduced_vectors(train, test, vectors, key, size=vector_size)
        fitted = fit_features(train, spec.value, columns)
        train, test = fitted.apply(train, spec.value), fitted.apply(test, spec.value)
        train_models(train, test, feature_names(train, test, spec), configs, registry, run, framework)
    return registry.comparison(run)
