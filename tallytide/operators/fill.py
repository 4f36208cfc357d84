"""Observation markers, forward and backward fill, interpolation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallytide.functions.scalars import known, nan_as_null
from tallytide.operators.layout import CHUNK, Layout, attach_carry, carry_last, plan_layout, positions, tag_chunks
from tallytide.schema import PLACEHOLDER
from tallytide.series import SeriesSpec

OBSERVED = "is_stop_event"


def mark_observations(df: DataFrame, value: str, marker: str = OBSERVED) -> DataFrame:
    """Flag the rows that carry an observation; must run before any fill."""
    return df.withColumn(marker, known(df, value).isNotNull())


def observations(df: DataFrame, value: str) -> DataFrame:
    """Only the rows that carry an observation."""
    return df.filter(known(df, value).isNotNull())


def drop_unobserved(df: DataFrame, value: str) -> DataFrame:
    """After a fill: drop the rows before the first observation of their series."""
    return df.filter(known(df, value).isNotNull())


def _fill(df: DataFrame, layout: Layout, columns: Sequence[str], reverse: bool) -> DataFrame:
    frame = layout.window(reverse).rowsBetween(Window.unboundedPreceding, 0)
    local = {c: F.last(c, ignorenulls=True).over(frame) for c in columns}
    if not layout.split:
        return df.withColumns(local)
    tagged = attach_carry(tag_chunks(df, layout), carry_last(df, layout, columns, reverse), layout)
    filled = {c: F.coalesce(local[c], F.col(f"_carry_{c}")) for c in columns}
    return tagged.withColumns(filled).drop(CHUNK, *[f"_carry_{c}" for c in columns])


def forward_fill(
    df: DataFrame, spec: SeriesSpec, columns: Sequence[str] | None = None, layout: Layout | None = None
) -> DataFrame:
    """Replace NULL and NaN by the last known value of the same series."""
    columns = columns or [spec.value]
    return _fill(nan_as_null(df, columns), layout or plan_layout(df, spec), columns, reverse=False)


def backward_fill(
    df: DataFrame, spec: SeriesSpec, columns: Sequence[str] | None = None, layout: Layout | None = None
) -> DataFrame:
    """Replace NULL and NaN by the next known value of the same series."""
    columns = columns or [spec.value]
    return _fill(nan_as_null(df, columns), layout or plan_layout(df, spec), columns, reverse=True)


def fill_sparse_columns(
    df: DataFrame,
    spec: SeriesSpec,
    placeholder_columns: Sequence[str] = (),
    marker: str = OBSERVED,
    layout: Layout | None = None,
) -> DataFrame:
    """Mark observations, then fill the value and the placeholder text columns.

    Text columns use ``"-"`` for missing; rows before the first known text keep it.
    Columns that are absent are left out.
    """
    texts = [c for c in placeholder_columns if c in df.columns]
    values = [spec.value] if spec.value in df.columns else []
    prepared = mark_observations(df, spec.value, marker) if values else df
    prepared = prepared.withColumns({c: F.nullif(F.col(c), F.lit(PLACEHOLDER)) for c in texts})
    filled = forward_fill(prepared, spec, [*values, *texts], layout or plan_layout(df, spec))
    return filled.withColumns({c: F.coalesce(F.col(c), F.lit(PLACEHOLDER)) for c in texts})


def neighbours(df: DataFrame, spec: SeriesSpec, layout: Layout | None = None) -> DataFrame:
    """Add ``pos`` and the nearest known (pos, x) at or before and at or after each row."""
    layout = layout or plan_layout(df, spec)
    indexed = positions(nan_as_null(df, [spec.value]), layout, "pos")
    point = F.when(F.col(spec.value).isNotNull(), F.struct(F.col("pos"), F.col(spec.value).alias("x")))
    pairs = indexed.withColumns({"prev": point, "next": point})
    return _fill(_fill(pairs, layout, ["prev"], False), layout, ["next"], True)


def between_neighbours(row: Column, start: Column, end: Column) -> Column:
    """Linear value at ``row.pos`` from the neighbours inside [start, end); flat at the edges, 0 if none."""
    has_prev = row["prev"].isNotNull() & (row["prev"]["pos"] >= start)
    has_next = row["next"].isNotNull() & (row["next"]["pos"] < end)
    gap = row["next"]["pos"] - row["prev"]["pos"]
    slope = (row["next"]["x"] - row["prev"]["x"]) / F.when(gap > 0, gap)
    linear = F.when(gap == 0, row["prev"]["x"]).otherwise(
        row["prev"]["x"] + slope * (row["pos"] - row["prev"]["pos"])
    )
    return (
        F.when(has_prev & has_next, linear)
        .when(has_prev, row["prev"]["x"])
        .when(has_next, row["next"]["x"])
        .otherwise(F.lit(0.0))
    )


def interpolate(
    df: DataFrame, spec: SeriesSpec, name: str = "interpolated", layout: Layout | None = None
) -> DataFrame:
    """Linear interpolation over the whole series, flat at both ends, 0 where nothing is known."""
    found = neighbours(df, spec, layout)
    row = F.struct("pos", "prev", "next")
    value = between_neighbours(row, F.lit(0), F.lit(2**62))
    return found.withColumn(name, value).drop("pos", "prev", "next")
