"""Column expressions: units, calendar, labels, external index."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallytide.schema import (
    AM_RUSH,
    INDEX_FLAG_ABOVE,
    KELVIN_OFFSET,
    LABELS,
    MPS_TO_KMH,
    PLACEHOLDER,
    PM_RUSH,
)


def kelvin_to_celsius(x: Column) -> Column:
    return x - KELVIN_OFFSET


def radians_to_degrees(x: Column) -> Column:
    return F.degrees(x)


def mps_to_kmh(x: Column) -> Column:
    return x * MPS_TO_KMH


# derived column -> (source column, conversion)
UNIT_COLUMNS = {
    "temp_C": ("temperature_ambient", kelvin_to_celsius),
    "lat_deg": ("gnss_latitude", radians_to_degrees),
    "lon_deg": ("gnss_longitude", radians_to_degrees),
    "speed_kmh": ("odometry_vehicleSpeed", mps_to_kmh),
}


def unit_conversions(df: DataFrame) -> DataFrame:
    """Add the converted columns whose source is present."""
    return df.withColumns(
        {name: fn(F.col(src)) for name, (src, fn) in UNIT_COLUMNS.items() if src in df.columns}
    )


def calendar_features(df: DataFrame, time: str = "time_iso") -> DataFrame:
    """Add hour, dayofweek (Monday 0), month, year, is_weekend and is_rush_hour, all in UTC."""
    t = F.col(time)
    hour, day = F.hour(t), F.weekday(t)
    weekend = day >= 5
    rush = F.lit(False)
    for start, stop in (AM_RUSH, PM_RUSH):
        rush = rush | ((hour >= start) & (hour < stop))
    return df.withColumns(
        {
            "hour": hour,
            "dayofweek": day,
            "month": F.month(t),
            "year": F.year(t),
            "is_weekend": weekend,
            "is_rush_hour": ~weekend & rush,
        }
    )


def year_month(t: Column) -> Column:
    return F.date_format(t, "yyyy-MM")


def duration_hours(start_unix: Column, end_unix: Column) -> Column:
    return (end_unix - start_unix) / 3600


def as_utc(text: Column) -> Column:
    """Timestamp from ISO text with or without a zone; text without one is taken as UTC.

    Needs the session time zone to be UTC.
    """
    return F.to_timestamp(text)


def null_placeholder(x: Column) -> Column:
    return F.nullif(x, F.lit(PLACEHOLDER))


def demand_class(x: Column, low: Column | float, high: Column | float, on_missing: str | None = None) -> Column:
    """``low`` up to the first boundary, ``medium`` up to the second, else ``high``.

    NULL and NaN give ``on_missing``; forecasts use "low" or "high" there.
    """
    missing = x.isNull() | F.isnan(x)
    bounds = [b if isinstance(b, Column) else F.lit(b) for b in (low, high)]
    return (
        F.when(missing, F.lit(on_missing))
        .when(x <= bounds[0], LABELS[0])
        .when(x <= bounds[1], LABELS[1])
        .otherwise(LABELS[2])
    )


def index_intensity(stringency: Column) -> Column:
    return stringency / 100.0


def index_flag(stringency: Column, above: float = INDEX_FLAG_ABOVE) -> Column:
    return (stringency > above).cast("int")


def known(df: DataFrame, name: str) -> Column:
    """The column with NaN, which stands for a missing value, as NULL."""
    value = F.col(f"`{name}`")
    kind = df.schema[name].dataType.typeName()
    return F.when(~F.isnan(value), value) if kind in ("double", "float") else value


def nan_as_null(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """NaN as NULL in the floating-point columns among ``columns``; nothing to do for the rest."""
    kinds = {f.name: f.dataType.typeName() for f in df.schema.fields}
    return df.withColumns({c: known(df, c) for c in columns if kinds.get(c) in ("double", "float")})
