"""Aggregates behind the exploratory tables."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallytide.functions.scalars import nan_as_null
from tallytide.operators.quantiles import exact_quantiles, quantile_values
from tallytide.scale import dimension_join, reliable_checkpoint
from tallytide.schema import LABELS, PLACEHOLDER

BINS = 50


def counts_by(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per value of each column: (unit, value, rows), one pass over the data."""
    units = F.array(*[F.struct(F.lit(c).alias("unit"), F.col(c).cast("long").alias("value")) for c in columns])
    # counted by the full combination first, so the fan-out happens on few rows
    combined = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    flat = combined.select(F.inline(units), "n")
    return flat.groupBy("unit", "value").agg(F.sum("n").alias("rows")).orderBy("unit", "value")


def mean_by(df: DataFrame, by: Sequence[str | Column], value: str, name: str = "mean") -> DataFrame:
    df = nan_as_null(df, [value])
    return df.groupBy(*by).agg(F.avg(value).alias(name))


def peak(profile: DataFrame, by: Sequence[str], at: str, mean: str) -> DataFrame:
    """The position with the highest mean per group; the smallest position wins a tie."""
    best = F.max(F.struct(F.col(mean), (-F.col(at)).alias("neg"))).alias("best")
    grouped = profile.groupBy(*by).agg(best)
    return grouped.select(*by, (-F.col("best.neg")).alias("peak_" + at), F.col(f"best.{mean}").alias("peak_mean"))


def top_groups(df: DataFrame, group: str, value: str, n: int = 25) -> DataFrame:
    """The n groups with the highest mean, the placeholder group left out."""
    df = nan_as_null(df, [value])
    means = df.filter(F.col(group) != PLACEHOLDER).groupBy(group).agg(F.avg(value).alias("mean"))
    return means.orderBy(F.desc("mean"), F.asc(group)).limit(n)


def group_distribution(df: DataFrame, group: str, value: str, probs: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Rows, mean and quantiles of the known values per group, the placeholder group left out."""
    df = nan_as_null(df, [value])
    kept = df.filter((F.col(group) != PLACEHOLDER) & F.col(value).isNotNull()).select(group, value)
    moments = kept.groupBy(group).agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.min(value).alias("min"), F.max(value).alias("max")
    )
    return moments.join(exact_quantiles(kept, value, probs, [group]), group)


def skewness(x: str) -> Column:
    """Bias-corrected sample skewness."""
    n = F.count(x).cast("double")
    return F.when(n > 2, F.skewness(x) * F.sqrt(n * (n - 1)) / (n - 2))


def summary(df: DataFrame, value: str) -> DataFrame:
    """min, mean, median, max and skewness of one column."""
    df = nan_as_null(df, [value])
    median = quantile_values(df, value, [0.5])
    return df.agg(
        F.min(value).alias("min"),
        F.avg(value).alias("mean"),
        F.lit(median[0] if median else None).cast("double").alias("median"),
        F.max(value).alias("max"),
        skewness(value).alias("skew"),
    )


def tercile_boundaries(df: DataFrame, value: str) -> tuple[float, float]:
    """The 1/3 and 2/3 quantiles of the known values."""
    low, high = quantile_values(df, value, [1 / 3, 2 / 3])
    return low, high


def label_frame(df: DataFrame, column: str = "label") -> DataFrame:
    """The three labels with their order, as a table."""
    return df.sparkSession.createDataFrame([(x, i) for i, x in enumerate(LABELS)], f"{column} string, label_order int")


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """Rows per label; a label that never occurs counts 0."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(F.col(label).alias("label")).count()
    return label_frame(df).join(counts, "label", "left").select(
        "label", F.coalesce("count", F.lit(0)).alias("rows")
    )


def missing_stats(df: DataFrame) -> DataFrame:
    """Per column: missing and placeholder counts and percentages, in one pass."""
    aggregates = [F.count(F.lit(1)).alias("_all")]
    for i, field in enumerate(df.schema.fields):
        x = F.col(f"`{field.name}`")
        gone = x.isNull()
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            gone = gone | F.isnan(x)
        dashes = F.count_if(x == PLACEHOLDER) if isinstance(field.dataType, T.StringType) else F.lit(0)
        aggregates += [F.count_if(gone).alias(f"_g{i}"), dashes.cast("long").alias(f"_d{i}")]
    row = df.agg(*aggregates)

    def percent(part: Column) -> Column:
        share = part / F.when(F.col("_all") > 0, F.col("_all")) * 100
        return F.bround(F.coalesce(share, F.lit(0.0)), 2)

    entries = [
        F.struct(
            F.lit(name).alias("column"),
            F.col(f"_g{i}").alias("nan_count"),
            percent(F.col(f"_g{i}")).alias("nan_pct"),
            F.col(f"_d{i}").alias("dash_count"),
            percent(F.col(f"_d{i}")).alias("dash_pct"),
        )
        for i, name in enumerate(df.columns)
    ]
    return row.select(F.inline(F.array(*entries)))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlations over pairwise complete rows: (a, b, r), both triangles and the diagonal."""
    df = nan_as_null(df, columns)
    pairs = list(combinations(columns, 2))
    both = {(a, b): F.col(a).isNotNull() & F.col(b).isNotNull() for a, b in pairs}
    row = df.agg(
        *[F.corr(F.when(both[p], F.col(p[0])), F.when(both[p], F.col(p[1]))).alias(f"_{i}") for i, p in enumerate(pairs)],
        *[F.when(F.stddev_pop(c) > 0, F.lit(1.0)).alias(f"_one{j}") for j, c in enumerate(columns)],
    )

    def entry(a: str, b: str, r: Column) -> Column:
        return F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), r.alias("r"))

    entries = [entry(c, c, F.col(f"_one{j}")) for j, c in enumerate(columns)]
    for i, (a, b) in enumerate(pairs):
        entries += [entry(a, b, F.col(f"_{i}")), entry(b, a, F.col(f"_{i}"))]
    return row.select(F.inline(F.array(*entries)))


def correlation_rank(df: DataFrame, columns: Sequence[str], target: str, n: int = 5) -> DataFrame:
    """The n columns with the strongest correlation with ``target``."""
    df = nan_as_null(df, [*columns, target])
    against = df.agg(*[F.corr(c, target).alias(c) for c in columns if c != target])
    entries = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("r")) for c in against.columns])
    listed = against.select(F.inline(entries)).filter(F.col("r").isNotNull())
    return listed.orderBy(F.desc(F.abs("r")), "feature").limit(n)


def _bin(x: Column, low: Column, high: Column, bins: int) -> Column:
    width = (high - low) / bins
    return F.when(high > low, F.least(F.lit(bins - 1), F.floor((x - low) / width))).otherwise(F.lit(0)).cast("int")


def histogram(df: DataFrame, value: str, bins: int = BINS) -> DataFrame:
    """Equal-width bins between minimum and maximum; the last one is closed, empty ones are kept."""
    df = nan_as_null(df, [value])
    known = df.filter(F.col(value).isNotNull()).select(F.col(value).cast("double").alias("_v"))
    low, high = known.agg(F.min("_v"), F.max("_v")).first()
    if low is None:
        return df.sparkSession.createDataFrame([], "bin int, bin_low double, bin_high double, rows long")
    counts = known.groupBy(_bin(F.col("_v"), F.lit(low), F.lit(high), bins).alias("bin")).count()
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    width = (high - low) / bins
    return grid.join(counts, "bin", "left").select(
        "bin",
        (F.lit(low) + F.col("bin") * width).alias("bin_low"),
        (F.lit(low) + (F.col("bin") + 1) * width).alias("bin_high"),
        F.coalesce("count", F.lit(0)).alias("rows"),
    )


def density_histogram(df: DataFrame, value: str, group: str, bins: int = BINS) -> DataFrame:
    """A histogram per group over its own range, scaled to area 1; only bins with rows."""
    df = nan_as_null(df, [value])
    known = df.filter(F.col(value).isNotNull()).select(group, F.col(value).cast("double").alias("_v"))
    ranges = known.groupBy(group).agg(
        F.min("_v").alias("_low"), F.max("_v").alias("_high"), F.count(F.lit(1)).alias("_n")
    )
    placed = dimension_join(known, reliable_checkpoint(ranges), [group], "inner", spread_by=["_v"])
    bin_ = _bin(F.col("_v"), F.col("_low"), F.col("_high"), bins).alias("bin")
    counts = placed.groupBy(group, bin_, "_low", "_high", "_n").agg(F.count(F.lit(1)).alias("rows"))
    width = (F.col("_high") - F.col("_low")) / bins
    return counts.select(
        group, "bin", "rows", (F.col("rows") / (F.col("_n") * F.when(width > 0, width))).alias("density")
    )


def quantile_bins(df: DataFrame, by: str, value: str, q: int = 10) -> DataFrame:
    """Mean of ``value`` in quantile bins of ``by``; bins are right-closed, equal edges are merged."""
    df = nan_as_null(df, [by, value])
    complete = df.filter(F.col(by).isNotNull() & F.col(value).isNotNull()).select(
        F.col(by).cast("double").alias("_b"), value
    )
    edges = sorted(set(quantile_values(complete, "_b", [i / q for i in range(q + 1)])))
    place = F.lit(0)
    for edge in edges[1:-1]:
        place = place + F.when(F.col("_b") > edge, 1).otherwise(0)
    return complete.groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("rows"), F.avg(value).alias("mean"))


def mean_by_flag(df: DataFrame, flag: str, values: Sequence[str]) -> DataFrame:
    """Means by a 0/1 column, with the count and percentage of rows where it is set."""
    df = nan_as_null(df, values)
    state = F.col(flag).cast("boolean")
    entries = []
    for v in values:
        entries += [
            F.avg(F.when(~state, F.col(v))).alias(f"{v}_off"),
            F.avg(F.when(state, F.col(v))).alias(f"{v}_on"),
        ]
    total = F.count(F.lit(1))
    set_ = F.count_if(state)
    return df.agg(*entries, set_.alias("rows_on"), (set_ / F.when(total > 0, total) * 100).alias("pct_on"))


def mean_of_means(df: DataFrame, series: Sequence[str], bucket: Column, value: str) -> DataFrame:
    """(hour, mean_pax): mean per series and bucket, then the unweighted mean of those."""
    df = nan_as_null(df, [value])
    per_series = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*series, bucket.alias("hour"))
        .agg(F.avg(value).alias("_mean"))
    )
    return per_series.groupBy("hour").agg(F.avg("_mean").alias("mean_pax"))


def fill_coverage(df: DataFrame, before: str, after: str) -> DataFrame:
    """How many rows have a value before and after the fill, and how many would be dropped."""
    df = nan_as_null(df, [before, after])
    total = F.count(F.lit(1))
    safe = F.when(total > 0, total)
    return df.agg(
        total.alias("rows"),
        F.count(before).alias("rows_before"),
        (F.count(before) / safe * 100).alias("pct_before"),
        F.count(after).alias("rows_after"),
        (F.count(after) / safe * 100).alias("pct_after"),
        (total - F.count(after)).alias("rows_dropped"),
    )


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, distinct_values): one scan, one shuffle of the distinct (column, value) pairs."""
    columns = list(columns)
    entry = [F.struct(F.lit(i).alias("i"), F.to_json(F.struct(F.col(c).alias("v"))).alias("v"),
                      F.col(c).isNull().alias("none")) for i, c in enumerate(columns)]
    pairs = df.select(F.inline(F.array(*entry))).groupBy("i", "v", "none").agg(F.lit(1).alias("_x"))
    known = pairs.groupBy("i").agg(F.count_if(~F.col("none")).alias("distinct_values"))
    names = F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("i") + 1)
    return known.select(names.alias("column"), "distinct_values")
