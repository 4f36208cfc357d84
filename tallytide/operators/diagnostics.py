"""Autocorrelation and stationarity of every series at once."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallytide.functions.scalars import known
from tallytide.operators.layout import (
    BLOCK,
    CHUNK,
    OWN,
    Layout,
    blocks,
    look_back,
    plan_layout,
    positions,
    tag_chunks,
)
from tallytide.operators.quantiles import exact_quantiles
from tallytide.scale import dimension_join, reliable_checkpoint
from tallytide.series import SeriesSpec

MIN_TEST_ROWS = 20
_EXPRESSION_LAGS = 64
_SLICE = 65_536
_DEPENDENT = 1e-7  # share of a column that those before it leave, below which a fit needs the pseudo-inverse

# KPSS level critical values with their p-values.
_KPSS_TABLE = ((0.347, 0.10), (0.463, 0.05), (0.574, 0.025), (0.739, 0.01))
# MacKinnon (1994) response surface, constant only.
_TAU_SPLIT, _TAU_MIN, _TAU_MAX = -1.61, -18.83, 2.74
_TAU_SMALL = (2.1659, 1.4412, 0.038269)
_TAU_LARGE = (1.7339, 0.93202, -0.12745, -0.010368)

STATIONARY, NON_STATIONARY = "STATIONARY", "NON-STATIONARY"
TREND_STATIONARY, INCONCLUSIVE = "TREND-STATIONARY", "INCONCLUSIVE"


def _known(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Key, order and the known values as ``_y``."""
    value = F.col(spec.value).cast("double").alias("_y")
    return df.filter(known(df, spec.value).isNotNull()).select(*dict.fromkeys([*spec.key, *spec.order_by]), value)


def _demeaned(rows: DataFrame, spec: SeriesSpec, layout: Layout) -> DataFrame:
    """Add ``_n``, ``_mean`` and ``_d``, the deviation from the series mean."""
    if layout.split:
        means = rows.groupBy(*spec.key).agg(F.count("_y").alias("_n"), F.avg("_y").alias("_mean"))
        rows = dimension_join(rows, reliable_checkpoint(means), spec.key, "inner", spread_by=spec.order_by)
    else:
        # in the order of the later windows, so that the rows are sorted once
        whole = layout.window().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        rows = rows.withColumns({"_n": F.count("_y").over(whole), "_mean": F.avg("_y").over(whole)})
    return rows.withColumn("_d", F.col("_y") - F.col("_mean"))


def _sum_arrays(df: DataFrame, key: list[str], column: str) -> DataFrame:
    """Element-wise sum of one array column per key."""
    items = df.select(*key, F.posexplode(column).alias("_i", "_x"))
    sums = items.groupBy(*key, "_i").agg(F.sum("_x").alias("_x"))
    ordered = F.array_sort(F.collect_list(F.struct("_i", "_x")))
    return sums.groupBy(*key).agg(F.transform(ordered, lambda s: s["_x"]).alias(column))


def autocovariances(
    df: DataFrame, spec: SeriesSpec, max_lag: int, layout: Layout | None = None, partial_sums: bool = False
) -> DataFrame:
    """(key, n, mean, gamma): biased autocovariances for lags 0..max_lag of the known values.

    ``partial_sums`` adds ``squares``, the sum of the squared running sums of deviations.
    """
    rows = _known(df, spec)
    layout = layout or plan_layout(rows, spec)
    centred = _demeaned(rows, spec, layout)
    key = [*spec.key]
    if partial_sums and (layout.split or max_lag > _EXPRESSION_LAGS):
        found = autocovariances(rows, spec.of("_y"), max_lag, layout)
        return found.join(_partial_sum_squares(rows, spec, layout), key)
    if max_lag <= _EXPRESSION_LAGS:
        names = [f"_l{k}" for k in range(1, max_lag + 1)]

        def add(frame: DataFrame, part: list[str], order: list[str]) -> DataFrame:
            along = Window.partitionBy(*part).orderBy(*order)
            lags = {f"_l{k}": F.lag("_d", k).over(along) for k in range(1, max_lag + 1)}
            upto = along.rowsBetween(Window.unboundedPreceding, 0)
            return frame.withColumns({**lags, **({"_s": F.sum("_d").over(upto)} if partial_sums else {})})

        lagged = look_back(centred, layout, max(max_lag, 1), add)
        n = F.first("_n")
        products = [F.sum(F.col("_d") * F.col("_d"))] + [F.sum(F.col("_d") * F.col(c)) for c in names]
        gamma = F.array(*[F.coalesce(p, F.lit(0.0)) / n for p in products])
        extra = [F.sum(F.col("_s") * F.col("_s")).alias("squares")] if partial_sums else []
        return lagged.groupBy(*key).agg(n.alias("n"), F.first("_mean").alias("mean"), gamma.alias("gamma"), *extra)

    schema = T.StructType(
        [centred.schema[c] for c in key]
        + [T.StructField("n", T.LongType()), T.StructField("mean", T.DoubleType())]
        + [T.StructField("gamma", T.ArrayType(T.DoubleType()))]
    )

    def products(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_pos")
        d, own = pdf["_d"].to_numpy(), pdf["_own"].to_numpy()
        sums = [float(np.dot(d[k:][own[k:]], d[: len(d) - k][own[k:]])) if k < len(d) else 0.0
                for k in range(max_lag + 1)]
        head = pdf.iloc[[0]]
        return pd.DataFrame(
            {**{c: head[c] for c in key}, "n": head["_n"], "mean": head["_mean"], "gamma": [sums]}
        )

    placed = blocks(centred, layout, max_lag).select(*key, BLOCK, "_pos", OWN, "_d", "_n", "_mean")
    parts = placed.groupBy(*key, BLOCK).applyInPandas(products, schema)
    sizes = parts.groupBy(*key).agg(F.first("n").alias("n"), F.first("mean").alias("mean"))
    total = _sum_arrays(parts, key, "gamma") if layout.split else parts.select(*key, "gamma")
    return sizes.join(total, key).withColumn("gamma", F.transform("gamma", lambda g: g / F.col("n")))


def acf(
    df: DataFrame, spec: SeriesSpec, max_lag: int, min_rows: int = 0, layout: Layout | None = None
) -> DataFrame:
    """(key, n, lag, acf, bound, significant) for lags 1..max_lag, at most n/2 - 1.

    ``bound`` is 1.96 / sqrt(n). Series shorter than ``min_rows`` are left out.
    """
    found = autocovariances(df, spec, max_lag, layout).filter(F.col("n") >= min_rows)
    lags = found.select(*spec.key, "n", F.posexplode("gamma").alias("lag", "g"), F.get("gamma", 0).alias("g0"))
    usable = lags.filter((F.col("lag") >= 1) & (F.col("lag") <= F.floor(F.col("n") / 2) - 1))
    value = F.col("g") / F.when(F.col("g0") > 0, F.col("g0"))
    limit = 1.96 / F.sqrt("n")
    return usable.select(
        *spec.key, "n", "lag", value.alias("acf"), limit.alias("bound"), (F.abs(value) > limit).alias("significant")
    )


def _levinson_durbin(gamma: np.ndarray) -> np.ndarray:
    """Partial autocorrelations from autocovariances."""
    order = len(gamma) - 1
    out = np.full(order + 1, np.nan)
    out[0] = 1.0
    if order == 0 or not gamma[0] > 0:
        return out
    phi, spread = np.zeros(0), gamma[0]
    for k in range(1, order + 1):
        reflection = (gamma[k] - phi @ gamma[k - 1 : 0 : -1]) / spread if spread > 0 else np.nan
        phi = np.append(phi - reflection * phi[::-1], reflection)
        spread *= 1 - reflection**2
        out[k] = reflection
    return out


def _pacf_array(gammas: pd.Series) -> pd.Series:
    return gammas.map(lambda g: _levinson_durbin(np.asarray(g, dtype=float)))


def pacf(
    df: DataFrame, spec: SeriesSpec, max_lag: int, min_rows: int = 0, layout: Layout | None = None
) -> DataFrame:
    """(key, n, lag, pacf, bound, significant): Yule-Walker partial autocorrelations."""
    found = autocovariances(df, spec, max_lag, layout).filter(F.col("n") >= min_rows)
    usable = F.slice("gamma", 1, F.least(F.size("gamma"), F.greatest(F.floor(F.col("n") / 2), F.lit(1))).cast("int"))
    solve = F.pandas_udf(_pacf_array, T.ArrayType(T.DoubleType()))
    values = found.select(*spec.key, "n", F.posexplode(solve(usable)).alias("lag", "pacf"))
    limit = 1.96 / F.sqrt("n")
    return values.filter(F.col("lag") >= 1).select(
        *spec.key, "n", "lag", "pacf", limit.alias("bound"), (F.abs("pacf") > limit).alias("significant")
    )


def suggested_order(partial: DataFrame, key: list[str]) -> DataFrame:
    """The last significant lag of each series, 0 if there is none."""
    last = F.max(F.when(F.col("significant"), F.col("lag")))
    return partial.groupBy(*key).agg(F.coalesce(last, F.lit(0)).alias("p"))


def _longest(rows: DataFrame, spec: SeriesSpec) -> int:
    return rows.groupBy(*spec.key).count().agg(F.max("count")).first()[0] or 0


def kpss(
    df: DataFrame,
    spec: SeriesSpec,
    min_rows: int = MIN_TEST_ROWS,
    layout: Layout | None = None,
    longest: int | None = None,
) -> DataFrame:
    """(key, n, kpss_stat, kpss_p, kpss_lag): level stationarity with the automatic lag of Hobijn et al.

    ``longest``: known values of the longest series, counted if not given.
    """
    rows = _known(df, spec)
    layout = layout or plan_layout(rows, spec)
    key = [*spec.key]
    longest = _longest(rows, spec) if longest is None else longest
    # enough lags for the rule itself and for the lag it usually picks
    first_lags = max(1, int(longest ** (2 / 9) + 1e-9), min(_EXPRESSION_LAGS, int(1.5 * longest ** (1 / 3))))
    found = reliable_checkpoint(autocovariances(rows, spec.of("_y"), first_lags, layout, True))

    m = F.floor(F.pow(F.col("n").cast("double"), F.lit(2 / 9)) + 1e-9)
    early = F.filter(F.col("gamma"), lambda g, i: (i >= 1) & (i <= m))

    def weighted(weight: Callable[[Column], Column]) -> Column:
        terms = F.transform(early, lambda g, i: g * weight(i + 1))
        return F.aggregate(terms, F.lit(0.0), lambda a, t: a + t)

    s0 = F.get("gamma", 0) + 2 * weighted(lambda i: F.lit(1.0))
    s1 = 2 * weighted(lambda i: i.cast("double"))
    rate = 1.1447 * F.pow(F.pow(s1 / F.when(s0 != 0, s0), 2), F.lit(1 / 3))
    auto = F.floor(rate * F.pow(F.col("n").cast("double"), F.lit(1 / 3)))
    lags = found.filter(F.col("n") >= min_rows).select(
        *key, "n", F.greatest(F.least(F.coalesce(auto, F.lit(0)), F.col("n") - 1), F.lit(0)).cast("int").alias("kpss_lag")
    )
    needed = lags.agg(F.max("kpss_lag")).first()[0] or 0
    wide = found if needed <= first_lags else autocovariances(rows, spec.of("_y"), needed, layout)
    joined = lags.join(wide.select(*key, "gamma"), key).join(found.select(*key, "squares"), key)
    bartlett = F.transform("gamma", lambda g, i: F.when(
        (i >= 1) & (i <= F.col("kpss_lag")), g * (1 - i / (F.col("kpss_lag") + 1))).otherwise(F.lit(0.0)))
    long_run = F.get("gamma", 0) + 2 * F.aggregate(bartlett, F.lit(0.0), lambda a, t: a + t)
    stat = F.col("squares") / (F.pow(F.col("n").cast("double"), F.lit(2)) * F.when(long_run > 0, long_run))
    return joined.select(*key, "n", stat.alias("kpss_stat"), "kpss_lag").withColumn(
        "kpss_p", kpss_p_value(F.col("kpss_stat"))
    )


def _partial_sum_squares(rows: DataFrame, spec: SeriesSpec, layout: Layout) -> DataFrame:
    """Sum of the squared running sums of deviations; a running sum may cross chunks."""
    tagged = tag_chunks(_demeaned(rows, spec, layout), layout)
    upto = Window.partitionBy(*layout.part).orderBy(*spec.order_by).rowsBetween(Window.unboundedPreceding, 0)
    per_chunk = tagged.withColumn("_s", F.sum("_d").over(upto)).groupBy(*layout.part).agg(
        F.count("_d").alias("_c"),
        F.sum("_d").alias("_total"),
        F.sum("_s").alias("_s1"),
        F.sum(F.col("_s") * F.col("_s")).alias("_s2"),
    )
    if not layout.split:
        return per_chunk.select(*spec.key, F.col("_s2").alias("squares"))
    before = Window.partitionBy(*spec.key).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("_total").over(before), F.lit(0.0))
    squares = F.col("_c") * F.col("_p") * F.col("_p") + 2 * F.col("_p") * F.col("_s1") + F.col("_s2")
    return per_chunk.withColumn("_p", start).groupBy(*spec.key).agg(F.sum(squares).alias("squares"))


def kpss_p_value(stat: Column) -> Column:
    """Interpolated p-value, cut off at the ends of the table."""
    value = F.when(stat <= _KPSS_TABLE[0][0], F.lit(_KPSS_TABLE[0][1]))
    for (x0, p0), (x1, p1) in zip(_KPSS_TABLE, _KPSS_TABLE[1:]):
        value = value.when(stat <= x1, p0 + (stat - x0) * ((p1 - p0) / (x1 - x0)))
    return F.when(stat.isNotNull(), value.otherwise(F.lit(_KPSS_TABLE[-1][1])))


# --- regressions over lagged values ---------------------------------------------------------


def lagged_gram(
    df: DataFrame,
    spec: SeriesSpec,
    depth: Column,
    max_depth: int,
    difference: int,
    level: bool,
    layout: Layout,
) -> DataFrame:
    """(key, n, depth, used, gram, head, tail): cross products of lagged values, summed over each series.

    With w the ``difference``-times differenced series, the row of time t is
    ``1, [y(t-1),] w(t), w(t-1), ..., w(t-depth)``, over all t that have it.
    Any least-squares fit on these columns follows from the matrix alone, so
    the series is read once, in blocks, however many models are tried. ``head``
    and ``tail`` are the first and last ``max_depth + difference + 1`` values.
    """
    key = [*spec.key]
    reach = max_depth + difference
    sized = positions(_known(df, spec), layout, "_at", "n").withColumn("depth", depth.cast("int"))
    placed = blocks(sized, layout, reach).select(*key, BLOCK, OWN, "_pos", "n", "depth", "_y")
    schema = T.StructType(
        [placed.schema[c] for c in key]
        + [T.StructField("n", T.LongType()), T.StructField("depth", T.IntegerType())]
        + [T.StructField("used", T.LongType()), placed.schema[BLOCK]]
        + [T.StructField(c, T.ArrayType(T.DoubleType())) for c in ("gram", "head", "tail")]
    )

    def cross_products(rows: pa.Table) -> pa.Table:  # a group is small next to the cost of a data frame
        order = np.argsort(rows["_pos"].to_numpy(), kind="stable")
        y, own = rows["_y"].to_numpy()[order], rows[OWN].to_numpy()[order]
        deep = rows["depth"][0].as_py()
        first = deep + difference
        size = 2 + deep + int(level)
        total, used = np.zeros((size, size)), 0
        w = np.diff(y, n=difference)
        for at in range(first, len(y), _SLICE):
            stop = min(len(y), at + _SLICE)
            windows = np.lib.stride_tricks.sliding_window_view(w[at - first : stop - difference], deep + 1)
            columns = [np.ones((stop - at, 1))]
            if level:
                columns.append(y[at - 1 : stop - 1, None])
            columns.append(windows[:, ::-1])
            z = np.hstack(columns)[own[at:stop]]
            total += z.T @ z
            used += len(z)
        head = rows.slice(0, 1)
        lists = [pa.array([x], pa.list_(pa.float64())) for x in (total.ravel(), y[: reach + 1], y[-(reach + 1) :])]
        return pa.table([*(head[c] for c in [*key, "n", "depth"]), pa.array([used], pa.int64()), head[BLOCK], *lists],
                        names=schema.names)

    parts = placed.groupBy(*key, BLOCK).applyInArrow(cross_products, schema)
    if not layout.split:
        return parts.drop(BLOCK)
    sizes = parts.groupBy(*key).agg(
        F.first("n").alias("n"),
        F.first("depth").alias("depth"),
        F.sum("used").alias("used"),
        F.min_by("head", BLOCK).alias("head"),
        F.max_by("tail", BLOCK).alias("tail"),
    )
    return sizes.join(_sum_arrays(parts, key, "gram"), key)


def least_squares(gram: np.ndarray, target: int, regressors: list[int]) -> tuple[np.ndarray, float, np.ndarray]:
    """Coefficients, residual sum of squares and inverse cross product from a cross-product matrix."""
    a = gram[np.ix_(regressors, regressors)]
    b = gram[regressors, target]
    scale = np.sqrt(np.where(np.diag(a) > 0, np.diag(a), 1.0))
    inverse = np.linalg.pinv(a / np.outer(scale, scale), rcond=1e-12, hermitian=True) / np.outer(scale, scale)
    beta = inverse @ b
    residual = gram[target, target] - 2 * beta @ b + beta @ a @ beta
    return beta, max(float(residual), 0.0), inverse


def nested_residuals(gram: np.ndarray, target: int, regressors: list[int]) -> np.ndarray | None:
    """Residual sums of squares on the first 0, 1, 2, ... regressors, all from one factorisation.

    None where the columns are too nearly dependent for that; :func:`least_squares` then decides.
    """
    columns = [*regressors, target]
    a = gram[np.ix_(columns, columns)]
    scale = np.sqrt(np.diag(a))
    if not (np.isfinite(scale).all() and (scale > 0).all()):
        return None
    try:
        root = np.linalg.cholesky(a / np.outer(scale, scale))
    except np.linalg.LinAlgError:
        return None
    if np.diag(root).min() ** 2 < _DEPENDENT:
        return None
    explained = np.concatenate([[0.0], np.cumsum(root[-1, :-1] ** 2)])
    return (1.0 - explained) * scale[-1] ** 2


def near_best(criterion: np.ndarray, used: int) -> np.ndarray:
    """Whether a criterion of ``used`` rows may be the smallest, given the rounding of ``nested_residuals``."""
    return criterion <= criterion.min() + 1e-3 + 1e-7 * used


def _normal_cdf(x: float) -> float:
    return 0.5 * (1 + math.erf(x / math.sqrt(2)))


def mackinnon_p(tau: float) -> float:
    """Approximate p-value of the unit-root statistic, constant only."""
    if tau > _TAU_MAX:
        return 1.0
    if tau < _TAU_MIN:
        return 0.0
    powers = _TAU_SMALL if tau <= _TAU_SPLIT else _TAU_LARGE
    return _normal_cdf(sum(c * tau**i for i, c in enumerate(powers)))


def _fit_adf(gram: np.ndarray, used: int, deep: int, head: np.ndarray) -> tuple[float, float, int]:
    """Statistic, p-value and lag: the lag by AIC on the common sample, then refitted on all rows it allows."""
    target, base = 2, [0, 1]  # columns: 1, y(t-1), dy(t), dy(t-1), ...
    best_lag, best_aic = 0, math.inf
    lags = np.arange(deep + 1)
    nested = nested_residuals(gram, target, base + list(range(3, 3 + deep)))
    if nested is not None and used > deep + 2:
        lags = lags[near_best(used * np.log(nested[2:] / used) + 2 * (2 + lags), used)]
    for lag in lags.tolist():
        columns = base + list(range(3, 3 + lag))
        _, rss, _ = least_squares(gram, target, columns)
        if rss <= 0 or used <= len(columns):
            continue
        aic = used * math.log(rss / used) + 2 * len(columns)
        if aic < best_aic:
            best_lag, best_aic = lag, aic
    columns = base + list(range(3, 3 + best_lag))
    steps = np.diff(head)
    rows = []
    for t in range(best_lag + 1, deep + 1):  # rows the common sample leaves out
        row = np.zeros(gram.shape[0])
        row[0], row[1] = 1.0, head[t - 1]
        row[2 : 3 + best_lag] = steps[t - 1 - best_lag : t][::-1]
        rows.append(row)
    full = gram + sum((np.outer(r, r) for r in rows), np.zeros_like(gram))
    count = used + len(rows)
    beta, rss, inverse = least_squares(full, target, columns)
    freedom = count - len(columns)
    if freedom <= 0 or rss <= 0:
        return math.nan, math.nan, best_lag
    error = math.sqrt(rss / freedom * inverse[1, 1])
    tau = float(beta[1] / error) if error > 0 else math.nan
    return tau, mackinnon_p(tau) if not math.isnan(tau) else math.nan, best_lag


def adf(
    df: DataFrame,
    spec: SeriesSpec,
    min_rows: int = MIN_TEST_ROWS,
    max_lag: int | None = None,
    layout: Layout | None = None,
    longest: int | None = None,
) -> DataFrame:
    """(key, n, adf_stat, adf_p, adf_lag): augmented Dickey-Fuller test with a constant.

    ``longest``: known values of the longest series, counted if not given.
    """
    rows = _known(df, spec)
    layout = layout or plan_layout(rows, spec)
    key = [*spec.key]
    longest = _longest(rows, spec) if longest is None else longest

    n = F.col("n").cast("double")
    rule = F.ceil(12 * F.pow(n / 100, F.lit(0.25)))
    depth = F.greatest(F.least(F.lit(max_lag) if max_lag is not None else rule, F.floor(n / 2) - 2), F.lit(0))
    deepest = max_lag if max_lag is not None else math.ceil(12 * (max(longest, 1) / 100) ** 0.25)
    grams = lagged_gram(rows, spec.of("_y"), depth, max(deepest, 1), 1, True, layout)
    ready = grams.filter(F.col("n") >= min_rows)
    schema = T.StructType(
        [ready.schema[c] for c in [*key, "n"]]
        + [T.StructField("adf_stat", T.DoubleType()), T.StructField("adf_p", T.DoubleType())]
        + [T.StructField("adf_lag", T.IntegerType())]
    )

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            fits = []
            for g, used, deep, head in zip(pdf["gram"], pdf["used"], pdf["depth"], pdf["head"]):
                size = 3 + int(deep)
                matrix = np.asarray(g, dtype=float).reshape(size, size)
                fits.append(_fit_adf(matrix, int(used), int(deep), np.asarray(head, dtype=float)[: int(deep) + 1]))
            out = pdf[[*key, "n"]].copy()
            for i, name in enumerate(("adf_stat", "adf_p", "adf_lag")):
                out[name] = [f[i] for f in fits]
            yield out

    return ready.mapInPandas(solve, schema)


def verdict(adf_p: Column, kpss_p: Column, level: float = 0.05) -> Column:
    unit_root_rejected, level_rejected = adf_p < level, kpss_p < level
    return (
        F.when(unit_root_rejected & ~level_rejected, STATIONARY)
        .when(~unit_root_rejected & level_rejected, NON_STATIONARY)
        .when(unit_root_rejected & level_rejected, TREND_STATIONARY)
        .when(adf_p.isNotNull() & kpss_p.isNotNull(), INCONCLUSIVE)
    )


def stationarity(
    df: DataFrame, spec: SeriesSpec, min_rows: int = MIN_TEST_ROWS, layout: Layout | None = None
) -> DataFrame:
    """Both tests and the verdict per series."""
    rows = _known(df, spec)
    layout = layout or plan_layout(rows, spec)
    longest = _longest(rows, spec)
    unit_root = adf(df, spec, min_rows, layout=layout, longest=longest)
    both = unit_root.join(kpss(df, spec, min_rows, layout, longest).drop("n"), [*spec.key])
    return both.withColumns(
        {
            "adf_reject": F.col("adf_p") < 0.05,
            "kpss_reject": F.col("kpss_p") < 0.05,
            "verdict": verdict(F.col("adf_p"), F.col("kpss_p")),
        }
    )


def retest_differences(df: DataFrame, spec: SeriesSpec, results: DataFrame, min_rows: int = 0) -> DataFrame:
    """Test the first differences of the series found non-stationary or trend-stationary."""
    # one row a series, written out: every pass below joins it, and both tests would be run again for each
    again = reliable_checkpoint(results.filter(F.col("verdict").isin(NON_STATIONARY, TREND_STATIONARY)).select(*spec.key))
    rows = dimension_join(_known(df, spec), again, spec.key, "left_semi", spread_by=spec.order_by)

    def add(frame: DataFrame, key: list[str], order: list[str]) -> DataFrame:
        return frame.withColumn("_step", F.col("_y") - F.lag("_y", 1).over(Window.partitionBy(*key).orderBy(*order)))

    steps = look_back(rows, plan_layout(rows, spec), 1, add).filter(F.col("_step").isNotNull())
    return stationarity(steps, spec.of("_step"), min_rows)


def verdict_counts(results: DataFrame) -> DataFrame:
    """How many series were found stationary, non-stationary (trend included) and inconclusive."""
    v = F.col("verdict")
    return results.agg(
        F.count_if(v == STATIONARY).alias("stationary"),
        F.count_if(v.isin(NON_STATIONARY, TREND_STATIONARY)).alias("non_stationary"),
        F.count_if(v == INCONCLUSIVE).alias("inconclusive"),
    )


def gap_stats(hours: DataFrame, spec: SeriesSpec, time: str, layout: Layout | None = None) -> DataFrame:
    """(key, n, mean, std, low, high, gap_median_s, gap_max_s) of a timed series."""
    def add(frame: DataFrame, key: list[str], order: list[str]) -> DataFrame:
        before = F.lag(time, 1).over(Window.partitionBy(*key).orderBy(*order))
        return frame.withColumn("_gap", F.unix_micros(F.col(time)) - F.unix_micros(before))

    gaps = look_back(hours, layout or plan_layout(hours, spec), 1, add)
    key = [*spec.key]
    stats = gaps.groupBy(*key).agg(
        F.count(spec.value).alias("n"),
        F.avg(spec.value).alias("mean"),
        F.stddev_samp(spec.value).alias("std"),
        F.min(spec.value).alias("low"),
        F.max(spec.value).alias("high"),
        (F.max("_gap") / 1e6).alias("gap_max_s"),
    )
    medians = exact_quantiles(gaps, "_gap", [0.5], key).select(*key, (F.get("q", 0) / 1e6).alias("gap_median_s"))
    return stats.join(medians, key, "left")
