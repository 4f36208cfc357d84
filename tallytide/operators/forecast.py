"""Order search and forecasts of autoregressive moving-average models, for every series at once.

The innovations of a moving-average part are not observed. A long
autoregression estimates them first (Hannan and Rissanen 1982); they are then
linear in lagged values, so the cross products of lagged values contain every
(p, q) regression and one pass over the data is enough for the whole grid.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallytide.operators.diagnostics import _known, lagged_gram, least_squares, near_best, nested_residuals
from tallytide.operators.layout import Layout, plan_layout
from tallytide.series import SeriesSpec

MAX_P, MAX_Q = 20, 5

_DOUBLES = T.ArrayType(T.DoubleType())


def _long_order(max_p: int, max_q: int) -> int:
    return max(1, max_p + max_q)


def _near_best_orders(model: np.ndarray, used: int, max_p: int, max_q: int, constant: list[int]) -> np.ndarray:
    """Which (p, q) are fitted: those that may have the lowest AIC, all but (0, 0) where columns are nearly dependent.

    The regressions of one q are nested in p, so one factorisation has the residuals of them all.
    """
    every = np.ones((max_p + 1, max_q + 1), bool)
    every[0, 0] = False
    if used <= len(constant) + max_p + max_q:
        return every
    criterion = np.empty((max_p + 1, max_q + 1))
    for q in range(max_q + 1):
        first = [*constant, *range(2 + max_p, 2 + max_p + q)]
        nested = nested_residuals(model, 1, [*first, *range(2, 2 + max_p)])
        if nested is None:
            return every
        size = len(first) + np.arange(max_p + 1)
        criterion[:, q] = used * (np.log(2 * math.pi * nested[len(first):] / used) + 1) + 2 * (size + 1)
    criterion[0, 0] = math.inf
    return near_best(criterion, used) & every


def _search(gram: np.ndarray, used: int, max_p: int, max_q: int, difference: int) -> dict | None:
    """The (p, q) with the lowest AIC; (0, 0) is not a candidate."""
    long = _long_order(max_p, max_q)
    depth = long + max_q
    # columns of ``gram``: 1, w(t), w(t-1), ..., at least up to w(t-depth)
    start, _, _ = least_squares(gram, 1, [0] + list(range(2, 2 + long)))
    size = depth + 2
    gram = gram[:size, :size]
    to_model = np.zeros((size, 2 + max_p + max_q))
    for j in range(2 + max_p):
        to_model[j, j] = 1.0
    for j in range(1, max_q + 1):  # e(t-j) = w(t-j) - c - sum phi_i w(t-j-i)
        column = to_model[:, 1 + max_p + j]
        column[0] = -start[0]
        column[1 + j] += 1.0
        column[2 + j : 2 + j + long] -= start[1:]
    model = to_model.T @ gram @ to_model
    constant = [0] if difference == 0 else []
    tried = _near_best_orders(model, used, max_p, max_q, constant)
    best = None
    for p in range(max_p + 1):
        for q in range(max_q + 1):
            if not tried[p, q]:
                continue
            columns = constant + list(range(2, 2 + p)) + list(range(2 + max_p, 2 + max_p + q))
            beta, rss, _ = least_squares(model, 1, columns)
            if rss <= 0 or used <= len(columns):
                continue
            aic = used * (math.log(2 * math.pi * rss / used) + 1) + 2 * (len(columns) + 1)
            if best is None or aic < best["aic"]:
                k = len(constant)
                best = {
                    "p": p, "q": q, "aic": aic, "sigma2": rss / used,
                    "const": float(beta[0]) if constant else 0.0,
                    "phi": beta[k : k + p], "theta": beta[k + p :], "long_ar": start,
                }
    return best


def orders_for(depth: int, max_p: int, max_q: int) -> tuple[int, int]:
    """The largest orders whose search looks at most ``depth`` values back.

    The search needs p + 2q values; a long series has all orders, a short one keeps
    the moving-average part down to a quarter of the depth.
    """
    if depth >= _long_order(max_p, max_q) + max_q:
        return max_p, max_q
    q = min(max_q, depth // 4)
    return min(max_p, depth - 2 * q), q


def _first_order(gram: np.ndarray, used: int, difference: int) -> dict:
    """(1, d, 0) by least squares; without variation the last value, or the last step, is kept."""
    constant = [0] if difference == 0 else []
    beta, rss, _ = least_squares(gram, 1, [*constant, 2])
    const, phi = (float(beta[0]) if constant else 0.0), float(np.clip(beta[-1], -1.0, 1.0))
    if used == 0 and constant:
        phi = 1.0
    fits = used > len(constant) + 1 and rss > 0
    aic = used * (math.log(2 * math.pi * rss / used) + 1) + 2 * (len(constant) + 2) if fits else None
    return {"p": 1, "q": 0, "aic": aic, "sigma2": rss / used if used else None, "const": const,
            "phi": np.array([phi]), "theta": np.empty(0), "long_ar": np.array([const, phi])}


def order_search(
    df: DataFrame,
    spec: SeriesSpec,
    d: int = 1,
    max_p: int = MAX_P,
    max_q: int = MAX_Q,
    layout: Layout | None = None,
) -> DataFrame:
    """(key, n, p, d, q, aic, sigma2, const, phi, theta, long_ar, tail): the best model of each series.

    Every series with a known value has a model. The candidates of a short series stop at the
    orders its own rows can tell apart (see :func:`orders_for`); where none can be fitted,
    the model is (1, d, 0), from as many rows as there are. The AIC is that of the conditional
    regression, NULL if there is none. ``tail`` holds the last values, which is all a forecast
    needs.
    """
    rows = _known(df, spec)
    layout = layout or plan_layout(rows, spec)
    depth = _long_order(max_p, max_q) + max_q
    key = [*spec.key]
    # a fit needs twice as many rows as it has columns: n - d - depth >= 2 * (depth + 2)
    own = F.greatest(F.lit(1), F.least(F.lit(depth), F.floor((F.col("n") - d - 4) / 3)))
    grams = lagged_gram(rows, spec.of("_y"), own, depth, d, False, layout)
    kinds = [("p", T.IntegerType()), ("d", T.IntegerType()), ("q", T.IntegerType()), ("aic", T.DoubleType()),
             ("sigma2", T.DoubleType()), ("const", T.DoubleType()), ("phi", _DOUBLES), ("theta", _DOUBLES),
             ("long_ar", _DOUBLES)]
    schema = T.StructType(
        [grams.schema[c] for c in [*key, "n"]] + [T.StructField(*k) for k in kinds] + [T.StructField("tail", _DOUBLES)]
    )

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            fits = []
            for g, used, deep in zip(pdf["gram"], pdf["used"], pdf["depth"]):
                gram = np.asarray(g, dtype=float).reshape(int(deep) + 2, int(deep) + 2)
                p, q = orders_for(int(deep), max_p, max_q)
                found = _search(gram, int(used), p, q, d) if used >= 2 * (deep + 2) else None
                fits.append(found or _first_order(gram, int(used), d))
            out = pdf[[*key, "n"]].copy()
            for name, _ in kinds:
                out[name] = [d if name == "d" else f[name] for f in fits]
            out["tail"] = pdf["tail"]
            yield out

    return grams.mapInPandas(solve, schema)


def _forecast(tail: np.ndarray, d: int, const: float, phi, theta, long_ar, steps: int) -> np.ndarray:
    """Recursive point forecasts from the last values of a series."""
    levels = [tail]
    for _ in range(d):
        levels.append(np.diff(levels[-1]))
    w = list(levels[-1])
    long = len(long_ar) - 1
    errors = [0.0] * len(w)
    for t in range(long, len(w)):
        errors[t] = w[t] - long_ar[0] - float(np.dot(long_ar[1:], w[t - long : t][::-1]))
    for _ in range(steps):
        ar = sum(c * w[-1 - i] for i, c in enumerate(phi) if i < len(w))
        ma = sum(c * errors[-1 - i] for i, c in enumerate(theta) if i < len(errors))
        w.append(const + ar + ma)
        errors.append(0.0)
    out = np.asarray(w[len(levels[-1]) :])
    for level in reversed(levels[:-1]):
        out = (level[-1] if len(level) else 0.0) + np.cumsum(out)
    return out


def forecast(models: DataFrame, key: Sequence[str], steps: int) -> DataFrame:
    """(key, step, forecast) for the next ``steps`` values after each fitted series."""
    key = list(key)
    schema = T.StructType([models.schema[c] for c in key] + [T.StructField("path", _DOUBLES)])
    parts = ["tail", "d", "const", "phi", "theta", "long_ar"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = pdf[key].copy()
            out["path"] = [
                _forecast(np.asarray(tail, dtype=float), int(d), const, phi, theta, long_ar, steps)
                for tail, d, const, phi, theta, long_ar in zip(*(pdf[c] for c in parts))
            ]
            yield out

    paths = models.select(*key, *parts).mapInPandas(run, schema)
    return paths.select(*key, F.posexplode("path").alias("step", "forecast")).withColumn("step", F.col("step") + 1)
