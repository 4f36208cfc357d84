"""Exact quantiles and rank thresholds that do not gather a column in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallytide.scale import TASK_ROWS, bound, dimension_join, reliable_checkpoint

_MIN_ACCURACY = 10_000
_DIGITS = 4  # 65,536 ranges at a time


def exact_quantiles(
    df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (), name: str = "q"
) -> DataFrame:
    """Linearly interpolated quantiles of the known values, as one array per group.

    Up to one task's worth of rows this is the built-in exact percentile, whose
    final aggregate holds every distinct value. Above, a mergeable sketch first
    gives a narrow bracket around each quantile; the rows below a bracket are
    only counted, and just the values inside it are ranked. The result is exact.
    """
    by, probs = list(by), [float(p) for p in probs]
    clean = df.select(*by, F.col(value).cast("double").alias("_v")).filter(
        F.col("_v").isNotNull() & ~F.isnan("_v")
    )
    limit = bound(df.sparkSession, TASK_ROWS)
    if df.count() <= limit:
        exact = F.percentile("_v", F.array(*[F.lit(p) for p in probs])).alias(name)
        return clean.groupBy(*by).agg(exact) if by else clean.agg(exact)
    return _bracketed(clean, probs, by, name, limit)


def _bracketed(
    clean: DataFrame, probs: list[float], by: list[str], name: str, limit: int, widen: float = 1.0
) -> DataFrame:
    # partial sums run before the shuffle, so a frequent value travels once per task
    values = reliable_checkpoint(clean.groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("_n")))
    largest = values.groupBy(*by).agg(F.sum("_n").alias("n")).agg(F.max("n")).first()[0] or 0
    accuracy = max(_MIN_ACCURACY, -(-4 * largest // limit))
    # the sketch may be off by 1/accuracy, and interpolation needs the two ranks around p
    slack = widen * (2.0 / accuracy + 3.0 / limit)
    wanted = [min(max(p + d, 0.0), 1.0) for p in probs for d in (-slack, slack)]
    sketch = clean.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.min("_v").alias("_min"),
        F.max("_v").alias("_max"),
        F.percentile_approx("_v", wanted, accuracy).alias("_edges"),
    )
    wide = F.col("_rows") > limit  # a smaller group is its own bracket
    targets = F.array(
        *[
            F.struct(
                F.lit(i).alias("i"),
                (F.lit(p) * (F.col("_rows") - 1)).alias("at"),
                F.when(wide & F.lit(p > slack), F.get("_edges", 2 * i)).otherwise(F.col("_min")).alias("lo"),
                F.when(wide & F.lit(p < 1 - slack), F.get("_edges", 2 * i + 1)).otherwise(F.col("_max")).alias("hi"),
            )
            for i, p in enumerate(probs)
        ]
    )
    brackets = reliable_checkpoint(sketch.select(*by, targets.alias("_targets")))
    if by:
        joined = dimension_join(values, brackets, by, "inner", spread_by=["_v"])
    else:
        first = brackets.first()
        packed = F.array(*[F.struct(*[F.lit(x).alias(k) for k, x in t.asDict().items()]) for t in first[0]])
        joined = values.withColumn("_targets", packed)
    each = joined.select(*by, "_v", "_n", F.explode("_targets").alias("_t"))
    group = [*by, "_i"]
    below = each.groupBy(*by, F.col("_t.i").alias("_i")).agg(
        F.sum(F.when(F.col("_v") < F.col("_t.lo"), F.col("_n")).otherwise(0)).alias("_below")
    )
    inside = each.filter((F.col("_v") >= F.col("_t.lo")) & (F.col("_v") <= F.col("_t.hi"))).select(
        *by, F.col("_t.i").alias("_i"), F.col("_t.at").alias("_at"), "_v", "_n"
    )
    upto = Window.partitionBy(*group).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = inside.withColumn("_upto", F.sum("_n").over(upto)).join(below, group).withColumn(
        "_upto", F.col("_upto") + F.col("_below")
    )
    picked = ranked.groupBy(*group).agg(
        F.first("_at").alias("_at"),
        F.first("_below").alias("_below"),
        F.min(F.when(F.col("_upto") > F.floor("_at"), F.col("_v"))).alias("_a"),
        F.min(F.when(F.col("_upto") > F.ceil("_at"), F.col("_v"))).alias("_b"),
    )
    picked = reliable_checkpoint(picked)  # a row for each group and quantile
    missed = (F.col("_below") > F.floor("_at")) | F.col("_a").isNull() | F.col("_b").isNull()
    if not picked.filter(missed).isEmpty():  # the sketch was off by more than it promises
        return _bracketed(clean, probs, by, name, limit, widen * 16)
    share = F.col("_at") - F.floor("_at")
    value = (1 - share) * F.col("_a") + share * F.col("_b")
    rows = picked.withColumn("_q", value)
    gathered = F.transform(F.array_sort(F.collect_list(F.struct("_i", "_q"))), lambda s: s["_q"])
    return rows.groupBy(*by).agg(gathered.alias(name))


def quantile_values(df: DataFrame, value: str, probs: Sequence[float]) -> list[float]:
    """The quantiles of one column as plain numbers; empty if nothing is known."""
    row = exact_quantiles(df, value, probs).first()
    return list(row[0]) if row and row[0] else []


def smallest_hash(rows: DataFrame, digest: str, k: int, small: int = 50_000) -> str | None:
    """The k-th smallest hexadecimal digest.

    Counts by the first digits find the range that holds rank k. The search goes
    on inside that range with more digits until it is small enough to order.
    """
    if k <= 0:
        return None
    prefix, scope = "", rows.select(digest)
    while True:
        digits = len(prefix) + _DIGITS
        counts = scope.groupBy(F.substring(digest, 1, digits).alias("p")).agg(F.count(F.lit(1)).alias("n"))
        upto = F.sum("n").over(Window.orderBy("p").rowsBetween(Window.unboundedPreceding, 0))
        hit = counts.withColumn("upto", upto).filter(F.col("upto") >= k).orderBy("p").first()
        if hit is None:
            return scope.agg(F.max(digest)).first()[0]
        k -= hit["upto"] - hit["n"]
        prefix = hit["p"]
        scope = scope.filter(F.substring(digest, 1, digits) == prefix)
        if hit["n"] <= small:
            return scope.orderBy(digest).limit(k).agg(F.max(digest)).first()[0]
        if len(prefix) < digits:  # one digest repeated
            return prefix
