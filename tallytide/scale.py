"""Size bounds, size-checked joins and lineage cuts shared by the operators.

Two bounds decide between the short plan and the one for very large or very
uneven inputs. Both are session settings, so a cluster can raise them and a
test can lower them:

``spark.tallytide.taskRows``
    rows one task may have to sort or aggregate for a single group.
``spark.tallytide.broadcastBytes``
    estimated size up to which a table may be broadcast.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TASK_ROWS = "spark.tallytide.taskRows"
BROADCAST_BYTES = "spark.tallytide.broadcastBytes"
_DEFAULTS = {TASK_ROWS: 5_000_000, BROADCAST_BYTES: 64 * 1024 * 1024}

_SALT, _SALTS = "_salt", "_salts"
_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def bound(spark: SparkSession, name: str) -> int:
    return int(spark.conf.get(name, str(_DEFAULTS[name])))


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see; a local one only where there is one machine, as in tests."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named is None and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
    return (named or tempfile.gettempdir()).rstrip("/")


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Cut lineage through the shared checkpoint folder, which outlives executors."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(f"{shared_folder(df.sparkSession)}/tallytide-checkpoints")
    return df.checkpoint(eager=True)


def released_checkpoint(df: DataFrame) -> DataFrame:
    """A checkpoint whose shuffle files go once it is written."""
    conf = df.sparkSession.conf
    before = conf.get(_RELEASE, None)
    conf.set(_RELEASE, "true")
    try:
        return reliable_checkpoint(df)
    finally:
        conf.unset(_RELEASE) if before is None else conf.set(_RELEASE, before)


def null_safe_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left", sized: bool = False
) -> DataFrame:
    """Join on equal keys where NULL equals NULL; ``right`` is broadcast if it is proven small.

    ``sized``: ``right`` comes from ``small_or_shuffled`` and need not be counted again.
    """
    tag = uuid.uuid4().hex[:8]
    renamed = right.withColumnsRenamed({c: f"_{tag}_{c}" for c in on})
    condition: Column = F.lit(True)
    for name in on:
        condition = condition & left[f"`{name}`"].eqNullSafe(renamed[f"`_{tag}_{name}`"])
    joined = left.join(renamed if sized else small_or_shuffled(renamed), condition, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"_{tag}_{c}" for c in on])


def small_or_shuffled(df: DataFrame, width: int | None = None) -> DataFrame:
    """Marked for broadcast where its size has been checked, else left to a shuffle."""
    return F.broadcast(df) if fits_broadcast(df, width) else df


def row_width(df: DataFrame, array_items: int = 64) -> int:
    """A generous guess of the bytes of one row; arrays count ``array_items`` items."""
    width = 0
    for field in df.schema.fields:
        kind = field.dataType.simpleString()
        if kind.startswith("array"):
            width += 16 * array_items
        else:
            width += 64 if kind == "string" else 24
    return width


def fits_broadcast(df: DataFrame, width: int | None = None) -> bool:
    """True when ``df`` is proven small, by a count: one number from each partition."""
    return df.count() * (width or row_width(df)) <= bound(df.sparkSession, BROADCAST_BYTES)


def dimension_join(
    fact: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    how: str = "left",
    spread_by: Sequence[str] = (),
    width: int | None = None,
) -> DataFrame:
    """Join a table with one row per key onto a large one.

    A small ``dim`` is broadcast. Otherwise both sides are shuffled on the key,
    and keys with more rows than one task may hold are split over several
    salts: the fact row picks its salt from ``spread_by`` and the few matching
    dimension rows are repeated once per salt. Rows with a NULL key match nothing
    but are spread in the same way.
    """
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how!r}")
    on = list(on)
    if fits_broadcast(dim, width):
        return fact.join(F.broadcast(dim), on, how)

    limit = bound(fact.sparkSession, TASK_ROWS)
    hot = (
        fact.groupBy(*on)
        .count()
        .filter(F.col("count") > limit)
        .select(*on, F.ceil(F.col("count") / limit).cast("int").alias(_SALTS))
    )
    hot = reliable_checkpoint(hot)  # at most total rows / limit entries
    if hot.isEmpty():
        return fact.join(dim, on, how)
    spread = list(spread_by) or [c for c in fact.columns if c not in on]
    salted_fact = (
        null_safe_join(fact, hot, on)
        .withColumn(_SALT, F.coalesce(F.pmod(F.xxhash64(*spread), F.col(_SALTS)), F.lit(0)).cast("int"))
        .drop(_SALTS)
    )
    salted_dim = (
        null_safe_join(dim, hot, on)
        .withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(_SALTS), F.lit(1)) - 1)))
        .drop(_SALTS)
    )
    return salted_fact.join(salted_dim, [*on, _SALT], how).drop(_SALT)
