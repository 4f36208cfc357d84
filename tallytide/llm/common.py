"""What the operators of this subpackage share: sessions, tables, intermediate results, components."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallytide.scale import reliable_checkpoint
from tallytide.session import prepare

BATCH_ROWS = "1000"  # rows of one Arrow batch; texts are long
EDGE_ROWS = 50_000  # edges a task reads at least, so that a small graph is not read in many tiny tasks
SPACED_WORDS = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ready(spark: SparkSession) -> SparkSession:
    """The session with the package on its workers and Arrow batches small enough for long texts."""
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame) -> DataFrame:
    """Written to the shared checkpoint folder and read back, so that it outlives executors."""
    return reliable_checkpoint(df)


def free_name(columns: Sequence[str], wanted: str) -> str:
    """``wanted``, with underscores in front until no column has that name."""
    taken = {c.lower() for c in columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def same(pairs: Sequence[tuple[str, str]]) -> Column:
    """NULL-safe equality of columns."""
    return functools.reduce(lambda a, b: a & b, [F.col(x).eqNullSafe(F.col(y)) for x, y in pairs])


def components(edges: DataFrame, a: Sequence[str], b: Sequence[str]) -> DataFrame:
    """Connected components of an undirected graph: columns ``v`` and ``root`` for each vertex with an edge.

    Vertices are structs (``c0``, ``c1``, ...) of the given columns; ``root`` is the smallest vertex of the component.
    Every round links each vertex to the smallest root among its neighbours' roots and then
    jumps to the root's root, so that the number of rounds grows with the logarithm of the
    diameter. Only aggregates and equi-joins; every round is saved, nothing is collected.
    """
    def vertex(columns):
        return F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)])

    pair = edges.select(vertex(a).alias("x"), vertex(b).alias("y")).filter("x <> y")
    both = saved(pair.unionByName(pair.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct())
    parts = both.count() // EDGE_ROWS + 1  # vertices are no more than these rows
    both = both.coalesce(parts)
    least = both.groupBy(F.col("x").alias("v")).agg(F.least(F.min("y"), F.first("x")).alias("root"))
    state = saved(least).coalesce(parts)
    while True:
        # the smallest root around each vertex
        around = (
            both.join(state.select(F.col("v").alias("y"), "root"), "y")
            .groupBy(F.col("x").alias("v"))
            .agg(F.min("root").alias("near"))
        )
        seen = state.join(around, "v").select("v", "root", F.least("root", "near").alias("near"))
        # hook: the old root learns of it too
        hooks = seen.filter("near < root").groupBy(F.col("root").alias("v")).agg(F.min("near").alias("hook"))
        linked = seen.join(hooks, "v", "left").select("v", "root", F.least("near", "hook").alias("next"))
        # jump: root of the root
        above = linked.select(F.col("v").alias("next"), F.col("next").alias("top"))
        jumped = saved(linked.join(above, "next", "left").select(
            "v", F.col("root").alias("was"), F.least("next", "top").alias("root"))).coalesce(parts)
        if jumped.filter("root <> was").isEmpty():
            return jumped.select("v", "root")
        state = jumped.select("v", "root")
