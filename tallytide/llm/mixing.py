"""Mixing sources to target weights: hash-random order within each source, cut at the exact budget.

Rows get a hash-random key, are range-partitioned on (source, key) so that a source of any size
lies over many tasks, and running sums of sizes come from sums per partition. A source whose
target exceeds its size is repeated whole, then cut in the last round.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallytide.llm.common import SPACED_WORDS, free_name, ready, saved

WEIGHTS, SHARE, EPOCHS = (3, 1, 2), 1.5, 2


def running_before(df: DataFrame, group: str, order: Sequence[str], value: str, name: str) -> DataFrame:
    """Add the sum of ``value`` over the earlier rows of the group; no group is gathered in one task."""
    order = list(order)
    place = free_name(df.columns, "_place")
    placed = df.repartitionByRange(F.asc_nulls_last(group), *[F.asc(c) for c in order])
    placed = saved(placed.withColumn(place, F.spark_partition_id()))
    sums = placed.groupBy(group, place).agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy(group).orderBy(place).rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    starts = sums.select(
        F.col(group).alias("_group"), F.col(place).alias("_at"),
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(group, place).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = placed.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    joined = summed.join(starts, F.col(group).eqNullSafe(F.col("_group")) & (F.col(place) == F.col("_at")))
    return joined.withColumn(name, F.col("_start") + F.col("_inside")).select(*df.columns, name)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(SPACED_WORDS)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS
                   ) -> DataFrame:
    """Add ``target`` to (source, source_size): weights in turn by code point of the source, NULL last.

    The total is ``share`` of all sizes; no target exceeds ``epochs`` times the source's size,
    what exceeds it is shared anew among the others by weight.
    """
    ranked = running_before(sizes.withColumn("_all", F.lit(0)).withColumn("_one", F.lit(1)), "_all", ["_last", "source"]
                            if "_last" in sizes.columns else ["source"], "_one", "_rank")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    table = saved(ranked.select("source", "source_size", weight.alias("_weight"),
                                (F.col("source_size") * float(epochs)).alias("_cap")))
    whole = table.agg(F.sum("source_size").alias("size"), F.sum("_weight").alias("weight")).first()
    total = share * (whole["size"] or 0)
    rate = total / whole["weight"] if whole["weight"] else 0.0
    while True:  # the rate only rises, so what is capped stays capped
        above = F.col("_weight") * F.lit(rate) > F.col("_cap")
        state = table.agg(
            F.sum(F.when(above, F.col("_cap"))).alias("capped"), F.sum(F.when(~above, F.col("_weight"))).alias("free")
        ).first()
        after = (total - (state["capped"] or 0.0)) / state["free"] if state["free"] else rate
        if after <= rate:
            break
        rate = after
    return table.select("source", "source_size", F.least("_cap", F.col("_weight") * F.lit(rate)).alias("target"))


def mix_plan(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    weights: Sequence[float] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS,
) -> DataFrame:
    """One row per text: its id, ``tie`` (a hash of the text), ``size`` in words, ``source_size``, ``target``, ``taken``.

    ``taken`` counts the words the mix takes of a text, repeats included; the text at the cut is
    taken in part, so that the words of a source add up to its target rounded down. NULL and
    empty texts have size 0. Rows with equal id and text are interchangeable. An empty table
    gives an empty plan. Other columns are not read.
    """
    ready(docs.sparkSession)
    key = F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    sized = saved(docs.select(
        F.col(doc_id).alias("id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"),
        key.alias("key"), F.xxhash64(F.col(text)).alias("tie")))
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    sizes = sizes.withColumn("_last", F.col("source").isNull())
    targets = source_targets(sizes, weights, share, epochs)
    targets = targets.select(F.col("source").alias("_source"), "source_size", "target")
    ordered = running_before(sized, "source", ["key", "tie"], "size", "before")
    plan = ordered.join(targets, F.col("source").eqNullSafe(F.col("_source")))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    rest = F.floor(F.col("target") - whole * F.col("source_size")).cast("long")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("before")))
    return plan.select(
        F.col("id").alias(doc_id), "tie", "size", "source_size", "target",
        (whole * F.col("size") + part).cast("long").alias("taken"))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The rows of ``docs`` that the mix takes, with ``taken`` words each (see :func:`mix_plan`); the rest go.

    A column ``taken`` of ``docs`` is replaced.
    """
    plan = mix_plan(docs, doc_id, text, source, **options)
    columns = [c for c in docs.columns if c != "taken"]
    alike = Window.partitionBy("_id", "_tie").orderBy("taken")
    chosen = plan.select(F.col(doc_id).alias("_id"), F.col("tie").alias("_tie"), "taken").withColumn(
        "_copy", F.row_number().over(alike))
    row = F.struct(*[F.col(f"`{c}`") for c in columns])
    rows = docs.select(row.alias("_row"), F.col(doc_id).alias("_id2"), F.xxhash64(F.col(text)).alias("_tie2"))
    same_rows = Window.partitionBy("_id2", "_tie2").orderBy(F.lit(0))
    rows = rows.withColumn("_copy2", F.row_number().over(same_rows))
    met = rows.join(chosen, F.col("_id2").eqNullSafe(F.col("_id")) & (F.col("_tie2") == F.col("_tie"))
                    & (F.col("_copy2") == F.col("_copy")))
    return met.filter("taken > 0").select(*[F.col(f"_row.`{c}`").alias(c) for c in columns], "taken")
