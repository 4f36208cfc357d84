"""Where the rows of a series are processed.

Ordered work is a window over the series key: one shuffle, one task per group
of keys. That holds as long as no single series outgrows a task. ``plan_layout``
checks this; when a series is larger, its order axis is cut into chunks and the
operators work per (key, chunk), carrying the little state that crosses a cut:

* ``carry_last``   the last known value before the chunk;
* ``positions``    the number of rows before the chunk;
* ``look_back``    copies of the last few rows before the chunk.

The cuts are values of the order columns taken from a hash sample, so the chunk
of a row depends on nothing but the row: a task that is run again after an
executor is lost produces the same chunks.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallytide.scale import TASK_ROWS, bound, null_safe_join, reliable_checkpoint, small_or_shuffled
from tallytide.series import SeriesSpec

CHUNK = "_chunk"
BLOCK = "_block"
OWN = "_own"
_CUTS, _POS, _OFFSET, _TOTAL = "_cuts", "_pos", "_offset", "_total"
_SAMPLES_PER_CHUNK = 64


@dataclass(frozen=True)
class Layout:
    """The chunks of the large series; ``cuts`` is None when there are none.

    ``offsets`` holds the rows before each chunk where they are known (see ``shared``).
    """

    spec: SeriesSpec
    limit: int
    cuts: DataFrame | None = None
    offsets: DataFrame | None = None

    @property
    def split(self) -> bool:
        return self.cuts is not None

    @property
    def part(self) -> list[str]:
        """Columns that bound what one task has to sort."""
        return [*self.spec.key, CHUNK] if self.split else [*self.spec.key]

    def window(self, reverse: bool = False):
        order = [F.col(c).desc() if reverse else F.col(c).asc() for c in self.spec.order_by]
        return Window.partitionBy(*self.part).orderBy(*order)


def plan_layout(df: DataFrame, spec: SeriesSpec, limit: int | None = None) -> Layout:
    """Find series too large for one task and cut their order axis."""
    limit = limit or bound(df.sparkSession, TASK_ROWS)
    rows = df.select(*spec.key, *[c for c in spec.order_by if c not in spec.key])
    if rows.count() <= limit:
        return Layout(spec, limit)
    hot = rows.groupBy(*spec.key).count().filter(F.col("count") > limit).select(*spec.key)
    hot = reliable_checkpoint(hot)  # at most total rows / limit keys
    if hot.isEmpty():
        return Layout(spec, limit)

    rate = max(1, limit // _SAMPLES_PER_CHUNK)
    step = max(1, limit // rate)
    sample = null_safe_join(rows, hot, spec.key, "left_semi").filter(
        F.pmod(F.xxhash64(*spec.key, *spec.order_by), F.lit(rate)) == 0
    )
    ranked = sample.withColumn(
        "_rank", F.row_number().over(Window.partitionBy(*spec.key).orderBy(*spec.order_by))
    ).filter(F.col("_rank") % step == 0)
    cuts = ranked.groupBy(*spec.key).agg(
        F.array_sort(F.collect_list(F.struct(*spec.order_by))).alias(_CUTS)
    )
    return Layout(spec, limit, small_or_shuffled(reliable_checkpoint(cuts)))


def _chunk_of(cuts: Column, row: Column) -> Column:
    """How many cuts are not after the row, by binary search."""
    size = F.size(cuts)
    steps = F.sequence(F.lit(0), F.ceil(F.log2(size + 1)).cast("int"))
    start = F.struct(F.lit(0).alias("lo"), size.alias("hi"))

    def halve(state: Column, _: Column) -> Column:
        lo, hi = state["lo"], state["hi"]
        mid = F.shiftright(lo + hi, 1)
        before = F.get(cuts, mid) <= row
        return F.when(lo >= hi, state).otherwise(
            F.struct(
                F.when(before, mid + 1).otherwise(lo).alias("lo"),
                F.when(before, hi).otherwise(mid).alias("hi"),
            )
        )

    return F.when(cuts.isNull(), F.lit(0)).otherwise(F.aggregate(steps, start, halve, lambda s: s["lo"]))


def tag_chunks(df: DataFrame, layout: Layout, hot_only: bool = False) -> DataFrame:
    """Add the chunk number; ``hot_only`` keeps just the rows of cut series."""
    if not layout.split:
        return df
    row = F.struct(*layout.spec.order_by)
    joined = null_safe_join(df, layout.cuts, layout.spec.key, "inner" if hot_only else "left", sized=True)
    return joined.withColumn(CHUNK, _chunk_of(F.col(_CUTS), row)).drop(_CUTS)


def attach_carry(df: DataFrame, carry: DataFrame, layout: Layout) -> DataFrame:
    """Join per-chunk state: one row per chunk of a cut series, hence small.

    The state is written out first. Otherwise every operator of a chain would
    hold the plan before it twice, and the plan would double with each of them.
    """
    return null_safe_join(df, reliable_checkpoint(carry), layout.part)


def carry_last(
    df: DataFrame, layout: Layout, columns: Sequence[str], reverse: bool = False
) -> DataFrame:
    """Per chunk of the cut series: the last known value of each column before it."""
    pick = F.min_by if reverse else F.max_by
    order = F.struct(*layout.spec.order_by)
    tails = (
        tag_chunks(df, layout, hot_only=True)
        .groupBy(*layout.part)
        .agg(*[pick(F.col(c), F.when(F.col(c).isNotNull(), order)).alias(c) for c in columns])
    )
    chunk = F.col(CHUNK).desc() if reverse else F.col(CHUNK).asc()
    before = (
        Window.partitionBy(*layout.spec.key)
        .orderBy(chunk)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return tails.select(
        *layout.part, *[F.last(c, ignorenulls=True).over(before).alias(f"_carry_{c}") for c in columns]
    )


def _offsets(df: DataFrame, layout: Layout) -> DataFrame:
    """Per chunk of the cut series: the rows before it and those of its series; written out."""
    needed = [*layout.spec.key, *[c for c in layout.spec.order_by if c not in layout.spec.key]]
    counts = tag_chunks(df.select(*needed), layout, hot_only=True).groupBy(*layout.part).count()
    by_key = Window.partitionBy(*layout.spec.key)
    earlier = by_key.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    return small_or_shuffled(reliable_checkpoint(counts.select(
        *layout.part,
        F.sum("count").over(earlier).alias(_OFFSET),
        F.sum("count").over(by_key).alias(_TOTAL),
    )))


def shared(df: DataFrame, layout: Layout) -> tuple[DataFrame, Layout]:
    """For a chain of operators that keep the rows of ``df``: the rows written out once, numbered once.

    Each operator on a cut series reads its input for the state that crosses the cuts. Without
    this, what lies before the chain would be computed anew by each of them.
    """
    if not layout.split:
        return df, layout
    rows = reliable_checkpoint(df)
    return rows, replace(layout, offsets=_offsets(rows, layout))


def positions(
    df: DataFrame, layout: Layout, name: str = "pos", length: str | None = None
) -> DataFrame:
    """Add the 0-based index of each row in its series, and the series length."""
    local = (F.row_number().over(layout.window()) - 1).cast("long")
    rows = F.count(F.lit(1)).over(Window.partitionBy(*layout.part))
    if not layout.split:
        out = df.withColumn(name, local)
        return out.withColumn(length, rows) if length else out

    offsets = layout.offsets if layout.offsets is not None else _offsets(df, layout)
    out = null_safe_join(tag_chunks(df, layout), offsets, layout.part, sized=True)
    out = out.withColumn(name, local + F.coalesce(F.col(_OFFSET), F.lit(0)))
    if length:
        out = out.withColumn(length, F.coalesce(F.col(_TOTAL), rows))
    return out.drop(CHUNK, _OFFSET, _TOTAL)


def look_back(
    df: DataFrame,
    layout: Layout,
    reach: int,
    fn: Callable[[DataFrame, list[str], list[str]], DataFrame],
) -> DataFrame:
    """Run window work that looks at most ``reach`` rows back.

    ``fn(frame, partition_by, order_by)`` adds columns. Cut series are processed
    in equal blocks, each preceded by copies of the ``reach`` rows before it.
    Block sizes are multiples of ``reach``.
    """
    spec = layout.spec
    if not layout.split:
        return fn(df, [*spec.key], [*spec.order_by])
    spread = blocks(df, layout, reach)
    done = fn(spread, [*spec.key, BLOCK], [_POS])
    return done.filter(OWN).drop(BLOCK, _POS, OWN)


def blocks(df: DataFrame, layout: Layout, reach: int) -> DataFrame:
    """Add ``_pos``, ``_block`` and ``_own``; rows with ``_own`` false are copies from the block before."""
    placed = positions(df, layout, _POS)
    if not layout.split:
        return placed.withColumns({BLOCK: F.lit(0).cast("long"), OWN: F.lit(True)})
    size = -(-max(layout.limit, reach) // reach) * reach
    home = F.floor(F.col(_POS) / size)
    copies = F.when(F.col(_POS) % size >= size - reach, F.array(home, home + 1)).otherwise(F.array(home))
    return placed.withColumn(BLOCK, F.explode(copies)).withColumn(OWN, F.col(BLOCK) == home)
