"""Rolling statistics, event lags, differences, context windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallytide.functions.scalars import nan_as_null
from tallytide.operators.fill import OBSERVED, between_neighbours, neighbours
from tallytide.operators.layout import (
    CHUNK,
    Layout,
    attach_carry,
    look_back,
    plan_layout,
    positions,
    tag_chunks,
)
from tallytide.schema import (
    CONTEXT_LENGTH,
    CONTEXT_MIN,
    CONTEXT_STRIDE,
    EVENT_LAGS,
    ROLLING_WINDOWS,
    TRAIN_CONTEXT_ROWS,
)
from tallytide.series import SeriesSpec

_STEP, _SEG = "_step", "_seg"
_SUMS = ("n", "s", "q", "c", "tn", "ts", "tq")


def _moments(n: Column, s: Column, q: Column, shift: Column, name: str) -> dict[str, Column]:
    """Count, mean (moved by ``shift``) and squared deviations from centred sums."""
    known = F.when(n > 0, n)
    return {
        name % "n": n,
        name % "m": F.coalesce(shift + s / known, F.lit(0.0)),
        name % "q": F.coalesce(q - s * s / known, F.lit(0.0)),
    }


def rolling_stats(
    df: DataFrame,
    spec: SeriesSpec,
    columns: dict[str, str],
    windows: Sequence[int] = ROLLING_WINDOWS,
    layout: Layout | None = None,
) -> DataFrame:
    """Trailing mean and sample standard deviation over the last w rows.

    ``columns`` maps a source column to the prefix of its results,
    ``{prefix}_roll_mean_{w}`` and ``{prefix}_roll_std_{w}``; both are NULL
    unless all w rows exist and have a value.

    A sliding frame costs w additions per row. Here the series is cut into
    segments of max(w) rows with running sums inside each, so every trailing
    window is the end of one segment and the start of the next: the cost does
    not depend on w. Sums start afresh in each segment, around its first value,
    which keeps the deviations exact when the level drifts.
    """
    df = nan_as_null(df, columns)
    layout = layout or plan_layout(df, spec)
    columns = {c: p for c, p in columns.items() if c in df.columns}
    segment = max(windows)

    def add(frame: DataFrame, key: list[str], order: list[str]) -> DataFrame:
        along = Window.partitionBy(*key).orderBy(*order)
        index = F.col("_pos") if order == ["_pos"] else (F.row_number().over(along) - 1).cast("long")
        frame = frame.withColumn(_STEP, index).withColumn(_SEG, F.floor(F.col(_STEP) / segment))

        inside = Window.partitionBy(*key, _SEG).orderBy(*([_STEP]))
        upto = inside.rowsBetween(Window.unboundedPreceding, 0)
        whole = inside.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        frame = frame.withColumns({f"_c_{p}": F.first(c, ignorenulls=True).over(whole) for c, p in columns.items()})
        running = {}
        for c, p in columns.items():
            d = F.col(c) - F.col(f"_c_{p}")
            for tag, term in (("n", F.when(d.isNotNull(), 1.0)), ("s", d), ("q", d * d)):
                running[f"_{tag}_{p}"] = F.coalesce(F.sum(term).over(upto), F.lit(0.0))
                running[f"_t{tag}_{p}"] = F.coalesce(F.sum(term).over(whole), F.lit(0.0))
        frame = frame.withColumns(running)

        # Each stage is its own projection: nested in one expression, the shared
        # terms would be repeated and the plan would grow without need.
        pairs = [(p, w) for p in columns.values() for w in windows]
        ordered = Window.partitionBy(*key).orderBy(_SEG, _STEP)  # the order the segments left the rows in
        then = {f"_g_{w}": F.lag(_SEG, w).over(ordered) for w in windows}
        then |= {f"_{t}_{p}_{w}": F.lag(f"_{t}_{p}", w).over(ordered) for p, w in pairs for t in _SUMS}
        frame = frame.withColumns(then)
        parts = {}
        for p, w in pairs:
            was = {t: F.col(f"_{t}_{p}_{w}") for t in _SUMS}
            same = F.col(f"_g_{w}") == F.col(_SEG)
            head = [F.col(f"_{t}_{p}") - F.when(same, was[t]).otherwise(F.lit(0.0)) for t in ("n", "s", "q")]
            rest = [F.when(~same, was[f"t{t}"] - was[t]).otherwise(F.lit(0.0)) for t in ("n", "s", "q")]
            parts |= _moments(*head, F.lit(0.0), f"_a%s_{p}_{w}")
            parts |= _moments(*rest, was["c"] - F.col(f"_c_{p}"), f"_b%s_{p}_{w}")
        frame = frame.withColumns(parts)
        results = {}
        for p, w in pairs:
            an, am, aq = (F.col(f"_a{t}_{p}_{w}") for t in ("n", "m", "q"))
            bn, bm, bq = (F.col(f"_b{t}_{p}_{w}") for t in ("n", "m", "q"))
            full, gap = an + bn == w, bm - am
            results[f"{p}_roll_mean_{w}"] = F.when(full, F.col(f"_c_{p}") + (am + gap * bn / w))
            squares = aq + bq + gap * gap * an * bn / w
            spread = F.sqrt(F.greatest(squares, F.lit(0.0)) / max(w - 1, 1))
            results[f"{p}_roll_std_{w}"] = F.when(full & F.lit(w > 1), spread)
        scratch = [f"_{t}_{p}" for p in columns.values() for t in _SUMS] + [*then, *parts]
        return frame.withColumns(results).drop(_STEP, _SEG, *scratch)

    return look_back(df, layout, segment, add)


def first_difference(
    df: DataFrame, spec: SeriesSpec, name: str = "acceleration", layout: Layout | None = None
) -> DataFrame:
    """``x - previous x``; NULL on the first row of a series."""
    df = nan_as_null(df, [spec.value])

    def add(frame: DataFrame, key: list[str], order: list[str]) -> DataFrame:
        previous = F.lag(spec.value, 1).over(Window.partitionBy(*key).orderBy(*order))
        return frame.withColumn(name, F.col(spec.value) - previous)

    return look_back(df, layout or plan_layout(df, spec), 1, add)


def dense_lag(
    df: DataFrame, spec: SeriesSpec, rows: int, name: str = "dense_lag", layout: Layout | None = None
) -> DataFrame:
    """The value ``rows`` rows ago. On filled data this mostly repeats the current value."""
    df = nan_as_null(df, [spec.value])

    def add(frame: DataFrame, key: list[str], order: list[str]) -> DataFrame:
        return frame.withColumn(name, F.lag(spec.value, rows).over(Window.partitionBy(*key).orderBy(*order)))

    return look_back(df, layout or plan_layout(df, spec), rows, add)


def observation_index(
    df: DataFrame, spec: SeriesSpec, name: str = "stop_index", layout: Layout | None = None
) -> DataFrame:
    """Keep the observations and number them from 0 in each series."""
    df = nan_as_null(df, [spec.value])
    stops = df.filter(F.col(spec.value).isNotNull())
    return positions(stops, layout or plan_layout(stops, spec), name)


def event_lag(
    df: DataFrame,
    spec: SeriesSpec,
    lags: Sequence[int] = EVENT_LAGS,
    prefix: str = "pax_stop_lag",
    marker: str = OBSERVED,
    layout: Layout | None = None,
) -> DataFrame:
    """The value k observations ago, held until the next observation.

    ``spec.value`` is the filled value and ``marker`` the flag set before the
    fill. The lag runs over the marked rows only and is then carried over the
    rows up to the next mark, so it never repeats the current value the way a
    lag over filled rows does.
    """
    df = nan_as_null(df, [spec.value])
    if marker not in df.columns:
        raise ValueError(f"event_lag needs the marker column {marker!r}; mark observations before filling")
    layout = layout or plan_layout(df, spec)
    names = {k: f"{prefix}_{k}" for k in lags}
    part, order = layout.part, [*spec.order_by]
    upto = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    among = Window.partitionBy(*part, marker).orderBy(*order)

    tagged = tag_chunks(df, layout)
    own = {f"_own_{k}": F.when(F.col(marker), F.lag(spec.value, k).over(among)) for k in lags}
    if not layout.split:
        held = {names[k]: F.last(f"_own_{k}", ignorenulls=True).over(upto) for k in lags}
        return tagged.withColumns(own).withColumns(held).drop(*own)

    tails = _last_observations(df, spec, marker, max(lags) + 1, layout)
    tagged = attach_carry(tagged, tails, layout).withColumns(own)
    seen = F.count(F.when(F.col(marker), True)).over(upto)
    tagged = tagged.withColumn("_seen", seen)
    held = {}
    for k in lags:
        inside = F.last(f"_own_{k}", ignorenulls=True).over(upto)
        carried = F.get(F.col("_tail"), F.size("_tail") - 1 - (F.lit(k) - F.col("_seen")).cast("int"))
        held[names[k]] = F.when(F.col("_seen") > k, inside).otherwise(carried)
    return tagged.withColumns(held).drop("_seen", "_tail", CHUNK, *own)


def _last_observations(df: DataFrame, spec: SeriesSpec, marker: str, keep: int, layout: Layout) -> DataFrame:
    """Per chunk of the cut series: the last ``keep`` observed values before it."""
    marked = tag_chunks(df.filter(F.col(marker)), layout, hot_only=True)
    backwards = Window.partitionBy(*layout.part).orderBy(*[F.col(c).desc() for c in spec.order_by])
    last = marked.withColumn("_back", F.row_number().over(backwards)).filter(F.col("_back") <= keep)
    along = Window.partitionBy(*spec.key).orderBy(CHUNK, F.col("_back").desc()).rowsBetween(1 - keep, 0)
    trails = last.withColumn("_trail", F.collect_list(spec.value).over(along)).filter(F.col("_back") == 1)
    chunks = tag_chunks(df.select(*spec.key, *spec.order_by), layout, hot_only=True).select(*layout.part).distinct()
    before = Window.partitionBy(*spec.key).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    return chunks.join(trails.select(*layout.part, "_trail"), layout.part, "left").select(
        *layout.part,
        F.coalesce(
            F.last("_trail", ignorenulls=True).over(before), F.array().cast("array<double>")
        ).alias("_tail"),
    )


def lag_leak_audit(
    df: DataFrame,
    spec: SeriesSpec,
    rows: int,
    k: int = 1,
    marker: str = OBSERVED,
    layout: Layout | None = None,
) -> DataFrame:
    """Share of rows whose lag equals the current value: lag over rows against lag over observations."""
    layout = layout or plan_layout(df, spec)
    both = dense_lag(event_lag(df, spec, [k], "_event", marker, layout), spec, rows, "_dense", layout)

    def audit(column: str, kind: str) -> Column:
        known = F.col(column).isNotNull() & F.col(spec.value).isNotNull()
        same = F.count_if(known & (F.col(column) == F.col(spec.value)))
        total = F.count_if(known)
        return F.struct(
            F.lit(kind).alias("kind"),
            total.alias("rows"),
            same.alias("rows_equal"),
            (same / F.when(total > 0, total)).alias("share_equal"),
        )

    return both.agg(F.array(audit("_dense", "dense"), audit(f"_event_{k}", "event")).alias("a")).select(F.inline("a"))


def last_rows(
    df: DataFrame, spec: SeriesSpec, n: int = TRAIN_CONTEXT_ROWS, at_least: int = 1, layout: Layout | None = None
) -> DataFrame:
    """The last ``n`` rows of every series that has ``at_least`` rows."""
    counted = positions(df, layout or plan_layout(df, spec), "_at", "_rows")
    kept = counted.filter((F.col("_rows") - F.col("_at") <= n) & (F.col("_rows") >= at_least))
    return kept.drop("_at", "_rows")


def context_windows(
    df: DataFrame,
    spec: SeriesSpec,
    length: int = CONTEXT_LENGTH,
    stride: int = CONTEXT_STRIDE,
    minimum: int = CONTEXT_MIN,
    label: str | None = None,
    fill_gaps: bool = True,
    layout: Layout | None = None,
) -> DataFrame:
    """Overlapping contexts and the index each one predicts.

    A context ends before ``target_index`` in ``minimum, minimum + stride, ...``
    below the series length and holds at most ``length`` values; gaps inside it
    are interpolated. Columns: key, ``target_index``, ``context``, ``target``
    and, if ``label`` is given, the label of the target row.

    Rows are gathered once into arrays of ``stride`` values, and a context is
    the last few arrays put together, instead of copying every row into each of
    the length/stride contexts that contain it.
    """
    df = nan_as_null(df, [spec.value])
    layout = layout or plan_layout(df, spec)
    indexed = neighbours(df, spec, layout) if fill_gaps else positions(df, layout, "pos")
    step = F.floor((F.col("pos") - minimum) / stride)
    fields = ["pos", F.col(spec.value).alias("x")]
    if fill_gaps:
        fields += ["prev", "next"]
    if label:
        fields.append(F.col(label).alias("label"))
    arrays = (
        indexed.withColumn(_STEP, step)
        .groupBy(*spec.key, _STEP)
        .agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("_rows"))
    )

    reach = -(-length // stride)
    by_step = SeriesSpec(spec.key, (_STEP,), "_rows")

    def add(frame: DataFrame, key: list[str], order: list[str]) -> DataFrame:
        along = Window.partitionBy(*key).orderBy(*order)
        # one array per row: the frame is at most reach arrays
        history = F.flatten(F.collect_list("_rows").over(along.rowsBetween(-reach, -1)))
        return frame.withColumn("_history", history)

    # one row per stride: a series cut for its rows may be small again here
    gathered = look_back(arrays, _step_layout(arrays, by_step, layout), reach, add).filter(F.col(_STEP) >= 0)
    kept = F.slice(F.col("_history"), -F.least(F.size("_history"), F.lit(length)), F.lit(length))
    first = F.get(F.col("_rows"), 0)
    out = gathered.filter(F.size("_history") >= minimum).select(
        *spec.key, first["pos"].alias("target_index"), kept.alias("_kept"), first.alias("_target")
    )
    if fill_gaps:
        start = F.get(F.col("_kept"), 0)["pos"]
        context = F.transform("_kept", lambda r: F.coalesce(
            r["x"].cast("double"), between_neighbours(r, start, F.col("target_index"))))
    else:
        context = F.transform("_kept", lambda r: r["x"].cast("double"))
    extra = [F.col("_target")["label"].alias(label)] if label else []
    return out.select(
        *spec.key, "target_index", context.alias("context"), F.col("_target")["x"].alias("target"), *extra
    )


def _step_layout(arrays: DataFrame, by_step: SeriesSpec, layout: Layout) -> Layout:
    return plan_layout(arrays, by_step, layout.limit) if layout.split else Layout(by_step, layout.limit)
