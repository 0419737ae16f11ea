"""Time and count windows. Windows are half-open and aligned to the epoch."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.times import epoch_ms, floor_to, millis, window_ms
from tidegauge.operators.scans import Axis, scan
from tidegauge.session import written

# Up to this many windows per row, copying panes is cheaper than one more shuffle.
FEW_WINDOWS = 16

_MERGE = {"sum": F.sum, "min": F.min, "max": F.max}


def tumble(df: DataFrame, ts: str, size: str, *aggs: Column, keys: Sequence[str] = ()) -> DataFrame:
    """One row per (key, window). Without keys it is the window over all rows; partial aggregation
    leaves each task at most one row per window to shuffle, so no constant key is needed."""
    return window_ms(df.groupBy(*keys, F.window(ts, size)).agg(*aggs))


def slide(df: DataFrame, ts: str, size: str, every: str, *aggs: Column, keys: Sequence[str] = ()) -> DataFrame:
    """Sliding windows for any aggregate; each row is copied into size/every windows.

    Use it when that ratio is small or the aggregate cannot be merged."""
    return window_ms(df.groupBy(*keys, F.window(ts, size, every)).agg(*aggs))


def _ms(df: DataFrame, ts: str) -> Column:
    """The time column in ms, whether it is a timestamp or in ms already."""
    return F.col(ts) if df.schema[ts].dataType.typeName() == "long" else epoch_ms(ts)


def _checked(size: str, every: str) -> tuple[int, int]:
    size_ms, every_ms = millis(size), millis(every)
    if size_ms % every_ms:
        raise ValueError("size must be a multiple of the slide")
    return size_ms, every_ms


def slide_panes(
    df: DataFrame, ts: str, size: str, every: str,
    parts: Mapping[str, tuple[str, Column]], keys: Sequence[str] = (),
) -> DataFrame:
    """Sliding ``sum``/``min``/``max`` by panes: rows are aggregated into slide-sized panes first,
    and only pane rows are copied into their size/every windows."""
    size_ms, every_ms = _checked(size, every)
    panes = df.groupBy(*keys, floor_to(_ms(df, ts), every_ms).alias("pane_ms")).agg(
        *[_MERGE[kind](value).alias(name) for name, (kind, value) in parts.items()]
    )
    starts = F.sequence(
        F.col("pane_ms") - F.lit(size_ms - every_ms), F.col("pane_ms"), F.lit(every_ms).cast("long")
    )
    return (
        panes.withColumn("window_start_ms", F.explode(starts))
        .groupBy(*keys, "window_start_ms")
        .agg(*[_MERGE[kind](name).alias(name) for name, (kind, _) in parts.items()])
        .withColumn("window_end_ms", F.col("window_start_ms") + F.lit(size_ms))
    )


def slide_counts(
    df: DataFrame, ts: str, size: str, every: str, keys: Sequence[str] = (),
    name: str = "n", sums: Mapping[str, Column] | None = None, segment_ticks: int = 4096,
) -> DataFrame:
    """Sliding row counts (and sums of exact types) whose cost does not grow with size/every.

    Up to FEW_WINDOWS windows per row it is ``slide_panes``. Beyond:

    A pane adds its count at the first window that covers it and takes it away again behind the
    last one. A running sum over those two steps per pane is the count of every window, and the
    windows between two steps share it. So the work is panes plus output rows, where copying panes
    costs panes times size/every. Sums must be integers or decimals: subtracting doubles drifts.
    """
    size_ms, every_ms = _checked(size, every)
    sums = dict(sums or {})
    for label, value in sums.items():
        if df.select(value.alias(label)).schema[label].dataType.typeName() in ("float", "double"):
            raise ValueError(f"{label}: sums over sliding steps need an integer or decimal type")
    if size_ms <= FEW_WINDOWS * every_ms:
        parts = {name: ("sum", F.lit(1).cast("long")), **{label: ("sum", value) for label, value in sums.items()}}
        return slide_panes(df, ts, size, every, parts, keys)
    measures = [name, *sums]
    panes = df.groupBy(*keys, floor_to(_ms(df, ts), every_ms).alias("pane_ms")).agg(
        F.count(F.lit(1)).alias(name), *[F.sum(value).alias(label) for label, value in sums.items()]
    )

    def step(tick: Column, sign: int) -> Column:
        return F.struct(
            tick.alias("tick_ms"), *[(F.coalesce(m, F.lit(0)) * F.lit(sign)).alias(m) for m in measures]
        )

    first = F.col("pane_ms") - F.lit(size_ms - every_ms)
    behind = F.col("pane_ms") + F.lit(every_ms)
    # few rows beside the input; written, as the scan reads them several times
    steps = written(
        panes.select(*keys, F.inline(F.array(step(first, 1), step(behind, -1))))
        .groupBy(*keys, "tick_ms")
        .agg(*[F.sum(m).alias(f"step_{m}") for m in measures]),
        "window-steps",
    )
    levels = scan(
        steps, keys, ["tick_ms"], Axis("tick_ms", segment_ticks),
        upto={m: ("sum", F.col(f"step_{m}")) for m in measures},
        following={"next_ms": F.col("tick_ms")},
        # a key has at most two steps per slide of the time span, however many rows it has
        split=not keys,
    )
    windows = F.sequence(
        F.col("tick_ms"), F.col("next_ms") - F.lit(every_ms), F.lit(every_ms).cast("long")
    )
    return (
        levels.where(F.col(name) > 0)
        .select(*keys, F.explode(windows).alias("window_start_ms"), *measures)
        .withColumn("window_end_ms", F.col("window_start_ms") + F.lit(size_ms))
    )


def stamp_arrival(df: DataFrame, name: str = "arrived_at") -> DataFrame:
    """Add the processing time, so that clock windows are time windows over this column."""
    return df.withColumn(name, F.current_timestamp())


def number_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], segment: Axis, name: str) -> DataFrame:
    """1-based position of each row within its key."""
    return scan(df, keys, order, segment, upto={name: ("sum", F.lit(1).cast("long"))})


def count_tumble(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], rows: int, *aggs: Column, segment: Axis
) -> DataFrame:
    """Per key, one result for every ``rows`` rows in order; an incomplete last window gives none."""
    numbered = number_rows(df, keys, order, segment, "__row")
    return (
        numbered.withColumn("window_no", F.expr(f"(__row - 1) div {rows}"))
        .groupBy(*keys, "window_no")
        .agg(*aggs, F.count(F.lit(1)).alias("__rows"))
        .where(F.col("__rows") == rows)
        .drop("__rows")
    )


def count_slide(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], rows: int, every: int,
    parts: Mapping[str, tuple[str, Column]], segment: Axis,
) -> DataFrame:
    """Per key, at every ``every``-th row, the aggregate of the last up to ``rows`` rows.

    Rows fold into panes of ``every`` rows; a pane then counts for its own and later windows."""
    if rows % every:
        raise ValueError("rows must be a multiple of every")
    numbered = number_rows(df, keys, order, segment, "__row")
    panes = (
        numbered.withColumn("__pane", F.expr(f"(__row - 1) div {every}"))
        .groupBy(*keys, "__pane")
        .agg(
            *[_MERGE[kind](value).alias(name) for name, (kind, value) in parts.items()],
            F.count(F.lit(1)).alias("__rows"),
        )
    )
    last = F.col("__pane") + F.lit(rows // every - 1)
    return (
        panes.withColumn("window_no", F.explode(F.sequence(F.col("__pane"), last)))
        .groupBy(*keys, "window_no")
        .agg(
            *[_MERGE[kind](name).alias(name) for name, (kind, _) in parts.items()],
            F.max(F.when(F.col("__pane") == F.col("window_no"), F.col("__rows"))).alias("__own"),
        )
        .where(F.col("__own") == every)
        .drop("__own")
    )
