"""Sliding windows of anything that merges, at a cost that does not grow with size/slide.

Sums can be taken away again behind a window; extremes and sketches cannot. Here the panes,
slide-sized pieces that are aggregated first, are grouped into blocks as long as a window. A window
is the end of one block and the beginning of the next, so two running merges per block, one from
each side, hold what every window needs: two values are merged wherever one of them changes, where
copying panes into their windows merges size/slide of them per window.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.functions.hashing import BITMAP_BITS, bit_offset
from tidegauge.functions.times import floor_to, millis
from tidegauge.operators.scans import by_time, scan

Merge = Callable[[Column], Column]
_EXTREMES: dict[str, Merge] = {"min": F.min, "max": F.max}


def slide_merged(
    panes: DataFrame, pane_ms: str, size: str | int, every: str | int, merges: Mapping[str, Merge], keys: Sequence[str] = ()
) -> DataFrame:
    """The merged columns of every (key, window) that holds a pane, in runs of windows that share them.

    ``panes`` has one row per (key, pane), whose start ``pane_ms`` is a multiple of ``every``. A merge is an
    aggregate whose result can be aggregated again and that may see a value twice, as min, max and
    unions may. A row stands for the windows that end at first_end_ms ... last_end_ms; ``each_window``
    lists them, best once the values are small. There are at most three runs per pane, and a (key,
    block) has at most size/every panes, so no task holds more of a key.
    """
    size_ms, every_ms = millis(size), millis(every)
    if size_ms % every_ms:
        raise ValueError("size must be a multiple of the slide")
    width, at = F.lit(size_ms // every_ms), F.col("__at")

    def block(at: Column) -> Column:
        return at - F.pmod(at, width)

    def pair(window) -> Column:
        so_far = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        # the condition is always true; it makes the cells nullable, as those of an ended tail are
        cells = {name: F.when(at.isNotNull(), merge(F.col(name)).over(so_far)) for name, merge in merges.items()}
        return F.struct(*[cell.alias(name) for name, cell in cells.items()])

    blocks = panes.withColumn("__at", F.expr(f"`{pane_ms}` div {every_ms}L")).withColumn("__block", block(at))
    ahead = Window.partitionBy(*keys, "__block").orderBy("__at")
    back = Window.partitionBy(*keys, "__block").orderBy(F.desc("__at"))
    merged = blocks.select(
        *keys, "__at", pair(ahead).alias("head"), pair(back).alias("tail"),
        # windows are told by their last pane; a tail serves those that begin behind the pane before it
        (F.coalesce(F.lag("__at").over(ahead), F.col("__block")) + width).alias("__from"), (at + width - 1).alias("__to"),
    )
    nothing = F.lit(None)
    empty = F.struct(*[F.lit(None).cast(merged.schema["tail"].dataType[name].dataType).alias(name) for name in merges])

    def change(place: Column, turn: int, head: Column, tail: Column, real: Column | None = None) -> Column:
        cells = F.struct(
            place.alias("__at"), F.lit(turn).alias("__turn"), head.cast(merged.schema["head"].dataType).alias("head"),
            tail.cast(merged.schema["tail"].dataType).alias("tail"),
        )
        return cells if real is None else F.when(real, cells)

    serves = F.col("__from") <= F.col("__to")  # the tail of a whole block is its head already
    changes = merged.select(*keys, F.inline(F.array_compact(F.array(
        change(at, 0, F.col("head"), nothing), change(F.col("__from"), 1, nothing, F.col("tail"), serves),
        change(F.col("__to") + 1, 0, nothing, empty, serves),
    ))))
    order = Window.partitionBy(*keys, "__block").orderBy("__at", "__turn")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    runs = changes.withColumn("__block", block(at)).select(
        *keys, ((at + 1) * F.lit(every_ms)).alias("first_end_ms"),
        (F.coalesce(F.lead("__at").over(order), F.col("__block") + width) * F.lit(every_ms)).alias("last_end_ms"),
        F.last("head", True).over(so_far).alias("head"), F.last("tail", True).over(so_far).alias("tail"),
    ).where("first_end_ms <= last_end_ms")
    both = runs.select(*keys, "first_end_ms", "last_end_ms", F.inline(F.array_compact(F.array("head", "tail"))))
    filled = both.where(reduce(Column.__or__, [F.col(name).isNotNull() for name in merges]))
    return filled.groupBy(*keys, "first_end_ms", "last_end_ms").agg(*[merge(F.col(name)).alias(name) for name, merge in merges.items()])


def each_window(runs: DataFrame, every: str | int) -> DataFrame:
    """One row per window, with its window_end_ms, of runs of windows."""
    ends = F.sequence("first_end_ms", "last_end_ms", F.lit(millis(every)).cast("long"))
    return runs.withColumn("window_end_ms", F.explode(ends)).drop("first_end_ms", "last_end_ms")


def _pane(ts_ms: str, every: str | int) -> Column:
    return floor_to(F.col(ts_ms), millis(every)).alias("pane_ms")


def slide_extremes(
    df: DataFrame, ts_ms: str, size: str | int, every: str | int, parts: Mapping[str, tuple[str, Column]], keys: Sequence[str] = ()
) -> DataFrame:
    """Sliding ``min`` and ``max``; nulls are passed over, rows without a time left out. A window has a row if
    one of its values is not null."""
    panes = df.where(F.col(ts_ms).isNotNull()).groupBy(*keys, _pane(ts_ms, every)).agg(
        *[_EXTREMES[kind](value).alias(name) for name, (kind, value) in parts.items()]
    )
    runs = slide_merged(panes, "pane_ms", size, every, {name: _EXTREMES[kind] for name, (kind, _) in parts.items()}, keys)
    return each_window(runs, every)


def unique_bitmap_sliding(
    df: DataFrame, ts_ms: str, size: str | int, every: str | int, visitor: str, bits: int = BITMAP_BITS, name: str = "uv"
) -> DataFrame:
    """Set bits of a hashed bitmap per sliding window.

    The panes' bitmaps are kept as their set bits, one row each, so what is moved and held grows with the visitors and
    not with the bitmap. The union of a window's panes holds a bit from the first window that has a pane with
    it to the last: each set bit adds the windows that the pane before with this bit doesn't reach, and
    a running sum of what windows gain and lose is their count. Rows without visitor count no one.
    """
    size_ms, every_ms = millis(size), millis(every)
    if size_ms % every_ms:
        raise ValueError("size must be a multiple of the slide")
    rows = df.where(F.col(ts_ms).isNotNull() & F.col(visitor).isNotNull())
    set_bits = rows.select(_pane(ts_ms, every), bit_offset(visitor, bits).alias("bit")).distinct()
    pane, before = F.col("pane_ms"), F.col("before")
    held = scan(set_bits, ["bit"], ["pane_ms"], by_time("pane_ms"), previous={"before": pane})
    change = F.inline(F.array(
        F.struct(F.greatest(pane + every_ms, before + size_ms + every_ms).alias("first_end_ms"), F.lit(1).cast("long").alias("change")),
        F.struct((pane + size_ms + every_ms).alias("first_end_ms"), F.lit(-1).cast("long").alias("change")),
    ))
    changes = held.select(change).groupBy("first_end_ms").agg(F.sum("change").alias("change"))
    end = F.col("first_end_ms")
    runs = scan(changes, [], ["first_end_ms"], by_time("first_end_ms"), upto={name: ("sum", F.col("change"))}, following={"next": end})
    filled = runs.where(F.col(name) > 0).select(end, (F.col("next") - every_ms).alias("last_end_ms"), name)
    return each_window(filled, every)


def unique_sketch_sliding(
    df: DataFrame, ts_ms: str, size: str | int, every: str | int, visitor: str, lg_k: int = 12, name: str = "uv"
) -> DataFrame:
    """Estimated distinct visitors per sliding window from one mergeable sketch per pane.

    The relative standard error is about 1.04 / sqrt(2^lg_k). Every row is read into one sketch,
    whatever the number of windows it belongs to.
    """
    rows = df.where(F.col(ts_ms).isNotNull() & F.col(visitor).isNotNull())
    panes = rows.groupBy(_pane(ts_ms, every)).agg(F.hll_sketch_agg(F.col(visitor), lg_k).alias("__sketch"))
    merged = slide_merged(panes, "pane_ms", size, every, {"__sketch": F.hll_union_agg})
    return each_window(merged.select("first_end_ms", "last_end_ms", F.hll_sketch_estimate("__sketch").alias(name)), every)
