"""Watermarks by arrival order, late rows and repeated window results.

Spark's own watermark moves once per micro-batch and drops late rows silently. These batch forms
give the per-row meaning: before row i the watermark is the largest event time of the rows that
arrived earlier, minus the allowed disorder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.times import floor_to, millis
from tidegauge.operators.scans import by_rows, scan
from tidegauge.operators.windows import slide_counts

FEW_WINDOWS = 4


def arrival_watermark(
    df: DataFrame, ts_ms: str, arrival: Sequence[str], disorder: str, rows_per_segment: int | None = None
) -> DataFrame:
    """Add ``wm_before`` and ``wm_after``, the watermark in ms around the arrival of each row.

    ``wm_before`` is NULL for the first row. The running maximum runs over arrival segments in
    parallel; only one row per segment meets in one place.
    """
    seen = scan(
        df, [], arrival, by_rows(arrival[0], rows_per_segment),
        before={"wm_before": ("max", F.col(ts_ms))}, upto={"wm_after": ("max", F.col(ts_ms))},
    )
    delay = F.lit(millis(disorder))
    return seen.withColumns({"wm_before": F.col("wm_before") - delay, "wm_after": F.col("wm_after") - delay})


def late_split(df: DataFrame, ts_ms: str, size: str, every: str, lateness: str) -> tuple[DataFrame, DataFrame]:
    """Split watermarked rows into (kept, late). A row is late when even its last window has closed."""
    last_end = floor_to(F.col(ts_ms), millis(every)) + F.lit(millis(size))
    late = F.coalesce(last_end - 1 + F.lit(millis(lateness)) <= F.col("wm_before"), F.lit(False))
    return df.where(~late), df.where(late)


def open_windows(df: DataFrame, ts_ms: str, size: str, every: str, lateness: str) -> DataFrame:
    """One row per watermarked row and window that still accepted it on arrival."""
    size_ms, every_ms = millis(size), millis(every)
    pane = floor_to(F.col(ts_ms), every_ms)
    starts = F.sequence(pane - F.lit(size_ms - every_ms), pane, F.lit(every_ms).cast("long"))
    in_windows = df.withColumn("window_start_ms", F.explode(starts)).withColumn(
        "window_end_ms", F.col("window_start_ms") + F.lit(size_ms)
    )
    closed = F.col("window_end_ms") - 1 + F.lit(millis(lateness)) <= F.col("wm_before")
    return in_windows.where(~F.coalesce(closed, F.lit(False)))


def _open_pairs(
    df: DataFrame, ts_ms: str, size: str, every: str, lateness: str, keys: Sequence[str], name: str, margin: int
) -> tuple[DataFrame, DataFrame]:
    """(counts per key and window, single row-window pairs), together all open pairs once.

    A row whose watermark is still more than ``-margin`` ms before its first window's end has all
    its pairs in the counts. Those, usually nearly all rows, are counted by panes without being
    copied into their windows. Only the other rows become single pairs.
    """
    every_ms = millis(every)
    first_end = floor_to(F.col(ts_ms), every_ms) + F.lit(every_ms)
    in_all = F.coalesce(F.col("wm_before") < first_end - 1 + F.lit(margin), F.lit(True))
    if millis(size) <= FEW_WINDOWS * every_ms:
        in_all = F.lit(False)  # copying a row a few times is cheaper than the extra shuffles
    return (
        slide_counts(df.where(in_all), ts_ms, size, every, keys, name),
        open_windows(df.where(~in_all), ts_ms, size, every, lateness),
    )


def late_window_counts(
    df: DataFrame, ts_ms: str, size: str, every: str, lateness: str, keys: Sequence[str], name: str = "n"
) -> DataFrame:
    """Final count per (key, window) after all accepted late rows: the last of its firings."""
    counts, pairs = _open_pairs(df, ts_ms, size, every, lateness, keys, name, millis(lateness))
    columns = [*keys, "window_start_ms", "window_end_ms"]
    together = counts.select(*columns, name).unionByName(pairs.select(*columns, F.lit(1).cast("long").alias(name)))
    return together.groupBy(*columns).agg(F.sum(name).alias(name))


def late_changelog(
    df: DataFrame, ts_ms: str, arrival: Sequence[str], size: str, every: str, lateness: str,
    keys: Sequence[str], name: str = "n", rows_per_segment: int | None = None,
) -> DataFrame:
    """Every result a (key, window) emits, with the arrival number that triggered it.

    A window fires when the watermark reaches its end; its rows so far give one result. Each later
    accepted row gives one more. The first result of a window that never fires before the input
    ends has a NULL arrival number. Arrival numbers are not negative.
    """
    every_ms = millis(every)
    sequence = arrival[0]
    window = ["window_start_ms", "window_end_ms"]

    # one entry at arrival -1 for what came before the firing, one for each row after it
    counts, pairs = _open_pairs(df, ts_ms, size, every, lateness, keys, name, 0)
    refires = F.col("wm_before") >= F.col("window_end_ms") - 1
    before = F.lit(-1).cast("long")
    entries = (
        counts.select(*keys, *window, *[before.alias(column) for column in arrival], name)
        .unionByName(pairs.select(
            *keys, *window, *[F.when(refires, F.col(column)).otherwise(before).alias(column) for column in arrival],
            F.lit(1).cast("long").alias(name),
        ))
        .groupBy(*keys, *window, *arrival).agg(F.sum(name).alias("__step"))
    )
    results = scan(
        entries, [*keys, *window], arrival, by_rows(sequence, rows_per_segment), upto={name: ("sum", F.col("__step"))}
    )

    # a row that lifts the watermark fires the window ends it passes: one row per window end
    first_end = floor_to(F.col("wm_before") + 1, every_ms) + F.lit(every_ms)
    last_end = floor_to(F.col("wm_after") + 1, every_ms)
    fired = (
        df.where((F.col("wm_after") > F.col("wm_before")) & (first_end <= last_end))
        .select(
            F.explode(F.sequence(first_end, last_end, F.lit(every_ms).cast("long"))).alias("__fired_end"),
            F.col(sequence).alias("__fired_at"),
        )
    )
    # only a window's first result needs the number of the row that fired it; one row per key and window
    is_first = F.col(sequence) == -1
    first = results.where(is_first).join(fired, F.col("window_end_ms") == F.col("__fired_end"), "left")
    columns = [*keys, *window, sequence, name]
    first = first.withColumn(sequence, F.col("__fired_at"))
    return first.select(columns).unionByName(results.where(~is_first).select(columns))
