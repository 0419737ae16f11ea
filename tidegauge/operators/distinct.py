"""Distinct visitors per window: exact, by hashed bitmap, by sketch, and as a running count."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.hashing import BITMAP_BITS, bit_offset
from tidegauge.functions.times import window_ms
from tidegauge.operators.scans import by_rows, scan


def unique_exact(df: DataFrame, ts: str, size: str, visitor: str, name: str = "uv") -> DataFrame:
    """Spark removes duplicate (window, visitor) pairs in each task before it shuffles them."""
    return window_ms(df.groupBy(F.window(ts, size)).agg(F.count_distinct(visitor).alias(name)))


def unique_bitmap(df: DataFrame, ts: str, size: str, visitor: str, bits: int = BITMAP_BITS, name: str = "uv") -> DataFrame:
    """Set bits of a hashed bitmap per window; visitors whose hashes collide count once.

    The bitmap is kept as its set bits, one row each: a task shuffles no more than the visitors it
    saw, and a busy window spreads over tasks, where whole bitmaps would be 64 MiB per window each.
    """
    return window_ms(df.groupBy(F.window(ts, size)).agg(F.count_distinct(bit_offset(visitor, bits)).alias(name)))


def unique_sketch(df: DataFrame, ts: str, size: str, visitor: str, rsd: float = 0.02, name: str = "uv") -> DataFrame:
    """HyperLogLog++ estimate with relative standard deviation ``rsd``; fixed memory per window."""
    return window_ms(df.groupBy(F.window(ts, size)).agg(F.approx_count_distinct(visitor, rsd).alias(name)))


def unique_running(
    df: DataFrame, ts: str, size: str, visitor: str, sequence: str, name: str = "uv", rows_per_segment: int | None = None
) -> DataFrame:
    """Each row together with the distinct visitors its window has seen up to and with this row.

    A first visit is the smallest sequence number per (window, visitor), found by partial
    aggregation. First visits enter the running sum as extra rows just ahead of their own row.
    """
    rows = window_ms(df.withColumn("window", F.window(ts, size)))
    window = ["window_start_ms", "window_end_ms"]
    firsts = rows.groupBy(*window, visitor).agg(F.min(sequence).alias(sequence)).drop(visitor)
    together = rows.withColumn("__first", F.lit(0)).unionByName(
        firsts.withColumn("__first", F.lit(1)), allowMissingColumns=True
    )
    counted = scan(
        together.withColumn("__turn", -F.col("__first")), window, [sequence, "__turn"],
        by_rows(sequence, rows_per_segment), upto={name: ("sum", F.col("__first").cast("long"))},
    )
    return counted.where(F.col("__first") == 0).drop("__first", "__turn")
