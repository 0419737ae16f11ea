"""Two-step sequence patterns per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.times import millis
from tidegauge.operators.scans import Axis, scan


def repeated_in_arrival(
    df: DataFrame, keys: Sequence[str], arrival: Sequence[str], hit: Column, ts_ms: str, bound: str, segment: Axis
) -> DataFrame:
    """A hit whose previous row of the key, by arrival, also is a hit, less than ``bound`` before it.

    Adds ``first_ms`` and ``next_ms``. The previous hit may carry a later time: arrival order rules.
    """
    linked = scan(df, keys, arrival, segment, previous={"__hit": hit, "first_ms": F.col(ts_ms)})
    return (
        linked.where(hit & F.col("__hit") & (F.col("first_ms") > F.col(ts_ms) - F.lit(millis(bound))))
        .withColumn("next_ms", F.col(ts_ms))
        .drop("__hit")
    )


def strict_next(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], begin: Column, then: Column,
    ts_ms: str, bound: str, segment: Axis,
) -> DataFrame:
    """A ``begin`` row directly followed, in event order, by a ``then`` row within less than ``bound``.

    Overlapping matches all count. Adds ``first_ms`` and ``next_ms``.
    """
    linked = scan(df, keys, order, segment, following={"__then": then, "next_ms": F.col(ts_ms)})
    return (
        linked.where(begin & F.col("__then") & (F.col("next_ms") - F.col(ts_ms) < F.lit(millis(bound))))
        .withColumn("first_ms", F.col(ts_ms))
        .drop("__then")
    )


def followed_by(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], begin: Column, then: Column,
    ts_ms: str, bound: str, segment: Axis,
) -> tuple[DataFrame, DataFrame]:
    """(matched, timed out) for each ``begin`` row: the first later ``then`` row of the key comes
    within less than ``bound``, or it does not. ``then`` rows without a begin are ignored."""
    linked = scan(df, keys, order, segment, after={"next_ms": ("min", F.when(then, F.col(ts_ms)))})
    begins = linked.where(begin).withColumn("first_ms", F.col(ts_ms))
    in_time = F.coalesce(F.col("next_ms") - F.col("first_ms") < F.lit(millis(bound)), F.lit(False))
    return begins.where(in_time), begins.where(~in_time).drop("next_ms")
