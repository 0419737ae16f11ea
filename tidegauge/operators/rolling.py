"""Rolling aggregates: one output row per input row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.operators.scans import Axis, scan


def rolling(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, kind: str, name: str, segment: Axis
) -> DataFrame:
    """Running ``sum``, ``min`` or ``max`` per key."""
    return scan(df, keys, order, segment, upto={name: (kind, value)})


def rolling_suffix(
    df: DataFrame, key: str, order: Sequence[str], suffix: str, segment: Axis, name: str = "n", label: str = "label"
) -> DataFrame:
    """Running reduce that appends ``suffix`` to the key with every further row of the key."""
    counted = scan(df, [key], order, segment, upto={name: ("sum", F.lit(1).cast("long"))})
    return counted.withColumn(label, F.concat(F.col(key), F.repeat(F.lit(suffix), (F.col(name) - 1).cast("int"))))


def routed_sum(
    df: DataFrame, key: str, order: Sequence[str], value: str, segment: Axis, name: str = "running"
) -> DataFrame:
    """Route rows by parity of ``value`` and keep a separate running sum per (route, key)."""
    routed = df.withColumn("route", F.when(F.pmod(F.col(value), F.lit(2)) == 0, "even").otherwise("odd"))
    return scan(routed, ["route", key], order, segment, upto={name: ("sum", F.col(value))})
