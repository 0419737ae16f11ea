"""Reconciling two inputs on a key, optionally within a time bound."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.times import millis
from tidegauge.operators.aggregates import first_row


class Reconciled(NamedTuple):
    matched: DataFrame
    only_left: DataFrame
    only_right: DataFrame


def earliest_per_key(df: DataFrame, key: str, ts_ms: str, ties: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(one row per key, a count of the surplus rows per repeated key). The earliest row stays; one
    without a time stays only if its key has no other.

    Partial aggregation cuts a key with many copies to one row per task before the shuffle."""
    grouped = df.groupBy(key).agg(
        first_row([c for c in df.columns if c != key], [ts_ms, *([ties] if ties else [])]).alias("__row"),
        F.count(F.lit(1)).alias("__copies"),
    )
    unique = grouped.select(key, "__row.*").select(*df.columns)
    surplus = grouped.where(F.col("__copies") > 1).select(key, (F.col("__copies") - 1).alias("surplus_rows"))
    return unique, surplus


def _matches(left_ts: str, right_ts: str, max_gap: str | None) -> Column:
    if max_gap is None:
        return F.lit(True)
    return F.abs(F.col(left_ts) - F.col(right_ts)) <= F.lit(millis(max_gap))


def reconcile(
    left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, max_gap: str | None = None
) -> DataFrame:
    """One full outer join of two inputs with unique keys; ``side`` says both, left or right.

    ``left`` and ``right`` share only the key column. With ``max_gap`` two rows match only when
    their times are at most that far apart. All three outputs come from this one join.
    """
    l = left.withColumn("__left", F.lit(True))
    r = right.withColumnRenamed(key, "__right_key").withColumn("__right", F.lit(True))
    joined = l.join(
        r, (F.col(key) == F.col("__right_key")) & _matches(left_ts, right_ts, max_gap), "full_outer"
    )
    # not decided by the keys: rows without a key exist too, and never match
    side = F.when(F.col("__right").isNull(), "left").when(F.col("__left").isNull(), "right").otherwise("both")
    return (
        joined.withColumn("side", side).withColumn(key, F.coalesce(key, "__right_key"))
        .drop("__right_key", "__left", "__right")
    )


def reconcile_outputs(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, max_gap: str | None = None) -> Reconciled:
    joined = reconcile(left, right, key, left_ts, right_ts, max_gap)
    return Reconciled(
        matched=joined.where(F.col("side") == "both").drop("side"),
        only_left=joined.where(F.col("side") == "left").select(*left.columns),
        only_right=joined.where(F.col("side") == "right").select(*right.columns),
    )


def only_one_side(df: DataFrame, other: DataFrame, key: str, ts: str, other_ts: str, max_gap: str | None = None) -> DataFrame:
    """Rows of ``df`` without a partner in ``other``, as an anti join."""
    o = other.select(F.col(key).alias("__other_key"), other_ts)
    return df.join(o, (F.col(key) == F.col("__other_key")) & _matches(ts, other_ts, max_gap), "left_anti")
