"""Splitting, tagging, merging and redistributing rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.hashing import shard_of


def side_output(df: DataFrame, to_side: Column, *side_columns: Column) -> tuple[DataFrame, DataFrame]:
    """(main, side): rows for which ``to_side`` is true leave the main output; NULL stays in it."""
    goes = F.coalesce(to_side, F.lit(False))
    side = df.where(goes)
    return df.where(~goes), side.select(*side_columns) if side_columns else side


def tag_rows(df: DataFrame, *tags: Column, name: str = "tags") -> DataFrame:
    """Add the tags of a row; a NULL tag does not apply."""
    return df.withColumn(name, F.array_compact(F.array(*tags)))


def select_tags(df: DataFrame, *wanted: str, name: str = "tags") -> DataFrame:
    """Rows with any of the wanted tags, each row once."""
    return df.where(F.arrays_overlap(name, F.array(*map(F.lit, wanted))))


def co_map(left: DataFrame, left_columns: Sequence[Column], right: DataFrame, right_columns: Sequence[Column]) -> DataFrame:
    """Map two inputs of different type separately into one output; absent columns become NULL."""
    return left.select(*left_columns).unionByName(right.select(*right_columns), allowMissingColumns=True)


def union_all(*inputs: DataFrame) -> DataFrame:
    """All rows of two or more inputs of one type, duplicates kept."""
    return reduce(DataFrame.unionByName, inputs)


def redistribute(df: DataFrame, *keys: str) -> DataFrame:
    """Bring equal keys together without aggregating. Adaptive execution splits a partition that a
    hot key makes too large and merges small ones; the rows stay the same."""
    return df.hint("rebalance", *[F.col(key) for key in keys])


def shard_filter(df: DataFrame, key: str, value: str, shards: int, name: str = "shard") -> DataFrame:
    """Keep rows whose ``value`` modulo ``shards`` equals the shard of their key."""
    return df.withColumn(name, shard_of(key, shards)).where(
        F.col(name) == F.pmod(F.col(value), F.lit(shards))
    )
