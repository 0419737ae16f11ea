"""Tokenising expressions; ``words`` gives one row per token."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def space_tokens(line: Column | str) -> Column:
    """Split on each single whitespace character; neighbours give empty tokens."""
    return F.split(line, r"\s")


def non_word_tokens(line: Column | str) -> Column:
    """Lower-case and split on runs of non-word characters."""
    return F.split(F.lower(line), r"\W+")


def words(df: DataFrame, tokens: Column, *kept: str, name: str = "word") -> DataFrame:
    """One row per non-empty token. The emptiness test runs on rows, inside generated code."""
    return df.select(*kept, F.explode(tokens).alias(name)).where(F.col(name) != "")
