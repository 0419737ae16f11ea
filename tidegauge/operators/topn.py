"""Top-N per window and its text report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n(df: DataFrame, groups: Sequence[str], measure: str, ties: Sequence[str], n: int, rank: str = "rank") -> DataFrame:
    """The ``n`` rows with the largest ``measure`` per group, ties by the columns in ``ties``.

    The bound on row_number lets Catalyst cut each task's rows to ``n`` per group before the shuffle.
    """
    order = Window.partitionBy(*groups).orderBy(F.col(measure).desc(), *ties)
    ranked = df.withColumn(rank, F.row_number().over(order)).where(F.col(rank) <= n)
    return ranked.withColumn(rank, F.col(rank).cast("long"))


def report(df: DataFrame, groups: Sequence[str], header: Column, line: Column, rank: str = "rank", name: str = "report") -> DataFrame:
    """Render ranked rows (at most N per group) as one text per group: a header, then a line per rank."""
    lines = F.sort_array(F.collect_list(F.struct(F.col(rank), line.alias("line"))))
    text = F.array_join(F.transform(lines, lambda row: row["line"]), "\n")
    return df.groupBy(*groups).agg(F.concat_ws("\n", F.first(header), text).alias(name))
