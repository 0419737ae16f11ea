"""Grouped aggregates with partial aggregation before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_rows(name: str = "n") -> Column:
    return F.count(F.lit(1)).alias(name)


def exact_mean(value: Column | str, digits: int | None = None) -> Column:
    """Mean as a double; the sum and count parts merge across tasks."""
    mean = F.avg(value)
    return mean if digits is None else F.round(mean, digits)


def whole_mean(value: Column | str) -> Column:
    """Mean truncated by integer division, for integer inputs."""
    value = F.col(value) if isinstance(value, str) else value
    return F.floor(F.sum(value) / F.count(value))


def _present_first(order: Sequence[str]) -> list[Column]:
    """``order`` with NULLs last."""
    return [part for name in order for part in (F.col(name).isNull(), F.col(name))]


def first_row(columns: Sequence[str], order: Sequence[str]) -> Column:
    """The row that comes first in ``order``, as a struct; rows with NULLs there come last.

    Keeps one row per group and task."""
    return F.min_by(F.struct(*columns), F.struct(*_present_first(order)))


def extreme(value: str, order: Sequence[str], carried: Sequence[str], kind: str, whole_row: bool) -> list[Column]:
    """``min``/``max`` of ``value`` with other fields from the first row, or, with ``whole_row``,
    from the extreme row itself (the earliest one of equals).

    A row without a value is never the extreme one while the group has others. A group with only
    NULLs gives NULL, and with ``whole_row`` the other fields of its first row. ``value`` may be of
    any type that sorts; for the largest whole row ``order`` has to be of integers.
    """
    smallest = kind == "min"
    best = F.min(value) if smallest else F.max(value)
    if not whole_row or smallest:
        first = [*([value] if whole_row else []), *order]
        return [best.alias(value), *[F.min_by(F.col(name), F.struct(*_present_first(first))).alias(name) for name in carried]]
    # the earliest of equal rows is the largest by complemented order, which unlike a negative never overflows
    latest = [part for name in order for part in (F.col(name).isNotNull(), F.bitwise_not(name))]
    rank = F.struct(F.col(value).isNotNull(), F.col(value), *latest)
    return [best.alias(value), *[F.max_by(F.col(name), rank).alias(name) for name in carried]]
