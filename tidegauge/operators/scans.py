"""Ordered scans per key that never need all rows of a hot key in one task.

``Window.partitionBy(key).orderBy(t)`` hands every row of a key to one task. That is the cheapest
plan while keys are small, and fails when one key holds a large share of the table. ``scan`` cuts
the order axis of hot keys into segments of about equally many rows:

1. rows are windowed per (key, segment), so a hot key spreads over as many tasks as it has segments
   and every other key is one segment;
2. one small row per hot (key, segment) is aggregated with map-side combine, and a window over those
   small rows gives what each segment inherits from the earlier or later ones;
3. the inherited row joins its segment by union, as one extra first (or last) row, so step 1's
   window sees it like any other row. The rows are shuffled once.

Which keys are hot is counted, at every size alike: keys with more than ``HOT_ROWS`` rows are written
to a small table, with the bounds of their segments, and that table is joined to the rows. It has at
most one row per ``HOT_ROWS`` rows of the input; how it is joined is left to Catalyst, which knows its
size. A key's number of segments follows from its rows, and the bounds are quantiles of its axis, so
bursts get many segments and stray values none of their own. Beyond ``CUTS`` segments the rows
between two quantiles are divided evenly by value; whatever the axis looks like, no segment then has
more than about one row in ``CUTS`` of its key, but for rows of one single value.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.session import written

SEGMENT = "__segment"
SLOT = "__slot"
ALL = "__all"
ROWS_PER_SEGMENT = 1 << 20  # of a hot key
CUTS = 1 << 8  # quantiles that are known of a hot key's axis
HOT_ROWS = 1 << 24  # a key with more rows than this is split

_COMBINE = {"sum": F.sum, "min": F.min, "max": F.max}

Aggregates = Mapping[str, tuple[str, Column]]


class Axis(NamedTuple):
    """A numeric column that does not fall along the order, and about how many rows a segment of it has."""

    column: str
    rows: int | None = None


def by_rows(sequence: str, rows: int | None = None) -> Axis:
    """Segments of a unique sequence number."""
    return Axis(sequence, rows)


def by_time(ms: str, rows: int | None = None) -> Axis:
    """Segments of a millisecond column; rows of one key in one millisecond stay together."""
    return Axis(ms, rows)


def hot_keys(df: DataFrame, keys: Sequence[str], axis: Axis, least: int) -> DataFrame:
    """The keys with more than ``least`` rows: __hot_0…, their __rows and __bounds, where their segments begin.

    Only rows of such keys are read for the quantiles. The last bound is the largest value.
    """
    names = [f"__hot_{i}" for i in range(len(keys))]
    at = F.col(axis.column).cast("double")
    named = df.select(*[F.col(key).alias(name) for key, name in zip(keys, names)], at.alias("__at"))
    if least:
        counted = named.groupBy(*names).agg(F.count(F.lit(1)).alias("__rows"))
        hot = written(counted.where(F.col("__rows") > least), "hot-keys")
        if hot.isEmpty():
            return hot.withColumn("__bounds", F.lit(None).cast("array<double>"))
        found = hot.select(*[F.col(name).alias(f"{name}_") for name in names])
        same = reduce(Column.__and__, [F.col(name).eqNullSafe(F.col(f"{name}_")) for name in names])
        named = named.join(found, same, "left_semi")
    spread = named.groupBy(*names).agg(
        F.count(F.lit(1)).alias("__rows"), F.min("__at").alias("__low"), F.max("__at").alias("__high"),
        F.percentile_approx("__at", [i / CUTS for i in range(1, CUTS)], 32 * CUTS).alias("__cuts"),
    )
    parts = F.least(_segments(axis), F.lit(CUTS))
    chosen = F.transform(F.sequence(F.lit(1), parts - 1), lambda i: F.get("__cuts", F.floor(i * CUTS / parts).cast("int") - 1))
    bounds = F.concat(F.array("__low"), F.when(parts > 1, chosen).otherwise(F.array().cast("array<double>")), F.array("__high"))
    return written(spread.select(*names, "__rows", bounds.alias("__bounds")), "hot-bounds")


def _segments(axis: Axis) -> Column:
    """How many segments a hot key's ``__rows`` ask for."""
    return F.ceil(F.col("__rows") / (axis.rows or ROWS_PER_SEGMENT))


def _segment_of(axis: Axis) -> Column:
    """The segment of a hot key's row: a binary search among ``__bounds``, and a share of what lies between two of them."""
    at, bounds = F.col(axis.column).cast("double"), F.col("__bounds")
    last = F.size(bounds) - 2
    steps = F.array(*[F.lit(CUTS >> i) for i in range(1, CUTS.bit_length())])

    def halved(place: Column, step: Column) -> Column:
        return F.when((place + step <= last) & (F.get(bounds, place + step) <= at), place + step).otherwise(place)

    def divided(place: Column) -> Column:
        low, high = F.get(bounds, place), F.get(bounds, place + 1)
        share = F.coalesce(F.try_divide(at - low, high - low), F.lit(0.0))
        return place * parts + F.least(F.floor(share * parts), parts - 1)

    parts = F.ceil(_segments(axis) / CUTS)
    return F.aggregate(steps, F.lit(0), halved, divided)


def scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    segment: Axis,
    *,
    upto: Aggregates | None = None,
    before: Aggregates | None = None,
    after: Aggregates | None = None,
    whole: Aggregates | None = None,
    previous: Mapping[str, Column] | None = None,
    following: Mapping[str, Column] | None = None,
    split: bool = True,
) -> DataFrame:
    """Add ordered per-key columns.

    ``order`` must be a total order within a key and ``segment``'s column must not decrease along it.
    ``upto``/``before``/``after`` map a new column to ``(sum|min|max, input)`` over the rows up to
    and with, strictly before, or strictly after the current one, ``whole`` over all rows of the
    key. ``previous``/``following`` map a new column to an expression taken from the neighbouring row. Without keys the whole table is
    one sequence, segmented where it asks for more than one segment. Rows with a NULL key are a key of their own. Without ``split``
    keys are taken to be small.
    """
    folds = {
        f"__{part}_{name}": (part, name, _COMBINE[kind], value)
        for part, group in (("upto", upto), ("before", before), ("after", after), ("whole", whole))
        for name, (kind, value) in (group or {}).items()
    }
    picks = {
        f"__{part}_{name}": (part, name, value)
        for part, group in (("previous", previous), ("following", following))
        for name, value in (group or {}).items()
    }
    inputs = {temp: spec[-1] for temp, spec in {**folds, **picks}.items()}

    def results(groups: list[str], by: list[str]) -> dict[str, Column]:
        local = Window.partitionBy(*groups).orderBy(*by)
        # Spark recomputes a frame with a moving start for every row, but adds to one with a fixed
        # start; so later rows are folded from the far end
        backwards = Window.partitionBy(*groups).orderBy(*[F.desc(column) for column in by])
        spans = {
            "upto": local.rowsBetween(Window.unboundedPreceding, Window.currentRow),
            "before": local.rowsBetween(Window.unboundedPreceding, -1),
            "after": backwards.rowsBetween(Window.unboundedPreceding, -1),
            "whole": local.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing),
        }
        added = {name: combine(temp).over(spans[part]) for temp, (part, name, combine, _) in folds.items()}
        return added | {
            name: (F.lag if part == "previous" else F.lead)(temp).over(local)
            for temp, (part, name, _) in picks.items()
        }

    if not split and keys:
        return df.withColumns(inputs).withColumns(results([*keys], [*order])).drop(*inputs)

    whole_table = not keys
    if whole_table:
        df, keys = df.withColumn(ALL, F.lit(0)), [ALL]
    least = (segment.rows or ROWS_PER_SEGMENT) if whole_table else HOT_ROWS  # a table of one segment needs no bounds
    hot = hot_keys(df, keys, segment, least)
    is_hot = reduce(Column.__and__, [F.col(key).eqNullSafe(F.col(f"__hot_{i}")) for i, key in enumerate(keys)])
    joined = df.withColumns(inputs).join(hot, is_hot, "left")
    is_split = F.col("__rows").isNotNull()
    number = F.when(is_split, _segment_of(segment)).otherwise(F.lit(0)).cast("long")
    rows = joined.withColumns({SEGMENT: number, SLOT: F.lit(1)}).drop("__bounds")
    position = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    summary = rows.where(is_split).groupBy(*keys, SEGMENT).agg(
        *[combine(temp).alias(temp) for temp, (_, _, combine, _) in folds.items()],
        *[
            (F.max_by if part == "previous" else F.min_by)(F.col(temp), position).alias(temp)
            for temp, (part, _, _) in picks.items()
        ],
    )
    across = Window.partitionBy(*keys).orderBy(SEGMENT)
    backwards = Window.partitionBy(*keys).orderBy(F.desc(SEGMENT))
    types = dict(summary.dtypes)

    def inherited(parts: set[str], slot: int) -> Column | None:
        """The extra row at one end of a segment, as a struct; NULL where nothing is inherited."""
        earlier = slot == 0
        span = (across if earlier else backwards).rowsBetween(Window.unboundedPreceding, -1)
        step = F.lag if earlier else F.lead
        values = {temp: combine(temp).over(span) for temp, (part, _, combine, _) in folds.items() if part in parts}
        values |= {temp: step(temp).over(across) for temp, (part, _, _) in picks.items() if part in parts}
        if not values:
            return None
        cells = [values.get(temp, F.lit(None).cast(types[temp])).alias(temp) for temp in inputs]
        return F.when(step(SEGMENT).over(across).isNotNull(), F.struct(F.lit(slot).alias(SLOT), *cells))

    ends = [inherited({"upto", "before", "whole", "previous"}, 0), inherited({"after", "whole", "following"}, 2)]
    ended = summary.select(
        *keys, SEGMENT, *[end.alias(f"__end{place}") for place, end in enumerate(ends) if end is not None]
    )
    found = F.array_compact(F.array(*[name for name in ended.columns if name.startswith("__end")]))
    extra = ended.select(*keys, SEGMENT, F.explode(found).alias("end")).select(*keys, SEGMENT, "end.*")
    together = rows.unionByName(extra, allowMissingColumns=True)
    found = together.withColumns(results([*keys, SEGMENT], [SLOT, *order])).where(F.col(SLOT) == 1)
    return found.drop(SEGMENT, SLOT, ALL, "__rows", *[f"__hot_{i}" for i in range(len(keys))], *inputs)
