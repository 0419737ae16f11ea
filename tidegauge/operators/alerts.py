"""Change alarms, rise alarms and rate caps per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.functions.times import day_end_ms, millis
from tidegauge.operators.folds import (
    NONE, hold_replay, hold_resolve, hold_summary, numbered, rise_replay, rise_resolve, rise_summary, segmented_fold,
)
from tidegauge.operators.scans import Axis, by_rows, scan

# Largest bound that Catalyst turns into a per-task row_number limit.
GROUP_LIMIT = 1000


def jump_alert(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, threshold: float, segment: Axis
) -> DataFrame:
    """Rows whose value differs from the key's previous one by more than ``threshold``. Adds ``last``."""
    linked = scan(df, keys, order, segment, previous={"last": F.col(value)})
    return linked.where(F.abs(F.col(value) - F.col("last")) > threshold)


def jump_alert_hold(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, threshold: float,
    segment: Axis, start: float = 0.0, rows_per_segment: int = 1 << 16,
) -> DataFrame:
    """As ``jump_alert``, but the reference starts at ``start`` and stays put while a row alerts."""
    rows = df.where(F.col(value).isNotNull()).withColumn(value, F.col(value).cast("double"))
    types = dict(rows.select(*order).dtypes)

    def replay(state, columns, ends):
        where, held = hold_replay(state, columns[value].tolist(), threshold)
        return {**{name: columns[name][where] for name in order}, "last": held, value: columns[value][where]}

    return segmented_fold(
        numbered(rows, keys, order, segment), keys, [*order, value], float(start),
        summarise=lambda columns: hold_summary(columns[value].tolist(), threshold),
        resolve=hold_resolve,
        replay=replay,
        output=", ".join([f"`{name}` {types[name]}" for name in order] + ["last double", f"`{value}` double"]),
        rows_per_segment=rows_per_segment,
    )


def rise_alarm(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, wait: str, segment: Axis,
    rows_per_segment: int = 1 << 16,
) -> DataFrame:
    """One ``alarm_ms`` whenever a key's value has risen without a drop for ``wait``.

    ``order`` starts with the time column in milliseconds. Equal values neither start nor stop a
    timer. Timers still running when the input ends fire.
    """
    time, wait_ms = order[0], millis(wait)
    linked = numbered(df, keys, order, segment, previous={"__last": F.col(value)})
    step = F.coalesce(F.signum(F.col(value) - F.col("__last")), F.lit(0)).cast("int")

    def replay(state, columns, ends):
        fired, timer = rise_replay(state, columns[time].tolist(), columns["__step"].tolist(), wait_ms)
        if ends and timer == timer:
            fired.append(int(timer))
        return {"alarm_ms": fired}

    return segmented_fold(
        linked.withColumn("__step", step), keys, [time, "__step"], NONE,
        summarise=lambda columns: rise_summary(columns[time], columns["__step"], wait_ms),
        resolve=rise_resolve,
        replay=replay,
        output="alarm_ms long",
        rows_per_segment=rows_per_segment,
    )


def daily_cap(df: DataFrame, keys: Sequence[str], ts: str, arrival: str, cap: int) -> tuple[DataFrame, DataFrame]:
    """(passed, alarms): the first ``cap`` rows per key and UTC day pass, the next one raises the
    day's single alarm, further rows are dropped.

    Both outputs only need the first ``cap + 1`` rows, so for usual caps each task cuts a hot key to
    that many rows before the shuffle; larger caps use a segmented count.
    """
    rows = df.withColumn("reset_ms", day_end_ms(ts))
    groups = [*keys, "reset_ms"]
    if cap < GROUP_LIMIT:
        numbered = rows.withColumn("nth", F.row_number().over(Window.partitionBy(*groups).orderBy(arrival)))
    else:
        numbered = scan(rows, groups, [arrival], by_rows(arrival), upto={"nth": ("sum", F.lit(1).cast("long"))})
    passed = numbered.where(F.col("nth") <= cap).drop("nth", "reset_ms")
    # the bound first: it is what reaches the tasks before the shuffle
    alarms = numbered.where(F.col("nth") <= cap + 1).where(F.col("nth") == cap + 1).drop("nth")
    return passed, alarms.withColumn("msg", F.format_string("more than %d a day", F.lit(cap)))
