"""Sequential folds per key that still run in parallel within a hot key.

Some detectors change their state in a way no built-in aggregate expresses. Rows are numbered within
their key first, and each key is cut into segments of a fixed number of rows, so a task sees a
bounded group however hot its key is; most keys are one segment. Where a key has more, a first pass
summarises what each segment does to *any* incoming state and a second one walks those small
summaries to get the state every segment starts from. The last pass replays each segment from its
own start state. Spark partitions, sorts and shuffles; Python sees one segment at a time.
"""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator, Mapping, Sequence
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from tidegauge.operators.scans import SEGMENT, SLOT, Axis, scan
from tidegauge.session import written

POSITION, LEFT = "__position", "__left"
HASHES = ["__h1", "__h2"]  # 128 bits of the key: runs of a key are told by them, the key itself is only carried
NONE = float("nan")

# what a segment does to a state: (bounds of the states, outcomes)
Summary = tuple[list[float], list[float]]


Arrays = dict[str, np.ndarray]


def _runs(batches: Iterator[pa.RecordBatch], by: Sequence[str]) -> Iterator[tuple[pa.Table, list[int]]]:
    """Tables of whole runs of rows with equal ``by`` columns, with the bounds of the runs.

    A run may span batches: the parts of the last one wait and are joined once, when it ends.
    """
    waiting: list[pa.Table] = []
    last: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        columns = [table.column(name).to_numpy() for name in by]
        changed = np.zeros(table.num_rows, dtype=bool)
        changed[0] = last is not None and last != tuple(column[0] for column in columns)
        for column in columns:
            changed[1:] |= column[1:] != column[:-1]
        starts = np.flatnonzero(changed)
        last = tuple(column[-1] for column in columns)
        if len(starts):
            whole = pa.concat_tables([*waiting, table.slice(0, starts[-1])])
            shift = whole.num_rows - starts[-1]
            if whole.num_rows:
                yield whole, sorted({0, *(starts + shift).tolist()})
            waiting = []
        waiting.append(table.slice(starts[-1] if len(starts) else 0))
    if waiting:
        whole = pa.concat_tables(waiting)
        yield whole, [0, whole.num_rows]


def _cells(table: pa.Table, names: Sequence[str]) -> Arrays:
    return {name: table.column(name).to_numpy() for name in names}


def numbered(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], segment: Axis, previous: Mapping[str, Column] | None = None
) -> DataFrame:
    """Add what ``segmented_fold`` needs: the row's position in its key and the rows left after it."""
    one = F.lit(1).cast("long")
    counted = scan(df, keys, order, segment, upto={POSITION: ("sum", one)}, whole={LEFT: ("sum", one)}, previous=previous)
    return counted.withColumn(LEFT, F.col(LEFT) - F.col(POSITION))


def segmented_fold(
    df: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    initial: float,
    summarise: Callable[[Arrays], Summary],
    resolve: Callable[[Summary, float], float],
    replay: Callable[[float, Arrays, bool], dict[str, Any]],
    output: str,
    rows_per_segment: int = 1 << 16,
) -> DataFrame:
    """Rows produced by ``replay(state, columns, whether the key ends here)`` over ``numbered`` rows.

    The state is one double; NaN means none.
    """
    keyed = [f"__k{i}" for i in range(len(keys))]
    rows = written(df.select(
        F.xxhash64(*keys).alias(HASHES[0]), F.xxhash64(F.lit(1), *keys).alias(HASHES[1]),
        *[F.col(key).alias(name) for key, name in zip(keys, keyed)],
        F.expr(f"({POSITION} - 1) div {rows_per_segment}").alias(SEGMENT),
        F.lit(1).alias(SLOT), POSITION, LEFT, *values,
    ), "numbered")
    goes_on = F.col(SEGMENT) < F.expr(f"({POSITION} + {LEFT} - 1) div {rows_per_segment}")
    fields = {field.name: field for field in rows.schema.fields}
    schema = StructType.fromDDL(output)
    names = schema.names
    whole_key = [fields[name] for name in [*HASHES, *keyed]]
    summary_type = StructType.fromDDL("at array<double>, out array<double>")
    summary_schema = StructType([*whole_key, fields[SEGMENT], *summary_type.fields])
    state_schema = StructType([*whole_key, fields[SEGMENT], *StructType.fromDDL("state double").fields])
    out_schema = StructType([*[StructField(name, fields[name].dataType) for name in keyed], *schema.fields])

    def batches_of(table: pa.Table, at: np.ndarray, carried: Sequence[str], added: dict[str, Any], into: StructType) -> list[pa.RecordBatch]:
        """Rows ``at`` of the carried columns, beside new ones, in the types of ``into``."""
        target = to_arrow_schema(into)
        taken = table.select(list(carried)).take(pa.array(at))
        columns = [
            taken.column(field.name).cast(field.type) if field.name in carried else pa.array(added[field.name], type=field.type)
            for field in target
        ]
        return pa.Table.from_arrays(columns, schema=target).combine_chunks().to_batches()

    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in _runs(batches, [*HASHES, SEGMENT]):
            cells = _cells(table, values)
            found = [
                summarise({name: column[low:high] for name, column in cells.items()})
                for low, high in zip(bounds, [*bounds[1:], table.num_rows]) if low < high
            ]
            at = np.array(bounds[:len(found)])
            added = {"at": [bound for bound, _ in found], "out": [out for _, out in found]}
            yield from batches_of(table, at, [*HASHES, *keyed, SEGMENT], added, summary_schema)

    def starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The state behind each summarised segment; a key's summaries pass one by one, only the state is held."""
        key, state = None, initial
        for batch in batches:
            table, after = pa.Table.from_batches([batch]), []
            one, two = (table.column(name).to_numpy() for name in HASHES)
            for i, (at, out) in enumerate(zip(table.column("at").to_pylist(), table.column("out").to_pylist())):
                if key != (one[i], two[i]):
                    key, state = (one[i], two[i]), initial
                state = resolve((at, out), state)
                after.append(state)
            if after:
                added = {SEGMENT: table.column(SEGMENT).to_numpy() + 1, "state": after}
                yield from batches_of(table, np.arange(table.num_rows), [*HASHES, *keyed], added, state_schema)

    def produce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in _runs(batches, [*HASHES, SEGMENT]):
            cells, slots, states = _cells(table, [LEFT, *values]), table.column(SLOT).to_numpy(), table.column("state").to_numpy()
            owners, sizes = [], []
            parts: dict[str, list] = {name: [] for name in names}
            for low, high in zip(bounds, [*bounds[1:], table.num_rows]):
                if low == high:
                    continue
                state, begin = (float(states[low]), low + 1) if slots[low] == 0 else (initial, low)
                group = {name: column[begin:high] for name, column in cells.items()}
                found = replay(state, group, bool(group[LEFT][-1] == 0))
                if len(found[names[0]]):
                    owners.append(low)
                    sizes.append(len(found[names[0]]))
                    for name in names:
                        parts[name].append(found[name])
            if owners:
                added = {name: np.concatenate(columns) for name, columns in parts.items()}
                yield from batches_of(table, np.repeat(owners, sizes), keyed, added, out_schema)

    def arranged(frame: DataFrame, by: Sequence[str], *sort: str) -> DataFrame:
        return frame.repartition(*by).sortWithinPartitions(*by, *sort)

    summary = arranged(rows.where(goes_on), [*HASHES, SEGMENT], POSITION).mapInArrow(summaries, summary_schema)
    states = arranged(summary, HASHES, SEGMENT).mapInArrow(starts, state_schema)
    # a state row goes first in its segment; zeros keep its other columns' types in numpy
    together = rows.unionByName(states.withColumn(SLOT, F.lit(0)), allowMissingColumns=True).fillna(
        0, [POSITION, LEFT, *values]
    )
    found = arranged(together, [*HASHES, SEGMENT], SLOT, POSITION).mapInArrow(produce, out_schema)
    return found.select(*[F.col(name).alias(key) for key, name in zip(keys, keyed)], *names)


# --- state: the reference value that moves only when a row does not alert -----------------------


def _within(value: float, threshold: float) -> tuple[float, float]:
    """The smallest and the largest state that ``value`` is within the threshold of, as the test itself rounds."""

    def edge(outward: float) -> float:
        at = value + math.copysign(threshold, outward)
        inside = abs(value - at) <= threshold
        beside = math.nextafter(at, outward if inside else value)
        if (abs(value - beside) <= threshold) != inside:
            return at if inside else beside
        reach = 4 * max(math.ulp(value), math.ulp(threshold))
        good, bad = value, at + math.copysign(reach, outward)
        if inside:
            good = at
        while True:
            middle = good + (bad - good) / 2
            if middle in (good, bad):
                return good
            if abs(value - middle) <= threshold:
                good = middle
            else:
                bad = middle

    return edge(-math.inf), edge(math.inf)


def hold_summary(values: Sequence[float], threshold: float) -> Summary:
    """The outcome for every incoming reference: bounds of disjoint ranges of it, two each, and one
    outcome per range. A reference in no range is left as it is.

    A row takes over the references within its threshold: those of ranges met before, and incoming
    ones that no row has reached yet, which become a new range. Neighbouring ranges that have come to
    one reference are one, so a series that moves in small steps leaves few.
    """
    low, high, held = np.empty(0), np.empty(0), np.empty(0)
    for value in values:
        value = float(value)
        begin, end = _within(value, threshold)
        if len(held) == 1 and abs(value - held[0]) <= threshold:
            # the usual case: one range, whose reference moves on; what is new overlaps it
            held[0], low[0], high[0] = value, min(begin, low[0]), max(end, high[0])
            continue
        held[np.abs(value - held) <= threshold] = value
        first, last = int(np.searchsorted(high, begin)), int(np.searchsorted(low, end, side="right"))
        at, gaps = begin, []
        for i in range(first, last):
            if at < low[i]:
                gaps.append((at, math.nextafter(low[i], -math.inf)))
            at = max(at, math.nextafter(high[i], math.inf))
        if at <= end:
            gaps.append((at, end))
        if not gaps:
            continue
        for a, b in gaps:
            place = int(np.searchsorted(low, a))
            low, high, held = np.insert(low, place, a), np.insert(high, place, b), np.insert(held, place, value)
        joined = (held[1:] == held[:-1]) & (np.nextafter(high[:-1], np.inf) == low[1:])
        if joined.any():
            low, held = low[np.append(True, ~joined)], held[np.append(True, ~joined)]
            high = high[np.append(~joined, True)]
    # ranges whose references met later
    joined = (held[1:] == held[:-1]) & (np.nextafter(high[:-1], np.inf) == low[1:])
    keep = np.append(True, ~joined)[:len(held)]
    low, high, held = low[keep], high[np.append(~joined, True)[:len(high)]], held[keep]
    return np.stack([low, high], axis=1).ravel().tolist(), held.tolist()


def hold_resolve(summary: Summary, state: float) -> float:
    bounds, out = summary
    place = bisect_right(bounds, state)
    if place % 2:
        return float(out[place // 2])
    return float(out[place // 2 - 1]) if place and bounds[place - 1] == state else state


def hold_replay(state: float, values: Sequence[float], threshold: float) -> tuple[list[int], list[float]]:
    """Indices of alerting rows and the reference each was compared with."""
    where, held = [], []
    for index, value in enumerate(values):
        if abs(value - state) > threshold:
            where.append(index)
            held.append(state)
        else:
            state = value
    return where, held


# --- state: the pending timer of a sustained rise -----------------------------------------------


def rise_replay(timer: float, times: Sequence[int], steps: Sequence[int], wait: int) -> tuple[list[int], float]:
    """Fired timers and the timer left over. A row at or after the timer sees it fired; then a rise
    starts a timer if none runs, a drop stops it."""
    fired = []
    for time, step in zip(times, steps):
        if time >= timer:
            fired.append(int(timer))
            timer = NONE
        if step < 0:
            timer = NONE
        elif step > 0 and timer != timer:
            timer = time + wait
    return fired, timer


def rise_summary(times: Sequence[int], steps: Sequence[int], wait: int) -> Summary:
    """After a drop the outcome no longer depends on the incoming timer. Without one, the first
    rise at or after that timer starts the next; rises with one outcome are one entry. The last row
    of any kind sees every timer up to its time fired."""
    times, steps = np.asarray(times), np.asarray(steps)
    drops = np.flatnonzero(steps < 0)
    if len(drops):
        _, timer = rise_replay(NONE, times[drops[-1]:], steps[drops[-1]:], wait)
        return [float("inf")], [timer]
    rises, end = times[steps > 0].astype(float), float(times[-1])
    following = np.searchsorted(rises, rises + wait, side="left")
    outcome = rises + wait
    for index in range(len(rises) - 1, -1, -1):
        if following[index] < len(rises):
            outcome[index] = outcome[following[index]]
    outcome[outcome <= end] = NONE
    last = np.append(outcome[1:] != outcome[:-1], True)[: len(rises)]
    return [*rises[last].tolist(), end], [*outcome[last].tolist(), NONE]


def rise_resolve(summary: Summary, timer: float) -> float:
    at, out = summary
    place = 0 if timer != timer else bisect_left(at, timer)
    return float(out[place]) if place < len(at) else timer
