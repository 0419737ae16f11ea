"""Keyed stateful processors for ``transformWithStateInPandas``.

Two orders are offered. *Arrival* processors work through the rows of a micro-batch by their arrival
number. *Event* processors hold rows back until the watermark has passed them and then work through
them by event time, which makes a stream give the rows its batch form gives. State per key is
small; memory per key is bounded by one micro-batch plus the rows still ahead of the watermark.

A call per key and its accesses to state cost milliseconds, so many keys with few rows each are dealt
into groups: one call then works on all keys of a group, whose states lie side by side. A row that is handed to a
call costs tens of microseconds, so the rows of a group travel as packs, Arrow bytes of many rows.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Mapping, Sequence
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BinaryType, StructField, StructType

from tidegauge.operators.folds import NONE, hold_replay, rise_replay


GROUP, NULLS, PACK = "__group", "__nulls", "pack"
ROWS_AT_ONCE = 1 << 17  # that a task holds to make packs of


def process(
    rows: DataFrame, keys: Sequence[str], processor: StatefulProcessor, output: str, time: str = "None", groups: int | None = None,
    ts: str = "ts",
) -> DataFrame:
    """Apply a processor per key; ``time`` is None, EventTime or ProcessingTime.

    With ``groups`` a call works on all keys of one of so many groups, for processors that are ``_Grouped``. The
    number is fixed for the life of a query. Rows then come without ``ts``, the event time the engine goes by.
    """
    by = list(keys)
    if groups is not None:
        by, types = [GROUP, NULLS], dict(rows.dtypes)
        # pandas turns a column of whole numbers with nulls into doubles, so which keys are null is told beside them
        nulls = sum((F.col(k).isNull().cast("long") * (1 << i) for i, k in enumerate(keys)), F.lit(0).cast("long"))
        filled = {k: F.coalesce(k, F.lit("" if types[k] == "string" else 0).cast(types[k])) for k in keys}
        rows = rows.withColumns({GROUP: F.pmod(F.xxhash64(*keys), F.lit(groups)), NULLS: nulls}).withColumns(filled)
        rows = in_packs(rows, by, ts)
        processor.in_groups = True
    return rows.groupBy(*by).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=output, outputMode="Append", timeMode=time
    )


def in_packs(rows: DataFrame, by: Sequence[str], ts: str) -> DataFrame:
    """The rows of a task that are equal ``by``, as one row for every ``ROWS_AT_ONCE``: Arrow bytes without ``by`` and ``ts``.

    A pack has the earliest ``ts`` of its rows, so the engine, which drops what is late, passes no late row.
    """
    fields = {field.name: field for field in rows.schema.fields}
    schema = StructType([*[fields[name] for name in [*by, ts]], StructField(PACK, BinaryType())])  # ts keeps its watermark
    inner = [name for name in fields if name not in (*by, ts)]

    def packs(tables: Iterator[pa.Table]) -> Iterator[pa.RecordBatch]:
        for table in tables:
            table = table.sort_by([(name, "ascending") for name in by]).combine_chunks()
            changed = np.ones(table.num_rows, dtype=bool)
            changed[1:] = False
            for column in (table.column(name).to_numpy() for name in by):
                changed[1:] |= column[1:] != column[:-1]
            starts = np.flatnonzero(changed)
            parts = [table.slice(low, high - low) for low, high in zip(starts, [*starts[1:], table.num_rows])]
            heads = [table.column(name).take(pa.array(starts)).combine_chunks() for name in by]
            earliest = pa.array([pc.min(part.column(ts)) for part in parts], table.schema.field(ts).type)
            packed = pa.array([_stream(part.select(inner)) for part in parts], pa.binary())
            yield pa.RecordBatch.from_arrays([*heads, earliest, packed], names=[*by, ts, PACK])

    return rows.mapInArrow(lambda batches: packs(_tables(batches)), schema)


def _tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches put together to tables of ``ROWS_AT_ONCE`` rows or a little more."""
    held, rows = [], 0
    for batch in batches:
        held, rows = [*held, batch], rows + batch.num_rows
        if rows >= ROWS_AT_ONCE:
            yield pa.Table.from_batches(held)
            held, rows = [], 0
    if rows:
        yield pa.Table.from_batches(held)


def _stream(rows: pa.Table | pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as stream:
        stream.write(rows)
    return sink.getvalue().to_pybytes()


def _opened(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of a call, out of their packs if they came in some."""
    for frame in frames:
        yield pa.concat_tables(pa.ipc.open_stream(p).read_all() for p in frame[PACK]).to_pandas() if PACK in frame else frame


def _gather(frames: Iterator[pd.DataFrame], order: Sequence[str]) -> pd.DataFrame:
    return pd.concat(list(_opened(frames)), ignore_index=True).sort_values(list(order), kind="stable", ignore_index=True)


class _Keyed(StatefulProcessor):
    """Common parts: key columns of the output and a value state read with a default."""

    keys: Sequence[str]

    def result(self, key: tuple, **columns: Any) -> pd.DataFrame:
        frame = pd.DataFrame(columns)
        for place, (name, value) in enumerate(zip(self.keys, key)):
            frame.insert(place, name, value)
        return frame

    @staticmethod
    def read(state: Any, default: Any) -> Any:
        return state.get()[0] if state.exists() else default

    def set_alarm(self, at: int | None) -> None:
        """One timer per key, at the earliest time asked for; ``alarm`` is a value state that remembers it."""
        current = self.read(self.alarm, None)
        if at is None or (current is not None and current <= at):
            return
        if current is not None:
            self.handle.deleteTimer(current)
        self.handle.registerTimer(at)
        self.alarm.update((at,))

    def close(self) -> None:
        pass


class _Grouped(_Keyed):
    """A processor that works on one key, or on a group of keys whose columns come with the rows."""

    in_groups = False

    @property
    def key_columns(self) -> list[str]:
        return list(self.keys) if self.in_groups else []

    def whose(self, key: tuple, rows: pd.DataFrame) -> list[tuple]:
        """The key of each row."""
        if not self.in_groups:
            return [tuple(key)] * len(rows)
        empty = [[None] * len(rows) if int(key[1]) >> i & 1 else None for i in range(len(self.keys))]
        return list(zip(*[none or rows[name].tolist() for name, none in zip(self.keys, empty)]))

    def results(self, found: Sequence[tuple], *columns: str) -> pd.DataFrame:
        """Rows of (key, value of each column)."""
        frame = {}
        for place, name in enumerate(self.keys):
            frame[name] = self._column([row[0][place] for row in found])
        for place, name in enumerate(columns, 1):
            frame[name] = self._column([row[place] for row in found])
        return pd.DataFrame(frame)

    @staticmethod
    def _column(values: list) -> Any:
        kinds = set(map(type, values))
        return pd.array(values, dtype="Int64") if kinds == {int, type(None)} else values

    @staticmethod
    def unpack(held: Any) -> Any:
        return pickle.loads(bytes(held[0]))

    @staticmethod
    def pack(states: Any) -> tuple[bytes]:
        return (pickle.dumps(states),)


# --- arrival order ------------------------------------------------------------------------------


class RunningSum(_Keyed):
    """Each row with the running sum of its key."""

    def __init__(self, keys: Sequence[str], order: str, value: str):
        self.keys, self.order, self.value = keys, order, value

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.total = handle.getValueState("total", "total long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        batch = _gather(rows, [self.order])
        running = batch[self.value].cumsum() + self.read(self.total, 0)
        self.total.update((int(running.iloc[-1]),))
        yield self.result(key, **{self.order: batch[self.order], "running": running})


class _Windowed(_Grouped):
    """Keys hold the end of their window in ms, at ``place``. What is known of the keys lies in one entry per window;
    an event-time timer forgets the windows that are over."""

    place: int

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.windows = handle.getMapState("windows", "window_end long", "known binary")
        self.alarm = handle.getValueState("alarm", "ms long")

    def known(self, window: int) -> dict[tuple, int]:
        return self.unpack(self.windows.getValue((window,))) if self.windows.containsKey((window,)) else {}

    def know(self, windows: Mapping[int, dict[tuple, int]]) -> None:
        for window, known in windows.items():
            self.windows.updateValue((window,), self.pack(known))
        self.set_alarm(min(windows, default=None))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        self.alarm.clear()
        windows = [int(window[0]) for window in self.windows.keys()]
        for window in windows:
            if window <= now:
                self.windows.removeKey((window,))
        self.set_alarm(min((window for window in windows if window > now), default=None))
        return iter(())


class FirstVisit(_Windowed):
    """Each row with 1 when it is the first of its key, else 0. The key starts with its window's end."""

    place = 0

    def __init__(self, keys: Sequence[str], order: str):
        self.keys, self.order = keys, order

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        batch = _gather(rows, [self.order])
        found, windows, changed = [], {}, set()
        for who, number in zip(self.whose(key, batch), batch[self.order].tolist()):
            window = who[self.place]
            if window not in windows:
                windows[window] = self.known(window)
            first = who not in windows[window]
            if first:
                windows[window][who] = 1
                changed.add(window)
            found.append((who, number, int(first)))
        self.know({window: windows[window] for window in changed})
        yield self.results(found, self.order, "first")


class RepeatedHit(_Keyed):
    """Two hits in a row of a key, the later less than ``bound_ms`` after the earlier."""

    def __init__(self, keys: Sequence[str], order: Sequence[str], hit: str, ts_ms: str, bound_ms: int):
        self.keys, self.order, self.hit, self.ts, self.bound = keys, order, hit, ts_ms, bound_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "ms long, hit boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        batch = _gather(rows, self.order)
        last_ms, last_hit = self.last.get() if self.last.exists() else (0, False)
        times, hits = batch[self.ts].to_numpy(), batch[self.hit].to_numpy(dtype=bool)
        before = np.concatenate([[last_ms], times[:-1]])
        both = hits & np.concatenate([[last_hit], hits[:-1]]) & (before > times - self.bound)
        self.last.update((int(times[-1]), bool(hits[-1])))
        yield self.result(key, first_ms=before[both], next_ms=times[both])


class DailyCap(_Windowed):
    """Rows of one (key, day): the first ``cap`` pass, the next one is the alarm, the rest drop.

    The key ends with the day's end in ms; an event-time timer clears the counts when the day is over.
    ``carried`` columns of the rows come out with them.
    """

    place = -1

    def __init__(self, keys: Sequence[str], order: str, cap: int, carried: Sequence[str] = ()):
        self.keys, self.order, self.cap, self.carried = keys, order, cap, carried

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        batch = _gather(rows, [self.order])
        found, days, changed = [], {}, set()
        names = [self.order, *self.carried]
        for who, *columns in zip(self.whose(key, batch), *[batch[name].tolist() for name in names]):
            day = who[self.place]
            if day not in days:
                days[day] = self.known(day)
            before = days[day].get(who, 0)
            if before <= self.cap:
                days[day][who] = before + 1
                changed.add(day)
                found.append((who, *columns, "pass" if before < self.cap else "alarm"))
        self.know({day: days[day] for day in changed})
        if found:
            yield self.results(found, *names, "output")


class CountWindow(_Keyed):
    """Every ``rows`` rows of a key: their smallest value and the window's number."""

    def __init__(self, keys: Sequence[str], order: str, value: str, rows: int):
        self.keys, self.order, self.value, self.size = keys, order, value, rows

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.done = handle.getValueState("done", "windows long")
        self.open = handle.getListState("open", "value long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = [row[0] for row in self.open.get()] if self.open.exists() else []
        values = np.asarray(held + _gather(rows, [self.order])[self.value].tolist(), dtype="int64")
        full, done = len(values) // self.size, self.read(self.done, 0)
        rest = values[full * self.size:]
        self.open.clear()
        if len(rest):
            self.open.put([(int(v),) for v in rest])
        if full:
            self.done.update((done + full,))
            best = values[: full * self.size].reshape(full, self.size).min(axis=1)
            yield self.result(key, window_no=done + np.arange(full), smallest=best)


class SlidingCountWindow(_Keyed):
    """At every ``every``-th row of a key: the smallest of its last up to ``rows`` values."""

    def __init__(self, keys: Sequence[str], order: str, value: str, rows: int, every: int):
        self.keys, self.order, self.value, self.size, self.every = keys, order, value, rows, every

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "rows long")
        self.recent = handle.getListState("recent", "value long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = [row[0] for row in self.recent.get()] if self.recent.exists() else []
        fresh = _gather(rows, [self.order])[self.value].tolist()
        seen = self.read(self.seen, 0)
        values = np.asarray(held + fresh, dtype="int64")
        position = seen + 1 + np.arange(len(fresh))
        ends = np.flatnonzero(position % self.every == 0) + len(held) + 1
        best = [values[max(0, end - self.size):end].min() for end in ends]
        self.seen.update((seen + len(fresh),))
        self.recent.put([(int(v),) for v in values[-(self.size - 1):]])
        if len(ends):
            yield self.result(key, window_no=position[ends - len(held) - 1] // self.every - 1, smallest=best)


# --- event order --------------------------------------------------------------------------------


def _packed(rows: pd.DataFrame) -> bytes:
    return _stream(pa.RecordBatch.from_pandas(rows, preserve_index=False))


def _unpacked(data: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(data).read_pandas()


class EventOrdered(_Grouped):
    """Rows wait in state until the watermark has passed them; ``fold`` then sees each key's in order.

    ``order`` starts with the time column in ms. ``fold`` returns its results, the key's new state, and the time it wants
    to be called again at, without rows, when the watermark reaches it. Waiting rows lie in pieces in order of
    time, told by their first time: each holds ``PIECE_ROWS`` rows or more, and whole buckets of ``BUCKET_MS``. New
    rows make new pieces, and a timer reads and drops the pieces that are due; what waits for later is not touched.
    """

    BUCKET_MS = 600_000
    PIECE_ROWS = 4096

    def __init__(self, keys: Sequence[str], order: Sequence[str], columns: Sequence[str], row_schema: str):
        self.keys, self.order, self.columns, self.row_schema = keys, order, columns, row_schema

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "low long, piece long", "rows binary")
        self.pieces = handle.getValueState("pieces", "made long")
        self.alarm = handle.getValueState("alarm", "ms long")
        self.states = handle.getValueState("states", "states binary")

    #: The names of the results that ``fold`` finds, as tuples.
    found: Sequence[str]

    def fold(self, state: Any, rows: Mapping[str, np.ndarray], now: int) -> tuple[Sequence[tuple], Any, int | None]: ...

    def _wait(self, rows: pd.DataFrame) -> int:
        """Put rows by as pieces; their first time."""
        rows = rows.sort_values(self.order[0], kind="stable", ignore_index=True)
        times = rows[self.order[0]].to_numpy(dtype="int64")
        buckets = np.flatnonzero(np.diff(times // self.BUCKET_MS)) + 1  # where buckets begin
        made, low = self.read(self.pieces, 0), 0
        while low < len(rows):
            at = np.searchsorted(buckets, low + self.PIECE_ROWS)
            high = int(buckets[at]) if at < len(buckets) else len(rows)
            self.waiting.updateValue((int(times[low]), made), (_packed(rows.iloc[low:high]),))
            made, low = made + 1, high
        self.pieces.update((made,))
        return int(times[0])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        names = [*self.key_columns, *self.columns]
        batch = pd.concat([frame[names] for frame in _opened(rows)], ignore_index=True)
        self.set_alarm(self._wait(batch))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        self.alarm.clear()
        places = [(int(low), int(piece)) for low, piece in self.waiting.keys()]
        due = sorted(place for place in places if place[0] <= now)
        later = [low for low, _ in places if low > now]
        parts = [_unpacked(bytes(self.waiting.getValue(place)[0])) for place in due]
        for place in due:
            self.waiting.removeKey(place)
        frame = pd.concat(parts, ignore_index=True) if parts else pd.DataFrame(columns=[*self.key_columns, *self.columns])
        passed = frame[self.order[0]] <= now
        if not passed.all():
            later.append(self._wait(frame[~passed]))
        states = self.unpack(self.states.get()) if self.states.exists() else {}
        found = self._fold_all(key, frame[passed], states, now)
        self.states.update(self.pack(states))
        if found:
            yield self.results(found, *self.found)
        wakes = [wake for _, wake in states.values() if wake is not None]
        self.set_alarm(min([*later, *wakes], default=None))

    def _fold_all(self, key: tuple, rows: pd.DataFrame, states: dict[tuple, tuple[Any, int | None]], now: int) -> list[tuple]:
        """Fold the keys that have rows or are to be called; (key, results) in order, with ``states`` changed."""
        rows = rows.sort_values([*self.key_columns, *self.order], kind="stable", ignore_index=True)
        changed = np.zeros(len(rows), dtype=bool)
        changed[:1] = True
        for name in self.key_columns:
            column = rows[name].to_numpy()
            changed[1:] |= column[1:] != column[:-1]
        starts = np.flatnonzero(changed)
        columns = {name: rows[name].to_numpy() for name in self.columns}
        work = [
            (who, {name: column[low:high] for name, column in columns.items()})
            for who, low, high in zip(self.whose(key, rows.iloc[starts]), starts, [*starts[1:], len(rows)])
        ]
        seen = {who for who, _ in work}
        none = {name: column[:0] for name, column in columns.items()}
        work += [(who, none) for who, (_, wake) in states.items() if wake is not None and wake <= now and who not in seen]
        out = []
        for who, part in work:
            found, state, wake = self.fold(states[who][0] if who in states else None, part, now)
            states[who] = (state, wake)
            out += [(who, *row) for row in found]
        return out


class JumpAlert(EventOrdered):
    """Values that differ from the key's previous one by more than ``threshold``."""

    def __init__(self, keys, order, columns, row_schema, value: str, threshold: float):
        super().__init__(keys, order, columns, row_schema)
        self.value, self.threshold = value, threshold
        self.found = [*order, "last", "value"]

    def fold(self, state, rows, now):
        values = rows[self.value].astype(float)
        before = np.concatenate([[NONE if state is None else state], values[:-1]])
        jumps = np.abs(values - before) > self.threshold
        found = [rows[n][jumps].tolist() for n in self.order]
        return list(zip(*found, before[jumps].tolist(), values[jumps].tolist())), float(values[-1]), None


class JumpAlertHold(JumpAlert):
    """As ``JumpAlert``; the reference starts at ``start`` and stays put while a row alerts."""

    start = 0.0

    def fold(self, state, rows, now):
        values = rows[self.value].astype(float).tolist()
        state = self.start if state is None else state
        where, held = hold_replay(state, values, self.threshold)
        alerting = set(where)
        calm = next((value for place, value in zip(reversed(range(len(values))), reversed(values)) if place not in alerting), state)
        found = [rows[n][where].tolist() for n in self.order]
        return list(zip(*found, held, [values[i] for i in where])), calm, None


class StrictNext(EventOrdered):
    """A hit directly followed by a hit of the key within less than ``bound_ms``."""

    found = ["first_ms", "next_ms"]

    def __init__(self, keys, order, columns, row_schema, hit: str, bound_ms: int):
        super().__init__(keys, order, columns, row_schema)
        self.hit, self.bound = hit, bound_ms

    def fold(self, state, rows, now):
        last_ms, last_hit = state or (0, False)
        times, hits = rows[self.order[0]].astype("int64"), rows[self.hit].astype(bool)
        before = np.concatenate([[last_ms], times[:-1]])
        both = hits & np.concatenate([[last_hit], hits[:-1]]) & (times - before < self.bound)
        return list(zip(before[both].tolist(), times[both].tolist())), (int(times[-1]), bool(hits[-1])), None


class FollowedBy(EventOrdered):
    """Begin rows whose first later closing row comes within less than ``bound_ms``, else a timeout.

    ``step`` is 1 for a begin row, 2 for a closing row. Open begins wait in state; their timeout is
    an event-time timer.
    """

    def __init__(self, keys, order, columns, row_schema, step: str, identity: str, bound_ms: int):
        super().__init__(keys, order, columns, row_schema)
        self.step, self.identity, self.bound = step, identity, bound_ms
        self.found = [identity, "first_ms", "next_ms"]

    def fold(self, state, rows, now):
        begun: list[tuple[int, int]] = state or []
        found: list[tuple[int, int, int | None]] = []

        def expire(at: int) -> None:
            nonlocal begun
            found.extend((who, ms, None) for ms, who in begun if at - ms >= self.bound)
            begun = [(ms, who) for ms, who in begun if at - ms < self.bound]

        for time, step, who in zip(*[rows[name].tolist() for name in (self.order[0], self.step, self.identity)]):
            if step == 2:
                expire(time)
                found.extend((begin, ms, int(time)) for ms, begin in begun)
                begun = []
            elif step == 1:
                begun.append((int(time), int(who)))
        expire(now)
        return found, begun, min(ms for ms, _ in begun) + self.bound if begun else None


class RiseAlarm(EventOrdered):
    """One alarm whenever a key's value has risen without a drop for ``wait_ms`` of event time."""

    found = ["alarm_ms"]

    def __init__(self, keys, order, columns, row_schema, value: str, wait_ms: int):
        super().__init__(keys, order, columns, row_schema)
        self.value, self.wait = value, wait_ms

    def fold(self, state, rows, now):
        (last, timer), fired = state or (NONE, NONE), []
        values = rows[self.value].astype(float)
        if len(values):
            step = np.sign(values - np.concatenate([[last], values[:-1]]))
            last = float(values[-1])
            moves = np.flatnonzero(np.isfinite(step) & (step != 0))
            times = rows[self.order[0]].astype("int64")
            fired, timer = rise_replay(timer, times[moves].tolist(), step[moves].tolist(), self.wait)
        if timer <= now:  # never true without a timer
            fired.append(int(timer))
            timer = NONE
        return [(ms,) for ms in fired], (last, timer), None if timer != timer else int(timer)


class ClockRiseAlarm(_Grouped):
    """Rise alarm on a clock: a rise sets a timer, a drop cancels it, and it fires when the clock reaches it.

    The clock is that of the machine (time mode ProcessingTime) or, with ``clock``, a column of ms that
    never falls along ``order`` and is the stream's event time (time mode EventTime). Rows are worked through as they
    arrive; none is held back.
    """

    def __init__(self, keys: Sequence[str], order: Sequence[str], value: str, wait_ms: int, clock: str | None = None):
        self.keys, self.order, self.value, self.wait, self.clock = keys, order, value, wait_ms, clock

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.states = handle.getValueState("states", "states binary")
        self.alarm = handle.getValueState("alarm", "ms long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        batch = _gather(rows, self.order)
        if self.clock is None:
            clocks = [timerValues.getCurrentProcessingTimeInMs()] * len(batch)
        else:
            batch = batch[batch[self.clock].notna()]
            clocks = batch[self.clock].astype("int64").tolist()
        states = self.unpack(self.states.get()) if self.states.exists() else {}
        found = []
        for who, now, value in zip(self.whose(key, batch), clocks, batch[self.value].astype(float).tolist()):
            last, timer = states.get(who, (NONE, None))
            if timer is not None and timer <= now:  # rows are handled before expired timers: this one fired first
                found.append((who, timer))
                timer = None
            if value < last:
                timer = None
            elif value > last and timer is None:
                timer = now + self.wait
            states[who] = (value, timer)
        self._keep(states)
        if found:
            yield self.results(found, "alarm_ms")

    def _keep(self, states: dict[tuple, tuple[float, int | None]]) -> None:
        self.states.update(self.pack(states))
        self.set_alarm(min((timer for _, timer in states.values() if timer is not None), default=None))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        reached = expiredTimerInfo.getExpiryTimeInMs() if self.clock is None else timerValues.getCurrentWatermarkInMs()
        self.alarm.clear()
        states = self.unpack(self.states.get())
        found = [(who, timer) for who, (_, timer) in states.items() if timer is not None and timer <= reached]
        for who, _ in found:
            states[who] = (states[who][0], None)
        self._keep(states)
        if found:
            yield self.results(found, "alarm_ms")


# --- windows that fire more than once -----------------------------------------------------------


class OpenWindows(_Keyed):
    """Results of a key's sliding windows: the first when the watermark reaches a window's end, then
    one for every late row until the window closes.

    Rows carry ``wm_before``, the watermark at their arrival, and the engine's watermark is one ms behind
    it. A result without arrival number is a first one. State: one entry per open window, and one timer
    at the next end or closing of any of them, which fires or drops all that are due.
    """

    def __init__(self, keys: Sequence[str], order: Sequence[str], ts_ms: str, size: int, every: int, late: int):
        self.keys, self.order, self.ts, self.size, self.every, self.late = keys, order, ts_ms, size, every, late

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", "window_end long", "n long, fired boolean")
        self.alarm = handle.getValueState("alarm", "ms long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        batch = _gather(rows, self.order)
        batch = batch[batch[self.ts].notna()]
        if not len(batch):
            return
        held = {int(end[0]): (int(value[0]), bool(value[1])) for end, value in self.open.iterator()}
        times, before = batch[self.ts].to_numpy(dtype="int64"), batch["wm_before"].to_numpy(dtype="int64")
        ends = (times // self.every + 1)[:, None] * self.every + np.arange(0, self.size, self.every)
        accepted = ends - 1 + self.late > before[:, None]
        again = accepted & (before[:, None] >= ends - 1)
        changed: dict[int, tuple[int, bool]] = {}
        for end, n in zip(*np.unique(ends[accepted & ~again], return_counts=True)):
            had, fired = held.get(int(end), (0, False))
            changed[int(end)] = (had + int(n), fired)
        found: list[tuple[int, int | None, int]] = []
        numbers = batch[self.order[0]].to_numpy(dtype="int64")
        for row, place in zip(*np.nonzero(again)):  # in order of arrival
            end = int(ends[row, place])
            n, fired = changed.get(end) or held.get(end, (0, False))
            if n and not fired:
                found.append((end, None, n))
            changed[end] = (n + 1, True)
            found.append((end, int(numbers[row]), n + 1))
        for end, value in changed.items():
            self.open.updateValue((end,), value)
        self.set_alarm(min((self._due(end, fired) for end, (_, fired) in changed.items()), default=None))
        if found:
            yield self._results(key, found)

    def _due(self, end: int, fired: bool) -> int:
        """When a window needs the timer next, on the engine's clock."""
        return end - 2 + (self.late if fired else 0)

    def _results(self, key: tuple, found: list[tuple[int, int | None, int]]) -> pd.DataFrame:
        ends, numbers, counts = zip(*found)
        return self.result(key, **{"window_end_ms": list(ends), self.order[0]: pd.array(numbers, dtype="Int64"), "n": list(counts)})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs() + 1
        self.alarm.clear()
        found: list[tuple[int, int | None, int]] = []
        waiting: list[int] = []
        for end, value in list(self.open.iterator()):
            end, n, fired = int(end[0]), int(value[0]), bool(value[1])
            fires = not fired and end - 1 <= watermark
            if fires:
                found.append((end, None, n))
            if end - 1 + self.late <= watermark:
                self.open.removeKey((end,))
                continue
            if fires:
                self.open.updateValue((end,), (n, True))
            waiting.append(self._due(end, fired or fires))
        self.set_alarm(min(waiting, default=None))
        if found:
            yield self._results(key, sorted(found))
