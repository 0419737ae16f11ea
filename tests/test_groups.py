"""Many keys in one call of a processor, with state held in plain Python so that every write is counted."""

from __future__ import annotations

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.test_waiting_rows import Clock, Value
from tidegauge.plans import catalog
from tidegauge.plans.tables import table
from tidegauge.streaming import arrivals, processors
from tidegauge.streaming.run import LateRows, append_files, drain, file_stream, state_settings

HOUR = 3_600_000
SF_DIR = "/root/testdata/sf0.001"


class Map(dict):
    written = 0

    def updateValue(self, key, value):
        self.written += 1
        self[key] = value

    def getValue(self, key):
        return self[key]

    def containsKey(self, key):
        return key in self

    def removeKey(self, key):
        del self[key]


class Handle:
    def __init__(self):
        self.timers, self.map = set(), Map()

    def getValueState(self, name, schema):
        return Value()

    def getMapState(self, name, key, value):
        return self.map

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.discard(at)


KEYS, NAMES = ["user", "kind"], ["user", "kind", "ms", "id", "value", "step"]


def run(processor, batches, watermarks, names=NAMES):
    """What a group's calls find, and the entries of state they wrote."""
    handle, found = Handle(), []
    processor.in_groups = True
    processor.init(handle)
    for rows, now in zip(batches, watermarks, strict=True):
        if rows:
            for frame in processor.handleInputRows((0, 0), iter([pd.DataFrame(rows, columns=names)]), Clock(now)):
                found += [tuple(None if pd.isna(v) else v for v in row) for row in frame.itertuples(index=False, name=None)]
        for at in [t for t in handle.timers if t <= now]:
            handle.timers.discard(at)
            for frame in processor.handleExpiredTimer((0, 0), Clock(now), None):
                found += [tuple(None if pd.isna(v) else v for v in row) for row in frame.itertuples(index=False, name=None)]
    assert not handle.map
    return found, handle.map.written


def feed(seed):
    """Rows of 100 keys over 30 days in four batches and the watermarks behind them, and each key's rows in order."""
    pick = random.Random(seed)
    rows = sorted(
        (pick.randrange(50), pick.choice("ab"), pick.randrange(30 * 24) * HOUR + 1, i, float(pick.randrange(40)), pick.randrange(3))
        for i in range(3000)
    )
    rows.sort(key=lambda r: (r[2] + pick.randrange(48 * HOUR), r[3]))
    batches = [rows[i:i + 750] for i in range(0, 3000, 750)] + [[]]
    marks = [max(r[2] for b in batches[:i + 1] for r in b) - 48 * HOUR for i in range(4)] + [10**12]
    by_key = {}
    for row in sorted(rows, key=lambda r: r[2:4]):
        by_key.setdefault(row[:2], []).append(row)
    return batches, marks, by_key


def jumps(rows):
    return [(b[2], b[3], a[4], b[4]) for a, b in zip(rows, rows[1:]) if abs(a[4] - b[4]) > 9]


COMMON = (KEYS, ["ms", "id"], NAMES[2:], "")
CASES = {"jump": (lambda: processors.JumpAlert(*COMMON, "value", 9), jumps)}


def held_jumps(rows):
    found, held = [], 0.0
    for _, _, ms, number, value, _ in rows:
        if abs(value - held) > 9:
            found.append((ms, number, held, value))
        else:
            held = value
    return found


CASES["hold"] = (lambda: processors.JumpAlertHold(*COMMON, "value", 9), held_jumps)


def hits_in_a_row(rows):
    return [(a[2], b[2]) for a, b in zip(rows, rows[1:]) if a[5] and b[5] and b[2] - a[2] < 20 * HOUR]


CASES["next"] = (lambda: processors.StrictNext(*COMMON, "step", 20 * HOUR), hits_in_a_row)


def followed(rows):
    found = []
    for place, (_, _, ms, number, _, step) in enumerate(rows):
        if step == 1:
            closing = next((r[2] for r in rows[place:] if r[5] == 2), None)
            found.append((number, ms, closing if closing is not None and closing - ms < 20 * HOUR else None))
    return found


CASES["followed"] = (lambda: processors.FollowedBy(*COMMON, "step", "id", 20 * HOUR), followed)


def rises(rows):
    found, timer, last = [], None, None
    for _, _, ms, _, value, _ in rows:
        if timer is not None and ms >= timer:
            found.append((timer,))
            timer = None
        if last is not None and value < last:
            timer = None
        elif last is not None and value > last and timer is None:
            timer = ms + 9 * HOUR
        last = value
    return found + ([(timer,)] if timer is not None else [])


CASES["rise"] = (lambda: processors.RiseAlarm(*COMMON, "value", 9 * HOUR), rises)


@pytest.mark.parametrize("case", CASES)
def test_a_group_gives_what_its_keys_give_alone(case):
    make, expected = CASES[case]
    batches, marks, by_key = feed(case)
    found, written = run(make(), batches, marks)
    assert sorted(found, key=str) == sorted([(*key, *row) for key, rows in by_key.items() for row in expected(rows)], key=str)
    assert written < 50  # pieces of rows that wait; one for each key and 10 minutes were some 3000


def test_sparse_rows_of_one_key_wait_together():
    processor, handle = processors.JumpAlert(["k"], ["ms", "id"], ["ms", "id", "value"], "", "value", 5), Handle()
    processor.init(handle)
    rows = pd.DataFrame([(h * HOUR, h, 0.0) for h in range(1, 721)], columns=["ms", "id", "value"])
    list(processor.handleInputRows(("k",), iter([rows]), Clock(0)))
    assert handle.map.written == 1


def with_day(batches):
    return [[(*row, (row[2] // (24 * HOUR) + 1) * 24 * HOUR) for row in batch] for batch in batches]


def test_a_group_counts_each_key_and_day_and_forgets_days_that_are_over():
    batches, marks, _ = feed("cap")
    counts, expected = {}, []
    for batch in with_day(batches):
        for row in sorted(batch, key=lambda r: r[3]):
            key = (row[0], row[1], row[-1])
            counts[key] = counts.get(key, 0) + 1
            if counts[key] <= 2:
                expected.append((*key, row[3], "pass" if counts[key] == 1 else "alarm"))
    processor = processors.DailyCap(["user", "kind", "day"], "id", 1)
    found, written = run(processor, with_day(batches), marks, [*NAMES, "day"])
    assert sorted(found) == sorted(expected) and len({row[-1] for row in expected}) == 2
    assert written < 100


def test_the_cap_carries_columns_of_each_key_in_a_group():
    batches, marks, _ = feed("carried")
    processor = processors.DailyCap(["user", "kind", "day"], "id", 2, ["ms"])
    found, _ = run(processor, with_day(batches), marks, [*NAMES, "day"])
    times = {row[3]: (row[0], row[1], row[2]) for batch in batches for row in batch}
    assert found and all(times[number] == (user, kind, ms) for user, kind, _, number, ms, _ in found)


def test_a_group_knows_the_first_visits_of_its_windows():
    batches, marks, _ = feed("visits")
    seen, expected = set(), []
    for batch in batches:
        for row in sorted(batch, key=lambda r: r[3]):
            key = (int((row[2] // (24 * HOUR) + 1) * 24 * HOUR), row[0])
            expected.append((*key, row[3], int(key not in seen)))
            seen.add(key)
    found, written = run(processors.FirstVisit(["day", "user"], "id"), with_day(batches), marks, [*NAMES, "day"])
    assert sorted(found) == sorted(expected)
    assert written < 100


def test_a_group_has_one_timer_for_the_alarms_of_its_keys():
    pick = random.Random(13)
    rows = [(pick.randrange(50), pick.choice("ab"), i * HOUR, i, float(pick.randrange(40)), 0) for i in range(1, 1001)]
    by_key = {}
    for row in rows:
        by_key.setdefault(row[:2], []).append(row)
    processor = processors.ClockRiseAlarm(KEYS, ["ms", "id"], "value", 200 * HOUR, "ms")
    batches = [rows[i:i + 250] for i in range(0, 1000, 250)] + [[]]
    found, _ = run(processor, batches, [*[batch[-1][2] - 1 for batch in batches[:-1]], 10**12])
    expected = []
    for key, own in by_key.items():
        timer, last = None, None
        for row in own:
            if timer is not None and row[2] >= timer:
                expected.append((*key, timer))
                timer = None
            if last is not None and row[4] < last:
                timer = None
            elif last is not None and row[4] > last and timer is None:
                timer = row[2] + 200 * HOUR
            last = row[4]
        expected += [(*key, timer)] if timer is not None else []
    assert sorted(found) == sorted(expected) and len(expected) > 50


def test_rows_of_a_group_travel_in_packs(spark):
    """A call gets few rows of bytes, which hold what the rows held, nulls included, and the earliest of their times."""
    rows = spark.range(0, 3000, 1, 2).select(
        (F.col("id") % 7).alias("group"), F.lit(0).cast("long").alias("nulls"),
        F.when(F.col("id") % 5 > 0, F.concat(F.lit("é"), F.col("id") % 3)).alias("name"),
        F.when(F.col("id") % 4 > 0, F.col("id") / 3).alias("value"), F.timestamp_millis(F.col("id") * 1000).alias("ts"), "id",
    )
    packs = processors.in_packs(rows, ["group", "nulls"], "ts").toPandas()
    assert len(packs) == 14 and list(packs) == ["group", "nulls", "ts", processors.PACK]
    assert sorted(packs["ts"].astype("datetime64[ms]").astype("int64") // 1000) == [*range(7), *range(1500, 1507)]
    for group, own in packs.groupby("group"):
        opened = pd.concat(processors._opened(iter([own]))).astype({"value": float}).sort_values("id", ignore_index=True)
        expected = rows.where(F.col("group") == group).select("name", "value", "id").orderBy("id").toPandas()
        pd.testing.assert_frame_equal(opened, expected)


class Reached(Exception):
    pass


def waiting(spark, monkeypatch, name, tmp_path):
    """The rows of a query that its processor gets."""
    got = []

    def stop(rows, *rest):
        got.append(rows)
        raise Reached

    monkeypatch.setattr(processors, "process", stop)
    with pytest.raises(Reached):
        catalog.queries()[name](spark, SF_DIR)
    drain(append_files(got[0], str(tmp_path)))
    return spark.read.parquet(f"{tmp_path}/out")


def test_only_steps_of_the_pattern_wait(spark, monkeypatch, tmp_path):
    rows = waiting(spark, monkeypatch, "streaming_order_payments", tmp_path)
    steps = table(spark, SF_DIR, "events").where(F.col("event_type").isin("signup", "purchase"))
    assert rows.count() == steps.count() > 0 and {row[0] for row in rows.select("kind").distinct().collect()} == {1, 2}


@pytest.mark.parametrize(("name", "unused"), [("streaming_login_fail_strict_next", "value"), ("streaming_rise_alarm", "kind")])
def test_columns_without_a_part_in_it_do_not_wait(spark, monkeypatch, tmp_path, name, unused):
    rows = waiting(spark, monkeypatch, name, tmp_path)
    assert unused not in rows.columns and rows.count() == table(spark, SF_DIR, "events").count()


def test_packs_with_late_rows_are_an_error(spark, tmp_path):
    feed = spark.createDataFrame([], "user long, ms long, ts timestamp")
    keys, folder = ["user"], str(tmp_path)
    for part in ([(1, 5000), (2, 9000)], [(1, 9500)], [(1, 7000), (1, 12000), (2, 13000)]):
        rows = spark.createDataFrame(part, "user long, ms long").withColumn("ts", F.timestamp_millis("ms"))
        arrivals.append_part(rows.coalesce(1), f"{folder}/feed")
    late = file_stream(spark, f"{folder}/feed", feed.schema, files_per_trigger=1).withWatermark("ts", "1 second")
    processor = processors.JumpAlert(keys, ["ms"], ["ms"], "", "ms", 1)
    found = processors.process(late, keys, processor, "user long, ms long, last double, value double", "EventTime", 1)
    with state_settings(spark, 1), pytest.raises(LateRows):
        drain(append_files(found, folder))
