"""Rows that wait for the watermark, with state held in plain Python so that every access is counted."""

from __future__ import annotations

import random

import pandas as pd
import pytest

from tidegauge.streaming import processors


class Value:
    def __init__(self):
        self.held = None

    def exists(self):
        return self.held is not None

    def get(self):
        return self.held

    def update(self, value):
        self.held = value

    def clear(self):
        self.held = None


class Map(dict):
    read = 0

    def updateValue(self, key, value):
        self[key] = value

    def getValue(self, key):
        self.read += len(self[key][0])
        return self[key]

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


class Clock:
    def __init__(self, now):
        self.now = now

    def getCurrentWatermarkInMs(self):
        return self.now


def run(batches, watermarks):
    """The jumps found, and the bytes of waiting rows that each batch's timers read."""
    processor, handle = processors.JumpAlert(["k"], ["ms", "id"], ["ms", "id", "value"], "", "value", 5), Handle()
    processor.init(handle)
    found, reads = [], []
    for rows, now in zip(batches, watermarks, strict=True):
        if rows:
            assert list(processor.handleInputRows(("k",), iter([pd.DataFrame(rows, columns=["ms", "id", "value"])]), Clock(now))) == []
        before = handle.map.read
        for at in [t for t in handle.timers if t <= now]:
            handle.timers.discard(at)
            for frame in processor.handleExpiredTimer(("k",), Clock(now), None):
                found += frame[["ms", "id", "last", "value"]].itertuples(index=False, name=None)
        reads.append(handle.map.read - before)
    assert not handle.map
    return found, reads


@pytest.mark.parametrize("bucket", [1, 50, 10_000_000])
def test_rows_come_out_in_order_whatever_the_pieces(monkeypatch, bucket):
    monkeypatch.setattr(processors.EventOrdered, "BUCKET_MS", bucket)
    pick = random.Random(bucket)
    rows = [(pick.randrange(0, 2000), i, float(pick.randrange(30))) for i in range(500)]
    rows.sort(key=lambda r: (r[0] + pick.randrange(200), r[1]))
    batches = [rows[i:i + 50] for i in range(0, 500, 50)] + [[]]
    marks = [max(r[0] for r in rows[:i + 50]) - 200 for i in range(0, 500, 50)] + [10**9]
    ordered = sorted(rows)
    expected = [(b[0], b[1], a[2], b[2]) for a, b in zip(ordered, ordered[1:]) if abs(a[2] - b[2]) > 5]
    assert run(batches, marks)[0] == expected


def test_a_timer_reads_what_is_due_and_no_more():
    """100,000 rows wait far ahead; batches of 100 rows read little more than themselves."""
    hour = 3_600_000
    far = [(1000 * hour + i * 1000, i, 0.0) for i in range(100_000)]
    small = [[(b * hour + i, 200_000 + b * 100 + i, 0.0) for i in range(100)] for b in range(1, 9)]
    _, reads = run([far, *small, []], [0, *[b * hour + 200 for b in range(1, 9)], 10**12])
    assert max(reads[1:-1]) < 10_000 and reads[-1] > 2_000_000
