"""Sliding merges against copies of every row into its windows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tidegauge.functions.hashing import bit_offset
from tidegauge.operators import sliding

ROW = "id long, key string, ms long, v long"


def rows(seed=3, n=400):
    pick = random.Random(seed)
    out = [(i, pick.choice(["a", "b", None]), pick.choice([pick.randrange(-5_000, 60_000), pick.randrange(300)]),
            pick.choice([None, *range(50)])) for i in range(n)]
    return out + [(n, "a", None, 7), (n + 1, "c", 10**12, 1), (n + 2, "c", -10**12, 2), (n + 3, None, 5, None)]


def copied(data, size, every):
    """(key, window end) -> rows."""
    found = {}
    for _, key, ms, v in data:
        if ms is not None:
            last = ms // every * every
            for start in range(last - size + every, last + every, every):
                found.setdefault((key, start + size), []).append(v)
    return found


@pytest.mark.parametrize("size,every", [(1000, 100), (60, 20), (100, 100), (72_000, 100), (3, 1)])
def test_extremes_equal_copied_windows(spark, size, every):
    data = rows()
    df = spark.createDataFrame(data, ROW).repartition(3)
    got = sliding.slide_extremes(df, "ms", size, every, {"least": ("min", F.col("v")), "most": ("max", F.col("v"))}, ["key"])
    expected = {}
    for place, values in copied(data, size, every).items():
        values = [v for v in values if v is not None]
        if values:
            expected[place] = (min(values), max(values))
    listed = got.collect()
    assert {(r["key"], r.window_end_ms): (r.least, r.most) for r in listed} == expected and len(listed) == len(expected)


@pytest.mark.parametrize("size,every", [(1000, 100), (50, 50)])
def test_bitmaps_and_sketches_equal_distinct_counts(spark, size, every):
    data = [(i, None, ms, v) for i, _, ms, v in rows() if ms is None or abs(ms) < 10**9]
    df = spark.createDataFrame(data, ROW)
    bits = {r.v: r.bit for r in df.select("v", bit_offset("v", 1 << 17).alias("bit")).distinct().collect()}
    expected = {end: {v for v in values if v is not None} for (_, end), values in copied(data, size, every).items()}
    bitmap = sliding.unique_bitmap_sliding(df, "ms", size, every, "v", 1 << 17)
    assert {r.window_end_ms: r.uv for r in bitmap.collect()} == {e: len({bits[v] for v in vs}) for e, vs in expected.items() if vs}
    sketch = sliding.unique_sketch_sliding(df, "ms", size, every, "v")
    assert {r.window_end_ms: r.uv for r in sketch.collect()} == {e: len(vs) for e, vs in expected.items() if vs}  # exact while small


def test_work_does_not_grow_with_the_windows_of_a_row(spark):
    """However many windows a pane is in, it makes at most three runs."""
    panes = spark.range(1000).select((F.col("id") * 7000).alias("pane_ms"), F.col("id").alias("v"))
    for size in ("10 seconds", "10 minutes", "5 hours"):
        runs = sliding.slide_merged(panes, "pane_ms", size, "1 second", {"v": F.max})
        assert runs.count() <= 3 * 1000


def test_empty_and_uneven(spark):
    df = spark.createDataFrame([], ROW)
    assert sliding.slide_extremes(df, "ms", 100, 10, {"v": ("min", F.col("v"))}).count() == 0
    with pytest.raises(ValueError):
        sliding.slide_extremes(df, "ms", 100, 30, {"v": ("min", F.col("v"))})
