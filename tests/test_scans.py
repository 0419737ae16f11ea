"""Segmented scans and folds against plain windows and plain loops, with tiny segments."""

from __future__ import annotations

import random
import time

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidegauge.operators import alerts, folds, scans
from tidegauge.operators.scans import by_rows, by_time, scan


def skewed(rows: int = 600, seed: int = 7) -> pd.DataFrame:
    """One key holds a third of the rows and more than half of them fall into one short burst."""
    rng = random.Random(seed)
    data = []
    for number in range(rows):
        key = "hot" if number % 3 == 0 else rng.choice("abcdefghij")
        ms = rng.randrange(1000) if rng.random() < 0.6 else rng.randrange(100_000)
        data.append((number, key, ms, float(rng.randrange(0, 200))))
    return pd.DataFrame(data, columns=["id", "key", "ms", "value"])


@pytest.fixture(autouse=True)
def every_key_is_hot(monkeypatch):
    monkeypatch.setattr(scans, "HOT_ROWS", 0)


@pytest.fixture(scope="module")
def table(spark):
    pdf = skewed()
    pdf.loc[pdf.index % 50 == 1, "key"] = None  # a missing key is a group of its own
    pdf.loc[pdf.index % 17 == 1, "value"] = None
    rows = [tuple(None if pd.isna(cell) else cell for cell in row) for row in pdf.itertuples(index=False)]
    return spark.createDataFrame(rows, "id long, key string, ms long, value double").repartition(5).cache()


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("keys", [["key"], []])
@pytest.mark.parametrize("hot_rows", [0, 150, 10_000])
@pytest.mark.parametrize("per_segment", [1, 40, 10_000_000])
def test_scan_equals_plain_windows(table, keys, per_segment, hot_rows, monkeypatch):
    monkeypatch.setattr(scans, "HOT_ROWS", hot_rows)  # 150: only the key with a third of the rows
    plain = Window.partitionBy(*keys).orderBy("ms", "id")
    upto, before = plain.rowsBetween(Window.unboundedPreceding, 0), plain.rowsBetween(Window.unboundedPreceding, -1)
    after = plain.rowsBetween(1, Window.unboundedFollowing)
    expected = table.select(
        "id", "key", "ms", "value",
        F.sum("value").over(upto).alias("s"), F.min("value").over(before).alias("m"), F.max("value").over(after).alias("x"),
        F.sum("value").over(Window.partitionBy(*keys)).alias("w"),
        F.lag("value").over(plain).alias("p"), F.lead("id").over(plain).alias("f"),
    )
    got = scan(
        table, keys, ["ms", "id"], by_time("ms", per_segment),
        upto={"s": ("sum", F.col("value"))}, before={"m": ("min", F.col("value"))}, after={"x": ("max", F.col("value"))},
        whole={"w": ("sum", F.col("value"))},
        previous={"p": F.col("value")}, following={"f": F.col("id")},
    )
    assert rows_of(got.select(expected.columns)) == rows_of(expected)


def test_scan_by_row_segments(table):
    plain = Window.partitionBy("key").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    expected = table.select("id", F.count(F.lit(1)).over(plain).alias("n"))
    got = scan(table, ["key"], ["id"], by_rows("id", 16), upto={"n": ("sum", F.lit(1).cast("long"))})
    assert rows_of(got.select("id", "n")) == rows_of(expected)


def test_hot_keys_are_counted(table):
    found = scans.hot_keys(table, ["key"], by_rows("id"), 150).collect()
    assert [(r["__hot_0"], r["__rows"]) for r in found] == [("hot", table.where("key = 'hot'").count())]


def test_every_hot_key_is_split(spark, monkeypatch):
    """More hot keys than any fixed bound: all of them are segmented, NULL too."""
    monkeypatch.setattr(scans, "HOT_ROWS", 2)
    key = F.when(F.col("id") % 5000 != 7, F.col("id") % 5000)
    rows = spark.range(20_000).select(key.alias("key"), F.col("id").alias("n"))
    assert scans.hot_keys(rows, ["key"], by_rows("n"), 2).count() == 5000
    got = scan(rows, ["key"], ["n"], by_rows("n", 1), upto={"place": ("sum", F.lit(1).cast("long"))})
    assert got.groupBy("place").count().orderBy("place").collect() == [(i, 5000) for i in (1, 2, 3, 4)]


def sizes_of_segments(df, per_segment):
    """Rows of each (key, segment) as ``scan`` cuts them."""
    axis = by_time("at", per_segment)
    hot = scans.hot_keys(df, ["key"], axis, per_segment)
    joined = df.join(hot, F.col("key").eqNullSafe(F.col("__hot_0")))
    placed = joined.select("key", "at", scans._segment_of(axis).alias("segment"))
    falling = placed.groupBy("key", "segment").agg(F.min("at").alias("low"), F.max("at").alias("high"), F.count(F.lit(1)).alias("n")).collect()
    by_key = {}
    for r in sorted(falling, key=lambda r: (r.key, r.segment)):
        by_key.setdefault(r.key, []).append((r.low, r.high, r.n))
    for spans in by_key.values():
        assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))  # segments follow the axis
    return {key: [n for _, _, n in spans] for key, spans in by_key.items()}


@pytest.mark.parametrize("cuts", [1 << 8, 1 << 4])
def test_segments_are_balanced_whatever_the_axis(spark, monkeypatch, cuts):
    """Even, one outlier in 2099, and 99 % of the rows in 1 % of the range: none above twice the mean."""
    monkeypatch.setattr(scans, "CUTS", cuts)
    n, day = 20_000, 86_400_000
    one = F.col("id")
    burst = F.when(one % 100 == 0, one * day).otherwise(50 * day + one * 7)
    shapes = {"even": one * 1000, "outlier": F.when(one == n - 1, 4_100_000_000_000).otherwise(one * 1000), "burst": burst}
    df = spark.range(n).select(F.explode(F.create_map(*[c for k, v in shapes.items() for c in (F.lit(k), v.cast("long"))])).alias("key", "at"))
    for key, found in sizes_of_segments(df, 1000).items():
        assert sum(found) == n and max(found) <= 2000, (key, found)
        assert len(found) >= 15


def test_more_segments_than_cuts_and_rows_of_one_value(spark, monkeypatch):
    monkeypatch.setattr(scans, "CUTS", 8)
    n = 8000
    df = spark.range(n).select(F.lit("even").alias("key"), (F.col("id") * 10).alias("at")).unionAll(
        spark.range(n).select(F.lit("same"), F.when(F.col("id") < 7000, 5).otherwise(F.col("id"))))
    found = sizes_of_segments(df, 100)
    assert max(found["even"]) <= 200 and max(found["same"]) <= 7000 + n / 8  # one value is never parted


def test_null_and_negative_places_on_the_axis(spark, monkeypatch):
    rows = [("a", i, i if i % 7 else None, i) for i in range(-300, 300)] + [(None, i, 5, i) for i in range(50)]
    df = spark.createDataFrame(rows, "key string, id long, at long, v long")
    plain = Window.partitionBy("key").orderBy("at", "id").rowsBetween(Window.unboundedPreceding, 0)
    expected = df.withColumn("s", F.sum("v").over(plain))
    assert rows_of(scan(df, ["key"], ["at", "id"], by_time("at", 40), upto={"s": ("sum", F.col("v"))})) == rows_of(expected)


def test_scan_never_groups_rows_by_key_alone(table):
    """Only the segment summaries meet per key; rows are shuffled by key and segment."""
    got = scan(table, ["key"], ["ms", "id"], by_time("ms", 100), upto={"s": ("sum", F.col("value"))})
    plan = got._jdf.queryExecution().executedPlan().toString()
    by_key = [part for part in plan.split("Exchange hashpartitioning(")[1:] if "segment" not in part.split(")")[0]]
    assert len(by_key) == 1 and "Aggregate" in by_key[0].split("Exchange")[0]


# --- folds --------------------------------------------------------------------------------------


def hold_by_loop(values, threshold, start=0.0):
    reference, found = start, []
    for index, value in enumerate(values):
        if abs(value - reference) > threshold:
            found.append((index, reference, value))
        else:
            reference = value
    return found


def rise_by_loop(rows, wait):
    """Rows of (ms, value) of one key in order."""
    last = timer = None
    fired = []
    for ms, value in rows:
        if timer is not None and ms >= timer:
            fired.append(timer)
            timer = None
        if last is None or value < last:
            timer = None
        elif value > last and timer is None:
            timer = ms + wait
        last = value
    return fired + ([timer] if timer is not None else [])


@given(
    st.lists(st.integers(0, 40), max_size=60), st.integers(0, 12), st.integers(1, 8), st.integers(-5, 45)
)
@settings(max_examples=300, deadline=None)
def test_hold_summaries_compose(values, threshold, size, start):
    state, values = float(start), [float(v) for v in values]
    for begin in range(0, len(values), size):
        part = values[begin:begin + size]
        plain = state
        for value in part:
            if abs(value - plain) <= threshold:
                plain = value
        state = folds.hold_resolve(folds.hold_summary(part, threshold), state)
        assert state == plain


@given(st.lists(st.floats(0, 1e3), max_size=40), st.floats(0, 300), st.floats(-100, 1100))
@settings(max_examples=300, deadline=None)
def test_hold_summary_with_real_numbers(values, threshold, start):
    plain = start
    for value in values:
        if abs(value - plain) <= threshold:
            plain = value
    assert folds.hold_resolve(folds.hold_summary(values, threshold), start) == plain


@given(
    st.lists(st.tuples(st.integers(0, 5), st.sampled_from([-1, 0, 1, 1])), max_size=50),
    st.integers(1, 12), st.integers(1, 8),
)
@settings(max_examples=300, deadline=None)
def test_rise_summaries_compose(moves, wait, size):
    time, times, steps = 0, [], []
    for gap, step in moves:
        time += gap
        times.append(time)
        steps.append(step)
    state = folds.NONE
    for begin in range(0, len(times), size):
        part = slice(begin, begin + size)
        _, plain = folds.rise_replay(state, times[part], steps[part], wait)
        got = folds.rise_resolve(folds.rise_summary(times[part], steps[part], wait), state)
        assert got == plain or (got != got and plain != plain)
        state = plain


@pytest.mark.parametrize("per_segment", [1, 7, 1 << 16])
def test_hold_alert_in_segments(spark, per_segment):
    pdf = skewed()
    expected = set()
    for key, group in pdf.sort_values(["ms", "id"]).groupby("key"):
        ids = group["id"].tolist()
        expected |= {(key, ids[i], held, value) for i, held, value in hold_by_loop(group["value"].tolist(), 30)}
    got = alerts.jump_alert_hold(
        spark.createDataFrame(pdf), ["key"], ["ms", "id"], "value", 30, by_time("ms", 50), rows_per_segment=per_segment
    )
    assert {(r["key"], r["id"], r["last"], r["value"]) for r in got.collect()} == expected


@pytest.mark.parametrize("per_segment", [1, 7, 1 << 16])
def test_rise_alarm_in_segments(spark, per_segment):
    pdf = skewed(400)
    pdf["value"] = (pdf["value"] // 40)
    expected = []
    for key, group in pdf.sort_values(["ms", "id"]).groupby("key"):
        expected += [(key, t) for t in rise_by_loop(list(zip(group["ms"].tolist(), group["value"])), 150)]
    got = alerts.rise_alarm(
        spark.createDataFrame(pdf), ["key"], ["ms", "id"], "value", 150, by_time("ms", 50), rows_per_segment=per_segment
    )
    assert sorted(map(tuple, got.collect())) == sorted(expected)


def test_a_steady_rise_has_a_small_summary():
    begin = time.perf_counter()
    bounds, out = folds.hold_summary([i * 0.001 for i in range(1 << 16)], 50)
    assert len(out) <= 2 and time.perf_counter() - begin < 2


@pytest.mark.parametrize("kind", ["timestamp", "decimal(20,6)", "string", "date"])
def test_keys_of_any_type_stay_apart(spark, kind):
    """Keys a microsecond apart, and NULL, are keys of their own and come back as they were."""
    keys = {
        "timestamp": ["2024-01-01 00:00:00.000001", "2024-01-01 00:00:00.000002", None], "decimal(20,6)": ["1.000001", "1.000002", None],
        "string": ["", "null", None], "date": ["2024-01-01", "2024-01-02", None],
    }[kind]
    rows = [(key, i, value) for k, key in enumerate(keys) for i, value in enumerate((100.0 * k, 100.0 * k + 60, 100.0 * k + 120))]
    table = spark.createDataFrame(rows, "key string, ms long, value double").withColumn("key", F.col("key").cast(kind))
    got = alerts.jump_alert_hold(table, ["key"], ["ms"], "value", 50, by_time("ms"), rows_per_segment=2)
    assert got.schema["key"].dataType.simpleString() == kind
    expected = [(keys[0], 1), (keys[0], 2), (keys[1], 0), (keys[1], 1), (keys[1], 2), (None, 0), (None, 1), (None, 2)]
    there = got.select(F.col("key").cast("string"), "ms").collect()
    assert sorted(map(repr, map(tuple, there))) == sorted(map(repr, expected))
