"""What a task holds, and what is moved, on tables larger than a task should hold."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidegauge.operators import sliding
from tidegauge.plans import analyses
from tidegauge.streaming import rolling


def test_panes_with_few_set_bits_hold_no_bitmaps(spark):
    views = spark.range(1000).select((F.col("id") * 10_000).alias("ms"), (F.col("id") % 7).alias("user"))
    found = sliding.unique_bitmap_sliding(views, "ms", "1 minute", "10 seconds", "user", 1 << 18)
    assert "bitmap" not in found._jdf.queryExecution().toString()
    counts = {r.window_end_ms: r.uv for r in found.collect()}
    assert counts == {end * 10_000: min(end, 6, 1006 - end) for end in range(1, 1006)}


def test_a_batch_of_rolled_lines_is_one_sequence_in_segments(spark):
    """Parts follow the lengths of all lines before, however the sequence is cut; what was open is numbered by itself."""
    lines = [(f"{i:0{1 + i % 9}d}", i, i, turn) for turn, n in ((0, 3), (1, 500)) for i in range(n)]
    rows = spark.createDataFrame(lines, "line string, place long, clock long, turn int").repartition(5)
    found = rolling._numbered(rows, 40, rows_per_segment=20).collect()
    expected, ahead = {}, {0: 0, 1: 0}
    for line, place, _, turn in lines:
        expected[turn, place] = ahead[turn] // (40 - 10 + 1)
        ahead[turn] += len(line) + 1
    assert {(r.turn, r.place): r.part for r in found} == expected and len(found) == len(lines)


@pytest.mark.parametrize("chars", [1 << 24, 100])
def test_words_are_counted_where_their_lines_are(spark, monkeypatch, chars):
    """The second window of three is longer than a range, where a range is short."""
    monkeypatch.setattr(analyses, "CHARS_PER_RANGE", chars)
    texts = [(0, "a b a"), (1, "b  c"), (3, "d d " * 40), (4, "a"), (7, None), (8, "c"), (None, "x")]
    lines = spark.createDataFrame(texts, "s long, text string").select("text", F.timestamp_seconds("s").alias("ts"))
    counts = analyses.windowed_word_counts(lines, "text", "ts")
    got = sorted((r.word, r.window_end_ms, r.n) for r in counts.collect())
    assert got == [("a", 3000, 2), ("a", 6000, 1), ("b", 3000, 2), ("c", 3000, 1), ("c", 9000, 1), ("d", 6000, 80)]
    if chars > 100:
        assert "hashpartitioning" not in counts._jdf.queryExecution().executedPlan().toString()
