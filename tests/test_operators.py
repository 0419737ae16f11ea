"""Properties that hold for any input."""

from __future__ import annotations

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidegauge.operators import distinct, lateness, routing, scans, windows
from tidegauge.operators.aggregates import count_rows
from tidegauge.sources import delimited, queue_options, write_delimited
from tidegauge.sources.queue import decode_messages
from tidegauge.sources.schemas import ORDER


@pytest.fixture(autouse=True)
def every_key_is_hot(monkeypatch):
    monkeypatch.setattr(scans, "HOT_ROWS", 0)


def rows_of(df, *columns):
    return sorted(map(tuple, (df.select(*columns) if columns else df).collect()), key=repr)


@pytest.fixture(scope="module")
def log(spark):
    rng = random.Random(3)
    data = []
    for number in range(800):
        key = "hot" if number % 3 == 0 else rng.choice("abcd")
        # disordered: the arrival number runs ahead of the event time by up to 300 s
        data.append((number, key, number * 10_000 - rng.randrange(300_000) * (rng.random() < 0.4), rng.randrange(50)))
    df = spark.createDataFrame(pd.DataFrame(data, columns=["seq", "key", "ms", "v"])).where(F.col("ms") >= 0)
    return df.withColumn("ts", F.timestamp_millis("ms")).repartition(6).cache()


@pytest.mark.parametrize("few", [0, 16])
@pytest.mark.parametrize("keys", [[], ["key"]])
def test_three_sliding_forms_agree(log, keys, few, monkeypatch):
    monkeypatch.setattr(windows, "FEW_WINDOWS", few)
    columns = [*keys, "window_start_ms", "window_end_ms", "n", "total"]
    direct = windows.slide(log, "ts", "1 hour", "5 minutes", count_rows(), F.sum("v").alias("total"), keys=keys)
    panes = windows.slide_panes(
        log, "ts", "1 hour", "5 minutes", {"n": ("sum", F.lit(1).cast("long")), "total": ("sum", F.col("v"))}, keys
    )
    steps = windows.slide_counts(
        log, "ts", "1 hour", "5 minutes", keys, sums={"total": F.col("v")}, segment_ticks=3
    )
    assert rows_of(panes, *columns) == rows_of(direct, *columns) == rows_of(steps, *columns)


def test_sliding_sums_refuse_doubles(log):
    with pytest.raises(ValueError, match="integer or decimal"):
        windows.slide_counts(log, "ts", "1 hour", "5 minutes", sums={"x": F.col("v").cast("double")})
    with pytest.raises(ValueError, match="multiple"):
        windows.slide_counts(log, "ts", "1 hour", "7 minutes")


def replayed(rows, size, every, disorder, late):
    """Rows one after the other, as a single machine would take them."""
    top, kept, dropped, counts, fired, changes = None, [], [], {}, set(), []
    for seq, key, ms in rows:
        before = None if top is None else top - disorder
        top = ms if top is None else max(top, ms)
        now = top - disorder
        first = ms // every * every - (size - every)
        open_ends = [
            s + size for s in range(first, first + size, every) if before is None or s + size - 1 + late > before
        ]
        (kept if open_ends else dropped).append(seq)
        for end in open_ends:
            counts[key, end] = counts.get((key, end), 0) + 1
            if before is not None and before >= end - 1:
                changes.append((key, end, seq, counts[key, end]))
                fired.add((key, end))
        for key_, end in list(counts):
            if (key_, end) not in fired and now >= end - 1:
                changes.append((key_, end, seq, counts[key_, end]))
                fired.add((key_, end))
    changes += [(key, end, None, n) for (key, end), n in counts.items() if (key, end) not in fired]
    return kept, dropped, counts, changes


@pytest.mark.parametrize("per_segment, few", [(13, 0), (1 << 20, 16)])
def test_late_rows_like_one_machine(log, per_segment, few, monkeypatch):
    monkeypatch.setattr(lateness, "FEW_WINDOWS", few)
    monkeypatch.setattr(windows, "FEW_WINDOWS", few)
    size, every, disorder, late = 120_000, 60_000, 20_000, 60_000
    rows = [tuple(r) for r in log.orderBy("seq").select("seq", "key", "ms").collect()]
    kept, dropped, counts, changes = replayed(rows, size, every, disorder, late)
    assert dropped and len(changes) > len(counts)
    seen = lateness.arrival_watermark(log, "ms", ["seq"], "20 seconds", per_segment)
    args = ("2 minutes", "1 minute", "1 minute")
    got_kept, got_late = lateness.late_split(seen, "ms", *args)
    assert rows_of(got_kept, "seq") == rows_of_values(kept) and rows_of(got_late, "seq") == rows_of_values(dropped)
    final = lateness.late_window_counts(seen, "ms", *args, ["key"])
    assert {(r["key"], r["window_end_ms"]): r["n"] for r in final.collect()} == counts
    log_rows = lateness.late_changelog(seen, "ms", ["seq"], *args, ["key"], rows_per_segment=per_segment)
    assert rows_of(log_rows, "key", "window_end_ms", "seq", "n") == sorted(changes, key=repr)


def rows_of_values(values):
    return sorted(((v,) for v in values), key=repr)


def test_running_visitors_end_at_the_exact_count(log):
    running = distinct.unique_running(log, "ts", "10 minutes", "v", "seq", rows_per_segment=11)
    assert running.count() == log.count()
    last = running.groupBy("window_end_ms").agg(F.max("uv").alias("uv"))
    exact = distinct.unique_exact(log, "ts", "10 minutes", "v").select("window_end_ms", "uv")
    bitmap = distinct.unique_bitmap(log, "ts", "10 minutes", "v").select("window_end_ms", "uv")
    assert rows_of(last, "window_end_ms", "uv") == rows_of(exact) == rows_of(bitmap)


def test_tags_and_side_outputs_keep_every_row(log):
    big = F.col("v") > 25
    tagged = routing.tag_rows(log, F.when(big, "high"), F.when(~big, "low"), F.when(F.col("v") == 7, "seven"))
    both = routing.select_tags(tagged, "high", "low", "seven")
    assert rows_of(both, "seq") == rows_of(log, "seq")
    main, side = routing.side_output(log.withColumn("v", F.when(F.col("v") != 3, F.col("v"))), F.col("v") > 25)
    assert main.count() + side.count() == log.count() and main.where("v IS NULL").count() > 0
    assert rows_of(routing.redistribute(log, "key")) == rows_of(log)
    assert rows_of(routing.union_all(log, log, log), "seq") == sorted(rows_of(log, "seq") * 3, key=repr)


def test_shards_do_not_depend_on_placement(log):
    a = routing.shard_filter(log, "key", "v", 2)
    b = routing.shard_filter(log.repartition(1).orderBy("v"), "key", "v", 2)
    assert rows_of(a, "seq", "shard") == rows_of(b, "seq", "shard") and 0 < a.count() < log.count()


def test_delimited_rows_and_rejects(spark, tmp_path):
    (tmp_path / "orders.csv").write_text("1, create,, 100\n1,pay,tx1,101\nx,pay,tx2,102\n2,pay\n")
    good, bad = delimited(spark.read, str(tmp_path), ORDER)
    assert rows_of(good) == [(1, "create", "", 100), (1, "pay", "tx1", 101)]
    assert rows_of(good.select("order_id")) == [(1,), (1,)]  # the same rows, whatever is selected
    assert rows_of(bad) == [("2,pay",), ("x,pay,tx2,102",)]


def test_delimited_output(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "w string, n long")
    for _ in range(2):  # overwrites
        write_delimited(df, str(tmp_path / "out"), " ")
    assert rows_of(spark.read.text(str(tmp_path / "out"))) == [("a 1",), ("b 2",)]


def test_queue_options_and_decoder(spark):
    options = queue_options("host:9092", "feedback", "readers", "earliest", 3000)
    assert options == {
        "kafka.bootstrap.servers": "host:9092", "subscribe": "feedback", "startingOffsets": "earliest",
        "kafka.group.id": "readers", "kafka.metadata.max.age.ms": "3000",
    }
    raw = spark.createDataFrame([(bytearray("k", "utf8"), bytearray("grün", "utf8"), 4)], "key binary, value binary, offset long")
    assert rows_of(decode_messages(raw)) == [("k", "grün", 4)]


def test_top_n_is_limited_before_the_shuffle(log):
    from tidegauge.operators.topn import top_n

    counts = windows.slide_counts(log, "ts", "1 hour", "5 minutes", ["key"])
    plan = top_n(counts, ["window_end_ms"], "n", ["key"], 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
