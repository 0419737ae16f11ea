"""Streams over several files and micro-batches give what the batch SQL gives."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from tests.oracle import compare, connect
from tidegauge.operators import scans
from tidegauge.plans import catalog, streaming_queries
from tidegauge.plans.tables import fresh_folder, table, typed_events
from tidegauge.streaming import arrivals, processors, rolling, split
from tidegauge.streaming.run import (
    EndOfInput, LateRows, append_files, drain, file_stream, rolling_text, run_with_end, split_late, split_outputs,
    state_settings,
)
from tidegauge.streaming.windows import latest_ranking, top_n_updates, windowed_counts

SF_DIR = "/root/testdata/sf0.001"
DAY = 86_400_000
EVENTS_FILE = SF_DIR + "/{events.parquet}"

# one micro-batch per file, files in time order, as a feed would deliver them
IN_ORDER = [
    "streaming_pageviews", "streaming_hot_items_top5", "streaming_uv_running", "streaming_updates",
    "streaming_window_updates",
    "streaming_reconcile", "streaming_jump_alert", "streaming_jump_alert_hold", "streaming_rise_alarm",
    "streaming_login_fail_strict_next", "streaming_order_payments", "streaming_route_running_sum",
    "streaming_count_tumbling", "streaming_count_sliding", "streaming_click_cap", "streaming_clicks_by_group",
    "streaming_hot_pages_late",
    "streaming_late_changelog", "streaming_route_running_split", "streaming_count_tumbling_split",
    "streaming_rolled_text",
]


@pytest.fixture(scope="module")
def parts_dir(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("parts")
    events = table(spark, SF_DIR, "events").orderBy("event_id")
    for part in range(4):
        # separate appends, so that the files' times follow the events' times
        events.where(F.expr(f"event_id div 250 = {part}")).coalesce(1).write.mode("append").parquet(
            str(folder / "events.parquet")
        )
        time.sleep(0.05)
    return str(folder)


@pytest.mark.parametrize("name", IN_ORDER)
def test_four_batches_equal_sql(spark, parts_dir, name, monkeypatch):
    monkeypatch.setattr(streaming_queries, "FILES_PER_TRIGGER", 1)
    got = catalog.queries()[name](spark, parts_dir)
    assert compare(got, connect(SF_DIR), catalog.oracles()[name]) == ""


@pytest.mark.parametrize("name", ["streaming_route_running_split", "streaming_count_tumbling_split"])
def test_hot_keys_of_a_stream_are_split(spark, parts_dir, name, monkeypatch):
    """Every key is hot and cut into many segments in each of four batches."""
    monkeypatch.setattr(streaming_queries, "FILES_PER_TRIGGER", 1)
    monkeypatch.setattr(scans, "HOT_ROWS", 5)
    monkeypatch.setattr(scans, "ROWS_PER_SEGMENT", 7)
    assert compare(catalog.queries()[name](spark, parts_dir), connect(SF_DIR), catalog.oracles()[name]) == ""


def test_running_extremes_and_null_keys_over_batches(spark, tmp_path):
    ddl, folder = "key string, n long, v long", str(tmp_path)
    rows = [(None if i % 5 == 0 else "ab"[i % 2], i, None if i % 7 == 0 else (i * 37) % 101) for i in range(120)]
    for part in range(3):
        arrivals.append_part(spark.createDataFrame(rows[part * 40:part * 40 + 40], ddl).coalesce(1), f"{folder}/feed")
    feed = file_stream(spark, f"{folder}/feed", spark.createDataFrame([], ddl).schema, files_per_trigger=1)
    measures = {"least": ("min", "v"), "most": ("max", "v"), "total": ("sum", "v")}
    drain(split.running(feed, folder, ["key"], "n", measures))
    state, expected = {}, []
    for key, n, v in rows:
        held = state.setdefault(key, [])
        if v is not None:
            held.append(v)
        expected.append((n, min(held, default=None), max(held, default=None), sum(held) if held else None))
    out = spark.read.parquet(f"{folder}/out")
    assert sorted(tuple(r) for r in out.select("n", "least", "most", "total").collect()) == sorted(expected)
    assert out.select("batch").distinct().count() == 3


# what these give must not depend on the order of files; the other queries number rows by arrival
ANY_ORDER = [
    "streaming_pageviews", "streaming_sliding_counts", "streaming_hot_items_top5", "streaming_uv_exact", "streaming_updates",
    "streaming_hot_pages_late",
    "streaming_window_updates", "streaming_late_side_output", "streaming_reconcile", "streaming_jump_alert",
    "streaming_jump_alert_hold", "streaming_rise_alarm", "streaming_login_fail_strict_next", "streaming_order_payments",
]


@pytest.fixture(scope="module")
def shuffled_dir(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("shuffled")
    events = table(spark, SF_DIR, "events")
    for part in (2, 0, 3, 1):
        events.where(F.expr(f"event_id div 250 = {part}")).coalesce(1).write.mode("append").parquet(str(folder / "events.parquet"))
        time.sleep(0.05)
    return str(folder)


@pytest.mark.parametrize("name", ANY_ORDER)
def test_files_out_of_time_order_lose_no_row(spark, shuffled_dir, name, monkeypatch):
    monkeypatch.setattr(streaming_queries, "FILES_PER_TRIGGER", 1)
    assert compare(catalog.queries()[name](spark, shuffled_dir), connect(SF_DIR), catalog.oracles()[name]) == ""


def test_late_rows_have_their_own_output(spark, shuffled_dir, tmp_path):
    schema = table(spark, SF_DIR, "events").schema
    start = split_late(file_stream(spark, f"{shuffled_dir}/{{events.parquet}}", schema, files_per_trigger=1), str(tmp_path), "ts", 60_000)
    drain(start)
    kept, late = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("kept", "late"))
    high, expected = None, 0
    for part in (2, 0, 3, 1):
        times = [r[0] for r in table(spark, SF_DIR, "events").where(F.expr(f"event_id div 250 = {part}")).select(F.unix_millis(F.col("ts").cast("timestamp"))).collect()]
        expected += sum(high is not None and t < high - 60_000 for t in times)
        high = max(times + ([] if high is None else [high]))
    assert late.count() == expected > 0 and kept.count() + expected == 1000


def test_rows_the_engine_drops_are_an_error(spark, shuffled_dir, tmp_path):
    schema = table(spark, SF_DIR, "events").schema
    rows = typed_events(file_stream(spark, f"{shuffled_dir}/{{events.parquet}}", schema, files_per_trigger=1))
    with state_settings(spark, 2), pytest.raises(LateRows):
        drain(append_files(windowed_counts(rows, "ts", "0 seconds", "1 hour"), str(tmp_path)))


def test_open_windows_wait_for_the_end_marker(spark):
    folder = fresh_folder(spark, "end")
    schema = table(spark, SF_DIR, "events").schema
    end = EndOfInput(spark, folder, schema)
    rows = typed_events(end.follow(file_stream(spark, EVENTS_FILE, schema)))
    start = append_files(windowed_counts(rows, "ts", "0 seconds", "1 day"), folder)
    with state_settings(spark, 2):
        drain(start)
        assert spark.read.parquet(f"{folder}/out").count() == 29
        run_with_end(start, end)
    out = spark.read.parquet(f"{folder}/out")
    assert out.count() == 30 and out.agg(F.sum("n")).first()[0] == 1000


def test_settings_are_restored(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with state_settings(spark, 3):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_a_repeated_batch_leaves_one_copy(spark, tmp_path):
    """The outputs of a batch replace what an earlier attempt at it left behind."""
    folder = str(tmp_path)
    spark.range(5).write.parquet(f"{folder}/high/batch=0")
    rows = file_stream(spark, EVENTS_FILE, table(spark, SF_DIR, "events").schema)
    outputs = {"high": lambda b: b.where("value > 50"), "low": lambda b: b.where("NOT value > 50")}
    drain(split_outputs(rows.select("event_id", "value"), folder, outputs))
    assert sum(spark.read.parquet(f"{folder}/{name}").count() for name in outputs) == 1000


def feed_of(spark, folder, hours):
    """One file per hour, in order: three items a minute, and one late row for the hour before."""
    for hour in range(hours):
        minute, item = F.expr("id div 3"), F.expr("id % 3")
        ms = F.lit(DAY + hour * 3_600_000) + minute * 60_000 + item
        late = spark.range(1).select(F.lit(DAY + hour * 3_600_000 - 1_000).alias("ms"), F.lit(9).cast("long").alias("item"))
        rows = spark.range(180).select(ms.alias("ms"), item.alias("item"))
        rows.unionAll(late).coalesce(1).write.mode("append").parquet(f"{folder}/feed")
    schema = spark.createDataFrame([], "ms long, item long").schema
    return file_stream(spark, f"{folder}/feed", schema, files_per_trigger=1).withColumn("ts", F.timestamp_millis("ms"))


def test_ranking_state_does_not_grow_with_the_batches(spark, tmp_path):
    """Each batch reads the counts of open windows only, and its rankings are those of all rows."""
    folder, hours = str(tmp_path), 12
    counts = windowed_counts(feed_of(spark, folder, hours), "ts", "5 minutes", "1 hour", keys=["item"]).drop("window_start_ms")
    with state_settings(spark, 2):
        drain(top_n_updates(counts, folder, "item", 3, "1 hour", "5 minutes"))
    per_batch = {r["batch"]: (r["n"], r["windows"]) for r in spark.read.parquet(f"{folder}/counts").groupBy("batch").agg(
        F.count("*").alias("n"), F.count_distinct("window_end_ms").alias("windows")).collect()}
    assert max(per_batch) >= hours - 1
    assert max(windows for _, windows in per_batch.values()) <= 3 and max(n for n, _ in per_batch.values()) <= 12
    got = {(r.window_end_ms, r["rank"]): (r.item, r.n) for r in latest_ranking(spark.read.parquet(f"{folder}/out")).collect()}
    expected = {}
    for hour in range(hours):
        expected |= {(DAY + (hour + 1) * 3_600_000, i + 1): (i, 60) for i in range(3)}
    expected[(DAY, 1)] = (9, 1)
    assert got == expected


def test_a_late_row_fires_its_window_again(spark, tmp_path):
    """By hand: 10 s windows, no disorder, 5 s of lateness; a late row fires again, a too late one is parted."""
    folder, ddl = str(tmp_path), "seq long, key string, ms long"
    parts = [
        [(1, "a", 1_000), (2, "a", 2_000), (3, "b", 12_000), (4, "a", 9_000)],  # 3 fires a's window, 4 fires it again
        [(5, "a", 8_000), (6, "b", 16_000), (7, "a", 3_000)],  # 6 closes it, 7 is too late
        [(8, "b", 31_000), (9, None, None), (10, "c", 29_000), (11, "b", 36_000)],  # c's window has fired without it
    ]
    schema = spark.createDataFrame([], ddl).schema
    spark.createDataFrame(parts[0], ddl).coalesce(1).write.parquet(f"{folder}/feed")
    feed = file_stream(spark, f"{folder}/feed", schema, files_per_trigger=1)
    mark = arrivals.mark_arrivals(feed, folder, "ms", ["seq"], "0 seconds", "10 seconds", "10 seconds", "5 seconds")
    with state_settings(spark, 2):
        drain(mark)
        kept, end = arrivals.kept_stream(spark, folder, schema)
        results = arrivals.late_results(kept, folder, ["key"], "ms", ["seq"], "10 seconds", "10 seconds", "5 seconds")
        drain(results)
        for part in parts[1:]:
            arrivals.append_part(spark.createDataFrame(part, ddl).coalesce(1), f"{folder}/feed")
            drain(mark)
            drain(results)
        end.close()
        drain(results)
    assert [r.seq for r in spark.read.parquet(f"{folder}/late").collect()] == [7]
    out = sorted(tuple(r) for r in spark.read.parquet(f"{folder}/out").select("key", "window_end_ms", F.coalesce("seq", F.lit(-1)), "n").collect())
    assert out == [
        ("a", 10_000, 3, 2), ("a", 10_000, 4, 3), ("a", 10_000, 5, 4),
        ("b", 20_000, 8, 2), ("b", 40_000, -1, 2), ("c", 30_000, 10, 1),
    ]
    high = [r.high for r in spark.read.parquet(f"{folder}/high").orderBy("batch").collect()]
    assert high == [12_000, 16_000, 36_000]


def test_parts_roll_by_size_age_and_inactivity(spark, tmp_path):
    """By hand, over a restart: parts of at most 40 bytes, 20 s of age, 10 s without a row."""
    folder, ddl = str(tmp_path), "n long, line string, ms long"
    batches = [
        [(1, "a" * 9, 0), (2, "b" * 9, 1_000)],  # open
        [(3, "c" * 9, 5_000)],  # open
        [(4, None, 15_000)],  # a tick: 10 s without a row, 1-3 go
        [(5, "d" * 9, 16_000)], [(6, "e" * 9, 25_000)],  # open
        [(7, "f" * 9, 34_000)], [(8, "g" * 9, 36_000)],  # 20 s old: 5-7 go, 8 is open
        [(i, f"h{i}" * 3, 37_000) for i in range(9, 25)],  # full parts go
    ]
    schema = spark.createDataFrame([], ddl).schema
    arrivals.append_part(spark.createDataFrame(batches[0], ddl).coalesce(1), f"{folder}/feed")
    feed = file_stream(spark, f"{folder}/feed", schema, files_per_trigger=1)
    start = rolling.rolling_parts(feed, folder, "line", "n", "ms", 40)
    drain(start)
    for batch in batches[1:]:
        arrivals.append_part(spark.createDataFrame(batch, ddl).coalesce(1), f"{folder}/feed")
    drain(start)  # goes on from the checkpoint
    files = sorted((tmp_path / "out").glob("batch=*/part=*/*.txt"))
    parts = [f.read_text().split() for f in files]
    assert parts[0] == ["a" * 9, "b" * 9, "c" * 9] and "batch=2/" in str(files[0])
    assert parts[1] == ["d" * 9, "e" * 9, "f" * 9] and "batch=6/" in str(files[1])
    for _ in range(2):
        rolling.close_parts(spark, folder, 40)
    files = list((tmp_path / "out").glob("batch=*/part=*/*.txt"))
    assert all(f.stat().st_size <= 40 for f in files) and len(files) <= 9
    got = sorted(line for f in files for line in f.read_text().split())
    assert got == sorted(line for batch in batches for _, line, _ in batch if line)


def test_rolling_text(spark, tmp_path):
    rows = file_stream(spark, EVENTS_FILE, table(spark, SF_DIR, "events").schema)
    query = rolling_text(rows.select("event_id", "event_type"), str(tmp_path), "1 second", records_per_file=300)
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    files = list((tmp_path / "out").glob("*.csv"))
    assert len(files) >= 4 and spark.read.csv(str(tmp_path / "out")).count() == 1000


def test_clock_timer_fires_unless_a_drop_cancels_it(spark, tmp_path):
    """A rise of key 1 fires after a second; key 2 drops in the same batch and stays quiet."""
    source, folder = str(tmp_path / "in"), str(tmp_path / "work")
    schema = "id long, seq long, v double"
    data = [(1, 0, 1.0), (1, 1, 5.0), (2, 0, 1.0), (2, 1, 5.0), (2, 2, 2.0), (3, 0, 4.0), (3, 1, 4.0)]
    spark.createDataFrame(data, schema).coalesce(1).write.parquet(source)
    rows = file_stream(spark, source, spark.createDataFrame([], schema).schema)
    alarms = processors.process(
        rows, ["id"], processors.ClockRiseAlarm(["id"], ["seq"], "v", 1000), "id long, alarm_ms long", "ProcessingTime"
    )
    started = time.time() * 1000
    with state_settings(spark, 2):
        query = (
            alarms.writeStream.format("parquet").option("checkpointLocation", f"{folder}/checkpoint")
            .option("path", f"{folder}/out").trigger(processingTime="500 milliseconds").start()
        )
        try:
            deadline = time.time() + 60
            found = []
            while time.time() < deadline and not found:
                time.sleep(1)
                try:
                    found = spark.read.schema(alarms.schema).parquet(f"{folder}/out").collect()
                except Exception:  # nothing written yet
                    found = []
            time.sleep(3)
            found = spark.read.schema(alarms.schema).parquet(f"{folder}/out").collect()
        finally:
            query.stop()
    assert [row["id"] for row in found] == [1] and found[0]["alarm_ms"] > started
