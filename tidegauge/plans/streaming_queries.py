"""Registered queries: streaming forms over the same tables, checked against the batch SQL.

Each one drains the table as a stream of files, marks the end of the input so that nothing waits
for a later watermark, and returns what the stream wrote.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidegauge.functions.times import day_end_ms, epoch_ms, floor_to
from tidegauge.plans.registry import ORACLES, query
from tidegauge.plans.tables import EVENTS_SQL, fresh_folder, station_log, table, typed_events
from tidegauge.streaming import arrivals, processors, rolling, split, windows
from tidegauge.streaming.run import (
    IS_END, EndOfInput, append_files, bucketed_parquet, drain, feed_disorder_ms, file_stream, latest, run_with_end,
    split_late, split_outputs, state_settings, updates,
)

HOUR_MS = 3_600_000
FILES_PER_TRIGGER = 200  # bounds a micro-batch, and with it what a processor holds of one key; results don't depend on it
ROWS_PER_GROUP = 100_000  # of the whole table, of all keys that a processor works on in one call


def event_files(sf_dir: str) -> str:
    """As a pattern, since the table may be one file or a folder of files."""
    return f"{sf_dir}/{{events.parquet}}"


def event_stream(spark: SparkSession, sf_dir: str, folder: str) -> tuple[DataFrame, EndOfInput]:
    """The events table as a stream, followed by its end marker, the row with ``is_end``."""
    schema = table(spark, sf_dir, "events").schema
    files = file_stream(spark, event_files(sf_dir), schema, files_per_trigger=FILES_PER_TRIGGER)
    end = EndOfInput(spark, folder, schema)
    return typed_events(end.follow(files)), end


def event_delay(spark: SparkSession, sf_dir: str, least_ms: int = 0) -> str:
    """The delay with which no row of the table is late, in whatever order its files come."""
    return f"{max(least_ms, feed_disorder_ms(table(spark, sf_dir, 'events'), epoch_ms('ts')))} milliseconds"


def key_groups(spark: SparkSession, sf_dir: str) -> int:
    """So many groups of keys that a group's rows stay bounded, and enough of them to go round."""
    return max(64, table(spark, sf_dir, "events").count() // ROWS_PER_GROUP)


def finish(spark: SparkSession, folder: str, start: Callable[[], StreamingQuery], *ends: EndOfInput) -> None:
    with state_settings(spark):
        run_with_end(start, *ends)


def append_and_read(spark: SparkSession, out: DataFrame, folder: str, *ends: EndOfInput) -> DataFrame:
    finish(spark, folder, append_files(out, folder), *ends)
    return spark.read.schema(out.schema).parquet(f"{folder}/out")


# --- windows ------------------------------------------------------------------------------------


@query("streaming_pageviews", ORACLES["pageviews_hourly"])
def streaming_pageviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_folder(spark, "pageviews")
    rows, end = event_stream(spark, sf_dir, folder)
    seen = rows.where((F.col("event_type") == "view") | F.col(IS_END))
    counts = windows.windowed_counts(seen, "ts", event_delay(spark, sf_dir), "1 hour").select(
        "window_end_ms", F.col("n").alias("pv")
    )
    return append_and_read(spark, counts, folder, end)


@query("streaming_sliding_counts", f"""
    SELECT event_type, window_start_ms + {2 * HOUR_MS} AS window_end_ms, count(*) AS n FROM (
      SELECT event_type, unnest(generate_series(
          ms // 600000 * 600000 - 6600000, ms // 600000 * 600000, 600000)) AS window_start_ms FROM ({EVENTS_SQL}))
    GROUP BY 1, 2""")
def streaming_sliding_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_folder(spark, "sliding")
    rows, end = event_stream(spark, sf_dir, folder)
    counts = windows.windowed_counts(rows, "ts", event_delay(spark, sf_dir, 10_000), "2 hours", "10 minutes", ["event_type"])
    return append_and_read(spark, counts.drop("window_start_ms"), folder, end)


@query("streaming_hot_items_top5", ORACLES["hot_items_top5"])
def streaming_hot_items_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_folder(spark, "hot-items")
    rows, end = event_stream(spark, sf_dir, folder)
    seen = rows.where((F.col("event_type") == "view") | F.col(IS_END)).withColumnRenamed("k", "item_id")
    counts = windows.windowed_counts(seen, "ts", event_delay(spark, sf_dir), "1 hour", "5 minutes", ["item_id"])
    finish(spark, folder, windows.top_n_writer(counts.drop("window_start_ms"), folder, "item_id", 5), end)
    return spark.read.parquet(f"{folder}/out").drop("batch")


@query("streaming_hot_pages_late", ORACLES["hot_items_top5"])
def streaming_hot_pages_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rankings are written at once and again when later rows change them; the last ones count."""
    folder = fresh_folder(spark, "hot-late")
    rows, _ = event_stream(spark, sf_dir, folder)
    seen = rows.where(F.col("event_type") == "view").withColumnRenamed("k", "item_id")
    delay = event_delay(spark, sf_dir, 61_000)
    counts = windows.windowed_counts(seen, "ts", delay, "1 hour", "5 minutes", ["item_id"])
    with state_settings(spark):
        drain(windows.top_n_updates(counts.drop("window_start_ms"), folder, "item_id", 5, HOUR_MS, delay))
    return windows.latest_ranking(spark.read.parquet(f"{folder}/out"))


@query("streaming_uv_exact", ORACLES["uv_exact_hourly"])
def streaming_uv_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_folder(spark, "uv")
    rows, end = event_stream(spark, sf_dir, folder)
    seen = rows.where((F.col("event_type") == "view") | F.col(IS_END))
    return append_and_read(
        spark, windows.unique_visitors(seen, "ts", event_delay(spark, sf_dir), "1 hour", "user_id").select("window_end_ms", "uv"),
        folder, end,
    )


@query("streaming_uv_running", ORACLES["uv_running"])
def streaming_uv_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First visits are found per (window, visitor), in state that ends with the window; each batch then
    adds its running count to the totals of the open windows."""
    folder = fresh_folder(spark, "uv-running")
    rows, end = event_stream(spark, sf_dir, folder)
    delay = event_delay(spark, sf_dir)
    rows = rows.withWatermark("ts", delay)
    views = rows.where((F.col("event_type") == "view") | F.col(IS_END)).withColumns(
        {"window_end_ms": floor_to(F.col("ms"), HOUR_MS) + HOUR_MS, "event_id": F.coalesce("event_id", F.lit(-1))}
    )
    keys = ["window_end_ms", "user_id", IS_END]
    visits = processors.process(
        views.select(*keys, "event_id", "ts"), keys, processors.FirstVisit(keys, "event_id"),
        f"window_end_ms long, user_id long, {IS_END} boolean, event_id long, first long", "EventTime",
        key_groups(spark, sf_dir),
    )
    finish(spark, folder, windows.running_unique_writer(visits, folder, "event_id", HOUR_MS, delay), end)
    return spark.read.parquet(f"{folder}/out").drop("batch")


@query("streaming_updates", f"""
    SELECT event_type, CAST(sum(cents) AS BIGINT) AS total FROM ({EVENTS_SQL}) GROUP BY 1""")
def streaming_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running sums in update mode: every batch writes the sums it changed."""
    folder = fresh_folder(spark, "updates")
    rows, _ = event_stream(spark, sf_dir, folder)
    sums = rows.groupBy("event_type").agg(F.sum("cents").alias("total"))
    with state_settings(spark):
        drain(updates(sums, folder))
    return latest(spark.read.parquet(f"{folder}/out"), "event_type")


@query("streaming_window_updates", ORACLES["uv_exact_hourly"].replace("count(DISTINCT user_id) AS uv", "count(*) AS n"))
def streaming_window_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows that stay open for late rows: each batch writes the windows it changed, until the
    watermark, here the disorder plus the allowed lateness behind, has passed them."""
    folder = fresh_folder(spark, "window-updates")
    rows, _ = event_stream(spark, sf_dir, folder)
    counts = windows.windowed_counts(rows.where(F.col("event_type") == "view"), "ts", event_delay(spark, sf_dir, 61_000), "1 hour")
    with state_settings(spark):
        drain(updates(counts.select("window_end_ms", "n"), folder))
    return latest(spark.read.parquet(f"{folder}/out"), "window_end_ms")


@query("streaming_late_side_output", f"SELECT event_id, cents FROM ({EVENTS_SQL})")
def streaming_late_side_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows behind the stream's own watermark go to a second output; both together are the input."""
    folder = fresh_folder(spark, "late")
    rows, _ = event_stream(spark, sf_dir, folder)
    drain(split_late(rows.select("event_id", "cents", "ts"), folder, "ts", 60_000))
    kept, late = (spark.read.schema("event_id long, cents long").parquet(f"{folder}/{name}") for name in ("kept", "late"))
    return kept.unionByName(late).select("event_id", "cents")


# --- watermarks that move with every row ----------------------------------------------------------

STATION_PARTS = 2
STATION_WINDOWS = ("1 hour", "30 minutes", "1 hour")  # size, slide, allowed lateness
STATION_ARRIVAL = ["seq", "event_id"]


def parts_in_arrival_order(log: DataFrame) -> list[DataFrame]:
    cuts = log.approxQuantile("seq", [i / STATION_PARTS for i in range(1, STATION_PARTS)], 0.01)
    part = sum((F.when(F.col("seq") > cut, 1).otherwise(0) for cut in cuts), F.lit(0))
    return [log.where(part == number) for number in range(STATION_PARTS)]


def marked_stations(spark: SparkSession, sf_dir: str, folder: str, then: Callable[[], None] = lambda: None) -> None:
    """The station log as a feed in its order of arrival, part by part, and its rows marked as they come.

    ``then`` runs after every part, as a second stream would.
    """
    log = station_log(spark, sf_dir).select("event_id", "seq", "ms", "event_type")
    start = None
    for part in parts_in_arrival_order(log):
        arrivals.append_part(part, f"{folder}/feed")
        if start is None:
            feed = spark.readStream.schema(log.schema).parquet(f"{folder}/feed")  # a part is one batch
            start = arrivals.mark_arrivals(feed, folder, "ms", STATION_ARRIVAL, "30 minutes", *STATION_WINDOWS)
        drain(start)
        then()


@query("streaming_arrival_watermark", ORACLES["arrival_watermark"])
def streaming_arrival_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The watermark before and after each row, carried from batch to batch as one number."""
    folder = fresh_folder(spark, "stream-watermark")
    marked_stations(spark, sf_dir, folder)
    return spark.read.parquet(f"{folder}/marked").select("event_id", "seq", "ms", "wm_before", "wm_after")


@query("streaming_late_rows", ORACLES["late_side_output"])
def streaming_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exactly the rows that are too late by the watermark at their own arrival."""
    folder = fresh_folder(spark, "stream-late")
    marked_stations(spark, sf_dir, folder)
    return spark.read.parquet(f"{folder}/late").select("event_id", "event_type", "ms")


@query("streaming_late_changelog", ORACLES["late_changelog"])
def streaming_late_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Window results that fire at the watermark and again for every accepted late row."""
    folder = fresh_folder(spark, "stream-changelog")
    schema = station_log(spark, sf_dir).select("event_id", "seq", "ms", "event_type").schema
    streams: list = []

    def results() -> None:
        if not streams:
            kept, end = arrivals.kept_stream(spark, folder, schema)
            streams.extend([arrivals.late_results(kept, folder, ["event_type"], "ms", STATION_ARRIVAL, *STATION_WINDOWS), end])
        drain(streams[0])

    with state_settings(spark):
        marked_stations(spark, sf_dir, folder, results)
        streams[1].close()
        drain(streams[0])
    return spark.read.parquet(f"{folder}/out").select("event_type", "window_end_ms", "seq", "n")


# --- join ---------------------------------------------------------------------------------------


@query("streaming_reconcile", f"""
    WITH l AS (SELECT event_id // 2 AS pair, ms AS left_ms FROM ({EVENTS_SQL}) WHERE event_id % 2 = 0),
    r AS (SELECT event_id // 2 AS pair, ms AS right_ms FROM ({EVENTS_SQL}) WHERE event_id % 2 = 1)
    SELECT coalesce(l.pair, r.pair) AS pair, left_ms, right_ms,
           CASE WHEN r.pair IS NULL THEN 'left' WHEN l.pair IS NULL THEN 'right' ELSE 'both' END AS side
    FROM l FULL JOIN r ON l.pair = r.pair AND abs(left_ms - right_ms) <= 300000""")
def streaming_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbouring events as two streams with one row per key, at most 5 minutes apart."""
    folder = fresh_folder(spark, "reconcile")
    a, left_end = event_stream(spark, sf_dir, f"{folder}/left")
    b, right_end = event_stream(spark, sf_dir, f"{folder}/right")

    def side(rows: DataFrame, odd: int, name: str) -> DataFrame:
        return rows.where((F.col("event_id") % 2 == odd) | F.col(IS_END)).select(
            F.expr("event_id div 2 AS pair"), F.timestamp_millis("ms").alias(f"{name}_ts"), F.col("ms").alias(f"{name}_ms"),
            F.col(IS_END).alias(f"{name}_end"),
        )

    joined = windows.reconcile(side(a, 0, "left"), side(b, 1, "right"), "pair", "left_ts", "right_ts", "5 minutes", event_delay(spark, sf_dir))
    marker = F.coalesce("left_end", F.lit(False)) | F.coalesce("right_end", F.lit(False))
    out = joined.select("pair", "left_ms", "right_ms", "side", marker.alias(IS_END))
    return append_and_read(spark, out, folder, left_end, right_end).where(~F.col(IS_END)).drop(IS_END)


# --- processors ---------------------------------------------------------------------------------


def by_user(spark: SparkSession, sf_dir: str, folder: str, kind=None) -> tuple[DataFrame, EndOfInput]:
    rows, end = event_stream(spark, sf_dir, folder)
    carried = F.col("value") if kind is None else kind.cast("int").alias("kind")
    # The end marker passes as a row of its own key. Filtering it out here would not work: Spark
    # moves the filter below the watermark, which then never sees the marker.
    return rows.withWatermark("ts", event_delay(spark, sf_dir)).select(
        "user_id", IS_END, "ts", "ms", F.coalesce("event_id", F.lit(-1)).alias("event_id"), carried
    ), end


def run_events(spark: SparkSession, sf_dir: str, name: str, make, output: str, kind=None, only=None) -> DataFrame:
    """``only`` tells the rows that can change a result; without it all rows wait for the watermark."""
    folder = fresh_folder(spark, name)
    rows, end = by_user(spark, sf_dir, folder, kind)
    if only is not None:
        rows = rows.where(only | F.col(IS_END))
    keys = ["user_id", IS_END]
    carried, ddl = ("value", "double") if kind is None else ("kind", "int")
    processor = make(keys, ["ms", "event_id"], ["ms", "event_id", carried], f"ms long, event_id long, {carried} {ddl}")
    found = processors.process(rows, keys, processor, f"user_id long, {IS_END} boolean, {output}", "EventTime", key_groups(spark, sf_dir))
    return append_and_read(spark, found, folder, end).where(~F.col(IS_END)).drop(IS_END)


@query("streaming_jump_alert", ORACLES["jump_alert"])
def streaming_jump_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_events(
        spark, sf_dir, "jump", lambda *a: processors.JumpAlert(*a, value="value", threshold=50),
        "ms long, event_id long, last double, value double",
    ).drop("ms")


@query("streaming_jump_alert_hold", ORACLES["jump_alert_hold"])
def streaming_jump_alert_hold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_events(
        spark, sf_dir, "jump-hold", lambda *a: processors.JumpAlertHold(*a, value="value", threshold=50),
        "ms long, event_id long, last double, value double",
    ).drop("ms")


@query("streaming_rise_alarm", ORACLES["rise_alarm"])
def streaming_rise_alarm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_events(
        spark, sf_dir, "rise", lambda *a: processors.RiseAlarm(*a, value="value", wait_ms=12 * HOUR_MS), "alarm_ms long"
    )


@query("streaming_rise_alarm_clock", ORACLES["rise_alarm_clock"])
def streaming_rise_alarm_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cancellable timers on a clock that comes with the rows, in their order of arrival."""
    folder = fresh_folder(spark, "clock")
    started = 24 * HOUR_MS  # the engine takes no row at or before time 0, where its watermark starts
    clock = (F.col("seq") * 60_000 + started).alias("clock_ms")
    log = station_log(spark, sf_dir).select("user_id", "seq", clock, "event_id", "value")
    end = EndOfInput(spark, folder, log.withColumn("ts", F.timestamp_millis("clock_ms")).schema)
    parts = parts_in_arrival_order(log.withColumn("ts", F.timestamp_millis("clock_ms")))
    arrivals.append_part(parts[0], f"{folder}/feed")
    feed = spark.readStream.schema(end.schema).parquet(f"{folder}/feed")
    keys = ["user_id", IS_END]
    # one ms behind, so that rows of the latest clock reading are not late to the engine
    rows = end.follow(feed).withWatermark("ts", "1 millisecond").select(*keys, "ts", "clock_ms", "event_id", "value")
    processor = processors.ClockRiseAlarm(keys, ["clock_ms", "event_id"], "value", 12 * HOUR_MS, "clock_ms")
    alarms = processors.process(rows, keys, processor, f"user_id long, {IS_END} boolean, alarm_ms long", "EventTime", key_groups(spark, sf_dir))
    start = append_files(alarms, folder)
    with state_settings(spark):
        drain(start)
        for part in parts[1:]:
            arrivals.append_part(part, f"{folder}/feed")
            drain(start)
        end.close()
        drain(start)
    found = spark.read.schema(alarms.schema).parquet(f"{folder}/out").where(~F.col(IS_END))
    return found.select("user_id", (F.col("alarm_ms") - started).alias("alarm_ms"))


@query("streaming_login_fail_strict_next", ORACLES["login_fail_strict_next"])
def streaming_login_fail_strict_next(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_events(
        spark, sf_dir, "strict-next", lambda *a: processors.StrictNext(*a, hit="kind", bound_ms=6 * HOUR_MS),
        "first_ms long, next_ms long", F.when(F.col("event_type") == "error", 1).otherwise(0),
    )


@query("streaming_order_payments", f"""
    SELECT user_id, event_id, first_ms, NULL::BIGINT AS next_ms FROM ({ORACLES["order_timeout"]})
    UNION ALL SELECT user_id, event_id, first_ms, next_ms FROM ({ORACLES["order_paid"]})""")
def streaming_order_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("event_type") == "signup", 1).when(F.col("event_type") == "purchase", 2).otherwise(0)
    return run_events(
        spark, sf_dir, "payments",
        lambda *a: processors.FollowedBy(*a, step="kind", identity="event_id", bound_ms=12 * HOUR_MS),
        "event_id long, first_ms long, next_ms long", kind, F.col("kind") > 0,
    )


def run_arrivals(spark: SparkSession, sf_dir: str, name: str, prepare, keys: list[str], processor, output: str) -> DataFrame:
    folder = fresh_folder(spark, name)
    rows, _ = event_stream(spark, sf_dir, folder)
    found = processors.process(prepare(rows), keys, processor, output)
    with state_settings(spark):
        drain(append_files(found, folder))
    return spark.read.schema(found.schema).parquet(f"{folder}/out")


@query("streaming_login_fail", ORACLES["login_fail_lag"])
def streaming_login_fail(spark: SparkSession, sf_dir: str) -> DataFrame:
    seq = F.col("event_id") + F.pmod(F.col("event_id") * 7919, F.lit(31))
    return run_arrivals(
        spark, sf_dir, "login-fail",
        lambda rows: rows.select("user_id", "event_id", seq.alias("seq"), "ms", (F.col("event_type") == "error").alias("hit")),
        ["user_id"], processors.RepeatedHit(["user_id"], ["seq", "event_id"], "hit", "ms", 6 * HOUR_MS),
        "user_id long, first_ms long, next_ms long",
    )


@query("streaming_route_running_sum", ORACLES["route_running_sum"])
def streaming_route_running_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["route", "event_type"]
    route = F.when(F.pmod("k", F.lit(2)) == 0, "even").otherwise("odd")
    return run_arrivals(
        spark, sf_dir, "route-sum", lambda rows: rows.select(route.alias("route"), "event_type", "event_id", "k"),
        keys, processors.RunningSum(keys, "event_id", "k"), "route string, event_type string, event_id long, running long",
    )


@query("streaming_count_tumbling", f"SELECT user_id, window_no, cents AS smallest FROM ({ORACLES['count_tumbling_min']})")
def streaming_count_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_arrivals(
        spark, sf_dir, "count-tumbling", lambda rows: rows.select("user_id", "event_id", "cents"),
        ["user_id"], processors.CountWindow(["user_id"], "event_id", "cents", 5),
        "user_id long, window_no long, smallest long",
    )


@query("streaming_count_sliding", f"SELECT user_id, window_no, min_cents AS smallest FROM ({ORACLES['count_sliding_min']})")
def streaming_count_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_arrivals(
        spark, sf_dir, "count-sliding", lambda rows: rows.select("user_id", "event_id", "cents"),
        ["user_id"], processors.SlidingCountWindow(["user_id"], "event_id", "cents", 10, 5),
        "user_id long, window_no long, smallest long",
    )


@query("streaming_route_running_split", ORACLES["route_running_sum"])
def streaming_route_running_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The routed sums again, with the rows of a hot route dealt out to all tasks."""
    folder = fresh_folder(spark, "route-split")
    rows, _ = event_stream(spark, sf_dir, folder)
    route = F.when(F.pmod("k", F.lit(2)) == 0, "even").otherwise("odd")
    routed = rows.select(route.alias("route"), "event_type", "event_id", "k")
    drain(split.running(routed, folder, ["route", "event_type"], "event_id", {"running": ("sum", "k")}))
    return spark.read.parquet(f"{folder}/out").select("route", "event_type", "event_id", "running")


@query("streaming_count_tumbling_split", f"""
    SELECT event_type, (rn - 1) // 5 AS window_no, min(cents) AS smallest FROM (
      SELECT event_type, cents, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS rn FROM ({EVENTS_SQL}))
    GROUP BY 1, 2 HAVING count(*) = 5""")
def streaming_count_tumbling_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of five rows of a few keys that hold all rows."""
    folder = fresh_folder(spark, "count-split")
    rows, _ = event_stream(spark, sf_dir, folder)
    drain(split.count_windows(rows.select("event_type", "event_id", "cents"), folder, ["event_type"], "event_id", "cents", 5))
    return spark.read.parquet(f"{folder}/out").select("event_type", "window_no", "smallest")


@query("streaming_click_cap", f"""
    SELECT event_id, 'pass' AS output FROM ({ORACLES["click_cap_pass"]})
    UNION ALL SELECT event_id, 'alarm' FROM ({ORACLES["click_cap_alarm"]})""")
def streaming_click_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passed rows and alarms go to separate outputs; an event-time timer resets each day's count."""
    folder = fresh_folder(spark, "click-cap")
    rows, end = event_stream(spark, sf_dir, folder)
    keys = ["user_id", "event_type", IS_END, "reset_ms"]
    clicks = rows.withWatermark("ts", event_delay(spark, sf_dir)).withColumns(
        {"reset_ms": day_end_ms("ts"), "event_id": F.coalesce("event_id", F.lit(-1))}
    )
    found = processors.process(
        clicks.select(*keys, "ts", "event_id"), keys,
        processors.DailyCap(keys, "event_id", 2),
        f"user_id long, event_type string, {IS_END} boolean, reset_ms long, event_id long, output string", "EventTime",
        key_groups(spark, sf_dir),
    )
    outputs = {
        name: (lambda batch, name=name: batch.where((F.col("output") == name) & ~F.col(IS_END))) for name in ("pass", "alarm")
    }
    finish(spark, folder, split_outputs(found, folder, outputs), end)
    passed, alarms = (spark.read.parquet(f"{folder}/{name}").select("event_id", "output") for name in outputs)
    return passed.unionByName(alarms)


@query("streaming_clicks_by_group", ORACLES["clicks_by_group_after_cap"])
def streaming_clicks_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cap's passed rows feed the windowed counts of a second stream; alarms have their own output."""
    folder = fresh_folder(spark, "clicks-by-group")
    rows, end = event_stream(spark, sf_dir, folder)
    keys = ["user_id", "event_type", IS_END, "reset_ms"]
    clicks = rows.withWatermark("ts", event_delay(spark, sf_dir)).withColumns(
        {"reset_ms": day_end_ms("ts"), "event_id": F.coalesce("event_id", F.lit(-1))}
    )
    found = processors.process(
        clicks.select(*keys, "ts", "event_id", "ms"), keys, processors.DailyCap(keys, "event_id", 2, ["ms"]),
        f"user_id long, event_type string, {IS_END} boolean, reset_ms long, event_id long, ms long, output string", "EventTime",
        key_groups(spark, sf_dir),
    )
    outputs = {name: (lambda batch, name=name: batch.where((F.col("output") == name) & ~F.col(IS_END))) for name in ("pass", "alarm")}
    finish(spark, folder, split_outputs(found, folder, outputs), end)

    schema = spark.createDataFrame([], "event_type string, ms long").schema
    passed = file_stream(spark, f"{folder}/pass/*", schema).withColumn("ts", F.timestamp_millis("ms"))
    close = EndOfInput(spark, f"{folder}/second", passed.schema)
    behind = feed_disorder_ms(spark.read.schema(schema).parquet(f"{folder}/pass/*"), F.col("ms"))
    counts = windows.windowed_counts(close.follow(passed), "ts", f"{behind} milliseconds", "1 hour", "10 minutes", ["event_type"])
    out = counts.select("event_type", "window_end_ms", "n")
    return append_and_read(spark, out, f"{folder}/second", close)


# --- sinks --------------------------------------------------------------------------------------


@query("streaming_bucketed_parquet", f"""
    SELECT event_id, cents, strftime(ts, '%Y-%m-%d--%H') AS bucket FROM ({EVENTS_SQL}) WHERE event_type = 'view'""")
def streaming_bucketed_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_folder(spark, "stream-buckets")
    rows, _ = event_stream(spark, sf_dir, folder)
    drain(bucketed_parquet(rows.where(F.col("event_type") == "view").select("event_id", "cents", "ts"), folder, "ts"))
    return spark.read.parquet(f"{folder}/out").select("event_id", "cents", F.col("bucket").cast("string"))


@query("streaming_csv", f"SELECT event_id, event_type, cents FROM ({EVENTS_SQL})")
def streaming_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_folder(spark, "stream-csv")
    rows, _ = event_stream(spark, sf_dir, folder)
    out = rows.select("event_id", "event_type", "cents")
    drain(append_files(out, folder, "csv", maxRecordsPerFile="1000000"))
    return spark.read.schema(out.schema).csv(f"{folder}/out")


@query("streaming_rolled_text", f"SELECT event_id, event_type, cents FROM ({EVENTS_SQL})")
def streaming_rolled_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text parts that roll at 64 KiB, after 20 hours, or after 10 without a row."""
    folder, most = fresh_folder(spark, "rolled"), 1 << 16
    rows, _ = event_stream(spark, sf_dir, folder)
    lines = rows.select(F.concat_ws(",", "event_id", "event_type", "cents").alias("line"), "event_id", "ms")
    drain(rolling.rolling_parts(lines, folder, "line", "event_id", "ms", most, 20 * HOUR_MS, 10 * HOUR_MS))
    rolling.close_parts(spark, folder, most)
    return spark.read.schema("event_id long, event_type string, cents long").csv(f"{folder}/out").select("event_id", "event_type", "cents")
