"""Registered queries: windows, distinct visitors, top-N and late rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.functions.times import epoch_ms
from tidegauge.operators import distinct, lateness, sliding, topn, windows
from tidegauge.operators.aggregates import count_rows, first_row
from tidegauge.plans import analyses
from tidegauge.plans.registry import ORACLES, query
from tidegauge.plans.tables import EVENTS_SQL, STATION_SQL, events, station_log
from tidegauge.session import written
from tidegauge.sources.files import access_log

HOUR, MINUTE, SECOND = 3_600_000, 60_000, 1_000


def viewed():
    return F.col("event_type") == "view"


def tumbled(size: int) -> str:
    return f"(ms // {size} + 1) * {size}"


def starts(size: int, every: int) -> str:
    """DuckDB list of the window starts that cover ``ms``."""
    return f"unnest(generate_series(ms // {every} * {every} - {size - every}, ms // {every} * {every}, {every}))"


def slid(size: int, every: int, columns: str, source: str = EVENTS_SQL) -> str:
    return f"SELECT {columns}, {starts(size, every)} AS window_start_ms FROM ({source})"


@query("pageviews_hourly", f"""
    SELECT {tumbled(HOUR)} AS window_end_ms, count(*) AS pv
    FROM ({EVENTS_SQL}) WHERE event_type = 'view' GROUP BY 1""")
def pageviews_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analyses.page_views(events(spark, sf_dir), viewed()).select("window_end_ms", "pv")


@query("uv_exact_hourly", f"""
    SELECT {tumbled(HOUR)} AS window_end_ms, count(DISTINCT user_id) AS uv
    FROM ({EVENTS_SQL}) WHERE event_type = 'view' GROUP BY 1""")
def uv_exact_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = events(spark, sf_dir).where(viewed())
    return distinct.unique_exact(views, "ts", "1 hour", "user_id").select("window_end_ms", "uv")


@query("uv_bitmap_hourly", f"""
    SELECT {tumbled(HOUR)} AS window_end_ms, count(DISTINCT list_reduce(
        list_prepend(0::BIGINT, list_transform(string_split(user_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
        lambda h, c: (h * 61 + c) & 536870911)) AS uv
    FROM ({EVENTS_SQL}) WHERE event_type = 'view' GROUP BY 1""")
def uv_bitmap_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = events(spark, sf_dir).where(viewed())
    return distinct.unique_bitmap(views, "ts", "1 hour", "user_id").select("window_end_ms", "uv")


@query("uv_sketch_daily", f"""
    SELECT ms // 86400000 * 86400000 + 86400000 AS window_end_ms, count(DISTINCT user_id) AS exact, true AS close
    FROM ({EVENTS_SQL}) WHERE event_type = 'view' GROUP BY 1""")
def uv_sketch_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sketch beside the exact count: within three of its relative standard deviations."""
    views, rsd = events(spark, sf_dir).where(viewed()), 0.02
    sketch = distinct.unique_sketch(views, "ts", "1 day", "user_id", rsd, "sketch")
    exact = distinct.unique_exact(views, "ts", "1 day", "user_id", "exact")
    off = F.abs(F.col("sketch") - F.col("exact"))
    return exact.join(sketch, "window_end_ms").select("window_end_ms", "exact", (off <= 3 * rsd * F.col("exact")).alias("close"))


@query("uv_running", f"""
    WITH v AS (SELECT *, {tumbled(HOUR)} AS window_end_ms FROM ({EVENTS_SQL}) WHERE event_type = 'view'),
    f AS (SELECT *, CASE WHEN event_id = min(event_id) OVER (PARTITION BY window_end_ms, user_id)
                         THEN 1 ELSE 0 END AS first_visit FROM v)
    SELECT event_id, window_end_ms, CAST(sum(first_visit) OVER (
        PARTITION BY window_end_ms ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS uv FROM f""")
def uv_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = events(spark, sf_dir).where(viewed()).select("event_id", "ts", "user_id")
    return distinct.unique_running(views, "ts", "1 hour", "user_id", "event_id").select("event_id", "window_end_ms", "uv")


HOT_ITEMS_SQL = f"""
    WITH w AS ({slid(HOUR, 5 * MINUTE, "k, event_type")}),
    c AS (SELECT window_start_ms + {HOUR} AS window_end_ms, k AS item_id, count(*) AS n
          FROM w WHERE event_type = 'view' GROUP BY 1, 2),
    r AS (SELECT *, row_number() OVER (PARTITION BY window_end_ms ORDER BY n DESC, item_id) AS rank FROM c)
    SELECT window_end_ms, item_id, n, rank FROM r WHERE rank <= 5"""


@query("hot_items_top5", HOT_ITEMS_SQL)
def hot_items_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = events(spark, sf_dir).withColumnRenamed("k", "item_id")
    return analyses.hot_items(views, viewed(), "item_id").select("window_end_ms", "item_id", "n", "rank")


@query("hot_items_report", f"""
    SELECT window_end_ms, 'window end ' || window_end_ms || chr(10) || string_agg(
        'No' || rank || ': item=' || item_id || ' count=' || n, chr(10) ORDER BY rank) AS report
    FROM ({HOT_ITEMS_SQL}) GROUP BY window_end_ms""")
def hot_items_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analyses.hot_items_report(hot_items_top5(spark, sf_dir), "item_id")


@query("sliding_panes_count", f"""
    WITH w AS ({slid(2 * HOUR, 10 * MINUTE, "event_type, cents")})
    SELECT event_type, window_start_ms, count(*) AS n, CAST(sum(cents) AS BIGINT) AS total_cents,
           min(cents) AS min_cents, max(cents) AS max_cents
    FROM w GROUP BY 1, 2""")
def sliding_panes_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = {
        "n": ("sum", F.lit(1).cast("long")), "total_cents": ("sum", F.col("cents")),
        "min_cents": ("min", F.col("cents")), "max_cents": ("max", F.col("cents")),
    }
    return windows.slide_panes(events(spark, sf_dir), "ts", "2 hours", "10 minutes", parts, ["event_type"]).drop(
        "window_end_ms"
    )


@query("sliding_sums", f"""
    WITH w AS ({slid(2 * HOUR, MINUTE, "event_type, cents")})
    SELECT event_type, window_start_ms, count(*) AS n, CAST(sum(cents) AS BIGINT) AS total_cents
    FROM w GROUP BY 1, 2""")
def sliding_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.slide_counts(
        events(spark, sf_dir), "ts", "2 hours", "1 minute", ["event_type"], sums={"total_cents": F.col("cents")}
    ).drop("window_end_ms")


@query("log_parse_top5", f"""
    WITH w AS ({slid(10 * MINUTE, MINUTE, "k")}),
    c AS (SELECT window_start_ms + {10 * MINUTE} AS window_end_ms, '/item/' || k AS url, count(*) AS n FROM w GROUP BY 1, 2),
    r AS (SELECT *, row_number() OVER (PARTITION BY window_end_ms ORDER BY n DESC, url) AS rank FROM c)
    SELECT window_end_ms, url, n, rank FROM r WHERE rank <= 5""")
def log_parse_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = events(spark, sf_dir).select(
        F.concat_ws(
            " ", F.lit("10.0.0.1"), F.col("user_id").cast("string"), F.lit("-"),
            F.date_format("ts", "dd/MM/yyyy:HH:mm:ss"), F.lit("+0000"), F.lit("GET"),
            F.concat(F.lit("/item/"), F.col("k").cast("string")),
        ).alias("value")
    )
    counts = windows.slide_counts(access_log(lines)[0], "ts", "10 minutes", "1 minute", ["url"])
    return topn.top_n(counts, ["window_end_ms"], "n", ["url"], 5).select("window_end_ms", "url", "n", "rank")


@query("access_log_rejects", f"""
    SELECT event_id, CASE WHEN event_id % 7 > 1 THEN '/item/' || k END AS url,
           CASE WHEN event_id % 7 = 0 THEN 'broken ' || event_id
                WHEN event_id % 7 = 1 THEN '10.0.0.1 u - soon +0000 GET /item/' || k END AS rejected_line
    FROM ({EVENTS_SQL})""")
def access_log_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good lines and two sorts of bad ones; both outputs together are the input."""
    url, turn = F.concat(F.lit("/item/"), F.col("k").cast("string")), F.col("event_id") % 7
    time = F.when(turn == 1, F.lit("soon")).otherwise(F.date_format("ts", "dd/MM/yyyy:HH:mm:ss"))
    good = F.concat_ws(" ", F.lit("10.0.0.1 u -"), time, F.lit("+0000 GET"), url)
    lines = events(spark, sf_dir).select(
        "event_id", F.when(turn == 0, F.concat(F.lit("broken "), F.col("event_id").cast("string"))).otherwise(good).alias("value")
    )
    records, rejected = access_log(lines)
    return records.select("event_id", "url").unionByName(rejected, allowMissingColumns=True)


# --- arrival order: disorder 30 min, lateness 1 h, windows 1 h / 30 min --------------------------

WATERMARKED_SQL = f"""
    SELECT *,
      max(ms) OVER (ORDER BY seq, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {30 * MINUTE} AS wm_before,
      max(ms) OVER (ORDER BY seq, event_id ROWS UNBOUNDED PRECEDING) - {30 * MINUTE} AS wm_after
    FROM ({STATION_SQL})"""

OPEN_SQL = f"""
    SELECT *, window_start_ms + {HOUR} AS window_end_ms,
           coalesce(wm_before >= window_start_ms + {HOUR} - 1, false) AS refire
    FROM (SELECT *, {starts(HOUR, 30 * MINUTE)} AS window_start_ms FROM ({WATERMARKED_SQL}))
    WHERE NOT coalesce(window_start_ms + {HOUR} - 1 + {HOUR} <= wm_before, false)"""


def watermarked(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = station_log(spark, sf_dir).select("event_id", "seq", "ms", "event_type", "k")
    return written(lateness.arrival_watermark(log, "ms", ["seq", "event_id"], "30 minutes"), "watermarked")


@query("arrival_watermark", f"SELECT event_id, seq, ms, wm_before, wm_after FROM ({WATERMARKED_SQL})")
def arrival_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return watermarked(spark, sf_dir).select("event_id", "seq", "ms", "wm_before", "wm_after")


@query("late_side_output", f"""
    SELECT event_id, event_type, ms FROM ({WATERMARKED_SQL})
    WHERE ms // {30 * MINUTE} * {30 * MINUTE} + {HOUR} - 1 + {HOUR} <= wm_before""")
def late_side_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, late = lateness.late_split(watermarked(spark, sf_dir), "ms", "1 hour", "30 minutes", "1 hour")
    return late.select("event_id", "event_type", "ms")


@query("late_changelog", f"""
    WITH o AS ({OPEN_SQL}), wm AS ({WATERMARKED_SQL}),
    ontime AS (SELECT event_type, window_end_ms, count(*) AS n FROM o WHERE NOT refire GROUP BY 1, 2),
    ends AS (SELECT DISTINCT window_end_ms FROM ontime),
    fired AS (SELECT window_end_ms, min(seq) AS seq FROM ends JOIN wm ON wm_after >= window_end_ms - 1 GROUP BY 1),
    again AS (SELECT event_type, window_end_ms, seq, row_number() OVER (
                  PARTITION BY event_type, window_end_ms ORDER BY seq, event_id) AS nth FROM o WHERE refire)
    SELECT event_type, window_end_ms, fired.seq AS seq, n FROM ontime LEFT JOIN fired USING (window_end_ms)
    UNION ALL
    SELECT again.event_type, again.window_end_ms, again.seq, coalesce(n, 0) + nth AS n
    FROM again LEFT JOIN ontime USING (event_type, window_end_ms)""")
def late_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lateness.late_changelog(
        watermarked(spark, sf_dir), "ms", ["seq", "event_id"], "1 hour", "30 minutes", "1 hour", ["event_type"]
    ).drop("window_start_ms")


@query("station_calls", ORACLES["late_changelog"])
def station_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = station_log(spark, sf_dir).select("event_id", "seq", "ms", "event_type")
    results, _ = analyses.station_calls(
        log, "event_type", "ms", ["seq", "event_id"], "1 hour", "30 minutes", "30 minutes", "1 hour"
    )
    return results.drop("window_start_ms")


@query("late_window_counts", f"SELECT event_type, window_end_ms, count(*) AS n FROM ({OPEN_SQL}) GROUP BY 1, 2")
def late_window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lateness.late_window_counts(
        watermarked(spark, sf_dir), "ms", "1 hour", "30 minutes", "1 hour", ["event_type"]
    ).drop("window_start_ms")


@query("hot_pages_late_top5", f"""
    WITH c AS (SELECT window_end_ms, k, count(*) AS n FROM ({OPEN_SQL}) GROUP BY 1, 2),
    r AS (SELECT *, row_number() OVER (PARTITION BY window_end_ms ORDER BY n DESC, k) AS rank FROM c)
    SELECT window_end_ms, k, n, rank FROM r WHERE rank <= 5""")
def hot_pages_late_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = station_log(spark, sf_dir).select("event_id", "seq", "ms", "k")
    return analyses.hot_pages(
        log, "k", "ms", ["seq", "event_id"], "1 hour", "30 minutes", "30 minutes", "1 hour"
    ).select("window_end_ms", "k", "n", "rank")


# --- other windows -------------------------------------------------------------------------------


@query("market_by_channel", f"""
    WITH w AS ({slid(2 * HOUR, 10 * MINUTE, "k % 4 AS channel, event_type AS behavior")})
    SELECT window_start_ms, window_start_ms + {2 * HOUR} AS window_end_ms, channel, behavior, count(*) AS n
    FROM w WHERE behavior <> 'signup' GROUP BY 1, 2, 3, 4""")
def market_by_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = events(spark, sf_dir).withColumns({"channel": F.pmod(F.col("k"), F.lit(4)), "behavior": F.col("event_type")})
    return analyses.market_by_channel(log, "channel", "behavior", "ts", "signup", every="10 minutes").select(
        "window_start_ms", "window_end_ms", "channel", "behavior", "n"
    )


def market_total_sql(every: int) -> str:
    return f"""
    WITH w AS ({slid(2 * HOUR, every, "event_type")})
    SELECT window_start_ms, window_start_ms + {2 * HOUR} AS window_end_ms,
           'market' AS channel, 'total' AS behavior, count(*) AS n
    FROM w WHERE event_type <> 'signup' GROUP BY 1, 2, 3, 4"""


@query("market_total", market_total_sql(10 * MINUTE))
def market_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analyses.market_total(events(spark, sf_dir), "event_type", "ts", "signup", every="10 minutes")


@query("market_total_fine", market_total_sql(10 * SECOND))
def market_total_fine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row belongs to 720 windows."""
    return analyses.market_total(events(spark, sf_dir), "event_type", "ts", "signup")


def in_windows(size: int, every: int, columns: str) -> str:
    return f"SELECT {columns}, {starts(size, every)} + {size} AS window_end_ms FROM ({EVENTS_SQL})"


@query("sliding_extremes_fine", f"""
    SELECT window_end_ms, min(cents) AS least, max(cents) AS most FROM ({in_windows(2 * HOUR, 10 * SECOND, "cents")}) GROUP BY 1""")
def sliding_extremes_fine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row belongs to 720 windows; each window merges two values."""
    parts = {"least": ("min", F.col("cents")), "most": ("max", F.col("cents"))}
    return sliding.slide_extremes(events(spark, sf_dir), "ms", "2 hours", "10 seconds", parts)


@query("sliding_extremes_by_type", f"""
    SELECT event_type, window_end_ms, min(cents) AS least, max(k) AS most_k
    FROM ({in_windows(HOUR, 5 * MINUTE, "event_type, cents, k")}) GROUP BY 1, 2""")
def sliding_extremes_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = {"least": ("min", F.col("cents")), "most_k": ("max", F.col("k"))}
    return sliding.slide_extremes(events(spark, sf_dir), "ms", "1 hour", "5 minutes", parts, ["event_type"])


@query("uv_bitmap_sliding", f"""
    SELECT window_end_ms, count(DISTINCT bit) AS uv FROM ({in_windows(2 * HOUR, 10 * SECOND, """event_type, list_reduce(
        list_prepend(0::BIGINT, list_transform(string_split(user_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
        lambda h, c: (h * 61 + c) & 262143) AS bit""")}) WHERE event_type = 'view' GROUP BY 1""")
def uv_bitmap_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bitmaps of 2^18 bits per 10 s pane, kept as their set bits, united over 720 panes per window."""
    views = events(spark, sf_dir).where(viewed())
    return sliding.unique_bitmap_sliding(views, "ms", "2 hours", "10 seconds", "user_id", 1 << 18)


@query("uv_sketch_sliding", f"""
    SELECT window_end_ms, count(DISTINCT user_id) AS exact, true AS close
    FROM ({in_windows(24 * HOUR, HOUR, "event_type, user_id")}) WHERE event_type = 'view' GROUP BY 1""")
def uv_sketch_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The united sketches beside the exact count: within three standard errors of 1.04 / sqrt(4096)."""
    views = events(spark, sf_dir).where(viewed())
    sketch = sliding.unique_sketch_sliding(views, "ms", "1 day", "1 hour", "user_id", 12, "sketch")
    exact = windows.slide(views, "ts", "1 day", "1 hour", F.count_distinct("user_id").alias("exact"))
    off = F.abs(F.col("sketch") - F.col("exact"))
    return exact.join(sketch, "window_end_ms").select(
        "window_end_ms", "exact", (off <= 3 * 1.04 / 64 * F.col("exact")).alias("close")
    )


@query("tumbling_sums", f"""
    SELECT user_id, {tumbled(HOUR)} AS window_end_ms, CAST(sum(ms) AS BIGINT) AS sum_ms, count(*) AS n
    FROM ({EVENTS_SQL}) GROUP BY 1, 2""")
def tumbling_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.tumble(
        events(spark, sf_dir), "ts", "1 hour", F.sum("ms").alias("sum_ms"), count_rows(), keys=["user_id"]
    ).drop("window_start_ms")


@query("edit_volume", f"""
    SELECT user_id, {tumbled(5 * MINUTE)} AS window_end_ms, CAST(sum(cents) AS BIGINT) AS volume
    FROM ({EVENTS_SQL}) GROUP BY 1, 2""")
def edit_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analyses.edit_volume(events(spark, sf_dir), "user_id", "cents", "ts", "5 minutes").drop("window_start_ms")


@query("first_per_window", f"""
    SELECT user_id, window_end_ms, event_id, cents FROM (
      SELECT *, {tumbled(HOUR)} AS window_end_ms,
             row_number() OVER (PARTITION BY user_id, {tumbled(HOUR)} ORDER BY ms, event_id) AS rn
      FROM ({EVENTS_SQL})) WHERE rn = 1""")
def first_per_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = first_row(["event_id", "cents"], ["ms", "event_id"]).alias("first")
    rows = windows.tumble(events(spark, sf_dir), "ts", "1 hour", first, keys=["user_id"])
    return rows.select("user_id", "window_end_ms", "first.event_id", "first.cents")


@query("clock_window_tumble", f"""
    SELECT user_id, {tumbled(10 * MINUTE)} AS window_end_ms, min(cents) AS min_cents
    FROM ({EVENTS_SQL}) GROUP BY 1, 2""")
def clock_window_tumble(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamped = events(spark, sf_dir).withColumnRenamed("ts", "arrived_at")
    return windows.tumble(
        stamped, "arrived_at", "10 minutes", F.min("cents").alias("min_cents"), keys=["user_id"]
    ).drop("window_start_ms")


@query("clock_window_slide", f"""
    WITH w AS ({slid(20 * MINUTE, 10 * MINUTE, "user_id, cents")})
    SELECT user_id, window_start_ms + {20 * MINUTE} AS window_end_ms, min(cents) AS min_cents FROM w GROUP BY 1, 2""")
def clock_window_slide(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamped = events(spark, sf_dir).withColumnRenamed("ts", "arrived_at")
    return windows.slide_panes(
        stamped, "arrived_at", "20 minutes", "10 minutes", {"min_cents": ("min", F.col("cents"))}, ["user_id"]
    ).drop("window_start_ms")


GROUP_WINDOW_SQL = """
    SELECT user_id, window_end_ms, count(*) AS n FROM (
      SELECT user_id, {start} + {size} AS window_end_ms FROM ({events})) GROUP BY 1, 2"""


@query("group_window_slide", GROUP_WINDOW_SQL.format(
    start=starts(10 * MINUTE, 5 * MINUTE), size=10 * MINUTE, events=EVENTS_SQL))
def group_window_slide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(
        """SELECT user_id, unix_millis(window(ts, '10 minutes', '5 minutes').end) AS window_end_ms, count(*) AS n
           FROM {rows} GROUP BY user_id, window(ts, '10 minutes', '5 minutes')""",
        rows=events(spark, sf_dir).select("user_id", "ts"),
    )


@query("group_window_tumble", GROUP_WINDOW_SQL.format(
    start=f"ms // {10 * MINUTE} * {10 * MINUTE}", size=10 * MINUTE, events=EVENTS_SQL))
def group_window_tumble(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).groupBy("user_id", F.window("ts", "10 minutes")).agg(count_rows())
    return rows.select("user_id", epoch_ms(F.col("window.end")).alias("window_end_ms"), "n")
