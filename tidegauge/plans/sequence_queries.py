"""Registered queries: rolling aggregates, count windows, patterns, alarms and reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.functions.times import epoch_ms
from tidegauge.operators import alerts, patterns, reconcile, rolling, windows
from tidegauge.operators.aggregates import exact_mean, extreme, whole_mean
from tidegauge.operators.scans import by_rows, by_time, scan
from tidegauge.plans import analyses
from tidegauge.plans.registry import ORACLES, query
from tidegauge.plans.tables import EVENTS_SQL, STATION_SQL, events, station_log, table

HOUR = 3_600_000
BY_EVENT = "event_id"


# --- rolling ------------------------------------------------------------------------------------


@query("rolling_sum", f"""
    SELECT event_id, event_type, CAST(sum(cents) OVER (
        PARTITION BY event_type ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running
    FROM ({EVENTS_SQL})""")
def rolling_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select("event_id", "event_type", "cents")
    return rolling.rolling(
        rows, ["event_type"], ["event_id"], F.col("cents"), "sum", "running", by_rows(BY_EVENT)
    ).drop("cents")


@query("rolling_min_max", f"""
    SELECT event_id, event_type,
      min(cents) OVER (PARTITION BY event_type ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS lowest,
      max(cents) OVER (PARTITION BY event_type ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS highest
    FROM ({EVENTS_SQL})""")
def rolling_min_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select("event_id", "event_type", "cents")
    return scan(
        rows, ["event_type"], ["event_id"], by_rows(BY_EVENT),
        upto={"lowest": ("min", F.col("cents")), "highest": ("max", F.col("cents"))},
    ).drop("cents")


@query("rolling_reduce_suffix", f"""
    SELECT event_id, n, source || repeat('_new', CAST(n - 1 AS INTEGER)) AS label FROM (
      SELECT event_id, user_id || '-' || event_type AS source,
             row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS n
      FROM ({EVENTS_SQL}))""")
def rolling_reduce_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select("event_id", F.concat_ws("-", F.col("user_id").cast("string"), "event_type").alias("source"))
    return rolling.rolling_suffix(rows, "source", ["event_id"], "_new", by_rows(BY_EVENT)).drop("source")


@query("route_running_sum", f"""
    SELECT event_id, event_type, route, CAST(sum(k) OVER (
        PARTITION BY route, event_type ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running
    FROM (SELECT *, CASE WHEN k % 2 = 0 THEN 'even' ELSE 'odd' END AS route FROM ({EVENTS_SQL}))""")
def route_running_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select("event_id", "event_type", "k")
    return rolling.routed_sum(rows, "event_type", ["event_id"], "k", by_rows(BY_EVENT)).drop("k")


@query("avg_value", f"""
    SELECT event_type, round(avg(cents), 4) AS mean_cents, CAST(floor(sum(cents) / count(*)) AS BIGINT) AS whole_cents
    FROM ({EVENTS_SQL}) GROUP BY 1""")
def avg_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).groupBy("event_type").agg(
        exact_mean("cents", 4).alias("mean_cents"), whole_mean("cents").alias("whole_cents")
    )


# --- count windows ------------------------------------------------------------------------------

NUMBERED_SQL = f"""
    SELECT *, (row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) AS pos FROM ({EVENTS_SQL})"""


def count_tumbling_sql(value: str, event: str) -> str:
    return f"""
    SELECT user_id, pos // 5 AS window_no, {value} AS cents, {event} AS event_id
    FROM ({NUMBERED_SQL}) GROUP BY 1, 2 HAVING count(*) = 5"""


def count_tumbling(spark: SparkSession, sf_dir: str, kind: str, whole_row: bool) -> DataFrame:
    rows = events(spark, sf_dir).select("user_id", "event_id", "cents")
    aggs = extreme("cents", ["event_id"], ["event_id"], kind, whole_row)
    return windows.count_tumble(rows, ["user_id"], ["event_id"], 5, *aggs, segment=by_rows(BY_EVENT))


@query("count_tumbling_min", count_tumbling_sql("min(cents)", "min(event_id)"))
def count_tumbling_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tumbling(spark, sf_dir, "min", False)


@query("count_tumbling_max", count_tumbling_sql("max(cents)", "min(event_id)"))
def count_tumbling_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tumbling(spark, sf_dir, "max", False)


@query("count_tumbling_minby", count_tumbling_sql("min(cents)", "first(event_id ORDER BY cents, event_id)"))
def count_tumbling_minby(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tumbling(spark, sf_dir, "min", True)


@query("count_tumbling_maxby", count_tumbling_sql("max(cents)", "first(event_id ORDER BY cents DESC, event_id)"))
def count_tumbling_maxby(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tumbling(spark, sf_dir, "max", True)


@query("count_sliding_min", f"""
    SELECT user_id, pos // 5 AS window_no, min_cents FROM (
      SELECT *, min(cents) OVER (PARTITION BY user_id ORDER BY pos ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS min_cents
      FROM ({NUMBERED_SQL})) WHERE pos % 5 = 4""")
def count_sliding_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select("user_id", "event_id", "cents")
    return windows.count_slide(
        rows, ["user_id"], ["event_id"], 10, 5, {"min_cents": ("min", F.col("cents"))}, by_rows(BY_EVENT)
    )


# --- patterns -----------------------------------------------------------------------------------


@query("login_fail_lag", f"""
    SELECT user_id, first_ms, ms AS next_ms FROM (
      SELECT *, lag(event_type) OVER w AS last_type, lag(ms) OVER w AS first_ms FROM ({STATION_SQL})
      WINDOW w AS (PARTITION BY user_id ORDER BY seq, event_id))
    WHERE event_type = 'error' AND last_type = 'error' AND first_ms > ms - {6 * HOUR}""")
def login_fail_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    logins = station_log(spark, sf_dir).select("user_id", "event_type", "ms", "seq", "event_id")
    failed = F.col("event_type") == "error"
    return analyses.login_alarms(
        logins, "user_id", ["seq", "event_id"], failed, "ms", "6 hours", by_rows("seq")
    ).select("user_id", "first_ms", "next_ms")


@query("login_fail_strict_next", f"""
    SELECT user_id, ms AS first_ms, next_ms FROM (
      SELECT *, lead(event_type) OVER w AS next_type, lead(ms) OVER w AS next_ms FROM ({EVENTS_SQL})
      WINDOW w AS (PARTITION BY user_id ORDER BY ms, event_id))
    WHERE event_type = 'error' AND next_type = 'error' AND next_ms - ms < {6 * HOUR}""")
def login_fail_strict_next(spark: SparkSession, sf_dir: str) -> DataFrame:
    logins = events(spark, sf_dir).select("user_id", "event_type", "ms", "event_id")
    failed = F.col("event_type") == "error"
    return patterns.strict_next(
        logins, ["user_id"], ["ms", "event_id"], failed, failed, "ms", "6 hours", by_time("ms")
    ).select("user_id", "first_ms", "next_ms")


PAYMENT_SQL = f"""
    SELECT user_id, event_id, ms AS first_ms, next_ms FROM (
      SELECT *, min(CASE WHEN event_type = 'purchase' THEN ms END) OVER (
          PARTITION BY user_id ORDER BY ms, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_ms
      FROM ({EVENTS_SQL})) WHERE event_type = 'signup'"""


def payments(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = events(spark, sf_dir).select("user_id", "event_type", "ms", "event_id")
    created, paid = F.col("event_type") == "signup", F.col("event_type") == "purchase"
    return analyses.order_payments(orders, "user_id", created, paid, "ms", "event_id", "12 hours")


@query("order_paid", f"""
    SELECT user_id, event_id, first_ms, next_ms, 'paid in time' AS msg
    FROM ({PAYMENT_SQL}) WHERE next_ms - first_ms < {12 * HOUR}""")
def order_paid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payments(spark, sf_dir)[0].select("user_id", "event_id", "first_ms", "next_ms", "msg")


@query("order_timeout", f"""
    SELECT user_id, event_id, first_ms, 'not paid in time' AS msg
    FROM ({PAYMENT_SQL}) WHERE NOT coalesce(next_ms - first_ms < {12 * HOUR}, false)""")
def order_timeout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payments(spark, sf_dir)[1].select("user_id", "event_id", "first_ms", "msg")


# --- alarms and caps ----------------------------------------------------------------------------


@query("jump_alert", f"""
    SELECT user_id, event_id, last, value FROM (
      SELECT *, lag(value) OVER (PARTITION BY user_id ORDER BY ms, event_id) AS last FROM ({EVENTS_SQL}))
    WHERE abs(value - last) > 50""")
def jump_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select("user_id", "ms", "event_id", "value")
    return alerts.jump_alert(rows, ["user_id"], ["ms", "event_id"], "value", 50, by_time("ms")).select(
        "user_id", "event_id", "last", "value"
    )


ORDERED_SQL = f"""
    SELECT user_id, event_id, ms, value, row_number() OVER (PARTITION BY user_id ORDER BY ms, event_id) AS rn,
           lag(value) OVER (PARTITION BY user_id ORDER BY ms, event_id) AS last
    FROM ({EVENTS_SQL})"""


@query("jump_alert_hold", f"""
    WITH RECURSIVE o AS MATERIALIZED ({ORDERED_SQL}),
    s AS (
      SELECT user_id, event_id, rn, value, 0.0::DOUBLE AS held,
             CASE WHEN abs(value - 0.0) > 50 THEN 0.0::DOUBLE ELSE value END AS ref
      FROM o WHERE rn = 1
      UNION ALL
      SELECT o.user_id, o.event_id, o.rn, o.value, s.ref,
             CASE WHEN abs(o.value - s.ref) > 50 THEN s.ref ELSE o.value END
      FROM s JOIN o ON o.user_id = s.user_id AND o.rn = s.rn + 1)
    SELECT user_id, event_id, held AS last, value FROM s WHERE abs(value - held) > 50""")
def jump_alert_hold(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select("user_id", "ms", "event_id", "value")
    return alerts.jump_alert_hold(
        rows, ["user_id"], ["ms", "event_id"], "value", 50, by_time("ms")
    ).select("user_id", "event_id", "last", "value")


@query("rise_alarm", f"""
    WITH RECURSIVE o AS MATERIALIZED ({ORDERED_SQL}),
    s AS (
      SELECT user_id, rn, NULL::BIGINT AS fired, NULL::BIGINT AS timer FROM o WHERE rn = 1
      UNION ALL
      SELECT o.user_id, o.rn,
             CASE WHEN o.ms >= s.timer THEN s.timer END,
             CASE WHEN o.value < o.last THEN NULL
                  WHEN o.value > o.last AND (s.timer IS NULL OR o.ms >= s.timer) THEN o.ms + {12 * HOUR}
                  WHEN o.ms >= s.timer THEN NULL
                  ELSE s.timer END
      FROM s JOIN o ON o.user_id = s.user_id AND o.rn = s.rn + 1)
    SELECT user_id, fired AS alarm_ms FROM s WHERE fired IS NOT NULL
    UNION ALL
    SELECT user_id, timer FROM s WHERE timer IS NOT NULL AND rn = (SELECT max(rn) FROM o WHERE o.user_id = s.user_id)""")
def rise_alarm(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select("user_id", "ms", "event_id", "value")
    return alerts.rise_alarm(rows, ["user_id"], ["ms", "event_id"], "value", "12 hours", by_time("ms"))


# the same on a clock that is supplied with the rows, here a minute for each arrival number
CLOCKED_SQL = f"""
    SELECT user_id, event_id, seq * 60000 AS ms, value,
           row_number() OVER (PARTITION BY user_id ORDER BY seq, event_id) AS rn,
           lag(value) OVER (PARTITION BY user_id ORDER BY seq, event_id) AS last
    FROM ({STATION_SQL})"""


@query("rise_alarm_clock", ORACLES["rise_alarm"].replace(ORDERED_SQL, CLOCKED_SQL))
def rise_alarm_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = station_log(spark, sf_dir).select("user_id", (F.col("seq") * 60_000).alias("clock_ms"), "event_id", "value")
    return alerts.rise_alarm(rows, ["user_id"], ["clock_ms", "event_id"], "value", "12 hours", by_time("clock_ms"))


CAPPED_SQL = f"""
    SELECT *, row_number() OVER (PARTITION BY user_id, event_type, ms // 86400000 ORDER BY event_id) AS nth
    FROM ({EVENTS_SQL})"""


def capped(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    clicks = events(spark, sf_dir).select("event_id", "user_id", "event_type", "ts", "ms")
    return alerts.daily_cap(clicks, ["user_id", "event_type"], "ts", "event_id", 2)


@query("click_cap_pass", f"SELECT event_id, user_id, event_type, ms FROM ({CAPPED_SQL}) WHERE nth <= 2")
def click_cap_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    return capped(spark, sf_dir)[0].select("event_id", "user_id", "event_type", "ms")


@query("click_cap_alarm", f"""
    SELECT event_id, user_id, event_type, (ms // 86400000 + 1) * 86400000 AS reset_ms, 'more than 2 a day' AS msg
    FROM ({CAPPED_SQL}) WHERE nth = 3""")
def click_cap_alarm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return capped(spark, sf_dir)[1].select("event_id", "user_id", "event_type", "reset_ms", "msg")


@query("clicks_by_group_after_cap", f"""
    SELECT event_type, window_start_ms + {HOUR} AS window_end_ms, count(*) AS n FROM (
      SELECT event_type, unnest(generate_series(
          ms // 600000 * 600000 - 3000000, ms // 600000 * 600000, 600000)) AS window_start_ms
      FROM ({CAPPED_SQL}) WHERE nth <= 2)
    GROUP BY 1, 2""")
def clicks_by_group_after_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    clicks = events(spark, sf_dir).select("event_id", "user_id", "event_type", "ts")
    counts, _ = analyses.clicks_by_group(
        clicks, ["user_id", "event_type"], "event_type", "ts", "event_id", 2, every="10 minutes"
    )
    return counts.select("event_type", "window_end_ms", "n")


# --- reconciliation -----------------------------------------------------------------------------


def both_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    ordered = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("orderkey"), epoch_ms("o_orderdate").alias("ordered_ms")
    )
    shipped = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("orderkey"), epoch_ms("l_shipdate").alias("shipped_ms")
    )
    # one receipt per key: the earliest shipment
    return ordered, shipped.groupBy("orderkey").agg(F.min("shipped_ms").alias("shipped_ms"))


SIDES_SQL = """
    WITH l AS (SELECT o_orderkey AS orderkey, epoch_us(o_orderdate) // 1000 AS ordered_ms FROM orders),
    r AS (SELECT l_orderkey AS orderkey, min(epoch_us(l_shipdate) // 1000) AS shipped_ms FROM lineitem GROUP BY 1)"""
YEAR_MS = 365 * 24 * HOUR


@query("reconcile_matched", f"""{SIDES_SQL}
    SELECT orderkey, ordered_ms, shipped_ms FROM l JOIN r USING (orderkey)
    WHERE abs(ordered_ms - shipped_ms) <= {YEAR_MS}""")
def reconcile_matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analyses.payment_receipts(
        *both_sides(spark, sf_dir), "orderkey", "ordered_ms", "shipped_ms", "365 days"
    ).matched


@query("reconcile_only_left", f"""{SIDES_SQL}
    SELECT orderkey, ordered_ms FROM l
    WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.orderkey = l.orderkey AND abs(ordered_ms - shipped_ms) <= {YEAR_MS})""")
def reconcile_only_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    ordered, shipped = both_sides(spark, sf_dir)
    return reconcile.only_one_side(ordered, shipped, "orderkey", "ordered_ms", "shipped_ms", "365 days")


@query("reconcile_only_right", f"""{SIDES_SQL}
    SELECT orderkey, shipped_ms FROM r
    WHERE NOT EXISTS (SELECT 1 FROM l WHERE r.orderkey = l.orderkey AND abs(ordered_ms - shipped_ms) <= {YEAR_MS})""")
def reconcile_only_right(spark: SparkSession, sf_dir: str) -> DataFrame:
    ordered, shipped = both_sides(spark, sf_dir)
    return reconcile.only_one_side(shipped, ordered, "orderkey", "shipped_ms", "ordered_ms", "365 days")


@query("reconcile_sides", f"""{SIDES_SQL},
    j AS (SELECT l.orderkey AS lk, r.orderkey AS rk FROM l FULL JOIN r
          ON l.orderkey = r.orderkey AND abs(ordered_ms - shipped_ms) <= {YEAR_MS})
    SELECT CASE WHEN rk IS NULL THEN 'left' WHEN lk IS NULL THEN 'right' ELSE 'both' END AS side, count(*) AS n
    FROM j GROUP BY 1""")
def reconcile_sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = reconcile.reconcile(*both_sides(spark, sf_dir), "orderkey", "ordered_ms", "shipped_ms", "365 days")
    return joined.groupBy("side").agg(F.count(F.lit(1)).alias("n"))


@query("reconcile_key_only", f"""{SIDES_SQL}
    SELECT coalesce(l.orderkey, r.orderkey) AS orderkey, ordered_ms, shipped_ms,
           CASE WHEN r.orderkey IS NULL THEN 'left' WHEN l.orderkey IS NULL THEN 'right' ELSE 'both' END AS side
    FROM l FULL JOIN r ON l.orderkey = r.orderkey""")
def reconcile_key_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.reconcile(*both_sides(spark, sf_dir), "orderkey", "ordered_ms", "shipped_ms")


@query("earliest_receipt", """
    SELECT l_orderkey AS orderkey, epoch_us(l_shipdate) // 1000 AS shipped_ms, l_partkey AS partkey FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY epoch_us(l_shipdate) // 1000, l_partkey) AS rn
      FROM lineitem) WHERE rn = 1""")
def earliest_receipt(spark: SparkSession, sf_dir: str) -> DataFrame:
    shipments = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("orderkey"), epoch_ms("l_shipdate").alias("shipped_ms"), F.col("l_partkey").alias("partkey")
    )
    return reconcile.earliest_per_key(shipments, "orderkey", "shipped_ms", "partkey")[0]


@query("earliest_receipt_surplus", """
    SELECT l_orderkey AS orderkey, count(*) - 1 AS surplus_rows FROM lineitem GROUP BY 1 HAVING count(*) > 1""")
def earliest_receipt_surplus(spark: SparkSession, sf_dir: str) -> DataFrame:
    shipments = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("orderkey"), epoch_ms("l_shipdate").alias("shipped_ms"), F.col("l_partkey").alias("partkey")
    )
    return reconcile.earliest_per_key(shipments, "orderkey", "shipped_ms", "partkey")[1]
