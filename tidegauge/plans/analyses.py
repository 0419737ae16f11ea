"""End-to-end analyses, composed from the operators. All take and return DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.text import non_word_tokens, space_tokens, words
from tidegauge.functions.times import epoch_ms, floor_to, millis
from tidegauge.operators import alerts, lateness, patterns, reconcile, topn, windows
from tidegauge.operators.aggregates import count_rows
from tidegauge.operators.scans import Axis, by_time
from tidegauge.session import written


def page_views(df: DataFrame, viewed: Column, ts: str = "ts", size: str = "1 hour") -> DataFrame:
    """Page views per window over the whole table."""
    return windows.tumble(df.where(viewed), ts, size, count_rows("pv"))


def hot_items(
    df: DataFrame, viewed: Column, item: str, ts: str = "ts", size: str = "1 hour", every: str = "5 minutes", n: int = 5
) -> DataFrame:
    """The ``n`` most viewed items of every sliding window."""
    counts = windows.slide_counts(df.where(viewed), ts, size, every, keys=[item])
    return topn.top_n(counts, ["window_end_ms"], "n", [item], n)


def hot_items_report(ranked: DataFrame, item: str) -> DataFrame:
    return topn.report(
        ranked, ["window_end_ms"],
        F.format_string("window end %d", F.col("window_end_ms")),
        F.format_string("No%d: item=%s count=%d", F.col("rank"), F.col(item).cast("string"), F.col("n")),
    )


def hot_pages(
    log: DataFrame, url: str, ts_ms: str, arrival: Sequence[str], size: str = "10 minutes", every: str = "5 seconds",
    disorder: str = "1 second", late: str = "60 seconds", n: int = 5,
) -> DataFrame:
    """The ``n`` most requested pages per sliding window, after the accepted late rows."""
    seen = written(lateness.arrival_watermark(log, ts_ms, arrival, disorder), "watermarked")
    counts = lateness.late_window_counts(seen, ts_ms, size, every, late, [url])
    return topn.top_n(counts, ["window_end_ms"], "n", [url], n)


def clicks_by_group(
    clicks: DataFrame, keys: Sequence[str], group: str, ts: str, arrival: str, cap: int = 100,
    size: str = "1 hour", every: str = "10 seconds",
) -> tuple[DataFrame, DataFrame]:
    """(clicks per group and window without those above the daily cap, cap alarms)."""
    passed, alarms = alerts.daily_cap(clicks, keys, ts, arrival, cap)
    return windows.slide_counts(passed, ts, size, every, keys=[group]), alarms


def market_by_channel(
    log: DataFrame, channel: str, behavior: str, ts: str, removed: str, size: str = "2 hours", every: str = "10 seconds"
) -> DataFrame:
    kept = log.where(F.col(behavior) != removed)
    return windows.slide_counts(kept, ts, size, every, keys=[channel, behavior])


def market_total(
    log: DataFrame, behavior: str, ts: str, removed: str, size: str = "2 hours", every: str = "10 seconds"
) -> DataFrame:
    totals = windows.slide_counts(log.where(F.col(behavior) != removed), ts, size, every)
    return totals.withColumns({"channel": F.lit("market"), "behavior": F.lit("total")})


def login_alarms(
    logins: DataFrame, user: str, arrival: Sequence[str], failed: Column, ts_ms: str, bound: str, segment: Column
) -> DataFrame:
    """Two failures in a row within less than ``bound``, rows taken as they arrive."""
    return patterns.repeated_in_arrival(logins, [user], arrival, failed, ts_ms, bound, segment)


def order_payments(
    orders: DataFrame, order: str, created: Column, paid: Column, ts_ms: str, ties: str,
    bound: str = "15 minutes", segment: Axis | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(orders paid in time, orders timed out), with their result message."""
    done, expired = patterns.followed_by(
        orders, [order], [ts_ms, ties], created, paid, ts_ms, bound,
        by_time(ts_ms) if segment is None else segment,
    )
    return done.withColumn("msg", F.lit("paid in time")), expired.withColumn("msg", F.lit("not paid in time"))


def payment_receipts(
    payments: DataFrame, receipts: DataFrame, key: str, paid_ms: str, receipt_ms: str, max_gap: str | None = "5 seconds"
) -> reconcile.Reconciled:
    return reconcile.reconcile_outputs(payments, receipts, key, paid_ms, receipt_ms, max_gap)


def station_calls(
    log: DataFrame, station: str, ts_ms: str, arrival: Sequence[str], size: str = "10 seconds", every: str = "5 seconds",
    disorder: str = "2 seconds", late: str = "4 seconds",
) -> tuple[DataFrame, DataFrame]:
    """(every result per station and window, rows too late for all their windows)."""
    seen = written(lateness.arrival_watermark(log, ts_ms, arrival, disorder), "watermarked")
    _, too_late = lateness.late_split(seen, ts_ms, size, every, late)
    return lateness.late_changelog(seen, ts_ms, arrival, size, every, late, [station]), too_late


def word_counts(df: DataFrame, line: str, by_space: bool = False) -> DataFrame:
    tokens = space_tokens(line) if by_space else non_word_tokens(line)
    return words(df, tokens).groupBy("word").agg(count_rows())


CHARS_PER_RANGE = 1 << 24


def windowed_word_counts(df: DataFrame, line: str, ts: str, size: str = "3 seconds") -> DataFrame:
    """Counts per word and window.

    Nearly every word of a window is a row of the result, so the lines are dealt out instead, by ranges of windows of about
    ``CHARS_PER_RANGE``: words are counted where their lines are, and are not shuffled. The rows come in ranges of
    time, but for windows that are longer than a range: the words of those are dealt out one by one.
    """
    by = ["window_start_ms", "word"]
    lines = df.where(F.col(ts).isNotNull()).select(floor_to(epoch_ms(ts), millis(size)).alias(by[0]), line)
    sizes = written(lines.groupBy(by[0]).agg(F.sum(F.length(line).cast("long")).alias("chars")), "window-chars")
    long = sizes.where(F.col("chars") > CHARS_PER_RANGE).select(by[0])
    ranges = (sizes.agg(F.sum("chars")).first()[0] or 0) // CHARS_PER_RANGE + 1

    def counted(lines: DataFrame) -> DataFrame:
        counts = words(lines, space_tokens(line), by[0]).groupBy(*by).agg(count_rows())
        return counts.withColumn("window_end_ms", F.col(by[0]) + millis(size))

    if long.isEmpty():
        return counted(lines.repartitionByRange(ranges, by[0]))
    rest = lines.join(long, by[0], "left_anti").repartitionByRange(ranges, by[0])
    return counted(rest).unionByName(counted(lines.join(long, by[0], "left_semi")))


def edit_volume(edits: DataFrame, user: str, amount: str, ts: str, size: str = "5 seconds") -> DataFrame:
    """Sum of changes per user and window."""
    return windows.tumble(edits, ts, size, F.sum(amount).alias("volume"), keys=[user])
