"""Small inputs with results worked out by hand."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidegauge.operators import alerts, patterns, reconcile, scans, windows
from tidegauge.operators.aggregates import extreme
from tidegauge.operators.scans import by_rows, by_time
from tidegauge.plans import analyses
from tidegauge.sources import access_log, key_value_lines
from tidegauge.sources.schemas import FEEDBACK


@pytest.fixture(autouse=True, params=[0, 1 << 60])
def split_or_not(request, monkeypatch):
    """Once with every key split into segments, once with none hot."""
    monkeypatch.setattr(scans, "HOT_ROWS", request.param)
    monkeypatch.setattr(scans, "ROWS_PER_SEGMENT", 2)


def rows_of(df, *columns):
    return sorted(map(tuple, (df.select(*columns) if columns else df).collect()), key=repr)


STATION = [(0, "id1", 1577080478000), (1, "id1", 1577080479000), (2, "id1", 1577080468000),
           (3, "id1", 1577080481000), (4, "id1", 1577080469000)]


def test_station_calls_with_late_rows(spark):
    log = spark.createDataFrame(STATION, "seq long, id string, ms long")
    results, late = analyses.station_calls(log, "id", "ms", ["seq"])
    # the row at 468 comes when 460-470 is already closed for it but 465-475 is not
    assert rows_of(late, "seq", "ms") == [(4, 1577080469000)]
    assert rows_of(results, "window_start_ms", "window_end_ms", "n", "seq") == [
        (1577080465000, 1577080475000, 1, 2),
        (1577080470000, 1577080480000, 2, None),
        (1577080475000, 1577080485000, 3, None),
        (1577080480000, 1577080490000, 1, None),
    ]


LOGINS = [
    (0, 23064, "fail", 826), (1, 5692, "fail", 833), (2, 5692, "success", 840), (3, 1035, "fail", 842),
    (4, 1035, "fail", 843), (5, 1035, "fail", 844), (6, 83419, "fail", 882), (7, 83419, "success", 885),
    (8, 83419, "fail", 886), (9, 83419, "success", 884), (10, 77, "fail", 100), (11, 77, "fail", 102),
]


def test_login_failures(spark):
    logins = spark.createDataFrame(LOGINS, "seq long, user long, state string, s long").withColumn("ms", F.col("s") * 1000)
    failed = F.col("state") == "fail"
    expected = [(1035, 842000, 843000), (1035, 843000, 844000)]
    by_arrival = analyses.login_alarms(logins, "user", ["seq"], failed, "ms", "2 seconds", by_rows("seq", 3))
    assert rows_of(by_arrival, "user", "first_ms", "next_ms") == expected
    strict = patterns.strict_next(logins, ["user"], ["ms", "seq"], failed, failed, "ms", "2 seconds", by_time("ms", 1000))
    assert rows_of(strict, "user", "first_ms", "next_ms") == expected


def test_order_payments(spark):
    data = [
        (0, 1, "create", 0), (1, 1, "pay", 60), (2, 2, "create", 10), (3, 2, "pay", 10 + 900),
        (4, 3, "pay", 20), (5, 4, "create", 30), (6, 5, "create", 40), (7, 5, "create", 50), (8, 5, "pay", 100),
        (9, 5, "pay", 110),
    ]
    orders = spark.createDataFrame(data, "id long, order long, oper string, s long").withColumn("ms", F.col("s") * 1000)
    for width in (1000, 10**9):
        paid, expired = analyses.order_payments(
            orders, "order", F.col("oper") == "create", F.col("oper") == "pay", "ms", "id", segment=by_time("ms", width)
        )
        # exactly 15 minutes is too late; each open create of order 5 takes the first pay
        assert rows_of(paid, "order", "first_ms", "next_ms") == [(1, 0, 60000), (5, 40000, 100000), (5, 50000, 100000)]
        assert rows_of(expired, "order", "msg") == [(2, "not paid in time"), (4, "not paid in time")]


PAYS = [("a", 0), ("b", 1000), ("c", 2000), ("d", 3000)]
RECEIPTS = [("a", 5000), ("b", 6001), ("c", 1000), ("e", 9000)]


def test_reconcile(spark):
    pays = spark.createDataFrame(PAYS, "tx string, pay_ms long")
    receipts = spark.createDataFrame(RECEIPTS, "tx string, receipt_ms long")
    bounded = analyses.payment_receipts(pays, receipts, "tx", "pay_ms", "receipt_ms")
    assert rows_of(bounded.matched) == [("a", 0, 5000), ("c", 2000, 1000)]
    assert rows_of(bounded.only_left) == [("b", 1000), ("d", 3000)]
    assert rows_of(bounded.only_right) == [("b", 6001), ("e", 9000)]
    for side, (one, other, one_ms, other_ms) in {
        "only_left": (pays, receipts, "pay_ms", "receipt_ms"), "only_right": (receipts, pays, "receipt_ms", "pay_ms"),
    }.items():
        anti = reconcile.only_one_side(one, other, "tx", one_ms, other_ms, "5 seconds")
        assert rows_of(anti) == rows_of(getattr(bounded, side))
    free = analyses.payment_receipts(pays, receipts, "tx", "pay_ms", "receipt_ms", None)
    assert [free.matched.count(), rows_of(free.only_left), rows_of(free.only_right)] == [3, [("d", 3000)], [("e", 9000)]]


def test_reconcile_rows_without_a_key(spark):
    pays = spark.createDataFrame([(None, 0), ("a", 1)], "tx string, pay_ms long")
    receipts = spark.createDataFrame([("a", 1), (None, 2)], "tx string, receipt_ms long")
    sides = analyses.payment_receipts(pays, receipts, "tx", "pay_ms", "receipt_ms")
    assert [rows_of(part) for part in sides] == [[("a", 1, 1)], [(None, 0)], [(None, 2)]]


def test_earliest_per_key(spark):
    df = spark.createDataFrame([("a", 5, 1), ("a", 3, 2), ("a", 3, 1), ("b", 1, 9)], "tx string, ms long, id long")
    unique, surplus = reconcile.earliest_per_key(df, "tx", "ms", "id")
    assert rows_of(unique) == [("a", 3, 1), ("b", 1, 9)] and rows_of(surplus) == [("a", 2)]


def test_daily_cap(spark):
    day = 86_400
    data = [(i, 1, 7, "x", i) for i in range(5)] + [(i, 1, 7, "x", day + i) for i in range(5, 8)] + [(8, 2, 7, "y", 3)]
    clicks = spark.createDataFrame(data, "seq long, user long, ad long, province string, s long").withColumn(
        "ts", F.timestamp_seconds("s")
    )
    for cap, big in ((3, 3), (alerts.GROUP_LIMIT, None)):
        passed, alarms = alerts.daily_cap(clicks, ["user", "ad"], "ts", "seq", cap)
        if big:
            assert rows_of(passed, "seq") == [(i,) for i in (0, 1, 2, 5, 6, 7, 8)]
            assert rows_of(alarms, "seq", "user", "msg") == [(3, 1, "more than 3 a day")]
        else:
            assert passed.count() == 9 and alarms.count() == 0


def test_words_and_running_reduce(spark):
    from tidegauge.operators.rolling import rolling_suffix

    lines = spark.createDataFrame([(0, "to be  or"), (1, "not to\tbe"), (2, " To-do ")], "id long, line string")
    assert rows_of(analyses.word_counts(lines, "line", by_space=True)) == [
        ("To-do", 1), ("be", 2), ("not", 1), ("or", 1), ("to", 2)]
    assert rows_of(analyses.word_counts(lines, "line")) == [("be", 2), ("do", 1), ("not", 1), ("or", 1), ("to", 3)]
    words = spark.createDataFrame([(0, "a"), (1, "b"), (2, "a"), (3, "a")], "id long, word string")
    assert rows_of(rolling_suffix(words, "word", ["id"], "_new", by_rows("id", 2)), "id", "label", "n") == [
        (0, "a", 1), (1, "b", 1), (2, "a_new", 2), (3, "a_new_new", 3)]


def test_count_windows(spark):
    values = [5, 3, 9, 3, 8, 1, 7, 7, 2, 6, 4, 4]
    df = spark.createDataFrame([(i, "k", v) for i, v in enumerate(values)] + [(99, "few", 1)], "id long, key string, v long")
    segment = by_rows("id", 4)
    keep_first = windows.count_tumble(df, ["key"], ["id"], 5, *extreme("v", ["id"], ["id"], "min", False), segment=segment)
    assert rows_of(keep_first, "window_no", "v", "id") == [(0, 3, 0), (1, 1, 5)]
    whole = windows.count_tumble(df, ["key"], ["id"], 5, *extreme("v", ["id"], ["id"], "max", True), segment=segment)
    assert rows_of(whole, "window_no", "v", "id") == [(0, 9, 2), (1, 7, 6)]
    sliding = windows.count_slide(df, ["key"], ["id"], 10, 5, {"v": ("min", F.col("v"))}, segment)
    assert rows_of(sliding, "window_no", "v") == [(0, 3), (1, 1)]


def test_jump_alert(spark):
    data = [(0, "id1", 1.0), (1, "id1", 12.0), (2, "id1", 14.0), (3, "id1", 3.0), (4, "id2", 50.0)]
    df = spark.createDataFrame(data, "ms long, id string, fre double")
    assert rows_of(alerts.jump_alert(df, ["id"], ["ms"], "fre", 10, by_time("ms", 2)), "ms", "last", "fre") == [
        (1, 1.0, 12.0), (3, 14.0, 3.0)]
    held = alerts.jump_alert_hold(df, ["id"], ["ms"], "fre", 10, by_time("ms", 2), rows_per_segment=2)
    assert rows_of(held, "ms", "last", "fre") == [(1, 1.0, 12.0), (2, 1.0, 14.0), (4, 0.0, 50.0)]


def test_access_log_and_lines(spark):
    lines = spark.createDataFrame(
        [("1.2.3.4 u - 17/05/2015:10:05:03 +0200 GET /a",), ("broken",), ("1.2.3.4 u - nonsense +0000 GET /b",)], "value string"
    )
    parsed, bad = access_log(lines)
    parsed = parsed.withColumn("ms", F.unix_millis("ts"))
    assert rows_of(bad, "rejected_line") == [("1.2.3.4 u - nonsense +0000 GET /b",), ("broken",)]
    assert rows_of(parsed, "ip", "user_id", "method", "url", "ms") == [("1.2.3.4", "u", "GET", "/a", 1431849903000)]
    rows = spark.createDataFrame([("id1 10 3",), ("",), ("id2 x 3",), ("id3 4",)], "value string")
    good, bad = key_value_lines(rows, FEEDBACK)
    assert rows_of(good) == [("id1", 10, 3)] and rows_of(bad) == [("id2 x 3",), ("id3 4",)]


# seconds after 10:05, page, in order of arrival
REQUESTS = [(14, "a"), (4, "a"), (45, "a"), (14, "a"), (17, "a"), (21, "a"), (40, "a"), (10, "a"), (37, "b"), (35, "c"),
            (3, "d"), (6, "e"), (3, "f"), (41, "g"), (32, "h"), (46, "i")]


def test_hot_pages(spark):
    from tidegauge.operators import lateness

    lines = spark.createDataFrame(
        [(i, f"1.2.3.4 - - 17/05/2015:10:05:{s:02d} +0000 GET /{page}") for i, (s, page) in enumerate(REQUESTS)],
        "seq long, value string",
    )
    log = access_log(lines)[0].withColumn("ms", F.unix_millis("ts"))
    seen = lateness.arrival_watermark(log, "ms", ["seq"], "1 second")
    counts = lateness.late_window_counts(seen, "ms", "10 minutes", "5 seconds", "60 seconds", ["url"])
    summary = counts.agg(F.count(F.lit(1)), F.count_distinct("window_end_ms"), F.max("n"), F.sum("n"))
    assert tuple(summary.first()) == (1089, 129, 8, 16 * 120)
    top = analyses.hot_pages(log, "url", "ms", ["seq"])
    assert top.groupBy("window_end_ms").count().agg(F.max("count")).first()[0] == 5
    assert top.where("rank = 1").agg(F.max("n")).first()[0] == 8


def test_clock_windows_count_every_row(spark):
    from tidegauge.operators.aggregates import count_rows

    stamped = windows.stamp_arrival(spark.range(100))
    assert windows.tumble(stamped, "arrived_at", "5 seconds", count_rows()).agg(F.sum("n")).first()[0] == 100


def test_nulls_are_never_the_extreme_or_first_row(spark):
    from tidegauge.operators.aggregates import extreme, first_row

    df = spark.createDataFrame(
        [(1, 1, 5), (1, 2, None), (1, 3, 3), (1, 4, 3), (2, 5, None), (2, 6, None), (3, None, 7), (3, 7, 7), (4, 8, -(1 << 63)), (4, 9, -(1 << 63))],
        "key int, id long, v long",
    )
    least = df.groupBy("key").agg(*extreme("v", ["id"], ["id"], "min", True))
    most = df.groupBy("key").agg(*extreme("v", ["id"], ["id"], "max", True))
    low = -(1 << 63)
    assert rows_of(least, "key", "v", "id") == [(1, 3, 3), (2, None, 5), (3, 7, 7), (4, low, 8)]
    assert rows_of(most, "key", "v", "id") == [(1, 5, 1), (2, None, 5), (3, 7, 7), (4, low, 8)]
    text = spark.createDataFrame([(1, "a"), (2, "c"), (3, "c"), (4, None)], "id long, v string")
    assert [tuple(r) for r in text.agg(*extreme("v", ["id"], ["id"], "max", True)).collect()] == [("c", 2)]
    assert df.groupBy("key").agg(first_row(["v", "id"], ["id"]).alias("r")).where("key = 3").first()["r"]["id"] == 7


def test_a_row_without_time_stays_only_alone(spark):
    from tidegauge.operators import reconcile

    df = spark.createDataFrame([(1, None, 1), (1, 5, 2), (2, None, 3)], "tx int, ms long, id long")
    unique, surplus = reconcile.earliest_per_key(df, "tx", "ms", "id")
    assert rows_of(unique, "tx", "ms", "id") == [(1, 5, 2), (2, None, 3)] and rows_of(surplus) == [(1, 1)]
