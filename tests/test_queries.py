"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect
from tests.test_streaming import IN_ORDER
from tidegauge.operators import scans

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


# the others run as streams of several batches in test_streaming
@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) - set(IN_ORDER)))
def test_query_equals_sql(spark, con, name):
    problem = compare(entry.queries()[name](spark, SF_DIR), con, entry.oracle_sql()[name])
    assert problem in ("", "both empty")


LARGE = [
    "rolling_sum", "count_tumbling_min", "login_fail_lag", "login_fail_strict_next", "order_paid", "order_timeout",
    "jump_alert", "jump_alert_hold", "rise_alarm", "uv_running", "late_changelog", "hot_pages_late_top5", "market_total",
]


@pytest.mark.parametrize("name", LARGE)
def test_query_equals_sql_as_if_large(spark, con, name, monkeypatch):
    """Nearly every key is hot and cut into many segments."""
    monkeypatch.setattr(scans, "HOT_ROWS", 20)
    monkeypatch.setattr(scans, "ROWS_PER_SEGMENT", 7)
    assert compare(entry.queries()[name](spark, SF_DIR), con, entry.oracle_sql()[name]) in ("", "both empty")


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).columns == ["window_end_ms", "item_id", "n", "rank"]
    assert entry.entry(spark).count() > 0


def test_sketch_is_close_to_the_exact_count(spark):
    from pyspark.sql import functions as F

    from tidegauge.operators import distinct
    from tidegauge.plans.tables import events

    rows = events(spark, "/root/testdata/sf0.01")
    exact = distinct.unique_exact(rows, "ts", "1 day", "user_id", "exact")
    sketch = distinct.unique_sketch(rows, "ts", "1 day", "user_id")
    off = exact.join(sketch, "window_end_ms").where(F.abs(F.col("uv") - F.col("exact")) > 0.06 * F.col("exact"))
    assert exact.count() == 30 and off.count() == 0
