"""Event-time expressions. Times travel as TIMESTAMP or as BIGINT epoch milliseconds."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def millis(duration: str | int) -> int:
    """``"10 minutes"`` → 600000; an int already is in milliseconds."""
    if isinstance(duration, int):
        return duration
    return int(pd.Timedelta(duration) / pd.Timedelta(milliseconds=1))


def epoch_ms(ts: Column | str) -> Column:
    """Timestamp (with or without zone) → epoch milliseconds."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_millis(ts.cast("timestamp"))


def floor_to(ms: Column, step: int) -> Column:
    """Start of the epoch-aligned slot of ``step`` milliseconds that holds ``ms``."""
    return ms - F.pmod(ms, F.lit(step))


def day_end_ms(ts: Column | str) -> Column:
    """The next UTC midnight after ``ts``."""
    return floor_to(epoch_ms(ts), 86_400_000) + F.lit(86_400_000)


def window_ms(df: DataFrame, window: str = "window") -> DataFrame:
    """Replace a ``window`` struct by ``window_start_ms`` and ``window_end_ms``."""
    return df.withColumns({
        "window_start_ms": epoch_ms(F.col(window)["start"]),
        "window_end_ms": epoch_ms(F.col(window)["end"]),
    }).drop(window)
