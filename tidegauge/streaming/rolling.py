"""Row files of a stream that roll by size, age and inactivity.

Files cannot grow once they are written, so the rows of the open part wait in a table that passes
from batch to batch, and a part is published when it is due. All times come from a clock column: one
of the rows' own, or ``current_timestamp()``, which a repeated batch finds unchanged. A batch
therefore decides alike each time it runs and overwrites what it published, so every row is in one part.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidegauge.functions.times import millis
from tidegauge.operators.scans import by_rows, scan
from tidegauge.streaming.run import Snapshots

_OPEN = "line string, place long, clock long"


def rolling_parts(
    rows: DataFrame, folder: str, line: str, order: str, clock_ms: str,
    max_bytes: int, age: str | int = "20 seconds", idle: str | int = "10 seconds",
) -> Callable[[], StreamingQuery]:
    """Write the column ``line`` as text files under ``out``, none larger than ``max_bytes``.

    A part is published when it is full, when its first row is ``age`` old, or when no row came for ``idle``, by
    the latest ``clock_ms`` of a batch. Rows without a line only move the clock: a stream of ticks, united with the
    rows, closes parts while no rows come. ``order`` numbers the rows; ``close_parts`` publishes the rest
    when a stream ends. A line longer than ``max_bytes`` is a part of its own.
    """
    state = Snapshots(f"{folder}/open", _OPEN)

    def write(batch: DataFrame, batch_id: int) -> None:
        fresh = batch.select(
            F.col(line).cast("string").alias("line"), F.col(order).cast("long").alias("place"), F.col(clock_ms).cast("long").alias("clock")
        ).persist()
        try:
            held = state.before(batch, batch_id)
            now = fresh.agg(F.max("clock").alias("now"))
            now.coalesce(1).write.mode("overwrite").parquet(f"{folder}/clock/batch={batch_id}")
            now = now.first().now
            waited = held.agg(F.min("clock").alias("first"), F.max("clock").alias("last")).first()
            due = None not in (now, waited.first) and (now - waited.first >= millis(age) or now - waited.last >= millis(idle))
            together = held.withColumn("turn", F.lit(0 if due else 1)).unionByName(fresh.where("line is not null").withColumn("turn", F.lit(1)))
            placed = f"{folder}/placed/batch={batch_id}"
            _numbered(together, max_bytes).write.mode("overwrite").parquet(placed)
            placed = batch.sparkSession.read.parquet(placed)
            # the last part stays open, unless the batch has outlived it already
            last = placed.where("turn = 1").agg(F.max("part").alias("part")).first().part
            tail = F.lit(False) if last is None else (F.col("turn") == 1) & (F.col("part") == last)
            opened = placed.where(tail).agg(F.min("clock").alias("first")).first().first
            if None not in (now, opened) and now - opened >= millis(age):
                tail = F.lit(False)
            _publish(placed.where(~tail), folder, batch_id)
            state.write(placed.where(tail).select("line", "place", "clock"), batch_id)
        finally:
            fresh.unpersist()

    return lambda: (
        rows.writeStream.foreachBatch(write).outputMode("append")
        .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    )


def _numbered(rows: DataFrame, max_bytes: int, rows_per_segment: int | None = None) -> DataFrame:
    """``rows`` with the ``part`` of their turn that they fill in order.

    Turn 0 is what was open, no more than a part. Turn 1 is a batch, one sequence that is cut into segments.
    """
    rows = rows.withColumn("bytes", F.octet_length("line").cast("long") + 1)
    longest = rows.where(F.col("bytes") <= max_bytes).agg(F.max("bytes")).first()[0] or 0
    room = F.lit(max(1, max_bytes - longest + 1)).cast("long")  # rows that begin within it end within max_bytes
    ahead = {"ahead": ("sum", F.col("bytes"))}
    due = scan(rows.where("turn = 0"), ["turn"], ["place", "line"], by_rows("place"), before=ahead, split=False)
    fresh = scan(rows.where("turn = 1"), [], ["place", "line"], by_rows("place", rows_per_segment), before=ahead)
    counted = due.unionByName(fresh)
    return counted.withColumn("part", F.floor(F.coalesce("ahead", F.lit(0)) / room)).drop("bytes", "ahead")


def _publish(rows: DataFrame, folder: str, batch_id: int) -> None:
    """One file per part."""
    named = rows.select(F.concat_ws("-", "turn", "part").alias("part"), "place", F.col("line").alias("value"))
    parts = named.repartition("part").sortWithinPartitions("part", "place", "value").select("part", "value")
    parts.write.mode("overwrite").partitionBy("part").text(f"{folder}/out/batch={batch_id}")


def close_parts(spark: SparkSession, folder: str, max_bytes: int) -> None:
    """Publish what is still open once a stream has ended; calling it again changes nothing."""
    last = spark.read.schema("now long, batch long").parquet(f"{folder}/clock").agg(F.max("batch")).first()[0]
    held = spark.read.schema(_OPEN).parquet(f"{folder}/open/batch={last}").withColumn("turn", F.lit(1))
    _publish(_numbered(held, max_bytes), folder, last + 1)
