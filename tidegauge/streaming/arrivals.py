"""Watermarks, late rows and repeated window results per row of a stream.

The engine's watermark moves once per micro-batch. Here it moves with every row, as in
``operators.lateness``: ``mark_arrivals`` computes it inside each micro-batch by the segmented scan,
starting from one number that the batch before left behind, and parts the rows that are too late.
``late_results`` is a second stream over the rows it kept: open windows live in keyed state, fire
when the watermark reaches their end and again for every accepted late row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidegauge.functions.times import floor_to, millis
from tidegauge.operators import lateness
from tidegauge.streaming.processors import OpenWindows, process
from tidegauge.streaming.run import IS_END, EndOfInput

WATERMARK = "wm_ts"
_DAY = 86_400_000


def append_part(rows: DataFrame, folder: str) -> None:
    """More files for a feed. Files are read in the order they were written."""
    rows.write.mode("append").parquet(folder)


def mark_arrivals(
    rows: DataFrame, folder: str, ts_ms: str, arrival: Sequence[str], disorder: str, size: str, every: str, late: str
) -> Callable[[], StreamingQuery]:
    """Write every row with ``wm_before`` and ``wm_after`` to ``kept`` or, if all its windows are closed, to ``late``.

    ``fired`` gets, for every window end that the watermark passes, the arrival number of the row that
    lifts it there. ``arrival`` must order the rows of all batches; a batch's rows come behind those of
    earlier ones. Of earlier batches one number is read, the latest time, from the batch before. Each
    batch overwrites what it wrote, so a repeated one leaves one copy. Rows without a time are kept,
    and lift nothing.
    """
    step = millis(every)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        high = None
        if batch_id:
            high = spark.read.schema("high long").parquet(f"{folder}/high/batch={batch_id - 1}").first().high
        before = None if high is None else high - millis(disorder)
        seen = lateness.arrival_watermark(batch, ts_ms, arrival, disorder).withColumns({
            name: F.greatest(F.col(name), F.lit(before).cast("long")) for name in ("wm_before", "wm_after")
        })
        marked = f"{folder}/marked/batch={batch_id}"
        seen.withColumn(WATERMARK, F.timestamp_millis("wm_after")).write.mode("overwrite").parquet(marked)
        seen = spark.read.parquet(marked)
        for name, part in zip(("kept", "late"), lateness.late_split(seen, ts_ms, size, every, late)):
            part.write.mode("overwrite").parquet(f"{folder}/{name}/batch={batch_id}")
        first_end = floor_to(F.col("wm_before") + 1, step) + F.lit(step)
        last_end = floor_to(F.col("wm_after") + 1, step)
        lifts = seen.where((F.col("wm_after") > F.col("wm_before")) & (first_end <= last_end)).select(
            F.explode(F.sequence(first_end, last_end, F.lit(step).cast("long"))).alias("window_end_ms"),
            F.col(arrival[0]).cast("long").alias("fired_at"), F.lit(batch_id).alias("batch"),
        ).withColumn("day", F.expr(f"window_end_ms div {_DAY}"))
        lifts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "batch").parquet(f"{folder}/fired")
        latest = seen.agg(F.greatest(F.max(ts_ms), F.lit(high).cast("long")).alias("high"))
        latest.coalesce(1).write.mode("overwrite").parquet(f"{folder}/high/batch={batch_id}")

    return lambda: (
        rows.writeStream.foreachBatch(write).outputMode("append")
        .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    )


def kept_stream(spark: SparkSession, folder: str, schema: StructType) -> tuple[DataFrame, EndOfInput]:
    """The rows that ``mark_arrivals`` keeps, followed by their end marker. A micro-batch takes whole batches.

    ``schema`` is that of the rows that go in.
    """
    marked = StructType([*schema.fields, *StructType.fromDDL(f"wm_before long, wm_after long, {WATERMARK} timestamp").fields])
    end = EndOfInput(spark, f"{folder}/results", marked, WATERMARK)
    files = spark.readStream.schema(marked).parquet(f"{folder}/kept/*")
    return end.follow(files), end


def late_results(
    kept: DataFrame, folder: str, keys: Sequence[str], ts_ms: str, arrival: Sequence[str],
    size: str, every: str, late: str,
) -> Callable[[], StreamingQuery]:
    """Write every result a (key, window) emits: ``out`` has the keys, window_end_ms, the arrival number
    that triggered it and n, as ``lateness.late_changelog`` gives them.

    The engine's watermark is the rows' own, one ms behind, so that rows that do not lift it are not
    late to the engine; timers at the windows' ends fire what no late row has fired before. A first
    result looks up the row that fired it among the window ends of its days.
    """
    by = [*keys, IS_END]
    types = dict(kept.dtypes)
    rows = kept.withWatermark(WATERMARK, "1 millisecond").select(
        *by, WATERMARK, ts_ms, *arrival, F.coalesce("wm_before", F.lit(-(1 << 62))).alias("wm_before")
    )
    sequence = arrival[0]
    output = ", ".join([*(f"`{k}` {types[k]}" for k in by), f"window_end_ms long, {sequence} long, n long"])
    results = process(rows, by, OpenWindows(by, arrival, ts_ms, millis(size), millis(every), millis(late)), output, "EventTime")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        kept_rows = batch.where(~F.col(IS_END)).drop(IS_END).persist()
        try:
            first = kept_rows.where(F.col(sequence).isNull())
            span = first.agg(F.min("window_end_ms").alias("low"), F.max("window_end_ms").alias("high")).first()
            fired = spark.read.schema("window_end_ms long, fired_at long, day long").parquet(f"{folder}/fired")
            days = F.col("day").between((span.low or 0) // _DAY, (span.high or 0) // _DAY)
            fired = fired.where(days).select("window_end_ms", "fired_at")
            named = first.join(fired, "window_end_ms", "left").withColumn(sequence, F.col("fired_at")).drop("fired_at")
            named.unionByName(kept_rows.where(F.col(sequence).isNotNull())).write.mode("overwrite").parquet(f"{folder}/out/batch={batch_id}")
        finally:
            kept_rows.unpersist()

    return lambda: (
        results.writeStream.foreachBatch(write).outputMode("append")
        .option("checkpointLocation", f"{folder}/results/checkpoint").trigger(availableNow=True).start()
    )
