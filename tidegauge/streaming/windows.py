"""Windowed aggregates, top-N and the outer join on streams."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidegauge.functions.times import millis, window_ms
from tidegauge.operators import topn
from tidegauge.operators.scans import by_rows, scan
from tidegauge.streaming.run import IS_END, Snapshots, split_outputs, still_open


def windowed(
    rows: DataFrame, ts: str, delay: str, size: str, every: str | None, *aggs: Column, keys: Sequence[str] = ()
) -> DataFrame:
    """Windows that are emitted once the watermark, ``delay`` behind the latest time, passes them."""
    window = F.window(ts, size, every) if every else F.window(ts, size)
    return rows.withWatermark(ts, delay).groupBy(*keys, window).agg(*aggs)


def windowed_counts(rows: DataFrame, ts: str, delay: str, size: str, every: str | None = None, keys: Sequence[str] = ()) -> DataFrame:
    return window_ms(windowed(rows, ts, delay, size, every, F.count(F.lit(1)).alias("n"), keys=keys))


def top_n_writer(counts: DataFrame, folder: str, key: str, n: int) -> Callable[[], StreamingQuery]:
    """Write the top ``n`` keys of each finished window of an append-mode count.

    All keys of a window finish in the same micro-batch, so ranking inside the batch is exact and
    keeps the per-task limit of the batch form; no window's keys are gathered in one state row.
    """
    ranked = lambda batch: topn.top_n(batch, ["window_end_ms"], "n", [key], n)
    return split_outputs(counts, folder, {"out": ranked})


def top_n_updates(
    counts: DataFrame, folder: str, key: str, n: int, size: str | int, delay: str | int
) -> Callable[[], StreamingQuery]:
    """Top ``n`` keys of every window, ranked again whenever a late row changes one of its counts.

    ``counts`` comes in update mode: window_end_ms, the key and n. The latest counts of the windows that
    are still open, by the windows' ``size`` and the watermark's ``delay``, pass from batch to batch as a snapshot; each
    batch writes the new ranking of the windows it changed, and ``latest_ranking`` picks a window's
    valid one. Repeated batches overwrite their own.
    """
    window = "window_end_ms"
    state = Snapshots(f"{folder}/counts", f"{window} long, `{key}` {dict(counts.dtypes)[key]}, n long, changed boolean")

    def write(batch: DataFrame, batch_id: int) -> None:
        open_before = still_open(state.before(batch, batch_id), window, millis(size) + millis(delay))
        earlier = open_before.select(window, key, "n", F.lit(False).alias("changed"))
        both = earlier.unionByName(batch.select(window, key, "n", F.lit(True).alias("changed")))
        # counts only grow, so the larger one is the later one
        valid = both.groupBy(window, key).agg(F.max("n").alias("n"), F.max("changed").alias("changed"))
        held = state.write(valid, batch_id)
        changed = held.where("changed").select(window).distinct()
        ranked = topn.top_n(held.drop("changed").join(changed, window, "left_semi"), [window], "n", [key], n)
        ranked.write.mode("overwrite").parquet(f"{folder}/out/batch={batch_id}")

    return lambda: (
        counts.writeStream.foreachBatch(write).outputMode("update")
        .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    )


def running_unique_writer(
    visits: DataFrame, folder: str, order: str, size: str | int, delay: str | int
) -> Callable[[], StreamingQuery]:
    """Every row of ``visits`` with the distinct visitors its window has seen up to and with it.

    ``visits`` has window_end_ms, the column ``order`` that numbers the rows of all batches, and ``first``, 1 where a visitor is new to the
    window. The totals of the windows that are still open pass from batch to batch as a snapshot.
    Rows of the end marker are left out.
    """
    window = "window_end_ms"
    state = Snapshots(f"{folder}/totals", f"{window} long, uv long")

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.where(~F.col(IS_END)).persist()
        try:
            earlier = still_open(state.before(batch, batch_id), window, millis(size) + millis(delay))
            counted = scan(kept, [window], [order], by_rows(order), upto={"uv": ("sum", F.col("first"))})
            counted.join(earlier.withColumnRenamed("uv", "earlier"), window, "left").select(
                order, window, (F.col("uv") + F.coalesce("earlier", F.lit(0))).alias("uv")
            ).write.mode("overwrite").parquet(f"{folder}/out/batch={batch_id}")
            totals = earlier.unionByName(kept.select(window, F.col("first").alias("uv"))).groupBy(window).agg(F.sum("uv").alias("uv"))
            state.write(totals, batch_id)
        finally:
            kept.unpersist()

    return lambda: (
        visits.writeStream.foreachBatch(write).outputMode("append")
        .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    )


def latest_ranking(rankings: DataFrame) -> DataFrame:
    """The rows of each window's last ranking."""
    last = rankings.groupBy("window_end_ms").agg(F.max("batch").alias("batch"))
    return rankings.join(last, ["window_end_ms", "batch"], "left_semi").drop("batch")


def unique_visitors(rows: DataFrame, ts: str, delay: str, size: str, visitor: str, exact: bool = True) -> DataFrame:
    """Distinct visitors per window: first one state row per (window, visitor), then their count.

    Exact counting keeps its state spread over visitors instead of one set per window.
    """
    if not exact:
        return window_ms(windowed(rows, ts, delay, size, None, F.approx_count_distinct(visitor, 0.02).alias("uv")))
    visits = windowed(rows, ts, delay, size, None, keys=[visitor], *[F.count(F.lit(1)).alias("visits")])
    ended = visits.select(F.window_time("window").alias("ended"))
    return window_ms(ended.groupBy(F.window("ended", size)).agg(F.count(F.lit(1)).alias("uv")))


def reconcile(
    left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, max_gap: str, delay: str = "0 seconds"
) -> DataFrame:
    """Full outer join within ``max_gap``; a row without partner comes out once the bound has passed.

    The two inputs share only the key column. The time range lets Spark drop old join state.
    """
    a = left.withColumn("__left", F.lit(True)).withWatermark(left_ts, delay)
    b = right.withColumnRenamed(key, "__right_key").withColumn("__right", F.lit(True)).withWatermark(right_ts, delay)
    gap = F.expr(f"INTERVAL {max_gap}")
    near = (F.col(right_ts) >= F.col(left_ts) - gap) & (F.col(right_ts) <= F.col(left_ts) + gap)
    joined = a.join(b, (F.col(key) == F.col("__right_key")) & near, "full_outer")
    side = F.when(F.col("__right").isNull(), "left").when(F.col("__left").isNull(), "right").otherwise("both")
    return (
        joined.withColumn("side", side).withColumn(key, F.coalesce(key, "__right_key"))
        .drop("__right_key", "__left", "__right")
    )
