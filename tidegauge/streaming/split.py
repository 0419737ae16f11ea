"""Rolling results and count windows of a stream whose hot keys are worked on by all tasks.

A keyed processor sees all rows of its key in one task. Here the rows of a micro-batch go through
the segmented scan, which parts a hot key's rows by their place in the order, and what a key carries
from batch to batch, one row, is added afterwards. The carried rows of all keys are written anew with
every batch: use these for keys with many rows, the processors for many keys with few.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidegauge.operators.scans import by_rows, scan
from tidegauge.streaming.run import Snapshots

_KINDS: dict[str, tuple[Callable, Callable[[Column, Column], Column]]] = {
    "sum": (F.sum, lambda a, b: F.coalesce(a + b, a, b)),
    "min": (F.min, lambda a, b: F.least(a, b)),
    "max": (F.max, lambda a, b: F.greatest(a, b)),
}


def _carried(rows: DataFrame, state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` with their key's state in columns with a leading ``__``; null keys have a state too."""
    renamed = state.select(*[F.col(c).alias(f"__{c}") for c in state.columns])
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    return rows.join(renamed, same, "left")


def _started(rows: DataFrame, folder: str, write: Callable[[DataFrame, int], None]) -> Callable[[], StreamingQuery]:
    return lambda: (
        rows.writeStream.foreachBatch(write).outputMode("append")
        .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    )


def running(
    rows: DataFrame, folder: str, keys: Sequence[str], order: str, measures: Mapping[str, tuple[str, str]],
    rows_per_segment: int | None = None,
) -> Callable[[], StreamingQuery]:
    """Write every row with running measures of its key, (sum, min or max, column) by name, to ``out``.

    ``order`` numbers the rows of all batches; a batch's rows come behind those of earlier ones.
    Repeated batches overwrite their own results and find the state they found before.
    """
    types = dict(rows.dtypes)
    schema = ", ".join([*(f"`{k}` {types[k]}" for k in keys), *(f"`{m}` {types[c]}" for m, (_, c) in measures.items())])
    state = Snapshots(f"{folder}/running", schema)

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            earlier = state.before(batch, batch_id)
            upto = {m: (kind, F.col(c)) for m, (kind, c) in measures.items()}
            found = _carried(scan(kept, keys, [order], by_rows(order, rows_per_segment), upto=upto), earlier, keys)
            total = {m: _KINDS[kind][1](F.col(m), F.col(f"__{m}")).alias(m) for m, (kind, _) in measures.items()}
            found.select(*batch.columns, *total.values()).write.mode("overwrite").parquet(f"{folder}/out/batch={batch_id}")
            fresh = kept.select(*keys, *[F.col(c).alias(m) for m, (_, c) in measures.items()])
            merged = earlier.unionByName(fresh).groupBy(*keys).agg(*[_KINDS[k][0](m).cast(types[c]).alias(m) for m, (k, c) in measures.items()])
            state.write(merged, batch_id)
        finally:
            kept.unpersist()

    return _started(rows, folder, write)


def count_windows(
    rows: DataFrame, folder: str, keys: Sequence[str], order: str, value: str, size: int, rows_per_segment: int | None = None
) -> Callable[[], StreamingQuery]:
    """Write every ``size`` rows of a key as one: window_no and their smallest value, to ``out``.

    Rows are numbered over all batches; of a window that is not full yet its smallest value is carried.
    """
    types = dict(rows.dtypes)
    state = Snapshots(f"{folder}/open", ", ".join([*(f"`{k}` {types[k]}" for k in keys), "total long", f"smallest {types[value]}"]))
    full = F.lit(size).cast("long")

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            earlier = state.before(batch, batch_id)
            one = F.lit(1).cast("long")
            numbered = scan(kept, keys, [order], by_rows(order, rows_per_segment), upto={"__nth": ("sum", one)})
            place = F.col("__nth") + F.coalesce("__total", F.lit(0)) - 1
            parts = _carried(numbered, earlier, keys).select(
                *keys, F.floor(place / full).alias("window_no"), F.col(value).alias("smallest"), one.alias("n")
            )
            begun = earlier.where(F.col("total") % full > 0).select(
                *keys, F.floor(F.col("total") / full).alias("window_no"), "smallest", (F.col("total") % full).alias("n")
            )
            found = parts.unionByName(begun).groupBy(*keys, "window_no").agg(F.min("smallest").alias("smallest"), F.sum("n").alias("n"))
            found.write.mode("overwrite").parquet(f"{folder}/parts/batch={batch_id}")
            found = batch.sparkSession.read.parquet(f"{folder}/parts/batch={batch_id}")
            found.where(F.col("n") == full).drop("n").write.mode("overwrite").parquet(f"{folder}/out/batch={batch_id}")
            open_now = found.where(F.col("n") < full).select(*keys, F.lit(0).cast("long").alias("total"), "smallest")
            totals = earlier.select(*keys, "total").unionByName(kept.select(*keys, one.alias("total")))
            merged = totals.withColumn("smallest", F.lit(None).cast(types[value])).unionByName(open_now)
            state.write(merged.groupBy(*keys).agg(F.sum("total").alias("total"), F.min("smallest").alias("smallest")), batch_id)
        finally:
            kept.unpersist()

    return _started(rows, folder, write)
