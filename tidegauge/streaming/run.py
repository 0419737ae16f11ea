"""Starting streams, ending them, and writing their results."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidegauge.sources.files import bucket_of

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
IS_END = "is_end"
END_OF_TIME = "2200-01-01 00:00:00"  # still fits the nanosecond timestamps of pandas


def file_stream(
    spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
    files_per_trigger: int | None = None, options: Mapping[str, str] | None = None,
) -> DataFrame:
    """New files of a folder as a stream; ``files_per_trigger`` bounds what one micro-batch holds."""
    reader = spark.readStream.format(fmt).schema(schema).options(**(options or {}))
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


@contextmanager
def state_settings(spark: SparkSession, partitions: int | None = None) -> Iterator[None]:
    """Session settings a stateful query takes over when it starts, restored afterwards.

    State lives in RocksDB. The number of state partitions is fixed for the life of a query, so it
    is chosen here: by default as many as the cluster has task slots.
    """
    wanted = {
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        "spark.sql.shuffle.partitions": str(partitions or spark.sparkContext.defaultParallelism),
        "spark.sql.streaming.numRecentProgressUpdates": "10000",  # drain looks through them for dropped rows
    }
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


class LateRows(RuntimeError):
    """The engine dropped rows behind the watermark that no output holds."""


def drain(start: Callable[[], StreamingQuery], late_rows_go: bool = False) -> None:
    """Run a query over everything that is available now.

    Fails if the engine dropped rows behind the watermark, unless the caller lets them go: a stream
    whose late rows matter keeps them with ``split_late`` first.
    """
    query = start()
    try:
        query.awaitTermination()
        dropped = sum(state.numRowsDroppedByWatermark for progress in query.recentProgress for state in progress.stateOperators)
    finally:
        query.stop()
    if dropped and not late_rows_go:
        raise LateRows(f"{dropped} rows came behind the watermark and were dropped")


def feed_disorder_ms(files: DataFrame, at: Column) -> int:
    """How far behind the latest time of earlier files a file's first time lies, at most, in ms.

    ``files`` is a batch read of the folder a stream will read and ``at`` the event time in ms. The file source delivers files by
    modification time; files of one modification time may come in any order. A stream with this
    much delay drops none of their rows, however few files a micro-batch holds.
    """
    per_time = files.groupBy(F.col("_metadata.file_modification_time").alias("moved")).agg(
        F.min(at).alias("low"), F.max(at).alias("high"), F.count_distinct("_metadata.file_path").alias("files")
    )
    earlier = F.max("high").over(Window.orderBy("moved").rowsBetween(Window.unboundedPreceding, -1))
    latest_before = F.greatest(F.coalesce(earlier, F.col("low")), F.when(F.col("files") > 1, F.col("high")))
    behind = per_time.select((latest_before - F.col("low")).alias("behind"))
    return max(0, behind.agg(F.max("behind")).first()[0] or 0)


def append_files(out: DataFrame, folder: str, fmt: str = "parquet", **options: str) -> Callable[[], StreamingQuery]:
    """Append results to files exactly once."""
    return lambda: (
        out.writeStream.format(fmt).outputMode("append").options(**options)
        .option("checkpointLocation", f"{folder}/checkpoint").option("path", f"{folder}/out")
        .trigger(availableNow=True).start()
    )


def rolling_text(out: DataFrame, folder: str, every: str = "20 seconds", records_per_file: int = 1_000_000) -> StreamingQuery:
    """Delimited text; a new set of files every ``every``, none larger than ``records_per_file``."""
    return (
        out.writeStream.format("csv").outputMode("append").option("maxRecordsPerFile", records_per_file)
        .option("checkpointLocation", f"{folder}/checkpoint").option("path", f"{folder}/out")
        .trigger(processingTime=every).start()
    )


def bucketed_parquet(out: DataFrame, folder: str, ts: str) -> Callable[[], StreamingQuery]:
    """Parquet by date-hour bucket, exactly once."""
    bucketed = out.withColumn("bucket", bucket_of(ts))
    return lambda: (
        bucketed.writeStream.format("parquet").outputMode("append").partitionBy("bucket")
        .option("checkpointLocation", f"{folder}/checkpoint").option("path", f"{folder}/out")
        .trigger(availableNow=True).start()
    )


def split_outputs(
    rows: DataFrame, folder: str, outputs: Mapping[str, Callable[[DataFrame], DataFrame]], mode: str = "append"
) -> Callable[[], StreamingQuery]:
    """Write several outputs of one stream to their own folders.

    Each batch overwrites its own sub-folder, so a repeated batch leaves one copy.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            for name, select in outputs.items():
                select(kept).write.mode("overwrite").parquet(f"{folder}/{name}/batch={batch_id}")
        finally:
            kept.unpersist()

    return lambda: (
        rows.writeStream.foreachBatch(write).outputMode(mode)
        .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    )


def split_late(rows: DataFrame, folder: str, ts: str, disorder_ms: int) -> Callable[[], StreamingQuery]:
    """Write every row to one of two outputs: ``kept``, or ``late`` if it is behind the watermark.

    The watermark of a batch is the latest time of all earlier batches, less the allowed disorder.
    Each batch records its latest time under its own id, so a repeated batch finds the watermark it
    had. A stream over ``kept`` with the same disorder as delay has no late rows.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, at = batch.sparkSession, F.unix_millis(F.col(ts).cast("timestamp"))
        spark.createDataFrame([], "high long").write.mode("overwrite").parquet(f"{folder}/seen/batch=-1")
        seen = spark.read.schema("high long, batch long").parquet(f"{folder}/seen").where(F.col("batch") < batch_id)
        high = seen.agg(F.max("high")).first()[0]
        late = F.lit(False) if high is None else F.coalesce(at < high - disorder_ms, F.lit(False))
        kept = batch.persist()
        try:
            for name, chosen in (("kept", ~late), ("late", late)):
                kept.where(chosen).write.mode("overwrite").parquet(f"{folder}/{name}/batch={batch_id}")
            kept.agg(F.max(at).alias("high")).write.mode("overwrite").parquet(f"{folder}/seen/batch={batch_id}")
        finally:
            kept.unpersist()

    return lambda: (
        rows.writeStream.foreachBatch(write).outputMode("append")
        .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    )


def updates(out: DataFrame, folder: str) -> Callable[[], StreamingQuery]:
    """Write the changed results of every batch; ``latest`` picks the valid ones."""
    return split_outputs(out, folder, {"out": lambda batch: batch}, mode="update")


def latest(changes: DataFrame, *keys: str) -> DataFrame:
    """The last written row per key."""
    fields = [c for c in changes.columns if c not in (*keys, "batch")]
    return changes.groupBy(*keys).agg(F.max_by(F.struct(*fields), "batch").alias("row")).select(*keys, "row.*")


class Snapshots:
    """State of a ``foreachBatch`` writer: a table that every batch reads from the batch before and writes anew.

    What a batch reads is what its predecessor held open, however many batches there were. A batch
    overwrites its own snapshot, so a repeated one finds what it found the first time. Batch numbers have no gaps.
    """

    def __init__(self, folder: str, schema: str):
        self.folder, self.schema = folder, schema

    def before(self, batch: DataFrame, batch_id: int) -> DataFrame:
        spark = batch.sparkSession
        if batch_id == 0:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(f"{self.folder}/batch={batch_id - 1}")

    def write(self, state: DataFrame, batch_id: int) -> DataFrame:
        """Write the state behind a batch, and read it back."""
        path = f"{self.folder}/batch={batch_id}"
        state.write.mode("overwrite").parquet(path)
        return state.sparkSession.read.schema(self.schema).parquet(path)


def still_open(state: DataFrame, window_end_ms: str, open_ms: int) -> DataFrame:
    """The rows of windows that may still change: those that end less than ``open_ms``, a window's size and the
    watermark's delay, before the latest end. No more than that many ms of windows are ever open."""
    latest_end = state.agg(F.max(window_end_ms).alias("__latest"))
    return state.join(F.broadcast(latest_end), F.col(window_end_ms) > F.col("__latest") - F.lit(open_ms)).drop("__latest")


class EndOfInput:
    """Lets a stream over a finite input release what still waits for its watermark.

    Results wait until event time passes them, which the last rows of a finite input never see.
    The marker source is empty while the input is read. ``close`` writes one row far in the future
    to it, and running the query again from its checkpoint moves the watermark past everything. The
    column ``is_end`` tells the marker from genuine rows.
    """

    def __init__(self, spark: SparkSession, folder: str, schema: StructType, ts: str = "ts"):
        self.spark, self.folder, self.schema, self.ts = spark, f"{folder}/marker", schema, ts
        spark.createDataFrame([], schema).write.parquet(self.folder)

    def follow(self, rows: DataFrame) -> DataFrame:
        marker = self.spark.readStream.schema(self.schema).parquet(self.folder)
        return rows.withColumn(IS_END, F.lit(False)).unionByName(marker.withColumn(IS_END, F.lit(True)))

    def close(self) -> None:
        cells = [
            F.lit(END_OF_TIME if field.name == self.ts else None).cast(field.dataType).alias(field.name)
            for field in self.schema
        ]
        self.spark.range(1).select(*cells).write.mode("append").parquet(self.folder)


def run_with_end(start: Callable[[], StreamingQuery], *ends: EndOfInput) -> None:
    """Drain the input, mark its end, and drain what that releases."""
    drain(start)
    for end in ends:
        end.close()
    drain(start)
