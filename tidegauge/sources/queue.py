"""Message-queue topics of UTF-8 text. Needs Spark's Kafka connector on the classpath to read."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def queue_options(
    servers: str, topic: str, group: str | None = None, offset_reset: str = "latest",
    discovery_ms: int | None = None, extra: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options for ``spark.readStream.format("kafka")``.

    ``offset_reset`` applies when a query starts without a checkpoint. ``discovery_ms`` bounds how
    long topic metadata may be stale, and with it how late new partitions are seen.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": offset_reset,
    }
    if group is not None:
        options["kafka.group.id"] = group
    if discovery_ms is not None:
        options["kafka.metadata.max.age.ms"] = str(discovery_ms)
    return {**options, **(extra or {})}


def decode_messages(messages: DataFrame) -> DataFrame:
    """The connector's ``key`` and ``value`` bytes as text; other columns stay."""
    return messages.withColumns({name: F.col(name).cast("string") for name in ("key", "value")})


def read_topic(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    return decode_messages(spark.readStream.format("kafka").options(**options).load())
