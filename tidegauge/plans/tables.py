"""The given tables in the roles the analyses need."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.functions.times import epoch_ms
from tidegauge.session import pin_utc, shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    pin_utc(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def typed_events(raw: DataFrame) -> DataFrame:
    """Events with an instant ``ts``, its epoch ms, the value in cents and the item number ``k``."""
    return raw.withColumn("ts", F.col("ts").cast("timestamp")).withColumns({
        "ms": epoch_ms("ts"),
        "cents": F.round(F.col("value") * 100).cast("long"),
        "k": F.get_json_object("props", "$.k").cast("long"),
    })


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed_events(table(spark, sf_dir, "events"))


def station_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in a disturbed order of arrival: ``seq``, ties by ``event_id``."""
    return events(spark, sf_dir).withColumn(
        "seq", F.col("event_id") + F.pmod(F.col("event_id") * 7919, F.lit(31))
    )


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new folder for one run, where every executor can reach it."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


# The same roles in SQL, for the oracles.
EVENTS_SQL = """
  SELECT event_id, ts, epoch_us(ts) // 1000 AS ms, user_id, event_type, value,
         CAST(round(value * 100) AS BIGINT) AS cents,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
  FROM events
"""

STATION_SQL = f"""
  SELECT *, event_id + (event_id * 7919) % 31 AS seq FROM ({EVENTS_SQL})
"""
