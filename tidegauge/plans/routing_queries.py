"""Registered queries: words, projections, routing, sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


from tidegauge.operators import routing
from tidegauge.plans import analyses
from tidegauge.plans.registry import query
from tidegauge.plans.tables import EVENTS_SQL, events, fresh_folder, table
from tidegauge.sources import (
    decode_messages, delimited, inline_rows, key_value_lines, write_bucketed_parquet, write_delimited,
)
from tidegauge.sources.schemas import FEEDBACK, USER_BEHAVIOR

# --- words --------------------------------------------------------------------------------------


@query("wordcount_lower_w", """
    SELECT word, count(*) AS n FROM (SELECT unnest(regexp_split_to_array(lower(text), '\\W+')) AS word FROM documents)
    WHERE word <> '' GROUP BY 1""")
def wordcount_lower_w(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analyses.word_counts(table(spark, sf_dir, "documents"), "text")


@query("wordcount_ws", """
    SELECT word, count(*) AS n FROM (SELECT unnest(regexp_split_to_array(text, '[ \\t\\n\\x0B\\f\\r]')) AS word FROM documents)
    WHERE word <> '' GROUP BY 1""")
def wordcount_ws(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analyses.word_counts(table(spark, sf_dir, "documents"), "text", by_space=True)


WINDOWED_WORDS_SQL = """
    SELECT word, (ms // 3000 + 1) * 3000 AS window_end_ms, count(*) AS n FROM (
      SELECT 1704067200000 + doc_id * 1000 AS ms,
             unnest(regexp_split_to_array(text, '[ \\t\\n\\x0B\\f\\r]')) AS word FROM documents)
    WHERE word <> '' GROUP BY 1, 2"""


@query("windowed_words_bucketed", f"""
    SELECT *, strftime(make_timestamp((window_end_ms - 3000) * 1000), '%Y-%m-%d--%H') AS bucket FROM ({WINDOWED_WORDS_SQL})""")
def windowed_words_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts per word and 3 s window, written as Parquet by date-hour bucket and read back."""
    documents = table(spark, sf_dir, "documents").select(
        "text", F.timestamp_seconds(F.lit(1704067200) + F.col("doc_id")).alias("ts")
    )
    counts = analyses.windowed_word_counts(documents, "text", "ts")
    folder = fresh_folder(spark, "words")
    write_bucketed_parquet(
        counts.withColumn("start", F.timestamp_millis("window_start_ms")).drop("window_start_ms"), folder, "start", ranged=True
    )
    return spark.read.parquet(folder).select("word", "window_end_ms", "n", F.col("bucket").cast("string"))


# --- projection and routing ---------------------------------------------------------------------


@query("table_select_filter", f"SELECT user_id, cents FROM ({EVENTS_SQL}) WHERE event_type = 'click' AND cents > 1000")
def table_select_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).selectExpr("user_id", "cents", "event_type")
    return rows.where("event_type = 'click' AND cents > 1000").select("user_id", "cents")


@query("threshold_side", f"""
    SELECT event_id, 'main' AS output, NULL AS msg FROM ({EVENTS_SQL}) WHERE NOT cents > 10000
    UNION ALL
    SELECT event_id, 'side', 'id=' || user_id || ' is abnormal' FROM ({EVENTS_SQL}) WHERE cents > 10000""")
def threshold_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    main, side = routing.side_output(
        events(spark, sf_dir), F.col("cents") > 10000,
        F.col("event_id"), F.format_string("id=%d is abnormal", "user_id").alias("msg"),
    )
    return routing.co_map(
        main, [F.col("event_id"), F.lit("main").alias("output")],
        side, [F.col("event_id"), F.lit("side").alias("output"), F.col("msg")],
    )


def high_or_low(spark: SparkSession, sf_dir: str) -> DataFrame:
    high = F.col("cents") > 5000
    return routing.tag_rows(events(spark, sf_dir), F.when(high, "high"), F.when(~high, "low"))


@query("split_high_low", f"""
    SELECT output, count(*) AS n, CAST(sum(cents) AS BIGINT) AS cents FROM (
      SELECT CASE WHEN cents > 5000 THEN 'high' ELSE 'low' END AS output, cents FROM ({EVENTS_SQL})
      UNION ALL SELECT 'all', cents FROM ({EVENTS_SQL})) GROUP BY 1""")
def split_high_low(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = high_or_low(spark, sf_dir)
    parts = {"high": ["high"], "low": ["low"], "all": ["high", "low"]}
    outputs = [
        routing.select_tags(tagged, *wanted).select(F.lit(name).alias("output"), "cents") for name, wanted in parts.items()
    ]
    return routing.union_all(*outputs).groupBy("output").agg(
        F.count(F.lit(1)).alias("n"), F.sum("cents").alias("cents")
    )


@query("comap_union", f"""
    SELECT event_id, cents, 'high' AS tag FROM ({EVENTS_SQL}) WHERE cents > 5000
    UNION ALL SELECT event_id, NULL, 'low' FROM ({EVENTS_SQL}) WHERE NOT cents > 5000""")
def comap_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = high_or_low(spark, sf_dir)
    return routing.co_map(
        routing.select_tags(tagged, "high"), [F.col("event_id"), F.col("cents"), F.lit("high").alias("tag")],
        routing.select_tags(tagged, "low"), [F.col("event_id"), F.lit("low").alias("tag")],
    )


@query("union_all", """
    SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
      SELECT event_type AS word, 1 AS n FROM events
      UNION ALL SELECT lang, n_chars FROM documents
      UNION ALL SELECT role, 1 FROM conversations) GROUP BY 1""")
def union_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = F.lit(1).cast("long").alias("n")
    merged = routing.union_all(
        table(spark, sf_dir, "events").select(F.col("event_type").alias("word"), one),
        table(spark, sf_dir, "documents").select(F.col("lang").alias("word"), F.col("n_chars").alias("n")),
        table(spark, sf_dir, "conversations").select(F.col("role").alias("word"), one),
    )
    return merged.groupBy("word").agg(F.sum("n").alias("n"))


@query("repartition_identity", "SELECT event_id, user_id FROM events")
def repartition_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.redistribute(table(spark, sf_dir, "events").select("event_id", "user_id"), "user_id")


@query("shard_filter", f"""
    SELECT event_id, k, shard FROM (
      SELECT *, ('0x' || substr(md5(user_id::VARCHAR), 1, 8))::BIGINT % 2 AS shard FROM ({EVENTS_SQL}))
    WHERE shard = k % 2""")
def shard_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.shard_filter(events(spark, sf_dir), "user_id", "k", 2).select("event_id", "k", "shard")


# --- sources and sinks --------------------------------------------------------------------------

LABELS = [("view", "pv"), ("purchase", "buy"), ("click", "cart")]


@query("inline_rows", f"""
    SELECT behavior, count(*) AS n FROM ({EVENTS_SQL})
    JOIN (VALUES ('view', 'pv'), ('purchase', 'buy'), ('click', 'cart')) AS l(event_type, behavior) USING (event_type)
    GROUP BY 1""")
def inline_rows_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = inline_rows(spark, LABELS, "event_type string, behavior string")
    # three literal rows, so sending them to every task is safe at any table size
    return events(spark, sf_dir).join(labels, "event_type").groupBy("behavior").agg(
        F.count(F.lit(1)).alias("n")
    )


@query("queue_decode", f"SELECT user_id, ms, cents FROM ({EVENTS_SQL})")
def queue_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = events(spark, sf_dir).select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.concat_ws(",", F.col("ms").cast("string"), F.col("cents").cast("string")).cast("binary").alias("value"),
    )
    part = F.split("value", ",")
    return decode_messages(messages).select(
        F.col("key").cast("long").alias("user_id"),
        F.get(part, F.lit(0)).cast("long").alias("ms"), F.get(part, F.lit(1)).cast("long").alias("cents"),
    )


@query("csv_roundtrip", f"""
    SELECT user_id, event_id AS item_id, CAST(k AS INTEGER) AS category, event_type AS behavior, ms // 1000 AS ts
    FROM ({EVENTS_SQL})""")
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select("user_id", "event_id", "k", "event_type", F.expr("ms div 1000 AS ts"))
    folder = fresh_folder(spark, "csv")
    write_delimited(rows, folder)
    return delimited(spark.read, folder, USER_BEHAVIOR)[0]


@query("key_value_lines", f"SELECT user_id::VARCHAR AS id, ms // 1000 AS ts, CAST(k AS INTEGER) AS fre FROM ({EVENTS_SQL})")
def key_value_lines_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select("user_id", F.expr("ms div 1000 AS ts"), "k")
    folder = fresh_folder(spark, "lines")
    write_delimited(rows, folder, sep=" ")
    return key_value_lines(spark.read.text(folder), FEEDBACK)[0]


@query("key_value_rejects", f"""
    SELECT CASE WHEN event_id % 5 > 0 THEN user_id::VARCHAR END AS id, CASE WHEN event_id % 5 > 0 THEN ms // 1000 END AS ts,
           CASE WHEN event_id % 5 > 0 THEN CAST(k AS INTEGER) END AS fre,
           CASE WHEN event_id % 5 = 0 THEN user_id || ' ' || ms // 1000 || ' x' END AS rejected_line
    FROM ({EVENTS_SQL})""")
def key_value_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = F.when(F.col("event_id") % 5 == 0, F.lit("x")).otherwise(F.col("k").cast("string"))
    lines = events(spark, sf_dir).select(F.concat_ws(" ", F.col("user_id").cast("string"), F.expr("ms div 1000").cast("string"), last).alias("value"))
    records, rejected = key_value_lines(lines, FEEDBACK)
    return records.unionByName(rejected, allowMissingColumns=True)


@query("parquet_bucketed", f"""
    SELECT event_id, cents, strftime(ts, '%Y-%m-%d--%H') AS bucket FROM ({EVENTS_SQL})""")
def parquet_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_folder(spark, "buckets")
    write_bucketed_parquet(events(spark, sf_dir).select("event_id", "cents", "ts"), folder, "ts")
    return spark.read.parquet(folder).select("event_id", "cents", F.col("bucket").cast("string"))
