"""What several operators of this subpackage share."""

from __future__ import annotations

import re
import uuid
import zlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.session import shared_folder

WORD = r"[^\x20\x09-\x0D]+"  # a word: anything but a space and the five ASCII white-space controls
WORDS = re.compile(WORD)


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the folder all executors share, and read back.

    It cuts the lineage, so a lost executor repeats a read and not the work before it, and Catalyst
    knows the real size of what it joins.
    """
    path = f"{shared_folder(df.sparkSession)}/llm/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_NULL_ID = -(1 << 63)


def whole_id(column: str = "doc_id") -> Column:
    """The id as a long without nulls, which pandas would turn into floats; null is the smallest long."""
    return F.coalesce(F.col(column).cast("long"), F.lit(_NULL_ID))


def id_again(column: str = "doc_id") -> Column:
    """The id that ``whole_id`` was made of."""
    return F.nullif(F.col(column), F.lit(_NULL_ID))


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def word_count(text: Column) -> Column:
    """Number of words; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def held_out(doc_id: Column) -> Column:
    """The fold that no label is learned from: crc32 of the id as text, mod 5, is 0."""
    return F.coalesce(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0, F.lit(False))


def crc(data: bytes) -> int:
    return zlib.crc32(data) & 0xFFFFFFFF


def connected_components(links: DataFrame, name: str, most_rounds: int = 100) -> DataFrame:
    """Smallest id reachable from every id: rows (node, component) for the ids in ``links``.

    ``links`` has two long columns a, b. Alternates the large-star and small-star steps, which end
    after about the squared logarithm of the longest path. A step is one minimum per node, with
    partial sums in the map tasks, and one equi-join, which adaptive execution splits where a node
    has very many links; no node's links are ever gathered. Rows with a null end or equal ends link
    nothing. An empty input gives no rows.
    """
    edges = saved(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), name
    )

    def star(pairs: DataFrame, large: bool) -> DataFrame:
        both = pairs.unionAll(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else pairs
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(
            F.col("u").alias("key"), F.least("m", "u").alias("m")
        )
        joined = both.join(least, both.u == least.key).select("u", "v", "m")
        if large:
            moved = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(
                least.select(F.col("key").alias("u"), F.col("m").alias("v"))
            )
        return moved.where("u != v").distinct()

    before = None
    for _ in range(most_rounds):
        edges = saved(star(star(edges, large=True), large=False), name)
        # the star graph is a fixed point; count, sum of ids and a hash tell it from the one before
        state = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots)


def ranked(rows: DataFrame, key: str, order: list[str], name: str, rows_per_run: int = 4096) -> DataFrame:
    """``rows`` with ``rank``, gapless from 0 within each ``key``, in an order fixed by the columns ``order``.

    A key's rows are numbered in runs of a hash and the runs' sizes are summed up, so no key is
    sorted in one task. ``rows`` should be a written table, as it is read twice; rows equal in all of
    ``order`` share a run.
    """
    sizes = saved(rows.groupBy(key).agg(F.count(F.lit(1)).alias("__n")), name)
    placed = rows.join(sizes, key).withColumn(
        "__run", F.pmod(F.xxhash64(*order), 1 + F.floor(F.col("__n") / rows_per_run))
    ).drop("__n")
    runs = placed.groupBy(key, "__run").agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.partitionBy(key).orderBy("__run")) - F.col("__n")
    runs = runs.select(key, "__run", before.alias("__before"))
    place = F.row_number().over(Window.partitionBy(key, "__run").orderBy(*order)) - 1
    return placed.join(runs, [key, "__run"]).withColumn("rank", (F.col("__before") + place).cast("long")).drop("__run", "__before")
