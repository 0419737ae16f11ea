"""Minimax contiguous partition of documents into shards of near equal bytes.

Equal texts are atomic: they have one hash, and hashes are put in order. The ordered groups are
gathered into at most 2^14 units of the hash range, each a whole number of groups (one group each on
small tables). A binary search finds the smallest capacity with which a greedy walk over the units
needs no more shards than wanted, and the walk with that capacity makes the cuts. All of it is column
expressions over one row that holds the units' running sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm.common import saved, text_or_empty

UNIT_BITS = 14  # bounds the units, and with them the one row and the broadcast, at any input size
ROWS_PER_SLOT_RUN = 4096


def measured(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, size, text_crc32, unit); a null text counts as an empty one."""
    text = text_or_empty()
    top = F.conv(F.substring(F.md5(text.cast("binary")), 1, 4), 16, 10).cast("int")
    return docs.select(
        F.col("doc_id").cast("long"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.shiftright(top, 16 - UNIT_BITS).alias("unit"),
    )


def partition_units(units: DataFrame, shards: int) -> DataFrame:
    """``units`` (unit, n, size) with ``shard`` and ``capacity``, the smallest feasible one."""
    order = Window.orderBy("unit")
    one = units.select("unit", "n", "size", F.sum("size").over(order).alias("upto")).agg(
        F.sort_array(F.collect_list(F.struct("unit", "n", "size", "upto"))).alias("units"),
        F.sort_array(F.collect_list("upto")).alias("ends"), F.max("size").alias("largest"), F.sum("size").alias("total"),
    ).where("total > 0")
    step = "coalesce(array_max(filter(ends, e -> e <= {base} + {capacity})), {base})"
    reach = f"aggregate(sequence(1, {shards}), 0L, (b, k) -> {step.format(base='b', capacity='((s.lo + s.hi) div 2)')})"
    search = f"""aggregate(sequence(1, 64), named_struct('lo', greatest(largest, total div {shards}), 'hi', total), (s, i) ->
        CASE WHEN s.lo >= s.hi THEN s
             WHEN {reach} >= total THEN named_struct('lo', s.lo, 'hi', (s.lo + s.hi) div 2)
             ELSE named_struct('lo', (s.lo + s.hi) div 2 + 1, 'hi', s.hi) END).hi"""
    # the capacity travels in the walk's state: as a column of its own it would be put into the lambda and searched for each unit
    last = step.format(base="element_at(w.cuts, -1)", capacity="w.capacity")
    walk = f"""aggregate(slice(sequence(1, {shards}), 2, {shards}), named_struct('cuts', array(0L), 'capacity', {search}),
        (w, k) -> named_struct('cuts', concat(w.cuts, array({last})), 'capacity', w.capacity))"""
    # the walk comes before the explode: behind it, it would be repeated for every unit
    cut = one.select("units", F.expr(walk).alias("walk")).select(F.explode("units").alias("u"), "walk")
    shard = F.size(F.filter("walk.cuts", lambda c: c <= F.col("u.upto") - F.col("u.size"))) - 1
    return cut.select("u.unit", "u.n", "u.size", F.least(shard, F.lit(shards - 1)).alias("shard"), "walk.capacity")


def unit_shards(rows: DataFrame, shards: int) -> DataFrame:
    """Rows (unit, n, shard); at most 2^14."""
    units = rows.groupBy("unit").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size"))
    return saved(partition_units(units, shards).select("unit", "n", "shard"), "shard-plan")


def assign(docs: DataFrame, shards: int = 8) -> DataFrame:
    """One row per document: doc_id, size (UTF-8 bytes + 1), text_crc32, shard, slot (gapless from 0 in a shard).

    Null texts are empty; equal texts share a shard; repeated rows get slots of their own; an empty
    table gives no rows. A unit of very many rows is numbered in salted runs, so a group of copies
    with a third of all rows is not sorted in one task.
    """
    rows = saved(measured(docs), "shard-rows")
    units = unit_shards(rows, shards)
    salts = 1 + F.floor(F.col("n") / ROWS_PER_SLOT_RUN)
    placed = rows.join(F.broadcast(units), "unit").withColumn(
        "run", F.pmod(F.xxhash64("doc_id", "size", "text_crc32"), salts)
    )
    runs = placed.groupBy("shard", "unit", "run").agg(F.count(F.lit(1)).alias("in_run"))
    before = F.sum("in_run").over(Window.partitionBy("shard").orderBy("unit", "run")) - F.col("in_run")
    runs = runs.select("unit", "run", before.alias("before"))
    place = F.row_number().over(Window.partitionBy("unit", "run").orderBy("doc_id", "size", "text_crc32")) - 1
    return placed.join(runs, ["unit", "run"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("before") + place).cast("long").alias("slot")
    )


def write_shards(docs: DataFrame, folder: str, shards: int = 8) -> None:
    """Write the documents themselves, one folder ``shard=i`` each; texts move once, spread by a salt."""
    units = unit_shards(saved(measured(docs), "shard-rows"), shards)
    top = F.conv(F.substring(F.md5(text_or_empty().cast("binary")), 1, 4), 16, 10).cast("int")
    placed = docs.withColumn("unit", F.shiftright(top, 16 - UNIT_BITS)).join(F.broadcast(units), "unit")
    placed.repartition("shard", F.pmod(F.xxhash64("text", "doc_id"), F.lit(16))).drop("unit", "n").write.partitionBy("shard").parquet(folder)
