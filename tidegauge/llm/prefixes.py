"""Conversation prefix trie by truncation peeling.

A node is a distinct sequence of first turns, and is known by the hashes of its prefixes. From the
deepest level upwards the conversations that end at a level meet the nodes that survive from below;
equal ones are merged, which gives the level's nodes with all their sums, and every node then loses
its last turn and joins the next round. No prefix is listed before its own round, and no conversation
is expanded into its prefixes.

Levels up to ``SHALLOW`` are one aggregation each. The few conversations that go deeper are peeled in
blocks of levels that double in height: all rows under one prefix of the block's lowest level go to
one task, which peels the block's levels at once. Prefixes with more than ``TURNS_AT_ONCE`` turns in a
block are merged level by level there too, so no task holds more.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import saved

SHALLOW = 8
TURNS_AT_ONCE = 200_000
IDS_PER_CHUNK = 4096
_HASH, _ENTRY = 16, 20  # a chain has for every turn the hash of the prefix that it ends and the turn's length
_SUMS = ["conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
_NODE = "id binary, parent binary, depth int, conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"


def rebuilt(conversations: DataFrame, head_turns: Column | None = None, per_base: int = 100) -> DataFrame:
    """Rows (conv_id, turns): every conversation with the first turns of its base instead of its own.

    ``turns`` are 20 bytes each, a hash of role and text and the text's length. The base of c is
    c - c % per_base, with the sign of c kept by %; ``head_turns`` says how many turns come from it,
    by default crc32 of the decimal id modulo 6. Turns are ordered by ``turn``, null first, and by
    that hash where turns share a number; equal rows are turns of their own. Rows with a null
    conv_id take no part. One conversation's turns, without their texts, are one row.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    told = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    length = F.lpad(F.hex(F.length(text)), 8, "0")
    turn = F.unhex(F.concat(F.substring(told, 1, 2 * _HASH), length))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.struct(F.col("turn").cast("long").alias("at"), turn.alias("turn")).alias("t")
    )
    own = saved(rows.groupBy("conv_id").agg(F.transform(F.sort_array(F.collect_list("t")), lambda t: t.turn).alias("own")), "prefix-own")
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6 if head_turns is None else head_turns
    base = F.col("conv_id") - F.col("conv_id") % per_base
    wanted = own.withColumns({"h": F.when(base != F.col("conv_id"), h).otherwise(0).cast("int"), "base": base})
    heads = own.where(F.col("conv_id") % per_base == 0).select(F.col("conv_id").alias("base"), F.col("own").alias("head"))
    joined = wanted.join(heads, "base", "left")
    nothing = F.array().cast("array<binary>")
    head = F.slice(F.coalesce("head", nothing), F.lit(1), F.col("h"))
    return joined.select("conv_id", F.concat(head, F.slice("own", F.col("h") + 1, F.size("own"))).alias("turns"))


def _chained(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, chain): each turn's hash replaced by that of the prefix up to it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            chains = []
            for turns in batch["turns"]:
                chain, before = bytearray(), b""
                for turn in turns:
                    before = hashlib.sha256(before + turn).digest()[:_HASH]
                    chain += before + turn[_HASH:]
                chains.append(bytes(chain))
            yield pd.DataFrame({"conv_id": batch["conv_id"], "chain": chains})

    return conversations.mapInPandas(run, "conv_id long, chain binary")


def _depth(chain: Column) -> Column:
    return (F.length(chain) / _ENTRY).cast("int")


def _id_at(chain: Column, depth: Column) -> Column:
    """Hash of the prefix of ``depth`` turns; empty for the root."""
    return F.when(depth < 1, F.lit(b"")).otherwise(F.substring(chain, (depth - 1) * _ENTRY + 1, F.lit(_HASH)))


def _hashed_ends(chains: DataFrame) -> DataFrame:
    """Rows (id, ends_sha256): for every node where conversations end, the hash of their sorted ids.

    The ids are joined in runs of ``IDS_PER_CHUNK`` by all tasks, whatever node they belong to; only
    the runs of one node meet, in order, and pass through one hash without being held.
    """

    def runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        node, ids, out = None, [], []

        def close():
            if ids:
                out.append((node, ids[0], ",".join(map(str, ids))))
            ids.clear()

        for batch in batches:
            for key, conv in zip(batch["id"], batch["conv_id"], strict=True):
                if key != node or len(ids) == IDS_PER_CHUNK:
                    close()
                    node = key
                ids.append(conv)
            if len(out) > 1000:
                yield pd.DataFrame(out, columns=["id", "first", "ids"])
                out.clear()
        close()
        yield pd.DataFrame(out, columns=["id", "first", "ids"])

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        node, state, out = None, None, []
        for batch in batches:
            for key, ids in zip(batch["id"], batch["ids"], strict=True):
                if key == node:
                    state.update(b"," + ids.encode())
                    continue
                if state is not None:
                    out.append((node, state.hexdigest()))
                node, state = key, hashlib.sha256(ids.encode())
            yield pd.DataFrame(out, columns=["id", "ends_sha256"])
            out = []
        if state is not None:
            yield pd.DataFrame([(node, state.hexdigest())], columns=["id", "ends_sha256"])

    ended = chains.select(_id_at(F.col("chain"), _depth(F.col("chain"))).alias("id"), "conv_id")
    joined = ended.repartitionByRange("id", "conv_id").sortWithinPartitions("id", "conv_id").mapInPandas(runs, "id binary, first long, ids string")
    return saved(joined.repartition("id").sortWithinPartitions("id", "first").mapInPandas(digests, "id binary, ends_sha256 string"), "prefix-ends")


def _stripped(nodes: DataFrame) -> DataFrame:
    """What nodes bring to their parents: rows like those of conversations that end, one turn shorter."""
    return nodes.select(
        F.expr(f"substring(chain, 1, length(chain) - {_ENTRY})").alias("chain"), "conv_id", "n_convs",
        F.lit(1).cast("long").alias("n_children"), "n_leaves", "saved_tokens",
    )


def _level(rows: DataFrame) -> DataFrame:
    """Nodes of one level: rows with equal chains merged. Map tasks merge what they hold first."""
    merged = rows.groupBy("chain").agg(F.min("conv_id").alias("conv_id"), *(F.sum(c).alias(c) for c in _SUMS[1:]))
    length = F.coalesce(F.conv(F.hex(F.substring("chain", -4, 4)), 16, 10).cast("long"), F.lit(0).cast("long"))
    return merged.withColumns({
        "n_leaves": F.when(F.col("n_children") == 0, 1).otherwise(F.col("n_leaves")).cast("long"),
        "saved_tokens": F.col("saved_tokens") + (F.col("n_convs") - 1) * length,
    })


def _described(nodes: DataFrame) -> DataFrame:
    """Nodes without their chain: id, the parent's id (null above the root) and the sums."""
    chain, depth = F.col("chain"), _depth(F.col("chain"))
    parent = F.when(depth > 0, _id_at(chain, depth - 1))
    return nodes.select(_id_at(chain, depth).alias("id"), parent.alias("parent"), depth.alias("depth"), *_SUMS)


def _peeled(rows: DataFrame, low: int) -> DataFrame:
    """All nodes deeper than ``low`` of rows that are at least as deep; ``chain`` only for the lowest level.

    ``rows`` come sorted by their prefix of ``low`` + 1 turns, and a prefix's rows in one task.
    """
    key_end = low * _ENTRY + _HASH

    def nodes_of(group: list[tuple]) -> Iterator[tuple]:
        levels: dict[int, dict[bytes, list]] = {}

        def add(depth: int, chain: bytes, conv, convs, children, leaves, spared):
            level = levels.setdefault(depth, {})
            node = level.get(key := chain[(depth - 1) * _ENTRY:(depth - 1) * _ENTRY + _HASH])
            if node is None:
                level[key] = [chain, conv, convs, children, leaves, spared]
            else:
                node[1] = min(node[1], conv)
                for i, more in enumerate((convs, children, leaves, spared), 2):
                    node[i] += more

        for row in group:
            add(len(row[0]) // _ENTRY, *row)
        for depth in range(max(levels), low, -1):
            for key, (chain, conv, convs, children, leaves, spared) in levels.pop(depth, {}).items():
                end = depth * _ENTRY
                spared += (convs - 1) * int.from_bytes(chain[end - 4:end], "big")
                leaves = leaves if children else 1
                parent = chain[end - 2 * _ENTRY:end - 2 * _ENTRY + _HASH] if depth > 1 else b""
                last = depth == low + 1
                yield key, parent, depth, conv, convs, children, leaves, spared, chain[:end] if last else None
                if not last:
                    add(depth - 1, chain, conv, convs, 1, leaves, spared)

    columns = ["id", "parent", "depth", *_SUMS, "chain"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group, key, out = [], None, []
        for batch in batches:
            for row in batch[["chain", *_SUMS]].itertuples(index=False, name=None):
                if row[0][:key_end] != key and group:
                    out += nodes_of(group)
                    group = []
                key = row[0][:key_end]
                group.append(row)
            if len(out) > 10_000:
                yield pd.DataFrame(out, columns=columns)
                out = []
        if group:
            out += nodes_of(group)
        if out:
            yield pd.DataFrame(out, columns=columns)

    return rows.mapInPandas(run, _NODE + ", chain binary")


def trie(turns: DataFrame, shallow: int = SHALLOW, turns_at_once: int = TURNS_AT_ONCE) -> DataFrame:
    """One row per distinct prefix of the conversations ``turns`` (conv_id, turns as in ``rebuilt``).

    Columns: conv_id (smallest member), depth, parent_conv_id (null for the root), n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256. Conversations without turns are members of the root alone. No
    conversation, no node. A conv_id should occur once.
    """
    chains = saved(_chained(turns), "prefix-chains")
    ends = _hashed_ends(chains)
    zero = [F.lit(0).cast("long").alias(c) for c in _SUMS[2:]]
    ended = saved(chains.groupBy("chain").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).select(
        "chain", "conv_id", "n_convs", *zero, _depth(F.col("chain")).alias("depth")
    ), "prefix-ended")
    deepest = ended.agg(F.max("depth")).first()[0]
    found: list[DataFrame] = []
    alive: DataFrame | None = None  # nodes one level below the next round

    def arriving(low: int, high: int) -> DataFrame:
        """Rows of the levels above ``low`` up to ``high``: conversations that end there, and surviving nodes."""
        new = ended.where((F.col("depth") > low) & (F.col("depth") <= high)).drop("depth")
        return new if alive is None else new.unionAll(_stripped(alive))

    def by_level(rows: DataFrame, low: int, high: int) -> DataFrame:
        """The nodes of level ``low`` + 1, after one round per level from ``high`` down."""
        below = None
        for level in range(high, low, -1):
            here = rows.where(F.length("chain") == level * _ENTRY)
            below = saved(_level(here if below is None else here.unionAll(_stripped(below))), "prefix-level")
            found.append(_described(below))
        return below

    high = shallow
    while deepest is not None and high < deepest:
        high *= 2
    while deepest is not None and high > shallow:
        low = high // 2
        rows = saved(arriving(low, high).withColumn("key", _id_at(F.col("chain"), F.lit(low + 1))), "prefix-block")
        sizes = rows.groupBy("key").agg(F.sum(_depth(F.col("chain")) - low).alias("n"))
        large = saved(sizes.where(F.col("n") > turns_at_once).select("key"), "prefix-large")
        small = rows.join(large, "key", "left_anti")
        nodes = saved(_peeled(small.repartition("key").sortWithinPartitions("key"), low), "prefix-nodes")
        found.append(nodes.drop("chain"))
        alive = nodes.where(F.col("depth") == low + 1).select("chain", *_SUMS)
        if not large.isEmpty():
            hot = saved(rows.join(large, "key", "left_semi").select("chain", *_SUMS), "prefix-hot")
            alive = alive.unionAll(by_level(hot, low, high).select("chain", *_SUMS))
        high = low
    for level in range(min(shallow, deepest), -1, -1) if deepest is not None else []:
        alive = saved(_level(arriving(level - 1, level)), "prefix-level")
        found.append(_described(alive))

    nodes = chains.sparkSession.createDataFrame([], _NODE)
    for part in found:
        nodes = nodes.unionAll(part)
    parents = nodes.select(F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    none = hashlib.sha256(b"").hexdigest()
    return nodes.join(parents, "parent", "left").join(ends, "id", "left").select(
        "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves",
        "saved_tokens", F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"),
    )
