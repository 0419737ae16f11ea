"""Approximate nearest neighbours: a hierarchical navigable small-world graph per shard.

A shard holds a bounded number of distinct vectors, drawn by a hash. Its graph is one row of flat
arrays: members of each layer and a fixed number of neighbours for each. Layers hold geometrically
fewer nodes, drawn at random. A node's neighbours on a layer are chosen from its nearest there and
from its nearest among the sparser layers' members, which give the long links; of these, a candidate
that is nearer to a chosen neighbour than to the node is passed over while there are others. Searches
walk down the layers and then keep a beam on the lowest one, all queries of a block in step. Every
shard answers every query and the answers are merged.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm.common import saved
from tidegauge.llm.vectors import matrix, unit, usable, with_class, with_width

ROWS_PER_SHARD = 8192
QUERIES_PER_BLOCK = 2048
LINKS = 16  # neighbours of a node on an upper layer; twice as many on the lowest
POOL, FAR = 48, 12  # candidates from the layer, and from each of the two sparser ones
BEAM = 128
SEED = 17
_BLOCK = 256


@dataclass
class Graph:
    """``layers[i]``: members (ascending) and their neighbours as positions in ``vectors``, -1 where there is none."""

    vectors: np.ndarray
    layers: list[tuple[np.ndarray, np.ndarray]]


def _choose(vectors: np.ndarray, nodes: np.ndarray, candidates: np.ndarray, near: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` of each node's candidates (sorted, nearest first), diverse ones before others."""
    count = candidates.shape[1]
    spots = vectors[np.maximum(candidates, 0)]
    between = np.einsum("bcd,bed->bce", spots, spots, optimize=True)
    taken = np.zeros(candidates.shape, dtype=bool)
    for j in range(count):
        shadowed = (taken[:, :j] & (between[:, j, :j] > near[:, j, None])).any(axis=1)
        taken[:, j] = (candidates[:, j] >= 0) & ~shadowed & (taken[:, :j].sum(axis=1) < most)
    order = np.argsort(np.where(taken, 0, np.where(candidates >= 0, 1, 2)), axis=1, kind="stable")[:, :most]
    return np.take_along_axis(candidates, order, axis=1)


def _layer(vectors: np.ndarray, members: np.ndarray, sparser: list[np.ndarray], most: int) -> np.ndarray:
    """Neighbours of ``members`` among themselves, linked both ways, at most ``most`` each."""
    n, half = len(members), max(1, most // 2)
    sources, targets, nearness = [], [], []
    pools = [(members, POOL)] + [(s, FAR) for s in sparser if len(s)]
    for low in range(0, n, _BLOCK):
        nodes = members[low:low + _BLOCK]
        found, close = [], []
        for pool, size in pools:
            sims = vectors[nodes] @ vectors[pool].T
            sims[nodes[:, None] == pool[None, :]] = -np.inf
            k = min(size, len(pool))
            best = np.argpartition(-sims, k - 1, axis=1)[:, :k]
            found.append(pool[best])
            close.append(np.take_along_axis(sims, best, axis=1))
        candidates, near = np.concatenate(found, axis=1), np.concatenate(close, axis=1)
        # one of each candidate: equal ones stand together once sorted by position
        order = np.argsort(candidates, axis=1, kind="stable")
        candidates, near = np.take_along_axis(candidates, order, axis=1), np.take_along_axis(near, order, axis=1)
        again = np.zeros(candidates.shape, dtype=bool)
        again[:, 1:] = candidates[:, 1:] == candidates[:, :-1]
        near = np.where(again, -np.inf, near)
        order = np.argsort(-near, axis=1, kind="stable")
        candidates, near = np.take_along_axis(candidates, order, axis=1), np.take_along_axis(near, order, axis=1)
        candidates = np.where(np.isneginf(near), -1, candidates)
        chosen = _choose(vectors, nodes, candidates, near, half)
        rows, columns = np.nonzero(chosen >= 0)
        sources.append(nodes[rows])
        targets.append(chosen[rows, columns])
    a = np.concatenate(sources) if sources else np.zeros(0, dtype=np.int64)
    b = np.concatenate(targets) if targets else np.zeros(0, dtype=np.int64)
    nearness = np.einsum("ij,ij->i", vectors[a], vectors[b]) if len(a) else np.zeros(0)
    # own choices first, then links that others made, nearest first
    source, target = np.concatenate([a, b]), np.concatenate([b, a])
    back, close = np.repeat([0, 1], len(a)), np.concatenate([nearness, nearness])
    _, first = np.unique(np.stack([source, target]), axis=1, return_index=True)
    order = first[np.lexsort((-close[first], back[first], source[first]))]
    source, target = source[order], target[order]
    row = np.searchsorted(members, source)
    place = np.arange(len(row)) - np.searchsorted(row, row, side="left")
    out = np.full((n, most), -1, dtype=np.int32)
    fits = place < most
    out[row[fits], place[fits]] = target[fits]
    return out


def build(vectors: np.ndarray, seed: int = SEED) -> Graph:
    """The graph over the rows of ``vectors``, which must be distinct; lengths do not matter."""
    near = unit(vectors).astype(np.float32)
    draw = np.random.default_rng(seed).random(len(near))
    level = np.floor(-np.log(1 - draw) / np.log(LINKS)).astype(int)
    members = [np.flatnonzero(level >= i) for i in range(level.max() + 1)] if len(near) else []
    layers = [
        (own, _layer(near, own, members[i + 1:i + 3], 2 * LINKS if i == 0 else LINKS)) for i, own in enumerate(members)
    ]
    return Graph(vectors, layers)


def _beam(near: np.ndarray, layer: tuple[np.ndarray, np.ndarray], queries: np.ndarray, entries: np.ndarray, width: int):
    """The ``width`` nearest found on a layer for each query, from its entries; all queries in step."""
    members, links = layer
    at = np.full(len(near), -1)
    at[members] = np.arange(len(members))
    n = len(queries)
    visited = np.zeros((n, len(near) + 1), dtype=bool)  # the last column stands for "no neighbour"
    visited[:, -1] = True
    rows = np.arange(n)[:, None]
    visited[rows, entries] = True
    ids = np.full((n, width), -1)
    sims = np.full((n, width), -np.inf, dtype=np.float32)
    open_ = np.zeros((n, width), dtype=bool)
    k = min(width, entries.shape[1])
    ids[:, :k] = entries[:, :k]
    sims[:, :k] = np.where(entries[:, :k] >= 0, np.einsum("qkd,qd->qk", near[entries[:, :k]], queries), -np.inf)
    open_[:, :k] = entries[:, :k] >= 0
    while True:
        live = np.flatnonzero(open_.any(axis=1))
        if not len(live):
            return ids, sims
        best = np.where(open_[live], sims[live], -np.inf).argmax(axis=1)
        open_[live, best] = False
        around = links[at[ids[live, best]]]
        fresh = ~visited[live[:, None], around]
        visited[live[:, None], around] = True
        close = np.where(fresh, np.einsum("qkd,qd->qk", near[around], queries[live]), -np.inf)
        all_ids = np.concatenate([ids[live], around], axis=1)
        all_sims = np.concatenate([sims[live], close], axis=1)
        all_open = np.concatenate([open_[live], fresh], axis=1)
        keep = np.argpartition(-all_sims, width - 1, axis=1)[:, :width]
        ids[live], sims[live] = np.take_along_axis(all_ids, keep, axis=1), np.take_along_axis(all_sims, keep, axis=1)
        open_[live] = np.take_along_axis(all_open, keep, axis=1)


def search(graph: Graph, queries: np.ndarray, k: int, width: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
    """Positions (-1 where there are fewer) and exact cosines of about the ``k`` nearest vectors of each query."""
    near, target = unit(graph.vectors).astype(np.float32), unit(queries).astype(np.float32)
    width = max(width, 2 * k)
    entries = np.repeat(graph.layers[-1][0][None, :8], len(queries), axis=0)
    for layer in reversed(graph.layers[1:]):
        ids, sims = _beam(near, layer, target, entries, 8)
        entries = np.where(np.isneginf(sims), -1, ids)  # none twice, or it would be found twice below
    ids, sims = _beam(near, graph.layers[0], target, entries, width)
    # a few more than k, so that rounding in the walk does not decide; then exact and sorted
    order = np.argsort(-sims, axis=1, kind="stable")[:, :k + 16]
    ids = np.where(np.isneginf(np.take_along_axis(sims, order, axis=1)), -1, np.take_along_axis(ids, order, axis=1))
    exact = np.where(ids >= 0, cosines(queries, graph.vectors[np.maximum(ids, 0)]), -np.inf)
    order = np.argsort(-exact, axis=1, kind="stable")[:, :k]
    return np.take_along_axis(ids, order, axis=1), np.take_along_axis(exact, order, axis=1)


def cosines(queries: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Cosine of each query with its row of others, in double precision on the vectors as they are."""
    a, b = queries / np.abs(queries).max(axis=1, keepdims=True), others / np.abs(others).max(axis=2, keepdims=True)
    dots = np.einsum("qkd,qd->qk", b, a)
    return dots / (np.sqrt(np.einsum("qd,qd->q", a, a))[:, None] * np.sqrt(np.einsum("qkd,qkd->qk", b, b)))


_INDEX = "shard int, ids binary, vectors binary, width int, members array<binary>, links array<binary>"


def index(classes: DataFrame) -> DataFrame:
    """One row per shard, written to the shared folder: ids, vectors, and each layer's flat arrays.

    ``classes`` has rep, embedding, width and shards, how many its width is dealt out to. Every row is
    indexed; a shard holds vectors of one width.
    """

    def make(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("rep")
        vectors = matrix(group["embedding"])
        graph = build(vectors)
        return pd.DataFrame([{
            "shard": group["shard"].iloc[0], "ids": group["rep"].to_numpy(np.int64).tobytes(), "vectors": vectors.tobytes(),
            "width": vectors.shape[1], "members": [m.astype(np.int32).tobytes() for m, _ in graph.layers],
            "links": [x.tobytes() for _, x in graph.layers],
        }])

    shard = F.pmod(F.xxhash64("rep", F.lit(SEED)), F.col("shards")).cast("int").alias("shard")
    return saved(classes.select("width", shard, "rep", "embedding").groupBy("width", "shard").applyInPandas(make, _INDEX), "neighbours-index")


def _graph(row) -> tuple[np.ndarray, Graph]:
    vectors = np.frombuffer(row.vectors, dtype=np.float64).reshape(-1, row.width)
    members = [np.frombuffer(m, dtype=np.int32).astype(np.int64) for m in row.members]
    links = [np.frombuffer(x, dtype=np.int32).reshape(len(m), -1) for m, x in zip(members, row.links, strict=True)]
    return np.frombuffer(row.ids, dtype=np.int64), Graph(vectors, list(zip(members, links, strict=True)))


def class_neighbours(graphs: DataFrame, queries: DataFrame, k: int, width: int = BEAM) -> DataFrame:
    """Rows (query, rep, score): for each query (query, embedding, width, shards) the ``k`` nearest of every shard of its width.

    Queries are dealt out in blocks, and a task holds one shard's graph and one block.
    """
    blocks = max(1, -(-queries.count() // QUERIES_PER_BLOCK))
    block = F.pmod(F.xxhash64("query"), F.lit(blocks)).cast("int")
    right = queries.withColumn("block", block).withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
    left = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def find(shard: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(shard) and len(asked):
            ids, graph = _graph(shard.iloc[0])
            for low in range(0, len(asked), _BLOCK):
                some = asked.iloc[low:low + _BLOCK]
                found, score = search(graph, matrix(some["embedding"]), k, width)
                row, column = np.nonzero(found >= 0)
                out.append(pd.DataFrame({"query": some["query"].to_numpy()[row], "rep": ids[found[row, column]], "score": score[row, column]}))
        return pd.concat(out) if out else pd.DataFrame({"query": [], "rep": [], "score": []}).astype({"query": "int64", "rep": "int64"})

    return left.groupBy("width", "shard", "block").cogroup(right.groupBy("width", "shard", "block")).applyInPandas(find, "query long, rep long, score double")


def nearest(embeddings: DataFrame, query: str, k: int = 5, width: int = BEAM, rows_per_shard: int = ROWS_PER_SHARD) -> DataFrame:
    """Rows (query_id, rank from 1, vec_id, score): the ``k`` nearest found of every row for which ``query`` holds.

    ``query`` is an SQL condition on vec_id. Candidates are all rows but those with the query's own
    id and of the query's width; score is the cosine in double precision; ties go to the smaller vec_id. Rows that ``usable``
    leaves out are neither queries nor candidates; rows that repeat id and vector count once. Equal
    vectors are one node of the graph and have one score; of a class, the ``k + 1`` smallest ids can
    be answers and only they are gathered. Fewer candidates than ``k`` are all returned; an empty
    table gives no rows.
    """
    members, classes = with_class(saved(usable(embeddings), "neighbours-rows"))
    asked = members.where(query).select(F.col("vec_id").alias("query_id"), F.col("rep").alias("query"))
    shards = F.ceil(F.col("total") / rows_per_shard).cast("int")
    classes = saved(with_width(classes).select("rep", "embedding", "width", shards.alias("shards")), "neighbours-classes")
    vectors = asked.select("query").distinct().join(classes, F.col("query") == F.col("rep")).select("query", "embedding", "width", "shards")
    found = class_neighbours(index(classes), saved(vectors, "neighbours-queries"), k + 1, width)
    best = Window.partitionBy("query").orderBy(F.desc("score"), "rep")
    found = saved(found.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1).drop("r"), "neighbours-found")
    few = members.withColumn("r", F.row_number().over(Window.partitionBy("rep").orderBy("vec_id"))).where(F.col("r") <= k + 1).drop("r")
    answers = asked.join(found, "query").join(few, "rep").where("vec_id != query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return answers.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
