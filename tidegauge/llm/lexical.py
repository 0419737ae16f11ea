"""Ranked lexical search with per-term geometric blocking.

The score of a document for an item is a sum over terms of weight times impact, in integers. A task
indexes its documents in shards of bounded size. In a shard every term's posting list is clustered by
similarity of its documents: some of them are pivots, and each document joins the pivot it is nearest
to by cosine of random projections. A cluster is a block, and its summary holds for every coordinate
the largest impact in it. A block's documents are scored only if the item's weights times the summary
reach the score of the ``k``-th best document so far; a list is left out if no document of it and the
lists behind it can reach that score. Both bounds are exact, so the best ``k`` of a shard are too, and
the best of all shards are the best of all documents.

Items are answered in blocks whose terms together stay near ``TERMS_AT_ONCE``; only these terms are
sent to the tasks and indexed.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm.common import id_again, saved, whole_id

TERMS_AT_ONCE = 1 << 14
CELLS = 1 << 25  # documents times terms of a shard
DOCS_PER_BLOCK = 64
SKETCH = 32
SHARDS_PER_MERGE = 64
_BLOCKS_AT_ONCE = 4

_PLAIN = bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
_FOLD = bytes(b if b in _PLAIN else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    """Terms of a UTF-8 text: runs of ASCII letters, digits and all characters beyond ASCII; A-Z lower-cased."""
    return (text or b"").translate(_FOLD).split()


def _item_terms(items: DataFrame) -> DataFrame:
    """Rows (item, term, times) of the items' distinct terms."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [(item, term, n) for item, text in zip(batch["item"], batch["text"], strict=True) for term, n in Counter(terms_of(text)).items()]
            yield pd.DataFrame(out, columns=["item", "term", "times"])

    return items.select("item", F.col("text").cast("binary")).mapInPandas(run, "item long, term binary, times long")


def _vectors(docs: DataFrame, vocabulary) -> DataFrame:
    """Rows (doc_id, n, terms, tfs) of all documents that have a term; the arrays hold the vocabulary's."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = vocabulary.value
        for batch in batches:
            out = []
            for doc, text in zip(batch["doc_id"], batch["text"], strict=True):
                words = terms_of(text)
                if words:
                    found = np.fromiter((number[w] for w in words if w in number), dtype=np.int32)
                    terms, tfs = np.unique(found, return_counts=True)
                    out.append((doc, len(words), terms.astype("<i4").tobytes(), tfs.astype("<i8").tobytes()))
            yield pd.DataFrame(out, columns=["doc_id", "n", "terms", "tfs"])

    rows = docs.select(whole_id().alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return rows.mapInPandas(run, "doc_id long, n long, terms binary, tfs binary")


def _document_counts(vectors: DataFrame, size: int) -> np.ndarray:
    """In how many documents each of ``size`` terms occurs; tasks count first."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(size, dtype=np.int64)
        for batch in batches:
            counts += np.bincount(np.frombuffer(b"".join(batch["terms"]), dtype="<i4"), minlength=size)
        terms = np.flatnonzero(counts)
        yield pd.DataFrame({"term": terms, "df": counts[terms]})

    counts = np.zeros(size, dtype=np.int64)
    for row in vectors.select("terms").mapInPandas(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        counts[row.term] = row.df
    return counts


class Shard:
    """Posting lists of some documents, in blocks that are made when a list is first asked for."""

    def __init__(self, doc_ids: np.ndarray, row: np.ndarray, term: np.ndarray, impact: np.ndarray, size: int, partners: list[np.ndarray]):
        self.doc_ids, self.partners = doc_ids, partners
        self.impacts = np.zeros((len(doc_ids), size), dtype=np.int32)
        self.impacts[row, term] = impact
        order = np.argsort(term, kind="stable")
        self.rows, self.ends = row[order], np.cumsum(np.bincount(term, minlength=size))
        self.largest = np.zeros(size, dtype=np.int64)
        np.maximum.at(self.largest, term, impact)
        self.sketch = np.zeros((len(doc_ids), SKETCH), dtype=np.float32)
        directions = np.random.default_rng(7)
        for begin in range(0, size, 512):
            part = self.impacts[:, begin:begin + 512].astype(np.float32)
            self.sketch += part @ directions.standard_normal((part.shape[1], SKETCH), dtype=np.float32)
        self.sketch /= np.maximum(np.linalg.norm(self.sketch, axis=1, keepdims=True), 1e-20)
        self.made: dict[int, tuple[list[np.ndarray], np.ndarray]] = {}

    def blocks(self, term: int) -> tuple[list[np.ndarray], np.ndarray]:
        """The blocks of a list and, per block, the largest impacts of the terms that items have beside ``term``."""
        if term not in self.made:
            docs = self.rows[self.ends[term - 1] if term else 0:self.ends[term]]
            starts = np.zeros(1, dtype=np.int64)
            if len(docs) > DOCS_PER_BLOCK:
                pivots = docs[::DOCS_PER_BLOCK]
                nearest = np.argmax(self.sketch[docs] @ self.sketch[pivots].T, axis=1)
                order = np.argsort(nearest, kind="stable")
                docs = docs[order]
                starts = np.flatnonzero(np.append(True, np.diff(nearest[order]) > 0))
            summary = np.maximum.reduceat(self.impacts[np.ix_(docs, self.partners[term])], starts, axis=0)
            self.made[term] = np.split(docs, starts[1:]), summary
        return self.made[term]

    def best(self, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of the ``k`` highest scores above 0, equal scores by doc_id."""
        reach = weights * self.largest[terms]
        order = np.argsort(-reach, kind="stable")
        rest = np.cumsum(reach[order][::-1])[::-1]  # what this list and those behind it can add up to
        seen = np.zeros(len(self.doc_ids), dtype=bool)
        docs, scores, least = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), 1
        for i, list_no in enumerate(order):
            if rest[i] < least:
                break
            term = terms[list_no]
            blocks, summary = self.blocks(term)
            bounds = summary[:, np.searchsorted(self.partners[term], terms)].astype(np.int64) @ weights
            ranked = np.argsort(-bounds, kind="stable")
            for begin in range(0, len(ranked), _BLOCKS_AT_ONCE):
                chosen = [b for b in ranked[begin:begin + _BLOCKS_AT_ONCE] if bounds[b] >= least]
                if not chosen:
                    break
                new = np.concatenate([blocks[b] for b in chosen])
                new = new[~seen[new]]
                seen[new] = True
                score = self.impacts[np.ix_(new, terms)].astype(np.int64) @ weights
                hit = score >= least
                docs, scores = np.concatenate([docs, new[hit]]), np.concatenate([scores, score[hit]])
                if len(docs) > k:
                    top = np.lexsort((self.doc_ids[docs], -scores))[:k]
                    docs, scores = docs[top], scores[top]
                if len(docs) == k:
                    least = max(int(scores.min()), 1)
        top = np.lexsort((self.doc_ids[docs], -scores))
        return docs[top], scores[top]


def _searched(vectors: DataFrame, queries, size: int, documents: int, length: int, k: int, cells: int) -> DataFrame:
    """Rows (item, doc_id, score): the best of every shard. ``queries``: broadcast (items, terms, weights, partners)."""
    per_shard = max(1, min(cells // max(size, 1), 1 << 14))

    def answered(parts: list[pd.DataFrame]) -> pd.DataFrame:
        rows = pd.concat(parts, ignore_index=True)
        items, terms_of_item, weights, partners = queries.value
        held = [np.frombuffer(t, dtype="<i4") for t in rows["terms"]]
        row = np.repeat(np.arange(len(rows)), [len(t) for t in held])
        term = np.concatenate(held).astype(np.int64)
        tf = np.frombuffer(b"".join(rows["tfs"]), dtype="<i8")
        m = 100 - 25 + (25 * rows["n"].to_numpy() * documents) // length
        shard = Shard(rows["doc_id"].to_numpy(), row, term, (1_000_000_000 * tf) // (1000 * tf + 12 * m[row]), size, partners)
        out = []
        for item, terms, weight in zip(items, terms_of_item, weights, strict=True):
            docs, scores = shard.best(terms, weight, k)
            out.append(pd.DataFrame({"item": item, "doc_id": shard.doc_ids[docs], "score": scores}))
        return pd.concat(out, ignore_index=True)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts, held = [], 0
        for batch in batches:
            while len(batch):
                take = batch.iloc[:per_shard - held]
                batch = batch.iloc[per_shard - held:]
                parts.append(take)
                held += len(take)
                if held == per_shard:
                    yield answered(parts)
                    parts, held = [], 0
        if parts:
            yield answered(parts)

    shards = math.ceil(documents / per_shard)
    found = vectors.coalesce(max(1, shards)).mapInPandas(run, "item long, doc_id long, score long")
    return found.withColumn("part", F.spark_partition_id() % math.ceil(shards / SHARDS_PER_MERGE))


def search(docs: DataFrame, items: DataFrame, k: int = 20, terms_at_once: int = TERMS_AT_ONCE, cells: int = CELLS) -> DataFrame:
    """The ``k`` highest-scoring of all documents ``docs`` (doc_id, text) for every row of ``items`` (item_id, text).

    Returns (item_id, rank from 1, doc_id, score), scores above 0 only, equal scores by doc_id, null
    first. Documents without a term (null and empty texts too) count nowhere; items without one get
    no rows. Repeated documents are ranked each, repeated items answered each. Empty tables give no
    rows; other columns are left out. Texts of any length are counted whole. A text's distinct terms must
    fit a task, and the terms of one item the driver.
    """
    spark = docs.sparkSession
    items = saved(items.select(F.monotonically_increasing_id().alias("item"), "item_id", F.col("text").cast("string")), "search-items")
    wanted = saved(_item_terms(items), "search-terms")
    blocks = math.ceil(wanted.count() / terms_at_once)
    found = None
    for block in range(blocks):
        rows = wanted.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).collect()  # terms_at_once on average
        vocabulary = sorted({bytes(r.term) for r in rows})
        number = {term: i for i, term in enumerate(vocabulary)}
        vectors = saved(_vectors(docs, spark.sparkContext.broadcast(number)), "search-vectors")
        documents, length = vectors.agg(F.count(F.lit(1)), F.sum("n")).first()
        if not documents or not rows:
            continue
        counts = _document_counts(vectors, len(vocabulary))
        weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(df) + 1))) for df in counts], dtype=np.int64)
        of_item: dict[int, list[tuple[int, int]]] = {}
        for r in rows:
            of_item.setdefault(r.item, []).append((number[bytes(r.term)], r.times))
        chosen = {item: np.array(sorted(pairs), dtype=np.int64) for item, pairs in of_item.items()}
        beside: list[set[int]] = [set() for _ in vocabulary]
        for pairs in chosen.values():
            for term in pairs[:, 0]:
                beside[term].update(pairs[:, 0].tolist())
        queries = spark.sparkContext.broadcast((
            list(chosen), [p[:, 0] for p in chosen.values()], [p[:, 1] * weight[p[:, 0]] for p in chosen.values()],
            [np.array(sorted(b), dtype=np.int64) for b in beside],
        ))
        best = saved(_searched(vectors, queries, len(vocabulary), documents, length, k, cells), "search-best")
        found = best if found is None else found.unionAll(best)
    if found is None:
        found = spark.createDataFrame([], "item long, doc_id long, score long, part int")
    order = [F.desc("score"), "doc_id"]
    some = found.withColumn("rank", F.row_number().over(Window.partitionBy("item", "part").orderBy(*order))).where(F.col("rank") <= k)
    best = some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)
    return best.join(items.select("item", "item_id"), "item").select("item_id", "rank", id_again("doc_id").alias("doc_id"), "score")
