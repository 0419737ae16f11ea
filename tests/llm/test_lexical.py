from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.brute import DOCUMENT, odd_documents
from tidegauge.llm import lexical

ITEM = "item_id long, text string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def folded(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain_search(docs, items, k):
    """Every document scored for every item."""
    held = [(doc, Counter(t), len(t)) for doc, t in ((d[0], folded(d[1])) for d in docs) if t]
    n, total = len(held), sum(h[2] for h in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for doc, count, length in held:
            m = 100 - 25 + (25 * length * n) // total
            score = sum(times * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * count[t]) // (1000 * count[t] + 12 * m))
                        for t, times in Counter(folded(text)).items() if count[t])
            if score > 0:
                scored.append((-score, doc is not None, doc, score))
        scored.sort(key=lambda s: s[:3] if s[1] else (s[0], False, 0))
        out += [(item, rank, s[2], s[3]) for rank, s in enumerate(scored[:k], 1)]
    return sorted(out, key=str)


def made(seed=1, docs=700, words=120):
    pick = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)] + ["É", "é", "x1", "日本"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    rows = [(i, " ".join(pick.choices(vocabulary, weights, k=pick.choice([3, 20, 60])))) for i in range(docs)]
    rows += [(docs + i, rows[5][1].upper()) for i in range(150)]  # copies: ties by doc_id
    items = [(i, "-".join(pick.choices(vocabulary, k=pick.choice([1, 4, 15])))) for i in range(40)] + [(90, rows[5][1]), (91, rows[5][1] * 3)]
    return rows, items + [(92, None), (93, ""), (94, "nowhere"), (90, "w1 w2"), (None, "w3 W3 w3"), (95, "... !")]


@pytest.mark.parametrize("terms_at_once,cells,k", [(1 << 14, 1 << 25, 20), (30, 5000, 20), (1 << 14, 20_000, 3)])
def test_equal_to_scoring_everything(spark, terms_at_once, cells, k):
    docs, items = made()
    documents = spark.createDataFrame([(*d, "en", "a", 1) for d in docs], DOCUMENT).withColumn("n", F.lit("x")).withColumn("score", F.lit(1))
    asked = spark.createDataFrame(items, ITEM).withColumn("rank", F.lit(0)).withColumn("item", F.lit("y"))
    got = lexical.search(documents, asked, k=k, terms_at_once=terms_at_once, cells=cells).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_search(docs, items, k)


def test_odd_documents_and_repeated_rows(spark):
    rows = odd_documents() * 2 + [(20, "z" * 100_000 + " A b", None, None, 0), (21, "q " * 50_000, None, None, 0)]
    items = [(1, "a b c"), (2, "w5x W6X école École é"), (3, "one"), (4, "z" * 100_000), (5, "q")]
    docs = spark.createDataFrame(rows, DOCUMENT)
    got = sorted((tuple(r) for r in lexical.search(docs, spark.createDataFrame(items, ITEM)).collect()), key=str)
    assert got == plain_search([r[:2] for r in rows], items, 20)
    assert lexical.search(docs.limit(0), spark.createDataFrame(items, ITEM)).collect() == []
    assert lexical.search(docs, spark.createDataFrame([], ITEM)).collect() == []
    assert lexical.search(docs.where("text is null"), spark.createDataFrame(items, ITEM)).collect() == []


def test_blocks_are_skipped_and_cover_their_lists():
    pick = np.random.default_rng(2)
    rows, size = 2000, 40
    impacts = np.where(pick.random((rows, size)) < 0.3, pick.integers(1, 900_000, (rows, size)), 0)
    impacts[:, :4] = np.where(np.arange(rows)[:, None] % 50 == 0, 999_000, impacts[:, :4] // 100)  # a group that stands out
    row, term = np.nonzero(impacts)
    beside = [np.arange(size)] * size
    shard = lexical.Shard(np.arange(rows), row, term, impacts[row, term], size, beside)
    for t in range(size):
        blocks, summary = shard.blocks(t)
        assert sorted(np.concatenate(blocks)) == np.flatnonzero(impacts[:, t]).tolist()
        for docs, top in zip(blocks, summary, strict=True):
            assert (impacts[docs].max(axis=0) == top).all()
    scored = []
    plain = shard.impacts
    class Seen(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, tuple):
                scored.append(np.size(key[0]))
            return np.asarray(super().__getitem__(key))
    shard.impacts = plain.view(Seen)
    docs, scores = shard.best(np.arange(4), np.array([5000, 4000, 3000, 2000]), 20)
    truth = plain[:, :4].astype(np.int64) @ np.array([5000, 4000, 3000, 2000])
    assert scores.tolist() == sorted(truth, reverse=True)[:20]
    assert sum(scored) < rows / 2
