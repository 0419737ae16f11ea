from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.llm.brute import groups
from tidegauge.llm import forest
from tidegauge.llm.queries import QUERIES

NAN = float("nan")


def brute(rows, threshold=0.95):
    ids, vectors = [r[0] for r in rows], np.array([r[1] for r in rows], dtype=float)
    near = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    close = near @ near.T >= threshold
    np.fill_diagonal(close, False)
    label = groups(ids, [(ids[a], ids[b]) for a, b in zip(*np.nonzero(close), strict=True)])
    return {(i, int(close[k].sum()), label[i], label[i] == i) for k, i in enumerate(ids)}


@pytest.mark.parametrize("sf", ["0.001", "0.1"])
def test_query_equals_brute_force(spark, sf):
    sf_dir = f"/root/testdata/sf{sf}"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    got = {tuple(r) for r in QUERIES["op2_embedding_forest"](spark, sf_dir).collect()}
    assert got == brute(rows)


def near_copies(n, groups_, noise, width=16):
    draw = np.random.default_rng(4)
    centres = draw.standard_normal((groups_, width))
    return [(int(i), (centres[i % groups_ if i % 3 else 0] + noise * draw.standard_normal(width)).tolist()) for i in range(n)]


@pytest.mark.parametrize("sample", [16_384, 200])
def test_many_rounds_and_large_groups(spark, monkeypatch, sample):
    """A third of all rows near one centre, small leaves, few rows to fit on: several rounds and blocks."""
    monkeypatch.setattr(forest, "LEAF", 40)
    monkeypatch.setattr(forest, "SAMPLE", sample)
    monkeypatch.setattr(forest, "LEVELS", 3)
    rows = near_copies(900, 150, 0.08)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    monkeypatch.setattr(forest, "SPILL", 1.0)
    got = {tuple(r) for r in forest.near_duplicates(table, 0.95).collect()}
    assert got == brute(rows)


def test_copies_and_unusable_rows(spark):
    good = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [2.0, 0.0]), (4, [0.0, 1.0]), (5, [1.0, 0.05]), (6, [-1.0, 0.0])]
    bad = [(10, None), (11, [0.0, 0.0]), (12, [NAN, 1.0]), (13, [1.0, None]), (14, [float("inf"), 0.0]), (15, []), (16, [1.0])]
    table = spark.createDataFrame(good + good[:2] + bad + [(None, [1.0, 0.0])], "vec_id long, embedding array<float>")
    got = forest.near_duplicates(table.withColumn("n", F.lit("x")).withColumn("rep", F.lit(1))).collect()
    assert {tuple(r) for r in got if r.vec_id and r.vec_id < 10} == brute(good)
    assert sorted((r.vec_id or 0, r.n_links, r.kept) for r in got if r.vec_id is None or r.vec_id > 9) == [
        (i, 0, True) for i in (0, 10, 11, 12, 13, 14, 15, 16)
    ]
    assert forest.near_duplicates(table.where("false")).count() == 0


def test_a_hot_group_keeps_its_pairs(spark):
    """60,000 rows, a third of them in one group of cosine about 0.957, with the production spill: no linked pair is parted."""
    draw = np.random.default_rng(6)
    rows = draw.standard_normal((60_000, 64))
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    noise = draw.standard_normal((20_000, 64)) / 8
    rows[::3] = rows[0] + 0.212 * noise
    table = spark.createDataFrame(pd.DataFrame({"rep": np.arange(60_000), "embedding": list(rows)}), "rep long, embedding array<double>")
    own = forest.leaves(table, 0.95).where("rep % 3 = 0").toPandas()
    held = own.groupby("rep")["leaf"].agg(set)
    near = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    a, b = 3 * draw.integers(0, 20_000, (2, 200_000))
    linked = (np.einsum("ij,ij->i", near[a], near[b]) >= 0.95) & (a != b)
    assert linked.sum() > 100_000
    assert sum(held[x].isdisjoint(held[y]) for x, y in zip(a[linked], b[linked], strict=True)) == 0
    assert len(own) < 60 * 20_000


@pytest.mark.parametrize("leaf", [20, 1024])
def test_vectors_of_several_widths(spark, monkeypatch, leaf):
    """Vectors link with those of their own width, however few they are; both a forest and a single leaf a width."""
    monkeypatch.setattr(forest, "LEAF", leaf)
    monkeypatch.setattr(forest, "SPILL", 1.0)
    parts = [near_copies(300, 60, 0.03, width=16), near_copies(90, 20, 0.03, width=8), [(0, [1.0, 2.0, 3.0]), (1, [1.0, 2.0, 3.01]), (2, [5.0])]]
    rows, expected = [], set()
    for k, part in enumerate(parts):
        part = [(1000 * k + i, v) for i, v in part]
        rows, expected = rows + part, expected | brute(part[:2] if k == 2 else part)
    expected.add((2002, 0, 2002, True))
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert {tuple(r) for r in forest.near_duplicates(table).collect()} == expected
