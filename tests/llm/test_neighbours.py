from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegauge.llm import neighbours
from tidegauge.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.1"
NAN, INF = float("nan"), float("inf")


def exact(ids, vectors, query_ids, k=5):
    near = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    out = {}
    for i in np.flatnonzero(np.isin(ids, query_ids)):
        sims = near @ near[i]
        sims[ids == ids[i]] = -np.inf
        out[ids[i]] = [(int(ids[j]), sims[j]) for j in np.lexsort((ids, -sims))[:k] if sims[j] > -np.inf]
    return out


def recall(rows, truth):
    found = {}
    for r in rows:
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(found) == set(truth)
    right = total = 0
    for q, best in truth.items():
        mine = sorted(found[q])
        assert [r[0] for r in mine] == list(range(1, len(best) + 1))
        assert all(a[2] > b[2] or a[2] == b[2] and a[1] < b[1] for a, b in zip(mine, mine[1:], strict=False))
        right += sum(score >= best[-1][1] - 1e-12 for _, _, score in mine)
        total += len(best)
    return right / total


@pytest.mark.parametrize("rows_per_shard", [8192, 600])
def test_recall_and_scores(spark, rows_per_shard):
    table = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    rows = neighbours.nearest(table, "vec_id % 50 = 0", rows_per_shard=rows_per_shard).collect()
    data = table.toPandas()
    ids, vectors = data["vec_id"].to_numpy(), np.stack(data["embedding"]).astype(float)
    truth = exact(ids, vectors, ids[ids % 50 == 0])
    assert recall(rows, truth) >= 0.97
    at = {v: i for i, v in enumerate(ids)}
    for r in rows[:300]:
        a, b = vectors[at[r.query_id]], vectors[at[r.vec_id]]
        assert abs(r.score - a @ b / np.linalg.norm(a) / np.linalg.norm(b)) < 1e-12


def test_copies_ties_and_unusable_rows(spark, tmp_path):
    rows = [(i, [1.0, 0.0]) for i in range(0, 400, 10)] + [(i, [float(i), 1.0]) for i in range(1, 40, 3)]
    rows += [(50, [0.0, 1.0])] + [(50, [1.0, 0.0])] * 2
    bad = [(1000, None), (1050, []), (1100, [0.0, 0.0]), (1150, [NAN, 1.0]), (1200, [1.0, INF]), (1250, [1.0, None]), (None, [1.0, 1.0]), (1300, [1.0])]
    table = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>").withColumn("rep", F.lit(1)).withColumn("score", F.lit("x"))
    table.write.parquet(f"{tmp_path}/embeddings.parquet")
    got = QUERIES["op8_neighbours"](spark, str(tmp_path)).collect()
    kept = sorted({(i, tuple(v)) for i, v in rows})
    assert {r.query_id for r in got} == {i for i, _ in kept if i % 50 == 0}
    mine = sorted((r.rank, r.vec_id) for r in got if r.query_id == 100)
    assert mine == [(1, 0), (2, 10), (3, 20), (4, 30), (5, 40)]
    few = table.where("vec_id in (0, 20, 1000)")
    assert [(r.query_id, r.vec_id) for r in neighbours.nearest(few, "vec_id % 50 = 0").collect()] == [(0, 20)]
    assert neighbours.nearest(table.where("false"), "vec_id % 50 = 0").count() == 0


def test_vectors_of_several_widths(spark):
    """Each width has shards of its own, and its queries search them only."""
    draw = np.random.default_rng(4)
    parts = {16: range(0, 500), 8: range(500, 620), 3: range(620, 622), 2: range(650, 651)}
    rows = [(i, draw.standard_normal(w).tolist()) for w, ids in parts.items() for i in ids]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = neighbours.nearest(table, "vec_id % 10 = 0", rows_per_shard=100).collect()
    truth = {}
    for ids in list(parts.values())[:3]:
        vectors = np.array([v for i, v in rows if i in ids])
        truth |= exact(np.array(ids), vectors, [i for i in ids if i % 10 == 0])
    assert recall(got, truth) >= 0.97
