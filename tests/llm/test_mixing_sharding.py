from __future__ import annotations

import zlib

import pytest
from pyspark.sql import functions as F

from tests.llm.brute import DOCUMENT, odd_documents, words
from tests.oracle import compare, connect
from tidegauge.llm import mixing, sharding
from tidegauge.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


def test_mix_equals_sql(spark):
    assert compare(QUERIES["op6_mixing"](spark, SF_DIR), connect(SF_DIR), ORACLES["op6_mixing"]) == ""


def test_mix_of_odd_rows(spark, monkeypatch):
    """Also with several buckets per source."""
    docs = spark.createDataFrame([(*r, 1.0) for r in odd_documents()], DOCUMENT + ", size double")
    for per_bucket in (4096, 2):
        monkeypatch.setattr(mixing, "ROWS_PER_BUCKET", per_bucket)
        got = mixing.mix(docs.unionAll(docs)).collect()
        assert len(got) == 2 * docs.count()
        for source in {r.source for r in got}:
            mine = [r for r in got if r.source == source]
            assert abs(sum(r.taken for r in mine) - mine[0].target) <= 0.5
            assert sum(r["size"] for r in mine) == mine[0].source_size
            assert mine[0].target <= 3 * mine[0].source_size
        assert all(0 <= r.taken <= 3 * r["size"] for r in got)
        assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.mix(docs.unionAll(docs)).collect()), key=str)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert sum(len(words(r.text)) for r in mixed.collect()) == sum(r.taken for r in mixing.mix(docs).collect())
    assert mixing.mix(spark.createDataFrame([], DOCUMENT)).count() == 0


def minimax(sizes, shards):
    low, high = max(sizes), sum(sizes)
    while low < high:
        middle, parts, load = (low + high) // 2, 1, 0
        for s in sizes:
            parts, load = (parts + 1, s) if load + s > middle else (parts, load + s)
        low, high = (low, middle) if parts <= shards else (middle + 1, high)
    return low


@pytest.mark.parametrize("shards", [1, 3, 8])
def test_smallest_capacity(spark, shards):
    sizes = [(i * 7919) % 101 + 1 for i in range(200)]
    units = spark.createDataFrame([(i, 1, s) for i, s in enumerate(sizes)], "unit int, n long, size long")
    rows = sorted(map(tuple, sharding.partition_units(units, shards).collect()))
    assert {r[4] for r in rows} == {minimax(sizes, shards)}
    loads = [sum(r[2] for r in rows if r[3] == k) for k in range(shards)]
    assert max(loads) <= rows[0][4] and [r[3] for r in rows] == sorted(r[3] for r in rows)


def check_shards(rows, texts):
    for shard in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sum(r.shard == shard for r in rows)))
    place = {}
    for r in rows:
        text = texts[r.doc_id] or ""
        assert r["size"] == len(text.encode()) + 1 and r.text_crc32 == zlib.crc32(text.encode())
        assert place.setdefault(text, r.shard) == r.shard


def test_shards_of_the_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = QUERIES["op7_sharding"](spark, SF_DIR).collect()
    check_shards(rows, {r.doc_id: r.text for r in docs.collect()})
    loads = [sum(r["size"] for r in rows if r.shard == k) for k in range(8)]
    assert len(rows) == docs.count() and max(loads) < 1.2 * sum(loads) / 8


def test_shards_of_odd_rows(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(sharding, "ROWS_PER_SLOT_RUN", 2)
    docs = spark.createDataFrame([(*r, 1) for r in odd_documents() * 3], DOCUMENT + ", slot int")
    rows = sharding.assign(docs).collect()
    assert len(rows) == docs.count()
    check_shards(rows, {r[0]: r[1] for r in odd_documents()})
    assert sharding.assign(spark.createDataFrame([], DOCUMENT)).count() == 0
    sharding.write_shards(docs.drop("slot"), str(tmp_path / "out"), 3)
    assert spark.read.parquet(str(tmp_path / "out")).agg(F.count("*")).first()[0] == docs.count()
