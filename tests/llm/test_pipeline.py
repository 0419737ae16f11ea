from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from tests.llm.brute import DOCUMENT, odd_documents
from tests.llm.test_pii import plain as personal
from tidegauge.llm.queries import QUERIES, TOKENIZER

SF_DIR = "/root/testdata/sf0.001"


def test_stages_one_after_the_other(spark, tmp_path):
    """Each stage's effect against brute force on what it was given; then run() gives the same rows."""
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    outs = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_DIR)
        out.write.parquet(f"{tmp_path}/{name}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{name}")
        outs[name] = docs
        if name != "packing":
            assert docs.columns == before.columns
    toxic = spark.read.parquet(f"{SF_DIR}/labels.parquet").where("toxic = 1")
    assert outs["toxicity"].join(toxic, "doc_id").count() <= 0.6 * toxic.count()
    assert outs["toxicity"].count() >= spark.read.parquet(f"{SF_DIR}/documents.parquet").count() - 2 * toxic.count()
    alone = outs["near_duplicates"].select("text")
    assert alone.distinct().count() == alone.count() and alone.count() >= 0.6 * outs["toxicity"].count()
    for r in outs["personal_data"].collect():
        assert not personal(r.text)
    words = lambda df: df.select(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")))).first()[0]
    assert abs(words(outs["mixing"]) - words(outs["personal_data"])) <= 20
    # rows that the mix repeats share an id, so the round trip is checked on those it takes once
    once = outs["mixing"].groupBy("doc_id").agg(F.count("*").alias("n"), F.first("text").alias("text")).where("n = 1")
    tokenizer = Tokenizer.from_file(TOKENIZER)
    for r in outs["packing"].join(once, "doc_id").collect():
        assert r.doc_tokens == len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1
    assert outs["packing"].exceptAll(QUERIES["pipeline"](spark, SF_DIR)).count() == 0
    total = outs["packing"].groupBy("sequence_id").agg(F.sum("length").alias("n"))
    assert total.where("n > 1024 OR bit_count(n) != 1").count() == 0


@pytest.mark.parametrize("rows", ["odd", "none"])
def test_odd_rows_pass_every_stage(spark, rows):
    docs = spark.createDataFrame([(*r, 1) for r in odd_documents()] if rows == "odd" else [], DOCUMENT + ", score int")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_DIR)
        if name != "packing":
            assert out.columns == docs.columns
            docs = spark.createDataFrame(out.collect(), out.schema)
        assert bool(out.count()) == (rows == "odd")


def test_eleven_queries_are_registered():
    names = entry.queries()
    assert {n.split("_")[0] for n in names} >= {f"op{i}" for i in range(1, 11)} | {"pipeline"}
