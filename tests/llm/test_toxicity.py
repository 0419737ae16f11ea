from __future__ import annotations

import zlib

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.llm.brute import DOCUMENT, odd_documents
from tidegauge.llm import toxicity
from tidegauge.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return [spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels")]


@pytest.fixture(scope="module")
def model(tables):
    return toxicity.fit(*tables)


def test_held_out_accuracy(spark, tables):
    docs, labels = tables
    rows = QUERIES["op1_toxicity"](spark, SF_DIR)
    assert rows.columns == ["doc_id", "held_out", "score", "predicted"] and rows.count() == docs.count()
    got = {r.doc_id: r for r in rows.collect()}
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    out = [(r.toxic, got[r.doc_id].predicted) for r in labels.collect() if got[r.doc_id].held_out]
    assert sum(t == p for t, p in out) >= 0.93 * len(out) and sum(p for t, p in out if t) >= 0.5 * sum(t for t, _ in out)


def test_hidden_insults():
    features = toxicity.Features({"lowei*": 3.0})
    at = toxicity.FEATURES.index
    for text in ("you 1d1ot", "st*pid thing", "an i d i o t here", "m.o.r.o.n", "looooser"):
        assert features(text)[at("obfuscated")] > 0, text
    assert features("Loweischaft")[at("lexicon")] == 1 and features("you are a stupid one")[at("near_second")] > 0
    assert features("stupid as you")[at("near_second")] > 0
    assert features(None) == features("") and not any(features("a clean text of ordinary words")[1:11])


def test_odd_rows(spark, model):
    docs = spark.createDataFrame([(*r, 0.5, [1.0]) for r in odd_documents()], DOCUMENT + ", score double, features array<double>")
    rows = model.score(docs.unionAll(docs)).select("row.doc_id", "score").collect()
    assert len(rows) == 2 * docs.count() and all(0 <= r.score <= 1 for r in rows)
    empty = spark.createDataFrame([], DOCUMENT)
    assert model.score(empty).count() == 0


def test_without_both_classes(spark):
    docs = spark.createDataFrame(odd_documents(), DOCUMENT)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {(r.score, r.predicted) for r in toxicity.scores(docs, none).collect()} == {(0.0, 0)}
    one = docs.select("doc_id", F.lit(1).alias("quality"), F.lit(1).alias("toxic"))
    assert {r.predicted for r in toxicity.scores(docs, one).collect()} == {1}
    kept = toxicity.without_toxic(docs, none)
    assert kept.columns == docs.columns and kept.count() == docs.count()


def test_batches_of_long_texts_are_bounded(spark):
    """Scoring hands texts to Python in batches of bounded size; a bound that the session has stays."""
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    docs = spark.createDataFrame(odd_documents(), DOCUMENT)
    long = spark.range(0, 3000, 1, 1).select(F.repeat(F.lit("word "), 2000).alias("text"))

    def sizes(batches):
        for batch in batches:
            yield pd.DataFrame({"n": [int(batch["text"].str.len().sum())]})

    before = spark.conf.get(setting, None)
    try:
        spark.conf.unset(setting)
        toxicity.Model({}, 0.0).score(docs)
        got = [r.n for r in long.mapInPandas(sizes, "n long").collect()]
        assert sum(got) == 3000 * 10_000 and max(got) <= 5 << 20
        spark.conf.set(setting, "1000000")
        toxicity.Model({}, 0.0).score(docs)
        assert spark.conf.get(setting) == "1000000"
    finally:
        spark.conf.unset(setting) if before is None else spark.conf.set(setting, before)


def test_terms_are_summed_whatever_the_batches(spark, monkeypatch):
    texts = ["stupid stupider words", "stupid again", None, ""] * 50
    rows = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    want = {r.term: r.docs for r in toxicity._document_counts(rows).collect()}
    assert want["stupid"] == 100 and want["stup*"] == 100 and want["words"] == 50
    monkeypatch.setattr(toxicity, "TERMS_HELD", 2)
    assert {r.term: r.docs for r in toxicity._document_counts(rows).collect()} == want
