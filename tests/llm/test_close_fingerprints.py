from __future__ import annotations

from pyspark.sql import functions as F

from tidegauge.llm import simhash


def test_close_fingerprints_alone_make_candidates(spark, monkeypatch):
    """Without any min-hash key, what the fingerprints bring together is still found, and verified."""
    monkeypatch.setattr(simhash, "_keys", lambda classes: classes.select(F.col("fp").alias("key"), "fp"))
    text = [f"w{i}" for i in range(3000)]
    docs = [(0, text), (1, text + ["end"]), (2, text[::-1]), (3, ["a", "b"]), (4, ["b", "a"])]
    rows = spark.createDataFrame([(d, " ".join(words)) for d, words in docs], "doc_id long, text string")
    prints = {d: simhash.majority([simhash.shingle_set(" ".join(words), 5)]) for d, words in docs}
    assert bin(prints[0] ^ prints[1]).count("1") <= 2
    assert {r.doc_id: r.component_id for r in simhash.similar(rows).collect()} == {0: 0, 1: 0, 2: 2, 3: 3, 4: 4}
