from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tests.llm.brute import DOCUMENT, odd_documents, words
from tests.oracle import compare, connect
from tidegauge.llm import passages
from tidegauge.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query_equals_sql(spark, sf):
    sf_dir = f"/root/testdata/sf{sf}"
    assert compare(QUERIES["op9_passages"](spark, sf_dir), connect(sf_dir), ORACLES["op9_passages"]) == ""


def brute(docs, window):
    seen, out = set(), set()
    for doc, text in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0)):
        w = words(text)
        gone = set()
        for i in range(len(w) - window + 1):
            run = tuple(w[i:i + window])
            if run in seen:
                gone.update(range(i, i + window))
            seen.add(run)
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.add((doc, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def made():
    """Passages at all places, within and across documents, cut short, overlapping and repeated at once."""
    draw = random.Random(8)
    fresh = lambda n: [f"x{draw.randrange(10**6)}" for _ in range(n)]
    shared = [fresh(n) for n in (4, 5, 6, 9, 20, 21, 60, 60)]
    docs = []
    for i in range(60):
        text = []
        for _ in range(draw.randrange(5)):
            text += fresh(draw.randrange(8)) + draw.choice(shared)[draw.randrange(4):]
        docs.append((i, " ".join(text)))
    docs += [(100 + i, "la " * n) for i, n in enumerate((3, 20, 21, 50))] + [(200, "é " * 30), (201, "É " * 30 + "\U0001f600 " * 30)]
    return docs


@pytest.mark.parametrize("window", [5, 20])
def test_made_documents(spark, monkeypatch, window):
    monkeypatch.setattr(passages, "PHRASES_PER_SHARD", 20)
    monkeypatch.setattr(passages, "CHARS_PER_CHUNK", 1500)
    docs = made()
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert {tuple(r) for r in passages.dedup(table, window).collect()} == brute(docs, window)


def test_odd_rows(spark):
    docs = [(r[0], r[1]) for r in odd_documents()]
    table = spark.createDataFrame(odd_documents(), DOCUMENT).withColumn("th", F.lit("x")).withColumn("copy", F.lit(1))
    assert {tuple(r) for r in passages.dedup(table).collect()} == brute(docs, 20)
    twice = sorted(map(str, passages.dedup(table.unionAll(table)).collect()))
    assert twice == sorted(2 * [str(r) for r in passages.dedup(table).collect()])
    assert passages.dedup(table.where("false")).count() == 0


def thue_morse(n):
    text = "a"
    while len(text) < n:
        text += text.translate(str.maketrans("ab", "ba"))
    return text


@pytest.mark.parametrize("n", [1024, 4096])
def test_long_words_whose_letters_cancel_in_powers_of_a_base(spark, n):
    first = thue_morse(n)
    second = first.translate(str.maketrans("ab", "ba"))
    start = [f"w{i}" for i in range(19)]
    docs = [(1, " ".join([*start, first])), (2, " ".join([*start, second])), (3, " ".join([*start, second]))]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    assert {tuple(r) for r in passages.dedup(table).collect()} == brute(docs, 20)


def test_word_hashes_tell_words_and_places_apart():
    draw = random.Random(3)
    made = {"".join(draw.choices("abé\U0001f600", k=draw.choice([1, 2, 3, 8, 63, 64, 65, 130]))) for _ in range(5000)}
    made |= {"a" * n for n in range(1, 300)} | {"a" * n + "b" for n in range(300)} | {"b" + "a" * n for n in range(300)}
    listed = sorted(made)
    together = passages._hashes("  ".join(listed).encode()).tolist()
    assert len(set(together)) == len(listed)
    assert together[:50] == [int(passages._hashes(f"\n{w}\t".encode())[0]) for w in listed[:50]]
    assert len(passages._hashes(b" \n ")) == len(passages._hashes(b"")) == 0
