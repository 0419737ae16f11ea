from __future__ import annotations

import random
import zlib
from collections import defaultdict
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.brute import DOCUMENT, odd_documents
from tidegauge.llm import packing
from tidegauge.llm.queries import QUERIES, TOKENIZER

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(TOKENIZER)
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def check(rows, texts, plain, window=1024):
    """Exact round trip: every id in one piece, sequences gapless, no padding beyond powers of two."""
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        docs[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(docs) == set(texts)
    for doc, mine in docs.items():
        ids, at = plain(texts[doc]), 0
        copies = sum(r.start == 0 for r in mine)
        for r in sorted(mine, key=lambda r: r.start):
            part = np.array(ids[r.start:r.start + r.length], dtype="<u4").tobytes()
            assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(part)
            at += r.length
        assert at == copies * len(ids)
    assert sorted(sequences) == list(range(len(sequences)))
    for mine in sequences.values():
        at = 0
        for r in sorted(mine, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at & (at - 1) == 0 and at <= window
    assert sum(sum(r.length for r in m) < window for m in sequences.values()) <= 10


def test_table(spark, plain):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    check(QUERIES["op5_packing"](spark, SF_DIR).collect(), texts, plain)


def test_odd_rows(spark, plain):
    rows = odd_documents() + [(50, "a <|endoftext|> b", None, None, 1), (51, " " * 3000, None, None, 1), (52, "x" * 20_000, None, None, 1)]
    docs = spark.createDataFrame(rows, DOCUMENT).withColumn("length", F.lit(1)).withColumn("at", F.lit("x"))
    texts = {r[0]: r[1] for r in rows}
    check(packing.pack(docs, TOKENIZER).collect(), texts, plain)
    check(packing.pack(docs.unionAll(docs), TOKENIZER, 64).collect(), texts, plain, 64)
    assert packing.pack(spark.createDataFrame([], DOCUMENT), TOKENIZER).count() == 0


def test_fill_finds_a_sum_whenever_there_is_one():
    draw = random.Random(3)
    for _ in range(300):
        counts = {draw.randrange(1, 30): draw.randrange(1, 4) for _ in range(4)}
        target = draw.randrange(0, 90)
        chosen = packing.fill(counts, target)
        sums = {sum(k * m for k, m in zip(counts, take, strict=True)) for take in product(*(range(n + 1) for n in counts.values()))}
        assert (chosen is not None) == (target in sums)
        if chosen is not None:
            assert sum(k * m for k, m in chosen.items()) == target and all(m <= counts[k] for k, m in chosen.items())


def test_one_length_that_never_fits(spark, plain):
    """All pieces have 600 ids: every window is completed by a cut."""
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.repeat(F.lit(" a"), 599).alias("text"))
    rows = packing.pack(docs, TOKENIZER).collect()
    check(rows, {r.doc_id: " a" * 599 for r in rows}, plain)
