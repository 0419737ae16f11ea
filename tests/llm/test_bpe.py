from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.brute import DOCUMENT, odd_documents
from tidegauge.llm import bpe
from tidegauge.llm.queries import QUERIES

FILE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(FILE)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def odd_texts():
    pick = random.Random(3)
    letters = [chr(c) for c in [*range(0x250), *range(0x300, 0x370), 0x2028, 0x3000, 0x4E00, 0x1F600, 0xFFFD]]
    young = [chr(c) for c in (0x558, 0x88F, 0x10EC5, 0x1E6C0, 0x3D000, 0x378)]  # code points that some Unicode versions lack
    texts = ["", " ", "a", "aaaaa", "a" * 5000, "ab" * 4000, " " * 3000 + "x", "\n" * 100, "x<|endoftext|>y  <|endoftext|> <|endoftext",
             "<|endoftext|>", "don't DON'T we'll 12³½ \x1c\x85\xa0 x", "".join(pick.choice("aeinrst") for _ in range(60_000))]
    texts += ["".join(pick.choices(letters, k=pick.randint(1, 80))) for _ in range(400)]
    texts += ["".join(pick.choices([*"ab  \n'st1!<|>", *young], k=pick.randint(1, 60))) for _ in range(400)]
    return texts


def split(ids, counts):
    return [part.tolist() for part in np.split(ids, np.cumsum(counts)[:-1])]


@pytest.mark.parametrize("long_word,cached", [(bpe.LONG_WORD, bpe.CACHED_CHARS), (3, 10), (1 << 20, 1 << 30)])
def test_same_ids_as_the_library(library, monkeypatch, long_word, cached):
    monkeypatch.setattr(bpe, "LONG_WORD", long_word)
    monkeypatch.setattr(bpe, "CACHED_CHARS", cached)
    texts = odd_texts() if long_word < 1 << 20 else [t for t in odd_texts() if len(t) < 10_000]
    coder = bpe.Bpe(FILE)
    for _ in range(2):  # the second time from the cache, or after it was emptied
        ids, counts = coder.encode(texts)
        assert split(ids, counts) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert coder.decode(ids, counts) == [library.decode(i, skip_special_tokens=False) for i in split(ids, counts)]


def test_decoding_of_any_ids(library):
    pick = random.Random(4)
    lists = [[pick.randrange(50257) for _ in range(pick.randint(0, 40))] for _ in range(1000)]
    flat, counts = np.array([i for ids in lists for i in ids]), np.array([len(ids) for ids in lists])
    assert bpe.Bpe(FILE).decode(flat, counts) == [library.decode(ids, skip_special_tokens=False) for ids in lists]


def expected(library, rows):
    out = []
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        out.append((doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    return sorted(out, key=str)


def test_query_equals_the_library(spark, library):
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    got = [tuple(r) for r in QUERIES["op12_bpe"](spark, folder).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()]
    assert sorted(got, key=str) == expected(library, rows)


def test_odd_rows_batches_and_an_empty_table(spark, library, tmp_path, monkeypatch):
    monkeypatch.setattr(bpe, "CHARS_AT_ONCE", 1000)
    texts = [(100 + i, t, "en", "a", 1) for i, t in enumerate(odd_texts()[:300])]
    rows = odd_documents() + texts + odd_documents()[:4]
    docs = spark.createDataFrame(rows, DOCUMENT).withColumn("ids", F.lit("x"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in QUERIES["op12_bpe"](spark, str(tmp_path)).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()]
    assert sorted(got, key=str) == expected(library, [r[:2] for r in rows])
    assert bpe.encoded(docs.limit(0), FILE).count() == 0
    lists = spark.createDataFrame([(1, None), (None, []), (2, [15496, None, -3, 99999])], "doc_id long, ids array<int>")
    assert sorted((r.text for r in bpe.decoded(lists, FILE).collect())) == ["", "", "Hello"]
