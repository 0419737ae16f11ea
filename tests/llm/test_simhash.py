from __future__ import annotations

import random

import pytest
import xxhash

from tests.llm.brute import DOCUMENT, groups, odd_documents, words
from tidegauge.llm import simhash
from tidegauge.llm.queries import QUERIES


def plain_fingerprint(text, k):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = words(lower)
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i:i + k]).encode(), 42) for i in range(max(1, len(w) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def expected(docs, k, bits):
    fps = {d: plain_fingerprint(t, k) for d, t in docs}
    ids = sorted(fps)
    close = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1:] if bin(fps[a] ^ fps[b]).count("1") <= bits]
    label = groups(ids, close)
    return {(d, f"{fps[d]:016x}", label[d]) for d in ids}


def test_query_equals_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert {tuple(r)[:3] for r in QUERIES["op3_simhash"](spark, sf_dir).collect()} == expected(docs, 3, 2)


def test_odd_rows(spark):
    rows = [r for r in odd_documents() if r[0] is not None]
    got = simhash.near_duplicates(spark.createDataFrame(rows, DOCUMENT), shingle=3).collect()
    assert {(r.doc_id, f"{r.fp & (1 << 64) - 1:016x}", r.component_id) for r in got} == expected(
        [r[:2] for r in rows], 3, 2
    )
    assert simhash.near_duplicates(spark.createDataFrame([], DOCUMENT)).count() == 0


@pytest.mark.parametrize("pairs_up_to", [1, 64])
def test_links_connect_what_is_close(spark, pairs_up_to):
    """Both for blocks whose pairs are compared and for those too large for that."""
    draw = random.Random(5)
    fps = set()
    for _ in range(12):
        base = draw.getrandbits(64)
        for _ in range(12):
            value = base
            for _ in range(draw.randrange(5)):
                value ^= 1 << draw.randrange(64)
            fps.add(value)
    fps |= {0, (1 << 64) - 1, 1, 3, 7}
    signed = {f: f - (1 << 64) if f >> 63 else f for f in fps}
    rows = spark.createDataFrame([(v,) for v in signed.values()], "fp long")
    links = [tuple(r) for r in simhash.close_links(rows, pairs_up_to=pairs_up_to).collect()]
    mask = (1 << 64) - 1
    assert all(bin((a ^ b) & mask).count("1") <= 2 for a, b in links)
    close = [(signed[a], signed[b]) for a in fps for b in fps if a < b and bin(a ^ b).count("1") <= 2]
    assert groups(signed.values(), links) == groups(signed.values(), close)


def test_one_of_each_group_stays(spark):
    docs = spark.createDataFrame([(*r, 1) for r in odd_documents()], DOCUMENT + ", row int")
    docs = docs.unionAll(docs.where("doc_id = 6"))
    for marked in (simhash.near_duplicates(docs), simhash.similar(docs)):
        kept = simhash.keep_one(docs, marked)
        assert kept.columns == docs.columns
        left = sorted((r.doc_id or 0) for r in kept.collect())
        assert left in ([0, 1, 4, 6, 8, 10, 11], [0, 1, 4, 8, 10, 11])  # in the second the null id stands for its group


@pytest.mark.parametrize("chunk", [2048, 20])
def test_similar_texts_are_found_and_others_left(spark, monkeypatch, chunk):
    """Of edited copies at 0.9 nearly all are found, at 0.8 most; unrelated texts never."""
    monkeypatch.setattr(simhash, "CHUNK", chunk)
    draw = random.Random(2)
    fresh = lambda n: [f"w{draw.randrange(10**5)}" for _ in range(n)]
    docs, truth = [], {}
    for g in range(60):
        base = fresh(300)
        docs.append((1000 * g, base))
        for i in range(1, 80 if g == 0 else 3):
            copy = list(base)
            for _ in range(draw.randrange(1, 8)):
                copy[draw.randrange(300)] = fresh(1)[0]
            docs.append((1000 * g + i, copy))
    sets = {d: {tuple(w[i:i + 5]) for i in range(len(w) - 4)} for d, w in docs}
    for d, s in sets.items():
        root = sets[d // 1000 * 1000]
        truth[d] = len(s & root) / len(s | root)
    rows = spark.createDataFrame([(d, " ".join(w)) for d, w in docs], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash.similar(rows).collect()}
    assert all(c // 1000 == d // 1000 for d, c in got.items())
    near = [d for d in truth if d % 1000 and truth[d] >= 0.9]
    close = [d for d in truth if d % 1000 and truth[d] >= 0.8]
    assert sum(got[d] % 1000 == 0 for d in near) >= 0.97 * len(near)
    assert sum(got[d] % 1000 == 0 for d in close) >= 0.9 * len(close)


def test_isolated_pairs_are_linked_from_a_similarity_of_exactly_four_fifths(spark):
    """Pairs without others to chain by: all at 0.8 and above are found, none below."""
    draw = random.Random(3)
    fresh = lambda n: [f"w{draw.randrange(10**7)}" for _ in range(n)]
    docs, truth = [], {}
    for g in range(1200):
        base, cut = fresh(304), draw.choice([8, 12, 16, 20, 24, 28, 30, 31, 32, 33, 34, 36, 40, 45, 50])
        docs += [(2 * g, base), (2 * g + 1, base[:304 - cut] + fresh(cut))]
        sets = [{tuple(w[i:i + 5]) for i in range(len(w) - 4)} for _, w in docs[-2:]]
        truth[g] = len(sets[0] & sets[1]) / len(sets[0] | sets[1])
    rows = spark.createDataFrame([(d, " ".join(w)) for d, w in docs], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash.similar(rows).collect()}
    for low, high, found in ((0, 0.8, 0), (0.8, 0.82, 1), (0.82, 0.85, 1), (0.85, 1.1, 1)):
        pairs = [g for g, s in truth.items() if low <= s < high]
        assert len(pairs) > 60
        linked = sum(got[2 * g + 1] == 2 * g for g in pairs)
        assert linked == found * len(pairs), (low, high, linked, len(pairs))


def test_distinct_texts_that_share_an_id_stay_apart(spark):
    """Repeated ids, and null ids: each text goes or stays with its own group."""
    text = {c: " ".join(f"{c}{i}" for i in range(100)) for c in "abcdef"}
    rows = [
        (0, text["b"]), (1, text["a"]), (1, text["b"]), (1, text["a"]), (5, text["a"] + " end"), (7, text["c"]), (7, text["d"]),
        (8, text["c"] + " end"), (None, text["e"]), (None, text["f"]), (9, text["d"]),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marked = simhash.similar(docs)
    null_parts = {r.component for r in marked.where("doc_id IS NULL").collect()}
    assert marked.count() == len(rows) and len(null_parts) == 2
    expected = [(0, "b"), (1, "a"), (7, "c"), (7, "d"), (-1, "e"), (-1, "f")]
    for found in (marked, simhash.near_duplicates(docs)):
        left = sorted((-1 if r.doc_id is None else r.doc_id, r.text[0]) for r in simhash.keep_one(docs, found).collect() if not r.text.endswith("end"))
        assert left == sorted(expected)
    assert sorted(r.text[-3:] == "end" for r in simhash.keep_one(docs, marked).collect()) == [False] * 6
