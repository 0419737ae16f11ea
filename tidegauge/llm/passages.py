"""Substring dedup: remove every later occurrence of a passage that documents share.

A window is a number of consecutive words of one document. Of windows with the same words the first,
by document and start, stays and the words of all others go.

1. Every text is cut into words, and each window chooses one phrase in it, the one with the smallest
   hash of all phrases of ``PHRASE`` words that start in it. Equal windows choose equal phrases, so
   only windows whose phrase occurs twice can recur, and few phrases stand for all windows.
2. Windows with such a phrase are counted by a 128-bit hash. Those that occur twice are confirmed,
   each with its first place.
3. Phrases are dealt out to shards by the text that owns them, the one with the smallest hash that
   holds them. A task compiles the heads of a shard's phrases into one Aho-Corasick automaton and
   streams the texts that hold any of the phrases through it; around every occurrence the windows are looked up among
   the shard's confirmed ones.

Exact copies of a text are found by hash first, and only one of them goes through the steps.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import WORDS, id_again, saved, text_or_empty, whole_id

WINDOW = 20
PHRASE = 8
HEAD = 4  # words of a phrase that the automaton holds; what it finds is looked up whole
PHRASES_PER_SHARD = 50_000
CHARS_PER_CHUNK = 16 << 20
_ROWS_AT_ONCE = 200_000
_A, _B, _C, _MIX = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x94D049BB133111EB))


def _rolling(hashes: np.ndarray, length: int, factor: np.uint64) -> np.ndarray:
    """A hash of every run of ``length`` words."""
    out = np.zeros(len(hashes) - length + 1, dtype=np.uint64)
    for k in range(length):
        out = out * factor + hashes[k:k + len(out)]
    out ^= out >> np.uint64(31)
    out *= _MIX
    return out ^ (out >> np.uint64(29))


def _mixed(x: np.ndarray) -> np.ndarray:
    """Numbers to numbers that look drawn at random."""
    x = (x + _A) * _B
    for shift in (32, 29):
        x = (x ^ (x >> np.uint64(shift))) * _MIX
    return x ^ (x >> np.uint64(32))


_NEAR = 64
_LETTERS = _mixed(np.arange(_NEAR << 8, dtype=np.uint64))  # a number for every byte at the first places of a word


def _hashes(data: bytes) -> np.ndarray:
    """A 64-bit hash of every word of UTF-8 bytes, all words at once.

    The hash is the sum of one number per byte and place in the word. The numbers are mixed, not
    powers of a base, so no pattern of letters cancels out; a last mix follows.
    """
    text = np.frombuffer(data, dtype=np.uint8)
    edge = np.ones(len(text) + 2, dtype=bool)
    edge[1:-1] = (text == 32) | ((text >= 9) & (text <= 13))
    bounds = np.flatnonzero(edge[1:] != edge[:-1])
    start, size = bounds[0::2], bounds[1::2] - bounds[0::2]
    if not len(start):
        return np.zeros(0, dtype=np.uint64)
    first = np.cumsum(size) - size  # where each word's bytes begin once the gaps are left out
    place = np.arange(first[-1] + size[-1]) - np.repeat(first, size)
    cell = (place << 8) | text[~edge[1:-1]]
    if size.max() <= _NEAR:
        numbers = _LETTERS[cell]
    else:
        numbers = np.where(place < _NEAR, _LETTERS[np.minimum(cell, len(_LETTERS) - 1)], _mixed(cell.astype(np.uint64)))
    return _mixed(np.add.reduceat(numbers, first) + size.astype(np.uint64) * _C)


@lru_cache
def _factors(window: int) -> np.ndarray:
    """What each word of a window is multiplied with, for two independent hashes."""
    return np.array([[pow(int(f), window - 1 - k, 1 << 64) for f in (_B, _C)] for k in range(window)], dtype=np.uint64)


def _window_hashes(hashes: np.ndarray, window: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of the windows that start ``at``."""
    out = np.zeros((len(at), 2), dtype=np.uint64)
    for low in range(0, len(at), 1 << 16):
        out[low:low + (1 << 16)] = hashes[at[low:low + (1 << 16), None] + np.arange(window)] @ _factors(window)
    out = (out ^ (out >> np.uint64(31))) * _MIX
    out ^= out >> np.uint64(29)
    return out[:, 0].copy().view(np.int64), out[:, 1].copy().view(np.int64)


def _chosen(hashes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all phrases, and where each window's chosen one starts, the leftmost of the smallest."""
    length = min(PHRASE, window)
    phrases = _rolling(hashes, length, _A)
    n = len(hashes) - window + 1
    best, at = phrases[:n].copy(), np.zeros(n, dtype=np.int8)
    for k in range(1, window - length + 1):
        other = phrases[k:k + n]
        less = other < best
        np.copyto(best, other, where=less)
        at[less] = k
    return phrases, np.arange(n) + at


def _columns(text: Column) -> tuple[Column, Column]:
    return F.xxhash64(text).alias("th"), F.xxhash64(F.lit(7), text).alias("th2")


def _phrases(docs: DataFrame, window: int) -> DataFrame:
    """Rows (phrase, owner): every phrase a text's windows choose, once per text.

    The owner is the text's hash with its lowest bit replaced: 1 if two places of the text chose the phrase.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            phrases, owners, size = [], [], 0
            for data, th in zip(batch["data"], batch["th"], strict=True):
                hashes = _hashes(data)
                if len(hashes) < window:
                    continue
                every, at = _chosen(hashes, window)
                new = np.ones(len(at), dtype=bool)
                new[1:] = at[1:] != at[:-1]  # places of chosen phrases never go back
                found, count = np.unique(every[at[new]], return_counts=True)
                phrases.append(found.view(np.int64))
                owners.append((np.int64(th) & ~np.int64(1)) | (count > 1))
                size += len(found)
                if size > _ROWS_AT_ONCE:
                    yield pd.DataFrame({"phrase": np.concatenate(phrases), "owner": np.concatenate(owners)})
                    phrases, owners, size = [], [], 0
            if phrases:
                yield pd.DataFrame({"phrase": np.concatenate(phrases), "owner": np.concatenate(owners)})

    return docs.select(F.col("text").cast("binary").alias("data"), "th").mapInPandas(run, "phrase long, owner long")


def _digest(words: list[str]) -> str:
    return hashlib.sha256(" ".join(words).encode("utf-8", "surrogatepass")).hexdigest()


_TEXTS = "doc_id long, th long, text string, phrases array<long>, owners array<long>, n_words long, n_removed long, kept_sha256 string"


def _settled(joined: DataFrame, window: int) -> DataFrame:
    """Final results of copies and of texts without recurring phrases; the others keep their words, as one line."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc, th, text, copy, phrases, owners in zip(*(batch[c] for c in ("doc_id", "th", "text", "copy", "phrases", "owners")), strict=True):
                words = WORDS.findall(text)
                long = len(words) >= window
                if long and not copy and phrases is not None:
                    out.append((doc, th, " ".join(words), phrases, owners, len(words), None, None))
                else:
                    gone = len(words) if long and copy else 0
                    out.append((doc, th, None, None, None, len(words), gone, _digest([] if gone else words)))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in _TEXTS.split(", ")]).astype({"n_removed": "Int64"})

    return joined.mapInPandas(run, _TEXTS)


def _windows(texts: DataFrame, window: int, shards: int) -> DataFrame:
    """Rows (w1, w2, shard, doc_id, start, th) of the windows whose phrase recurs."""
    names = ["w1", "w2", "shard", "doc_id", "start", "th"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts, size = [], 0
            for doc, th, data, phrases, owners in zip(*(batch[c] for c in ("doc_id", "th", "data", "phrases", "owners")), strict=True):
                hashes = _hashes(data)
                every, chosen = _chosen(hashes, window)
                known = np.asarray(phrases, dtype=np.int64)
                mine = every.view(np.int64)[chosen]
                at = np.minimum(np.searchsorted(known, mine), len(known) - 1)
                start = np.flatnonzero(known[at] == mine)
                one, two = _window_hashes(hashes, window, start)
                shard = (np.asarray(owners, dtype=np.int64)[at[start]] % shards).astype(np.int32)
                parts.append((one, two, shard, np.full(len(start), doc), start.astype(np.int32), np.full(len(start), th)))
                size += len(start)
                if size > _ROWS_AT_ONCE:
                    yield pd.DataFrame({name: np.concatenate(column) for name, column in zip(names, zip(*parts, strict=True), strict=True)})
                    parts, size = [], 0
            if parts:
                yield pd.DataFrame({name: np.concatenate(column) for name, column in zip(names, zip(*parts, strict=True), strict=True)})

    rows = texts.select("doc_id", "th", F.col("text").cast("binary").alias("data"), "phrases", "owners")
    return rows.mapInPandas(run, "w1 long, w2 long, shard int, doc_id long, start int, th long")


def _phrase_texts(texts: DataFrame, window: int, shards: int) -> DataFrame:
    """Rows (shard, phrase): the first words of every recurring phrase, from the text that owns it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out: list[tuple[int, str]] = []
            for th, text, phrases, owners in zip(*(batch[c] for c in ("th", "text", "phrases", "owners")), strict=True):
                owners, known = np.asarray(owners, dtype=np.int64), np.asarray(phrases, dtype=np.int64)
                known, shard = known[owners >> 1 == th >> 1], (owners[owners >> 1 == th >> 1] % shards)
                if not len(known):
                    continue
                words = text.split(" ")
                every, chosen = _chosen(_hashes(text.encode()), window)
                places = np.unique(chosen)
                mine, first = np.unique(every.view(np.int64)[places], return_index=True)
                at = np.searchsorted(mine, known)
                length = min(HEAD, PHRASE, window)
                for s, i in zip(shard, at, strict=True):
                    p = places[first[i]]
                    out.append((int(s), " ".join(words[p:p + length])))
            yield pd.DataFrame(out, columns=["shard", "phrase"]).astype({"shard": "int32", "phrase": "str"})

    return texts.select("th", "text", "phrases", "owners").mapInPandas(run, "shard int, phrase string")


def _locate(texts: pd.DataFrame, bundle: pd.DataFrame, window: int) -> pd.DataFrame:
    """Starts of the windows in ``texts`` that are confirmed ones elsewhere first."""
    out = []
    if len(texts) and len(bundle):
        automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        for phrase in bundle["words"].iloc[0]:
            automaton.add_word(f" {phrase} ")
        automaton.make_automaton()
        one, two, doc, start, th = (np.asarray(bundle[c].iloc[0], dtype=np.int64) for c in ("w1", "w2", "docs", "starts", "ths"))
        order = np.lexsort((two, one))
        one, two, doc, start, th = one[order], two[order], doc[order], start[order], th[order]
        back = window - min(PHRASE, window)
        for me, mine, text in zip(texts["key"], texts["th"], texts["text"], strict=True):
            hits = np.fromiter((end - length + 1 for end, length in automaton.iter(f" {text} ")), dtype=np.int64)
            if not len(hits):
                continue
            gaps = np.flatnonzero(np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32) == 32) + 1
            places, n_words = np.searchsorted(gaps, hits, side="right"), len(gaps) + 1
            # a window that chose the phrase starts at most so many words before it
            near = np.zeros(n_words + back + 1, dtype=bool)
            for k in range(back + 1):
                near[places - k + back] = True
            near = np.flatnonzero(near[back:])
            near = near[near <= n_words - window]
            a, b = _window_hashes(_hashes(text.encode()), window, near)
            # equal first hashes of different windows are next to each other; step past them
            at = np.searchsorted(one, a)
            while True:
                inside = np.minimum(at, len(one) - 1)
                other = (at < len(one)) & (one[inside] == a) & (two[inside] != b)
                if not other.any():
                    break
                at = at + other
            inside = np.minimum(at, len(one) - 1)
            known = (at < len(one)) & (one[inside] == a) & (two[inside] == b)
            first = (doc[inside] == me) & (start[inside] == near) & (th[inside] == mine)
            later = near[known & ~first]
            if len(later):
                out.append((me, mine, later.astype(np.int32)))
    return pd.DataFrame(out, columns=["key", "th", "starts"]).astype({"key": "int64", "th": "int64"})


def _kept(found: DataFrame, window: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc, text, parts in zip(batch["doc_id"], batch["text"], batch["parts"], strict=True):
                words = text.split(" ")
                edge = np.zeros(len(words) + 1, dtype=np.int64)
                starts = np.unique(np.concatenate([np.asarray(p) for p in parts])) if parts is not None and len(parts) else np.zeros(0, dtype=np.int64)
                np.add.at(edge, starts, 1)
                np.add.at(edge, starts + window, -1)
                gone = np.cumsum(edge)[:-1] > 0
                kept = [w for w, g in zip(words, gone, strict=True) if not g]
                out.append((doc, len(words), int(gone.sum()), " ".join(kept)))
            yield pd.DataFrame(out, columns=["doc_id", "n_words", "n_removed", "kept"])

    return found.select("doc_id", "text", "parts").mapInPandas(run, "doc_id long, n_words long, n_removed long, kept string")


def dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by one space).

    Words and windows are the document's own; a null text has no words. Documents are in order of
    doc_id, null first; rows that repeat id and text are one document and come back alike. Texts of
    fewer words than a window lose nothing. An empty table gives no rows.
    """
    rows = docs.select(whole_id().alias("doc_id"), text_or_empty().alias("text"))
    rows = rows.select("doc_id", "text", *_columns(F.col("text")))
    classes = saved(rows.groupBy("th", "th2").agg(F.min("doc_id").alias("rep")), "passages-classes")

    # one shuffle by phrase serves both the count and the join with it
    chosen = _phrases(rows, window).repartition("phrase")
    recurring = chosen.groupBy("phrase").agg(F.min("owner").alias("own"), F.max("owner").alias("last")).where(
        "shiftright(own, 1) != shiftright(last, 1) OR own & 1 = 1"
    ).select("phrase", "own")
    held = chosen.join(recurring, "phrase").select(F.shiftright("owner", 1).alias("half"), "phrase", "own").distinct()
    lists = held.groupBy("half").agg(F.array_sort(F.collect_list(F.struct("phrase", "own"))).alias("held"))  # bounded by the text
    lists = saved(lists.select("half", F.expr("held.phrase").alias("phrases"), F.expr("held.own").alias("owners")), "passages-held")
    shards = max(1, -(-lists.select(F.explode("phrases").alias("p")).agg(F.count_distinct("p")).first()[0] // PHRASES_PER_SHARD))

    marked = classes.join(lists, F.shiftright(classes.th, 1) == lists.half, "left").select("th", "th2", "rep", "phrases", "owners")
    joined = rows.join(marked, ["th", "th2"]).select("doc_id", "th", "text", (F.col("doc_id") != F.col("rep")).alias("copy"), "phrases", "owners")
    texts = saved(_settled(joined, window), "passages-texts")
    settled = texts.where("text IS NULL").select("doc_id", "n_words", "n_removed", "kept_sha256")
    open_texts = texts.where("text IS NOT NULL").select("doc_id", "th", "text", "phrases", "owners")

    confirmed = _windows(open_texts, window, shards).groupBy("w1", "w2").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct(F.col("doc_id").alias("doc"), "start", "th")).alias("first"), F.min("shard").alias("shard")
    ).where("n > 1")
    confirmed = saved(confirmed.select("w1", "w2", "first.*", "shard"), "passages-confirmed")
    # a shard's phrases and windows are bounded by PHRASES_PER_SHARD; each column is a flat array
    entries = confirmed.groupBy("shard").agg(F.collect_list(F.struct("w1", "w2", "doc", "start", "th")).alias("e")).select(
        "shard", *[F.expr(f"e.{c}").alias(a) for c, a in (("w1", "w1"), ("w2", "w2"), ("doc", "docs"), ("start", "starts"), ("th", "ths"))]
    )
    words = _phrase_texts(open_texts, window, shards).groupBy("shard").agg(F.collect_set("phrase").alias("words"))
    bundles = saved(words.join(entries, "shard"), "passages-bundles")

    routed = open_texts.withColumn("shard", F.explode(F.array_distinct(F.transform("owners", lambda o: F.pmod(o, F.lit(shards)).cast("int")))))
    sizes = routed.groupBy("shard").agg(F.ceil(F.sum(F.length("text")) / CHARS_PER_CHUNK).cast("int").alias("chunks"))
    sizes = saved(sizes, "passages-sizes")
    left = routed.join(sizes, "shard").select(
        "shard", F.pmod(F.xxhash64("doc_id", "th"), "chunks").cast("int").alias("chunk"), F.col("doc_id").alias("key"), "th", "text"
    )
    right = bundles.join(sizes, "shard").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).drop("chunks")
    places = left.groupBy("shard", "chunk").cogroup(right.groupBy("shard", "chunk")).applyInPandas(
        lambda t, b: _locate(t, b, window), "key long, th long, starts array<int>"
    )
    parts = places.groupBy("key", "th").agg(F.collect_list("starts").alias("parts"))  # bounded by the text
    parts = saved(parts, "passages-places").select("key", F.col("th").alias("own_th"), "parts")
    found = open_texts.join(parts, (open_texts.doc_id == parts.key) & (open_texts.th == parts.own_th), "left")
    kept = _kept(found, window)
    kept = kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept"), 256).alias("kept_sha256"))
    return settled.unionByName(kept).withColumn("doc_id", id_again())
