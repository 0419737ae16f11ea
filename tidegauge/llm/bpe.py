"""Byte-level BPE by batched merge rounds, and back.

The distinct words of many texts lie as symbols in one flat array. In a round every word finds the
pair of lowest rank among its neighbours, by binary search of the pairs' keys among the sorted keys of
the merges, and all its occurrences are merged at once, from the left where they overlap. A pair that
a merge makes possible ranks behind it, so this gives what merging one pair after the other gives.
Words that no merge applies to leave the array. Words of more than ``LONG_WORD`` bytes, for which
rounds would take the square of their length, are merged in the same order from a heap.

Words are found by the library's own pattern; texts with code points that have no category yet, on
which Unicode versions differ, are split by the file's own splitter.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import text_or_empty

LONG_WORD = 2048
CHARS_AT_ONCE = 4 << 20
CACHED_CHARS = 6 << 20  # words of a task whose ids are kept for its next texts
_NONE = np.int64(1 << 40)
_loaded: dict[str, Bpe] = {}


def _byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write bytes as."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions starts[i] ... starts[i] + lengths[i] - 1 of all i, one after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


class Bpe:
    """The vocabulary and merges of a ``tokenizers`` file; truncation and padding are not used."""

    def __init__(self, path: str):
        import public_tokenizers
        import regex

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, splitter = spec["model"], spec["pre_tokenizer"] or {}
        plain = spec["normalizer"] is None and splitter.get("type") == "ByteLevel" and not splitter["add_prefix_space"]
        if not (plain and model["type"] == "BPE" and splitter.get("use_regex", True) and not model.get("ignore_merges")):
            raise ValueError(f"{path} is not a plain byte-level BPE")
        if any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError(f"{path} has added tokens with options")
        self.path, self.pattern = path, regex.compile(public_tokenizers.PATTERN)
        vocabulary, letters = model["vocab"], _byte_letters()
        self.byte_ids = np.zeros(256, dtype=np.int64)
        for letter, byte in letters.items():
            self.byte_ids[byte] = vocabulary[letter]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([self.key(vocabulary[a], vocabulary[b]) for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([vocabulary[a + b] for a, b in pairs], dtype=np.int64)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.special_pattern = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if longest_first else None
        spelled = {i: bytes(letters[c] for c in token) for token, i in vocabulary.items()}
        spelled |= {i: token.encode() for token, i in self.special.items()}
        as_bytes = [spelled.get(i, b"") for i in range(max(spelled) + 1)]
        self.token_length = np.array([len(b) for b in as_bytes], dtype=np.int64)
        self.token_start = np.cumsum(self.token_length) - self.token_length
        self.token_bytes = np.frombuffer(b"".join(as_bytes), dtype=np.uint8)
        self.unsure = np.array([unicodedata.category(chr(c)) == "Cn" for c in range(0x110000)])
        self.rank_of: dict[int, int] | None = None  # the same pairs for words that are merged one by one
        self._splitter = None
        self._forget()

    @staticmethod
    def key(left, right):
        return left << 24 | right

    def _forget(self) -> None:
        self.index: dict[str, int] = {}
        self.flat, self.start, self.length = (np.zeros(0, dtype=np.int64) for _ in range(3))
        self.cached = 0

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs, found in the sorted keys."""
        key = self.key(left, right)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], _NONE) if len(self.keys) else np.full(len(key), _NONE)

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all non-empty ``words``, one after the other, and how many each word has."""
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        long = np.flatnonzero(sizes > LONG_WORD)
        short = np.flatnonzero(sizes <= LONG_WORD)
        finished: list[tuple[np.ndarray, np.ndarray]] = []  # (word, symbol) of words that are done
        symbol = self.byte_ids[np.frombuffer(b"".join(words[i] for i in short), dtype=np.uint8)]
        word = np.repeat(short, sizes[short])
        rank = np.full(len(symbol), _NONE)  # of the pair that starts at a symbol
        inner = np.flatnonzero(word[:-1] == word[1:])
        rank[inner] = self._rank(symbol[inner], symbol[inner + 1])
        while len(symbol):
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            best = np.minimum.reduceat(rank, first)
            counts = np.diff(np.append(first, len(word)))
            done = np.repeat(best == _NONE, counts)
            if done.any():
                finished.append((word[done], symbol[done]))
                active = best != _NONE
                best = best[active]
                word, symbol, rank, counts = word[~done], symbol[~done], rank[~done], counts[active]
                if not len(symbol):
                    break
            hit = rank == np.repeat(best, counts)
            at = np.flatnonzero(hit)
            # of places that overlap, as in aaa, the first, third, ... of a run are merged
            new_run = np.append(True, np.diff(at) > 1)
            in_run = np.arange(len(at)) - np.maximum.accumulate(np.where(new_run, np.arange(len(at)), 0))
            at = at[in_run % 2 == 0]
            symbol[at] = self.merged[rank[at]]
            keep = np.ones(len(symbol), dtype=bool)
            keep[at + 1] = False
            moved = at - np.arange(len(at))  # where the merged symbols are once the right halves are gone
            word, symbol, rank = word[keep], symbol[keep], rank[keep]
            changed = np.unique(np.concatenate([moved, np.maximum(moved - 1, 0)]))
            after = np.minimum(changed + 1, len(word) - 1)
            paired = (after > changed) & (word[after] == word[changed])
            rank[changed] = _NONE
            changed = changed[paired]
            rank[changed] = self._rank(symbol[changed], symbol[changed + 1])
        for i in long:
            ids = self._merge_one(words[i])
            finished.append((np.full(len(ids), i), ids))
        if not finished:
            return np.zeros(0, dtype=np.int64), np.zeros(len(words), dtype=np.int64)
        word, symbol = (np.concatenate(part) for part in zip(*finished, strict=True))
        return symbol[np.argsort(word, kind="stable")], np.bincount(word, minlength=len(words))

    def _merge_one(self, word: bytes) -> np.ndarray:
        """The same for one long word: pairs wait in a heap by rank and place."""
        symbol = self.byte_ids[np.frombuffer(word, dtype=np.uint8)]
        ranks = self._rank(symbol[:-1], symbol[1:])
        ids, n = symbol.tolist(), len(symbol)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        if self.rank_of is None:
            self.rank_of = dict(zip(self.keys.tolist(), self.ranks.tolist(), strict=True))
        known = self.rank_of
        heap = [(int(r), i, ids[i], ids[i + 1]) for i, r in enumerate(ranks) if r != _NONE]
        heapq.heapify(heap)

        def offer(i):
            j = after[i]
            if j < n and (r := known.get(self.key(ids[i], ids[j]))) is not None:
                heapq.heappush(heap, (r, i, ids[i], ids[j]))

        while heap:
            r, i, left, right = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue
            ids[i], ids[j] = int(self.merged[r]), -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return np.array([x for x in ids if x >= 0], dtype=np.int64)

    def _words(self, text: str) -> list[str]:
        if not text.isascii() and self.unsure[np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)].any():
            if self._splitter is None:
                from tokenizers import Tokenizer

                self._splitter = Tokenizer.from_file(self.path).pre_tokenizer
            return [text[a:b] for _, (a, b) in self._splitter.pre_tokenize_str(text)]
        return self.pattern.findall(text)

    def _split(self, text: str) -> list[str]:
        """Words and special tokens of a text, in order."""
        if self.special_pattern is None or not any(s in text for s in self.special):
            return self._words(text)
        out = []
        for part in self.special_pattern.split(text):
            out += [part] if part in self.special else self._words(part)
        return out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and how many each text has."""
        split = [self._split(text) for text in texts]
        if self.cached > CACHED_CHARS:
            self._forget()
        new = list({w: None for words in split for w in words if w not in self.index})
        if new:
            plain = [w for w in new if w not in self.special]
            marks = [w for w in new if w in self.special]
            flat, length = self.merge([w.encode() for w in plain])
            flat = np.concatenate([flat, np.array([self.special[w] for w in marks], dtype=np.int64)])
            length = np.concatenate([length, np.ones(len(marks), dtype=np.int64)])
            self.index.update(zip(plain + marks, range(len(self.index), len(self.index) + len(new)), strict=True))
            self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(length) - length])
            self.flat, self.length = np.concatenate([self.flat, flat]), np.concatenate([self.length, length])
            self.cached += sum(map(len, new))
        counts = np.array([len(words) for words in split], dtype=np.int64)
        place = np.fromiter((self.index[w] for words in split for w in words), dtype=np.int64, count=counts.sum())
        lengths = self.length[place]
        total = np.append(0, np.cumsum(lengths))
        ends = np.cumsum(counts)
        return self.flat[_ranges(self.start[place], lengths)], total[ends] - total[ends - counts]

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """Texts of ``counts[i]`` ids each; bytes that are not UTF-8 become replacement characters.

        Ids that the vocabulary does not hold stand for nothing.
        """
        known = (ids >= 0) & (ids < len(self.token_length))
        safe = np.where(known, ids, 0)
        lengths = np.where(known, self.token_length[safe], 0)
        flat = self.token_bytes[_ranges(self.token_start[safe], lengths)].tobytes()
        total = np.append(0, np.cumsum(lengths))
        ends = np.cumsum(counts)
        return [flat[total[e - n]:total[e]].decode("utf-8", "replace") for e, n in zip(ends.tolist(), counts.tolist(), strict=True)]


def loaded(path: str) -> Bpe:
    """The vocabulary of a file, read once in a worker."""
    if path not in _loaded:
        _loaded[path] = Bpe(path)
    return _loaded[path]


def _groups(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose sizes add up to ``most``, or of one larger row."""
    begin = held = 0
    for i, size in enumerate(sizes):
        if held and held + size > most:
            yield begin, i
            begin, held = i, 0
        held += size
    if begin < len(sizes):
        yield begin, len(sizes)


def encoded(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Rows (doc_id, ids): the ids of every whole text, special tokens' strings as their ids.

    Null and empty texts have no ids. Repeated rows stay as many rows, null ids stay null, other
    columns are left out; an empty table gives no rows. Memory: one Arrow batch, ``CHARS_AT_ONCE`` of
    text or one longer text, and words of ``CACHED_CHARS``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(tokenizer)
        for batch in batches:
            texts = batch.column("text")
            for begin, end in _groups(pc.binary_length(texts).to_pylist(), CHARS_AT_ONCE):
                ids, counts = bpe.encode(texts.slice(begin, end - begin).to_pylist())
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)), pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(begin, end - begin), lists], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def decoded(rows: DataFrame, tokenizer: str) -> DataFrame:
    """``rows`` (doc_id, ids) with the text that the ids spell; null and empty lists give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(tokenizer)
        for batch in batches:
            lists = batch.column("ids")
            counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)
            for begin, end in _groups(counts.tolist(), CHARS_AT_ONCE // 4):
                part = lists.slice(begin, end - begin)
                ids = pc.fill_null(part.flatten(), -1).to_numpy().astype(np.int64)
                texts = pa.array(bpe.decode(ids, counts[begin:end]), pa.string())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(begin, end - begin), part, texts], ["doc_id", "ids", "text"])

    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids")).mapInArrow(
        run, "doc_id long, ids array<int>, text string"
    )
