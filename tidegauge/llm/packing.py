"""Pack tokenised documents into fixed windows by minimum bin slack.

Documents are cut at whole windows; what matters is the piece left at the end of each. Only how many
pieces there are of each length goes to the driver, at most one number per length below the window.
There, subset-sum dynamic programming on bitsets picks the multiset of lengths that fills a window
best, beside the longest piece left; the counts found by backtracking say how often the same choice
can be repeated. Lengths that no choice completes are laid end to end and cut at the windows' ends,
the last window into powers of two, which need no padding. Every piece then finds its place from its
rank among the pieces of its length.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import crc, id_again, ranked, saved, whole_id

END_ID = 0
_SPECIAL = {"<|endoftext|>": 50256}
_loaded: dict[str, object] = {}


def _encoder(path: str):
    """A function from text to ids, as ``tokenizers`` gives them for the file, in an array.

    The file's ranks, which stand beside it, are run by tiktoken: the same ids in a quarter of the
    time. A text that its pattern engine gives up on goes to ``tokenizers``.
    """
    if path not in _loaded:
        import base64

        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        with open(os.path.splitext(path)[0] + ".tiktoken", "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=_SPECIAL)
        slow: list[object] = []

        def encode(text: str) -> np.ndarray:
            try:
                return fast.encode_to_numpy(text, allowed_special="all")
            except Exception as error:
                if not slow:
                    slow.append(Tokenizer.from_file(path))
                if not isinstance(error, (RuntimeError, ValueError)) and type(error).__name__ != "PanicException":
                    raise
                return np.asarray(slow[0].encode(text, add_special_tokens=False).ids, dtype=np.uint32)

        _loaded[path] = encode
    return _loaded[path]


def _ids(text: str | None, path: str) -> np.ndarray:
    return np.append(_encoder(path)(text or ""), END_ID).astype("<u4")


def pieces(docs: DataFrame, tokenizer: str, window: int = 1024) -> DataFrame:
    """Rows (doc_id, start, length, ids_crc32, doc_tokens): every document cut at whole windows.

    A document is its ids and then id 0, so null and empty texts give one piece of one id. Repeated
    rows give pieces of their own.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = _ids(text, tokenizer)
                out += [(doc, s, min(window, len(ids) - s), crc(ids[s:s + window].tobytes()), len(ids)) for s in range(0, len(ids), window)]
            yield pd.DataFrame(out, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    rows = docs.select(whole_id().alias("doc_id"), F.col("text").cast("string"))
    return rows.mapInPandas(run, "doc_id long, start long, length int, ids_crc32 long, doc_tokens long")


@dataclass
class Plan:
    """Where the pieces go. ``places[length]``: rows (first rank, end rank, first sequence, per sequence, offset);
    ``loose[length]``: (first rank, position) of the pieces that are laid end to end."""

    window: int
    places: dict[int, list[tuple[int, int, int, int, int]]] = field(default_factory=dict)
    loose: dict[int, tuple[int, int]] = field(default_factory=dict)
    sequences: int = 0
    loose_tokens: int = 0

    def ends(self) -> list[int]:
        """Ends of the power-of-two sequences behind the last full one, from its end."""
        left, ends = self.loose_tokens % self.window, [0]
        for bit in reversed(range(self.window.bit_length())):
            if left >> bit & 1:
                ends.append(ends[-1] + (1 << bit))
        return ends

    def locate(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sequence, offset and room left there, of positions among the loose pieces."""
        full = self.loose_tokens // self.window
        ends = np.array(self.ends())
        inside = at - full * self.window
        part = np.searchsorted(ends, np.maximum(inside, 0), side="right") - 1
        tail = inside >= 0
        begin = np.where(tail, full * self.window + ends[part], at // self.window * self.window)
        after = np.append(ends, ends[-1])[part + 1]
        end = np.where(tail, full * self.window + after, begin + self.window)
        return self.sequences + np.where(tail, full + part, at // self.window), at - begin, end - at


def fill(counts: dict[int, int], target: int) -> dict[int, int] | None:
    """Lengths and how often each, with sum ``target``, longest first; None if no choice reaches it."""
    reach, steps, want = 1, [], (1 << (target + 1)) - 1
    for length in sorted((k for k in counts if k <= target), reverse=True):
        left, take = min(counts[length], target // length), 1
        while left:
            take = min(take, left)
            steps.append((length, take, reach))
            reach |= reach << (length * take) & want
            left, take = left - take, take * 2
            if reach >> target & 1:
                break
        if reach >> target & 1:
            break
    if not reach >> target & 1:
        return None
    chosen: dict[int, int] = {}
    for length, take, before in reversed(steps):
        if not before >> target & 1:
            chosen[length] = chosen.get(length, 0) + take
            target -= length * take
    return chosen


def make_plan(counts: dict[int, int], window: int = 1024) -> Plan:
    """Sequences for so many pieces of each length; every one but the last few is full."""
    plan, left, used = Plan(window), {k: n for k, n in counts.items() if n}, dict.fromkeys(counts, 0)
    loose: list[int] = []
    while left:
        longest = max(left)
        rest = left | {longest: left[longest] - 1}
        chosen = fill({k: n for k, n in rest.items() if n}, window - longest)
        if chosen is None:
            loose.append(longest)
            del left[longest]
            continue
        chosen[longest] = chosen.get(longest, 0) + 1
        times, offset = min(left[k] // m for k, m in chosen.items()), 0
        for k, m in sorted(chosen.items(), reverse=True):
            plan.places.setdefault(k, []).append((used[k], used[k] + m * times, plan.sequences, m, offset))
            used[k] += m * times
            offset += m * k
            left[k] -= m * times
            if not left[k]:
                del left[k]
        plan.sequences += times
    for k in loose:
        plan.loose[k] = (used[k], plan.loose_tokens)
        plan.loose_tokens += k * (counts[k] - used[k])
    return plan


_OUT = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _placed(rows: DataFrame, plan: Plan) -> DataFrame:
    """Rows as ``_OUT`` and ``at``: a loose piece has its position there instead of a sequence."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rank, length = batch["rank"].to_numpy(), batch["length"].to_numpy()
            sequence, offset, at = (np.full(len(batch), -1, dtype=np.int64) for _ in range(3))
            for k in np.unique(length):
                mine = np.flatnonzero(length == k)
                first, position = plan.loose.get(int(k), (np.iinfo(np.int64).max, 0))
                apart = rank[mine] >= first
                at[mine[apart]] = position + (rank[mine[apart]] - first) * k
                mine = mine[~apart]
                if len(mine):
                    table = np.array(plan.places[int(k)], dtype=np.int64)
                    row = table[np.searchsorted(table[:, 0], rank[mine], side="right") - 1]
                    since = rank[mine] - row[:, 0]
                    sequence[mine] = row[:, 2] + since // row[:, 3]
                    offset[mine] = row[:, 4] + since % row[:, 3] * k
            yield batch.drop(columns="rank").assign(sequence_id=sequence, offset=offset, at=at)

    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    return rows.select(*columns, "rank").mapInPandas(run, _OUT + ", at long")


def _cut(rows: DataFrame, docs: DataFrame, tokenizer: str, plan: Plan) -> DataFrame:
    """Loose pieces that a window's end divides, with the checksums of their parts.

    Only their documents are tokenised again, each against its own pieces; a document is told by its
    id, its length and its piece's checksum, so repeated rows find equal ids.
    """
    ids = rows.select("doc_id").distinct()
    texts = docs.select(whole_id().alias("doc_id"), F.col("text").cast("string")).join(ids, "doc_id", "left_semi")

    def tails(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc, text in zip(batch["doc_id"], batch["text"], strict=True):
                found = _ids(text, tokenizer)
                data = found[(len(found) - 1) // plan.window * plan.window:].tobytes()
                out.append((doc, len(found), crc(data), data))
            yield pd.DataFrame(out, columns=["doc", "tokens", "checksum", "ids"])

    known = texts.mapInPandas(tails, "doc long, tokens long, checksum long, ids binary").dropDuplicates(["doc", "tokens", "checksum"])
    both = rows.join(known, (rows.doc_id == known.doc) & (rows.doc_tokens == known.tokens) & (rows.ids_crc32 == known.checksum))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc, start, length, tokens, at, data in zip(*(batch[c] for c in ("doc_id", "start", "length", "doc_tokens", "at", "ids")), strict=True):
                begin = 0
                while begin < length:
                    sequence, offset, room = (int(v[0]) for v in plan.locate(np.array([at + begin])))
                    end = min(length, begin + room)
                    out.append((doc, start + begin, end - begin, crc(data[4 * begin:4 * end]), tokens, sequence, offset))
                    begin = end
            yield pd.DataFrame(out, columns=[c.split()[0] for c in _OUT.split(", ")])

    return both.select("doc_id", "start", "length", "doc_tokens", "at", "ids").mapInPandas(cut, _OUT)


def pack(docs: DataFrame, tokenizer: str, window: int = 1024) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every id of every document lies in exactly one piece and every sequence but those shorter than
    the window is full; shorter ones have a power of two of ids. Sequence ids are gapless from 0. The
    window must be a power of two. An empty table gives no rows.
    """
    if window & (window - 1):
        raise ValueError("the window must be a power of two")
    rows = saved(pieces(docs, tokenizer, window), "pack-pieces")
    counts = {r.length: r.n for r in rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `window` rows
    plan = make_plan(counts, window)
    placed = saved(_placed(ranked(rows, "length", ["doc_id", "start", "ids_crc32", "doc_tokens"], "pack-lengths"), plan), "pack-placed")

    done = placed.where("at < 0").drop("at")
    loose = placed.where("at >= 0")

    def locate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sequence, offset, room = plan.locate(batch["at"].to_numpy())
            yield batch.assign(sequence_id=sequence, offset=offset, whole=room >= batch["length"].to_numpy())

    loose = saved(loose.mapInPandas(locate, _OUT + ", at long, whole boolean"), "pack-loose")
    whole = loose.where("whole").drop("at", "whole")
    return done.unionByName(whole).unionByName(_cut(loose.where("NOT whole"), docs, tokenizer, plan)).withColumn("doc_id", id_again())
