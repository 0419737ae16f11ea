"""Near-duplicates: SimHash fingerprints, pigeonhole blocks, verified Hamming distance, components; and
for a given similarity min-hash keys, verified on the sets of shingles."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm.common import connected_components, id_again, saved, text_or_empty, whole_id

BITS = 64
SEED = 42
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_AT_ONCE = 1 << 15  # shingles whose bits are summed at a time


def _hashes(text: str | None, shingle: int) -> Iterator[np.ndarray]:
    """Hashes of the shingles in order, some at a time; a text of fewer words is one shingle, one without words has none."""
    words = _WORD.findall((text or "").encode().lower())  # bytes.lower() changes A-Z alone
    if not words:
        return
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    ends = ends.tolist()
    n, last = max(1, len(words) - shingle + 1), min(shingle, len(words)) - 1
    digest = xxhash.xxh64_intdigest
    for low in range(0, n, _AT_ONCE):
        high = min(n, low + _AT_ONCE)
        yield np.fromiter(
            (digest(joined[starts[i]:ends[i + last]], SEED) for i in range(low, high)), dtype=np.uint64, count=high - low
        )


def fingerprint(text: str | None, shingle: int) -> int:
    """Majority bits of the shingles' hashes; 0 without words."""
    return majority(_hashes(text, shingle))


def majority(parts: Iterable[np.ndarray]) -> int:
    """The bits that over half of the hashes have; 0 without any."""
    ones, n = np.zeros(BITS, dtype=np.int64), 0
    for hashes in parts:
        ones += np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
        n += len(hashes)
    return int(np.packbits(ones * 2 > n).view(">u8")[0])


def shingle_set(text: str | None, shingle: int) -> np.ndarray:
    """The distinct hashes of the shingles, in order."""
    return np.unique(np.concatenate([np.zeros(0, dtype=np.uint64), *_hashes(text, shingle)]))


def fingerprints(docs: DataFrame, shingle: int = 5) -> DataFrame:
    """Rows (doc_id, text_key, fp): the fingerprint of every whole text as a signed long; null texts are empty."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t, shingle) for t in batch["text"]), dtype=np.uint64, count=len(batch))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "text_key": batch["text_key"], "fp": fps.view(np.int64)})

    rows = docs.select(whole_id().alias("doc_id"), _text_key().alias("text_key"), F.col("text").cast("string"))
    return rows.mapInPandas(run, "doc_id long, text_key long, fp long").withColumn("doc_id", id_again())


def _bounds(blocks: int) -> list[tuple[int, int]]:
    cuts = [round(i * BITS / blocks) for i in range(blocks + 1)]
    return list(zip(cuts, cuts[1:], strict=False))


def block_masks(bits: int, shared: int) -> list[int]:
    """One mask per choice of ``shared`` of ``bits + shared`` blocks.

    At most ``bits`` differing bits touch at most that many blocks, so the other ``shared`` agree:
    a pair within the distance has equal bits under at least one mask.
    """
    parts = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in _bounds(bits + shared)]
    return [sum(chosen) for chosen in combinations(parts, shared)]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def close_links(fps: DataFrame, bits: int = 2, shared: int = 3, pairs_up_to: int = 64) -> DataFrame:
    """Links (a, b) between distinct fingerprints whose components are those of Hamming distance <= ``bits``.

    ``fps`` has one row per distinct fingerprint, column fp. A block with at most ``pairs_up_to``
    fingerprints is joined with itself and every pair's distance is verified. In a larger block that
    would be all pairs of a group, so there each fingerprint names the points half the distance away
    from it, at most ``(bits + 1) // 2`` flips of the bits outside the block, and links to the
    smallest fingerprint that names the same point. Two fingerprints that share a point differ in at
    most ``bits`` bits, or ``bits + 1`` where that is odd, which the last filter drops, and two
    within an even distance share the point half way, so this is exact for even ``bits``.
    """
    if bits % 2:
        raise ValueError("an even number of bits is needed for large blocks")
    masks = block_masks(bits, shared)
    keys = fps.select("fp", F.posexplode(F.array(*[
        F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in masks
    ])).alias("mask", "block"))
    sizes = keys.groupBy("mask", "block").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    found = saved(keys.join(sizes, ["mask", "block"]), "simhash-blocks")

    small = found.where(F.col("n") <= pairs_up_to).select("mask", "block", "fp")
    pairs = small.select("mask", "block", F.col("fp").alias("a")).join(
        small.select("mask", "block", F.col("fp").alias("b")), ["mask", "block"]
    ).where("a < b").where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= bits).select("a", "b")

    # points half way: flip up to bits/2 of the bits that the block leaves free
    outside = F.element_at(F.array(*[F.lit(_signed(((1 << BITS) - 1) ^ m)) for m in masks]), F.col("mask") + 1)
    flips = [0]
    for k in range(1, bits // 2 + 1):
        flips += [sum(1 << p for p in chosen) for chosen in combinations(range(BITS), k)]
    points = (
        found.where(F.col("n") > pairs_up_to)
        .select("mask", "block", "fp", outside.alias("free"), F.explode(F.array(*[F.lit(_signed(f)) for f in flips])).alias("flip"))
        .where(F.col("flip").bitwiseAND(F.col("free")) == F.col("flip"))
        .select("mask", "block", "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("point"))
    )
    least = points.groupBy("mask", "block", "point").agg(F.min("fp").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1")
    stars = points.join(least, ["mask", "block", "point"]).where("fp != a").select("a", F.col("fp").alias("b"))
    return pairs.unionAll(stars.distinct())


def near_duplicates(docs: DataFrame, shingle: int = 5, bits: int = 2, shared: int = 3) -> DataFrame:
    """One row (doc_id, fp, component_id, text_key, component) per document row.

    Documents with fingerprints at most ``bits`` apart are linked; ``component_id`` is the smallest
    doc_id reachable. Equal fingerprints are one class, so copies are never paired. Null texts are
    empty; texts without words have fingerprint 0 and link like any other; a class whose doc_ids are
    all null has a null component. Repeated rows come back repeated. An empty table gives no rows.
    ``text_key`` and ``component`` tell texts and components also where doc_ids are null or repeated.
    """
    prints = saved(fingerprints(docs, shingle), "simhash-prints")
    classes = saved(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-classes")
    linked = connected_components(close_links(classes.select("fp"), bits, shared), "simhash-links")
    whole = classes.join(linked, classes.fp == linked.node, "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("component")
    )
    whole = saved(whole, "simhash-whole")
    smallest = whole.groupBy("component").agg(F.min("first").alias("component_id"))
    ids = whole.join(smallest, "component").select("fp", "component_id", "component")
    return prints.join(ids, "fp").select("doc_id", "fp", "component_id", "text_key", "component")


TABLES, KEY_BYTES = 40, 6  # tables, and minima in a table's key; at 0.8 all keys differ five times in a million
LEAST_SIMILAR = 0.8
LEAST_EQUAL = 160  # of a sketch's 240 bytes: at 0.8 there are 192 and a deviation of 6
CHUNK = 2048  # rows of a block that are compared with each other at once
CHUNK_SHINGLES = 1 << 20  # shingles of those rows, about
FEW = 32  # rows of a group that are compared by shifting
_FACTORS = np.random.default_rng(SEED).integers(0, 1 << 64, TABLES * KEY_BYTES, dtype=np.uint64) | np.uint64(1)


def sketch(hashes: np.ndarray) -> np.ndarray:
    """One byte of each of ``TABLES * KEY_BYTES`` minima over a set of hashes; two sets agree in a byte about as often as they are similar."""
    least = np.full(len(_FACTORS), (1 << 64) - 1, dtype=np.uint64)
    for low in range(0, len(hashes), 256):
        np.minimum(least, (_FACTORS[:, None] * hashes[None, low:low + 256]).min(axis=1), out=least)
    return (least >> np.uint64(24)).astype(np.uint8)


def _sketches(docs: DataFrame, shingle: int) -> DataFrame:
    """Rows (doc_id, text_key, fp, print, sketch): 64 bits of the text, 64 bits that tell its set of shingles, and the
    set's fingerprint and sketch."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fps, prints, sketches = [], [], []
            for text in batch["text"]:
                hashes = shingle_set(text, shingle)
                fps.append(xxhash.xxh64_intdigest(hashes.tobytes(), SEED))
                prints.append(majority(hashes[low:low + _AT_ONCE] for low in range(0, len(hashes), _AT_ONCE)))
                sketches.append(sketch(hashes).tobytes())
            yield pd.DataFrame({
                "doc_id": batch["doc_id"], "text_key": batch["text_key"], "fp": np.array(fps, dtype=np.uint64).view(np.int64),
                "print": np.array(prints, dtype=np.uint64).view(np.int64), "sketch": sketches,
            })

    rows = docs.select(whole_id().alias("doc_id"), _text_key().alias("text_key"), F.col("text").cast("string"))
    return rows.mapInPandas(run, "doc_id long, text_key long, fp long, print long, sketch binary")


def _text_key() -> Column:
    return F.xxhash64(text_or_empty())


def _keys(classes: DataFrame) -> DataFrame:
    """Rows (key, fp): one per table and class."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            bytes_ = np.frombuffer(b"".join(batch["sketch"]), dtype=np.uint8).reshape(len(batch), TABLES, KEY_BYTES).astype(np.int64)
            for t in range(TABLES):
                key = np.full(len(batch), t, dtype=np.int64)
                for c in range(KEY_BYTES):
                    key = key << 8 | bytes_[:, t, c]
                yield pd.DataFrame({"key": key, "fp": batch["fp"]})

    return classes.select("fp", "sketch").mapInPandas(run, "key long, fp long")


def _roots(block: np.ndarray, apart: bool, linked: Callable[[int, np.ndarray], np.ndarray]) -> np.ndarray:
    """The smallest row of each row's part; ``linked`` tells which of the given rows link to one.

    Rows that are in one part already are not compared, so a group of near copies takes few rounds.
    ``apart`` leaves out pairs within a block.
    """
    label = np.arange(len(block))
    for p in range(len(block) - 1):
        rest = p + 1 + np.flatnonzero((label[p + 1:] != label[p]) & (block[p + 1:] != block[p] if apart else True))
        if not len(rest):
            continue
        hit = rest[linked(p, rest)]
        if len(hit):
            joined = np.unique(np.append(label[hit], label[p]))
            label[np.isin(label, joined)] = joined[0]
    return label


def _alike(rows: pd.DataFrame) -> pd.DataFrame:
    """Links (a, b) of whole groups by their sketches, one for each row but the first of its part."""
    sketches = np.frombuffer(b"".join(rows["sketch"]), dtype=np.uint8).reshape(len(rows), -1)
    group, block, fp = (rows[c].to_numpy() for c in ("group", "block", "fp"))
    apart = rows["i"].to_numpy() != rows["j"].to_numpy()
    starts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    counts = np.diff(np.append(starts, len(rows)))
    few = np.repeat(counts <= FEW, counts)
    a, b, shift = [], [], 1
    while shift < min(FEW, len(rows)):
        at = np.flatnonzero((group[shift:] == group[:-shift]) & few[shift:])
        if not len(at):
            break
        at = at[~apart[at] | (block[at] != block[at + shift])]
        at = at[(sketches[at] == sketches[at + shift]).sum(axis=1) >= LEAST_EQUAL]
        a.append(at)
        b.append(at + shift)
        shift += 1
    for low, n in zip(starts[counts > FEW], counts[counts > FEW], strict=True):
        part = sketches[low:low + n]
        label = _roots(block[low:low + n], apart[low], lambda p, rest: (part[rest] == part[p]).sum(axis=1) >= LEAST_EQUAL)  # noqa: B023
        moved = np.flatnonzero(label != np.arange(n))
        a.append(low + label[moved])
        b.append(low + moved)
    a, b = (np.concatenate([np.zeros(0, dtype=np.int64), *x]) for x in (a, b))
    return pd.DataFrame({"a": fp[a], "b": fp[b]}).drop_duplicates()


def _similar_enough(rows: pd.DataFrame, least: float) -> pd.DataFrame:
    """Links (a, b) of whole groups by the exact similarity of their sets, one for each row but the first of its part."""
    out = []
    for _, part in rows.groupby("group", sort=False):
        sets = [np.frombuffer(x, dtype=np.uint64) for x in part["hashes"]]
        sizes = np.array([len(x) for x in sets])
        ends = np.cumsum(sizes)
        starts = ends - sizes
        names, ids = np.unique(np.concatenate(sets), return_inverse=True)
        flags = np.zeros(len(names), dtype=np.int64)

        def linked(p: int, rest: np.ndarray) -> np.ndarray:
            flags[ids[starts[p]:ends[p]]] = 1  # noqa: B023
            both = np.add.reduceat(flags[ids], starts)[rest]  # noqa: B023
            flags[ids[starts[p]:ends[p]]] = 0  # noqa: B023
            return both / (sizes[p] + sizes[rest] - both) >= least  # noqa: B023

        label = _roots(part["block"].to_numpy(), part["i"].iloc[0] != part["j"].iloc[0], linked)
        moved, fp = np.flatnonzero(label != np.arange(len(part))), part["fp"].to_numpy()
        out.append(pd.DataFrame({"a": fp[label[moved]], "b": fp[moved]}))
    return pd.concat(out)


def _by_group(batches: Iterator[pd.DataFrame], compare: Callable[[pd.DataFrame], pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """``compare`` on rows in order of (key, i, j), whole groups at a time, numbered by a column group."""
    waiting = None
    for batch in batches:
        rows = batch if waiting is None else pd.concat([waiting, batch], ignore_index=True)
        if not len(rows):
            continue
        changed = (rows["key"].diff().ne(0) | rows["i"].diff().ne(0) | rows["j"].diff().ne(0)).to_numpy()
        rows = rows.assign(group=np.cumsum(changed))
        last = int(np.flatnonzero(changed)[-1])
        if last:
            yield compare(rows.iloc[:last])
        waiting = rows.iloc[last:].drop(columns="group")
    if waiting is not None:
        yield compare(waiting.assign(group=0))


def _blocks(rows: DataFrame, chunks: Column, column: str) -> DataFrame:
    """Rows (key, i, j, block, fp, ``column``), together where i, j are a pair of a key's blocks."""
    rows = rows.withColumn("chunks", chunks.cast("int")).withColumn("block", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    rows = rows.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "fp", column)
    return rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "fp")


def _sets(docs: DataFrame, classes: DataFrame, shingle: int) -> DataFrame:
    """``classes`` (key, fp, text_key) with the set of shingles as ``hashes`` and its size ``n``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [shingle_set(t, shingle) for t in batch["text"]]
            yield pd.DataFrame({"key": batch["key"], "fp": batch["fp"], "n": [len(x) for x in sets], "hashes": [x.tobytes() for x in sets]})

    texts = docs.select(_text_key().alias("text_key"), F.col("text").cast("string"))
    rows = texts.join(classes, "text_key").groupBy("key", "fp").agg(F.first("text").alias("text"))
    return rows.mapInPandas(run, "key long, fp long, n long, hashes binary").where("n > 0")


def _close_classes(classes: DataFrame, bits: int = 2) -> DataFrame:
    """Links (a, b) of classes (fp, print) whose fingerprints are at most ``bits`` apart, as ``close_links`` finds them."""
    first = saved(classes.groupBy("print").agg(F.min("fp").alias("a")), "simhash-first")
    equal = classes.join(first, "print").where("fp != a").select("a", F.col("fp").alias("b"))
    close = close_links(first.select(F.col("print").alias("fp")), bits).withColumnsRenamed({"a": "low", "b": "high"})
    ends = close.join(first.select(F.col("print").alias("low"), "a"), "low").join(
        first.select(F.col("print").alias("high"), F.col("a").alias("b")), "high"
    )
    return equal.unionAll(ends.select("a", "b"))


def similar(docs: DataFrame, shingle: int = 5, least: float = LEAST_SIMILAR) -> DataFrame:
    """One row (doc_id, component_id, text_key, component) per document row; texts are linked if their
    sets of shingles have a Jaccard similarity of ``least`` or more.

    Texts with equal sets are one class, told by 64 bits of the set. Classes whose fingerprints are at most 2 bits
    apart, found in pigeonhole blocks, are candidates. Fingerprints that close miss most edited copies, so
    classes that agree in six minima of one of ``TABLES`` tables are compared by their sketches too, and what
    either way finds is joined to candidate groups. Within a group the sets themselves are compared, so no link is an estimate: a
    link can only be missed where no key agrees and nothing else brings the two into one group. Groups of any
    size are compared whole, in pairs of blocks. Nulls, empties and repeated rows as in
    ``near_duplicates``.
    """
    prints = saved(_sketches(docs, shingle), "simhash-sketches")
    classes = saved(prints.groupBy("fp").agg(
        F.min("doc_id").alias("first"), F.min("text_key").alias("text_key"), F.first("print").alias("print"), F.first("sketch").alias("sketch")
    ), "simhash-sets")
    keys = saved(_keys(classes), "simhash-keys")
    sizes = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    rows = keys.join(sizes, "key").join(classes.select("fp", "sketch"), "fp")
    rows = _blocks(rows, F.ceil(F.col("n") / CHUNK), "sketch")
    alike = rows.mapInPandas(lambda b: _by_group(b, _alike), "a long, b long")
    maybe = connected_components(_close_classes(classes.select("fp", "print")).unionAll(alike), "simhash-maybe")
    groups = maybe.select(F.col("node").alias("fp"), F.col("component").alias("key")).join(classes.select("fp", "text_key"), "fp")
    sets = saved(_sets(docs, groups, shingle), "simhash-groups")
    sizes = sets.groupBy("key").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("shingles"))
    chunks = F.least(F.col("rows"), F.greatest(F.ceil(F.col("rows") / CHUNK), F.ceil(F.col("shingles") / CHUNK_SHINGLES)))
    found = _blocks(sets.join(sizes, "key"), chunks, "hashes").mapInPandas(
        lambda b: _by_group(b, lambda rows: _similar_enough(rows, least)), "a long, b long"
    )
    linked = connected_components(found, "simhash-similar")
    whole = classes.join(linked, classes.fp == linked.node, "left").select("fp", "first", F.coalesce("component", "fp").alias("component"))
    whole = saved(whole, "simhash-parts")
    smallest = whole.groupBy("component").agg(F.min("first").alias("component_id"))
    ids = whole.join(smallest, "component").select("fp", "component_id", "component")
    return prints.join(ids, "fp").select(id_again().alias("doc_id"), id_again("component_id").alias("component_id"), "text_key", "component")


def keep_one(docs: DataFrame, marked: DataFrame) -> DataFrame:
    """``docs`` without the near-duplicates: the row with the smallest doc_id of each group stays.

    ``marked`` is what ``near_duplicates`` or ``similar`` give. Rows are told by doc_id and text, so of
    rows with one doc_id only those of one group are reduced to one. Rows with a null doc_id can't be
    told from each other; they all stay.
    """
    gone = marked.where("doc_id != component_id OR doc_id IS NOT NULL AND component_id IS NULL").select("doc_id", "text_key").distinct()
    again = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 AND doc_id IS NOT NULL").select("doc_id")
    parts = marked.join(again, "doc_id", "left_semi").select("doc_id", "text_key", "component").distinct()
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", _text_key().alias("text_key"))
    kept = row.join(gone, ["doc_id", "text_key"], "left_anti")
    once = kept.join(again, "doc_id", "left_anti").select("row")
    order = Window.partitionBy("doc_id", "component").orderBy("text_key")
    one = kept.join(parts, ["doc_id", "text_key"]).withColumn("n", F.row_number().over(order)).where("n = 1").select("row")
    return once.unionAll(one).select("row.*")
