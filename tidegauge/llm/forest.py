"""Embedding near-duplicates by a forest of random-projection trees with spill.

A tree splits its vectors by their projections on a random direction, one direction per tree and
depth, again and again until a leaf is small. The cut is where the fewest vectors lie near it, and
those go to both sides, so that close pairs are seldom parted, and each tree parts others. Where many
lie near every cut, as in one dense group, the leaf is not split. The number of trees grows with the
depth that the table needs. Within the leaves all pairs are
verified in double precision. A pair that meets in several leaves counts in the smallest of them
only, which each side tells from the list of its own leaves, so no pairs are written.

The first levels are fitted on a bounded sample drawn by a hash; leaves that are still large then
are fitted further, each on a bounded sample of its own rows, in further rounds. A leaf that can't
be split, as one of near copies, is compared block against block, so it is whole as well.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import connected_components, saved
from tidegauge.llm.vectors import matrix, unit, usable, with_class

TREES = 8  # at least
PARTED = 0.021  # chance that a split parts a pair at the threshold, of vectors in all directions
MISSED = 1e-6  # chance that all trees part it
LEAF = 1024  # vectors in a leaf, about, and rows of a block when a leaf stays larger
SAMPLE = 16_384  # rows that a round of splits is fitted on
LEAST_SAMPLE = 64  # rows of a sample that a split needs
LEVELS = 8  # splits in a round
SPILL = 0.5  # half width of the strip that goes both ways, in deviations of a close pair's projected distance
SEED = 23
MOST_BOTH = 0.25  # of a leaf's rows may go both ways in a split; a cut through a dense group parts its pairs
CUTS = np.linspace(0.25, 0.75, 33)  # quantiles that a cut is chosen from
_DEPTH_BITS = 46  # a leaf is tree * 2^46 + path, the path with a leading 1


def direction(tree: int, depth: int, width: int) -> np.ndarray:
    v = np.random.default_rng([SEED, tree, depth]).standard_normal(width)
    return v / np.linalg.norm(v)


def margin(threshold: float, width: int) -> float:
    return SPILL * float(np.sqrt(max(0.0, 2 - 2 * threshold) / width))


def trees_for(total: int) -> int:
    """Trees that a table of ``total`` rows needs for ``MISSED``, with a fifth more levels than halves."""
    levels = max(1.0, 1.2 * np.log2(max(1, total) / LEAF))
    return max(TREES, int(np.ceil(np.log(MISSED) / np.log(1 - (1 - PARTED) ** levels))))


def thinnest_cut(at: np.ndarray, strip: float) -> tuple[float, float]:
    """The cut between the quarters with the fewest rows within ``strip`` of it, and their share; the middle one of equals."""
    ordered = np.sort(at)
    cuts = np.quantile(ordered, CUTS)
    near = np.searchsorted(ordered, cuts + strip, "right") - np.searchsorted(ordered, cuts - strip, "right")
    best = np.lexsort((np.abs(CUTS - 0.5), near))[0]
    return float(cuts[best]), float(near[best] / len(at))


def fit_splits(sample: np.ndarray, tree: int, depth: int, total: int, strip: float, leaf: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Cuts and states of a subtree as heaps from index 1: a cut, or NaN at its leaves.

    ``total`` is how many rows the sample stands for. State 1: small enough, or splits no more;
    state 2: to be fitted further on a larger sample.
    """
    leaf = leaf or LEAF
    cuts, state = np.full(1 << (LEVELS + 1), np.nan), np.zeros(1 << (LEVELS + 1), dtype=np.int8)
    each = total / max(1, len(sample))
    todo = [(1, 0, np.arange(len(sample)))]
    while todo:
        node, level, rows = todo.pop()
        if len(rows) * each <= leaf:
            state[node] = 1
            continue
        if level == LEVELS or len(rows) < LEAST_SAMPLE and len(rows) < total:
            state[node] = 2
            continue
        at = sample[rows] @ direction(tree, depth + level, sample.shape[1])
        cut, both = thinnest_cut(at, strip)
        left, right = rows[at <= cut + strip], rows[at > cut - strip]
        if both > MOST_BOTH or max(len(left), len(right)) > 0.9 * len(rows):
            state[node] = 1
            continue
        cuts[node] = cut
        todo += [(2 * node, level + 1, left), (2 * node + 1, level + 1, right)]
    return cuts, state


def descend(vectors: np.ndarray, cuts: np.ndarray, tree: int, depth: int, strip: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, node) of every subtree leaf that each vector reaches."""
    rows, nodes = np.arange(len(vectors)), np.ones(len(vectors), dtype=np.int64)
    done = []
    for level in range(LEVELS + 1):
        cut = cuts[nodes]
        inner = ~np.isnan(cut)
        done.append((rows[~inner], nodes[~inner]))
        rows, nodes, cut = rows[inner], nodes[inner], cut[inner]
        if not len(rows):
            break
        at = (vectors @ direction(tree, depth + level, vectors.shape[1]))[rows]
        left, right = at <= cut + strip, at > cut - strip
        rows, nodes = np.concatenate([rows[left], rows[right]]), np.concatenate([2 * nodes[left], 2 * nodes[right] + 1])
    return np.concatenate([d[0] for d in done]), np.concatenate([d[1] for d in done])


def _below(leaf: np.ndarray, node: np.ndarray) -> np.ndarray:
    """The leaf number of a subtree's node under the leaf that the subtree replaces."""
    levels = np.floor(np.log2(node)).astype(np.int64)
    tree, path = leaf >> _DEPTH_BITS, leaf & ((1 << _DEPTH_BITS) - 1)
    return (tree << _DEPTH_BITS) | (path << levels) | (node - (np.int64(1) << levels))


def _depth(leaf: int) -> int:
    return int(leaf & ((1 << _DEPTH_BITS) - 1)).bit_length() - 1


_LEAVES = "rep long, leaf long, more boolean"


def _first_round(classes: DataFrame, trees: int, strip: float, total: int) -> DataFrame:
    drawn = F.pmod(F.xxhash64("rep", F.lit(SEED)), F.lit(1 << 30)) < int(min(1.0, SAMPLE / max(1, total)) * (1 << 30))
    sample = classes.where(drawn).orderBy("rep").limit(2 * SAMPLE).toPandas()  # a bounded sample; the limit only guards it
    near = unit(matrix(sample["embedding"])) if len(sample) else np.zeros((0, 1))
    fitted = [fit_splits(near, t, 0, total, strip) for t in range(trees)]

    def run(batches):
        for batch in batches:
            vectors, reps = unit(matrix(batch["embedding"])), batch["rep"].to_numpy()
            for t, (cuts, state) in enumerate(fitted):
                rows, nodes = descend(vectors, cuts, t, 0, strip)
                yield pd.DataFrame({"rep": reps[rows], "leaf": (np.int64(t) << _DEPTH_BITS) | nodes, "more": state[nodes] == 2})

    return classes.select("rep", "embedding").mapInPandas(run, _LEAVES)


def _next_round(classes: DataFrame, large: DataFrame, strip: float) -> DataFrame:
    """The leaves of ``large`` (rep, leaf), split further."""
    sizes = large.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"))
    rows = large.join(sizes, "leaf").join(classes.select("rep", "embedding"), "rep")
    drawn = rows.where(F.pmod(F.xxhash64("rep", "leaf"), F.lit(1 << 30)) < F.least(F.lit(1.0), SAMPLE / F.col("n")) * (1 << 30))

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("rep")
        leaf = int(group["leaf"].iloc[0])
        cuts, state = fit_splits(unit(matrix(group["embedding"])), leaf >> _DEPTH_BITS, _depth(leaf), int(group["n"].iloc[0]), strip)
        state[1] = 1 if np.isnan(cuts[1]) else state[1]  # not split at all: it won't be next time
        return pd.DataFrame([{"leaf": leaf, "cuts": cuts.tobytes(), "state": state.tobytes()}])

    fitted = saved(drawn.select("leaf", "n", "rep", "embedding").groupBy("leaf").applyInPandas(fit, "leaf long, cuts binary, state binary"), "forest-cuts")

    def run(batches):
        for batch in batches:
            for leaf, group in batch.groupby("leaf"):
                cuts, state = np.frombuffer(group["cuts"].iloc[0]), np.frombuffer(group["state"].iloc[0], dtype=np.int8)
                rows, nodes = descend(unit(matrix(group["embedding"])), cuts, int(leaf) >> _DEPTH_BITS, _depth(int(leaf)), strip)
                yield pd.DataFrame({"rep": group["rep"].to_numpy()[rows], "leaf": _below(np.int64(leaf), nodes), "more": state[nodes] == 2})

    return rows.select("rep", "leaf", "embedding").join(fitted, "leaf").mapInPandas(run, _LEAVES)


def _forest(classes: DataFrame, threshold: float, trees: int | None, width: int, total: int) -> DataFrame:
    """Rows (rep, leaf): every leaf of every tree that each of ``total`` classes of one width is in."""
    trees = trees or trees_for(total)
    strip = margin(threshold, width)
    rows = saved(_first_round(classes, trees, strip, total), "forest-leaves")
    done = rows.where("NOT more")
    while rows.where("more").limit(1).count():
        rows = saved(_next_round(classes, rows.where("more").select("rep", "leaf"), strip), "forest-leaves")
        done = done.unionAll(rows.where("NOT more"))
    return done.select("rep", "leaf").distinct()


def leaves(classes: DataFrame, threshold: float, trees: int | None = None) -> DataFrame:
    """Rows (rep, width, leaf): every leaf of every tree that each class of vectors is in.

    Each width has a forest of its own, but for widths of at most ``LEAF`` classes, which are one leaf.
    """
    sizes = saved(classes.groupBy(F.size("embedding").alias("width")).agg(F.count(F.lit(1)).alias("total")), "forest-widths")
    large = [(r.width, r.total) for r in sizes.where(F.col("total") > LEAF).orderBy("width").collect()]  # few: each is a table's worth
    own = classes.withColumn("width", F.size("embedding"))
    out = own.where(~F.col("width").isin([w for w, _ in large])).select("rep", "width", F.lit(0).cast("long").alias("leaf"))
    for width, total in large:
        mine = _forest(own.where(F.col("width") == width).drop("width"), threshold, trees, width, total)
        out = out.unionAll(mine.select("rep", F.lit(width).alias("width"), "leaf"))
    return out


_FOUND = "rep long, links long, root long"


def _verify(group: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Links within a leaf, or between two blocks of one: their weight per class, and a local root.

    A linked pair is counted only if no smaller leaf holds both; every linked pair joins the roots.
    """
    nothing = pd.DataFrame({"rep": [], "links": [], "root": []}).astype("int64")
    leaf, i, j = (int(group[c].iloc[0]) for c in ("leaf", "i", "j"))
    if len(group) < 2:
        return nothing
    group = group.sort_values("rep")
    near = unit(matrix(group["embedding"]))
    close = near @ near.T >= threshold
    block = group["block"].to_numpy()
    if i != j:
        close &= block[:, None] != block[None, :]
    np.fill_diagonal(close, False)
    some = np.flatnonzero(close.any(axis=1))
    if not len(some):
        return nothing
    close, group = close[np.ix_(some, some)], group.iloc[some]
    reps, weight = group["rep"].to_numpy(np.int64), group["n"].to_numpy(np.int64)
    earlier = [np.asarray(x)[np.asarray(x) < leaf] for x in group["leaves"]]
    names, at = np.unique(np.concatenate(earlier), return_inverse=True)
    held = np.zeros((len(some), len(names)), dtype=np.float32)
    held[np.repeat(np.arange(len(some)), [len(x) for x in earlier]), at] = 1
    fresh = close & ~(held @ held.T > 0)
    links = fresh @ weight
    label = np.arange(len(some))  # reps are sorted, so the smallest label is the smallest rep
    while True:
        least = np.minimum(label, np.where(close, label[None, :], len(some)).min(axis=1))
        least = np.minimum(least, least[least])
        if (least == label).all():
            break
        label = least
    return pd.DataFrame({"rep": reps, "links": links, "root": reps[label]})


def links(classes: DataFrame, threshold: float, trees: int | None = None) -> DataFrame:
    """Rows (rep, links, root), several per class: how many vectors link to it, and a linked root."""
    own = saved(leaves(classes, threshold, trees), "forest-own")
    sizes = own.groupBy("width", "leaf").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    # the list of a class is bounded by the trees and their spill, not by the table
    lists = own.groupBy("rep").agg(F.array_sort(F.collect_list("leaf")).alias("leaves"))
    rows = classes.join(lists, "rep").withColumn("width", F.size("embedding")).withColumn("leaf", F.explode("leaves")).join(sizes, ["width", "leaf"])
    blocks = F.ceil(F.col("size") / LEAF).cast("int")
    rows = rows.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("rep", "leaf"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select(
        "width", "leaf", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "rep", "n", "embedding", "leaves"
    )
    return rows.groupBy("width", "leaf", "i", "j").applyInPandas(lambda g: _verify(g, threshold), _FOUND)


def near_duplicates(embeddings: DataFrame, threshold: float = 0.95, trees: int | None = None) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors of one width link where their cosine is at least ``threshold``. Equal vectors link with each other
    and are one class in the forest, so copies are never paired. Rows that repeat id and vector
    count once. Vectors that ``usable`` leaves out link with nothing, are components of their own and
    are kept; so are rows with a null id, whose component is null. An empty table gives no rows.
    """
    rows = saved(usable(embeddings), "forest-rows")
    members, classes = with_class(rows)
    found = saved(links(classes, threshold, trees), "forest-links")
    edges = found.where("rep != root").select(F.col("rep").alias("a"), F.col("root").alias("b"))
    linked = connected_components(edges, "forest-edges").withColumnRenamed("node", "rep")
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    whole = classes.select("rep", "n").join(counts, "rep", "left").join(linked, "rep", "left").select(
        "rep", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).cast("long").alias("n_links"), F.coalesce("component", "rep").alias("component_id")
    )
    out = members.join(whole, "rep").groupBy("vec_id").agg(
        F.sum("n_links").cast("long").alias("n_links"), F.min("component_id").alias("component_id")
    )
    rest = embeddings.select(F.col("vec_id").cast("long").alias("vec_id")).where("vec_id IS NOT NULL").join(rows, "vec_id", "left_anti").distinct()
    nulls = embeddings.where("vec_id IS NULL").select(F.col("vec_id").cast("long").alias("vec_id"))
    alone = rest.unionAll(nulls).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionAll(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
