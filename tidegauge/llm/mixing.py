"""Mix sources to target weights by weighted sampling without replacement (Efraimidis-Spirakis).

Every document draws a key ``-ln(u) / w`` with u from a hash of its id and w its quality weight; the
documents with the smallest keys of a source are its weighted sample. A source whose target is k
times its size is taken k whole times, and what is left of the target is filled with the documents of
smallest keys, the last one in part. Keys are cut into buckets of the key range, so that the prefix
sum over a source is one over small bucket totals and only the rows of one bucket per source are
ever sorted: a source with a third of all rows costs no more than others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm.common import saved, text_or_empty, word_count

WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
LEAST_QUALITY, MOST_QUALITY = 0.5, 1.5
ROWS_PER_BUCKET = 4096
SEED = "mix-1"

_SOURCE, _SIZE, _KEY, _ROW = "__mix_source", "__mix_size", "__mix_key", "__mix_row"


def length_quality(size: Column) -> Column:
    """A plain quality weight: longer documents, up to 400 words, are likelier."""
    return F.least(F.lit(MOST_QUALITY), LEAST_QUALITY + size / F.lit(400.0))


def keyed(docs: DataFrame, quality: Column | None = None) -> DataFrame:
    """``docs`` as one column ``__mix_row``, with source, size in words and sampling key.

    A null source becomes a source of its own; a quality weight outside [0.5, 1.5] counts as the
    nearest bound, a null one as 1.
    """
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(_ROW),
        F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col("source").cast("string"))).alias(_SOURCE),
        word_count(text_or_empty()).alias(_SIZE),
        (quality if quality is not None else F.lit(None).cast("double")).alias("__mix_quality"),
    )
    weight = F.greatest(F.lit(LEAST_QUALITY), F.least(F.lit(MOST_QUALITY), F.coalesce(
        "__mix_quality", length_quality(F.col(_SIZE))
    )))
    digits = F.substring(F.md5(F.concat(F.lit(SEED + ":"), F.coalesce(F.col(f"{_ROW}.doc_id").cast("string"), F.lit("")))), 1, 13)
    uniform = (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 52)
    return rows.select(_ROW, _SOURCE, _SIZE, (-F.log(uniform) / weight).alias(_KEY))


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """Rows (__mix_source, n, source_size, target): the whole size shared out by weight.

    Sources by code point, null last, take the weights in turn. A target above ``most`` times its
    source's size stops there and the excess goes to the others by weight, until none is above:
    sources ordered by cap per weight are capped up to the first one that its share does not fill.
    """
    # "n" sorts before "s", so the null source is put last by its first letter
    by_code_point = Window.orderBy(F.substring(_SOURCE, 1, 1).desc(), _SOURCE)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("__i") % len(weights) + 1).cast("int"))
    rows = sizes.withColumn("__i", F.row_number().over(by_code_point) - 1).withColumn("__w", w)
    rows = rows.withColumn("__cap", F.col("source_size") * most)
    order = Window.orderBy(F.col("__cap") / F.col("__w"), "__i")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy(F.lit(1))
    rows = rows.withColumn("__level", (
        F.sum("source_size").over(whole) - F.coalesce(F.sum("__cap").over(before), F.lit(0))
    ) / F.sum("__w").over(after))
    ratio = F.col("__cap") / F.col("__w")
    share = F.min_by("__level", F.when(F.col("__level") <= ratio, F.struct(ratio, F.col("__i")))).over(whole)
    return rows.withColumn("__share", share).select(
        _SOURCE, "n", "source_size",
        F.least(F.col("__share") * F.col("__w"), F.col("__cap").cast("double")).alias("target"),
    )


def _bucket() -> Column:
    """Bucket of a key, in key order; none holds more than three times the mean of its source."""
    buckets = 1 + F.floor(F.col("n") / ROWS_PER_BUCKET)
    return F.floor((1 - F.exp(-F.col(_KEY) * LEAST_QUALITY)) * buckets)


def plan(rows: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """One row per source: target, whole epochs, and the bucket in which the rest of the target ends."""
    sizes = rows.groupBy(_SOURCE).agg(F.count(F.lit(1)).alias("n"), F.sum(_SIZE).alias("source_size"))
    shares = saved(targets(sizes, weights, most), "mix-targets")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    shares = shares.withColumn("epochs", epochs.cast("long")).withColumn(
        "rest", F.round(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long")
    )
    totals = rows.join(shares.select(_SOURCE, "n"), _SOURCE).groupBy(_SOURCE, _bucket().alias("bucket")).agg(
        F.sum(_SIZE).alias("s")
    )
    run = F.sum("s").over(Window.partitionBy(_SOURCE).orderBy("bucket"))
    ends = totals.withColumn("upto", run).join(shares.select(_SOURCE, "rest"), _SOURCE).where("upto >= rest")
    edge = ends.groupBy(_SOURCE).agg(F.min_by(F.struct("bucket", (F.col("upto") - F.col("s")).alias("before")), "bucket").alias("edge"))
    return saved(shares.join(edge, _SOURCE, "left").select(
        _SOURCE, "n", "source_size", "target", "epochs", "rest", F.coalesce("edge.bucket", F.lit(-1)).alias("edge"),
        F.coalesce("edge.before", F.lit(0)).alias("before"),
    ), "mix-plan")


def taken(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """``rows`` with their source's size and target, and ``taken``: the words the mix takes of them."""
    joined = rows.join(sources, _SOURCE).withColumn("bucket", _bucket())
    whole = F.when(F.col("bucket") < F.col("edge"), F.col(_SIZE)).otherwise(F.lit(0))
    inside = joined.where("bucket != edge").withColumn("part", whole.cast("long"))
    order = Window.partitionBy(_SOURCE).orderBy(_KEY, F.col(f"{_ROW}.doc_id"), _SIZE)
    upto = F.sum(_SIZE).over(order.rowsBetween(Window.unboundedPreceding, -1))
    left = F.col("rest") - F.col("before") - F.coalesce(upto, F.lit(0))
    edge = joined.where("bucket = edge").withColumn("part", F.greatest(F.lit(0), F.least(F.col(_SIZE), left)).cast("long"))
    return inside.unionByName(edge).withColumn("taken", F.col("epochs") * F.col(_SIZE) + F.col("part"))


def mix(docs: DataFrame, quality: Column | None = None, weights: Sequence[int] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """One row per document: doc_id, size, source, source_size, target, taken.

    Null texts have size 0 and nothing of them is taken; repeated rows are rows of their own; ties of
    keys go by doc_id, then size. A table without words has targets 0; an empty table gives no rows.
    The same documents always give the same mix.
    """
    kept = docs.select("doc_id", "text", "source")
    rows = keyed(kept, quality).withColumn(_ROW, F.struct(F.col(f"{_ROW}.doc_id"), F.col(f"{_ROW}.source")))
    rows = saved(rows, "mix-rows")
    return taken(rows, plan(rows, weights, most)).select(
        F.col(f"{_ROW}.doc_id"), F.col(f"{_ROW}.source"), F.col(_SIZE).alias("size"), "source_size", "target", "taken"
    )


def mixed_documents(docs: DataFrame, quality: Column | None = None, weights: Sequence[int] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a document once per epoch in which it is taken.

    One document per source is taken in part; its text is cut behind the last word that is taken,
    and its words are then joined by single spaces. Documents of which nothing is taken are left out.
    """
    rows = keyed(docs, quality)
    sources = plan(saved(rows.select(_SOURCE, _SIZE, _KEY), "mix-keys"), weights, most)
    copies = taken(rows, sources).select(_ROW, _SIZE, F.explode(F.when(F.col("taken") > 0, F.concat(
        F.array_repeat(F.col(_SIZE), F.col("epochs").cast("int")),
        F.when(F.col("part") > 0, F.array(F.col("part"))).otherwise(F.array().cast("array<bigint>")),
    ))).alias("__mix_words"))
    words = F.regexp_extract_all(F.col(f"{_ROW}.text"), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    cut = F.array_join(F.slice(words, 1, F.col("__mix_words").cast("int")), " ")
    text = F.when(F.col("__mix_words") < F.col(_SIZE), cut).otherwise(F.col(f"{_ROW}.text"))
    return copies.select(*[text.alias(c) if c == "text" else F.col(f"{_ROW}.`{c}`") for c in docs.columns])
