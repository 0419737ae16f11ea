"""Embeddings as the two vector operators need them: usable rows, and classes of equal vectors."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import saved


SALTS = 64  # parts that the rows of one width are joined in


def usable(embeddings: DataFrame) -> DataFrame:
    """Distinct rows (vec_id, embedding as doubles) that a cosine is defined for.

    Rows with a null id, and vectors that are null, empty, zero or hold null or non-finite
    components, take no part. Vectors of several widths may be mixed; those of one width concern
    each other.
    """
    wide = F.transform("embedding", lambda x: x.cast("double"))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), wide.alias("embedding"))
    return rows.where(F.col("vec_id").isNotNull() & fine & F.exists("embedding", lambda x: x != 0)).distinct()


def with_width(classes: DataFrame) -> DataFrame:
    """``classes`` (rep, ..., embedding) with ``width`` and ``total``, the classes of that width.

    Totals are joined in salted parts, so the rows of one width never meet in one task.
    """
    rows = classes.withColumn("width", F.size("embedding"))
    totals = rows.groupBy("width").agg(F.count(F.lit(1)).alias("total")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("rep"), F.lit(SALTS)).cast("int"))
    return salted.join(totals, ["width", "salt"]).drop("salt")


def with_class(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members (vec_id, rep) and classes (rep, n, embedding) of equal vectors; rep is the smallest vec_id.

    Equal vectors are told by two 64-bit hashes, so no class is gathered and no vector is a join key.
    """
    keys = (F.xxhash64("embedding").alias("h1"), F.xxhash64(F.lit(1), F.col("embedding")).alias("h2"))
    keyed = rows.select("vec_id", "embedding", *keys)
    classes = saved(keyed.groupBy("h1", "h2").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n"), F.min_by("embedding", "vec_id").alias("embedding")
    ), "vector-classes")
    members = saved(keyed.select("vec_id", "h1", "h2").join(classes.select("rep", "h1", "h2"), ["h1", "h2"]).select("vec_id", "rep"), "vector-members")
    return members, classes.select("rep", "n", "embedding")


def matrix(column) -> np.ndarray:
    """Rows of a pandas column of vectors."""
    return np.stack(column.to_numpy()).astype(np.float64)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; scaled by the largest component first, so that no square overflows."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]
