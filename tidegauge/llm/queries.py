"""The registered queries of this subpackage, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm import (
    bpe, forest, lexical, licenses, mixing, neighbours, packing, passages, pii, prefixes, sharding, simhash, toxicity,
)
from tidegauge.plans.tables import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, bits=2)
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.mix(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "source_size", "target", "taken")


ORACLES["op6_mixing"] = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents
), keyed AS (
  SELECT *, -ln((CAST('0x' || substr(md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) + 0.5)
                / 4503599627370496.0) / least(1.5, 0.5 + size / 400.0) AS k FROM sized
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS i FROM sized GROUP BY source
), weighed AS (
  SELECT *, [5.0, 2.0, 1.0][i % 3 + 1]::DOUBLE AS w, 3 * source_size AS cap FROM sources
), levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed WINDOW o AS (ORDER BY cap / w, i)
), share AS (
  SELECT level AS s FROM levels WHERE level <= cap / w ORDER BY cap / w, i LIMIT 1
), planned AS (
  SELECT source, source_size, least(s * w, CAST(cap AS DOUBLE)) AS target FROM levels, share
), ordered AS (
  SELECT k.doc_id, k.size, p.source_size, p.target,
         CASE WHEN p.source_size > 0 THEN CAST(floor(p.target / p.source_size) AS BIGINT) ELSE 0 END AS epochs,
         coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY k.k, k.doc_id, k.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM keyed k JOIN planned p ON k.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(epochs * size + greatest(0, least(size, round(target - epochs * source_size) - before)) AS BIGINT) AS taken
FROM ordered
"""


@query
def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.assign(table(spark, sf_dir, "documents"), shards=8)
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = F.col("found")
    base = pii.of_kind(found, *pii.BASE)
    counts = [F.size(pii.of_kind(found, k)).cast("long").alias(f"n_{k}") for k in pii.BASE]
    return pii.find(table(spark, sf_dir, "documents")).select(
        "doc_id", *counts, F.sha2(pii.as_text(base), 256).alias("base_sha256"), pii.as_text(found).alias("spans")
    )


@query
def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, found = F.col("base"), F.col("detections")
    base_labels, labels = F.array_distinct(F.expr("base.label")), F.array_distinct(F.expr("detections.label"))
    at = F.expr("base.start")
    best = F.coalesce(F.array_max(F.expr("detections.confidence")), F.lit(0.0))
    return licenses.scan(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(at).alias("first_word"), F.array_max(at).alias("last_word"),
        F.array_join(F.array_sort(base_labels), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base_labels, labels)), ",").alias("labels"),
        F.greatest(best, F.when(F.size(base) > 0, licenses.BASE_CONFIDENCE).otherwise(0.0)).alias("score"),
        F.size(found).cast("long").alias("n_detections"),
    )


TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


@query
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), TOKENIZER, window=1024)


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), "vec_id % 50 = 0", k=5)


@query
def op2_embedding_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.95)


ORACLES["op2_embedding_forest"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), linked AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id != b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95
), reached AS (
  SELECT vec_id, vec_id AS other FROM v
  UNION
  SELECT reached.vec_id, linked.b FROM reached JOIN linked ON reached.other = linked.a
), components AS (
  SELECT vec_id, min(other) AS component_id FROM reached GROUP BY vec_id
)
SELECT vec_id, (SELECT count(*) FROM linked WHERE a = vec_id) AS n_links, component_id, vec_id = component_id AS kept
FROM components
"""


@query
def op9_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.dedup(table(spark, sf_dir, "documents"), window=20)


ORACLES["op9_passages"] = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), windows AS (
  SELECT doc_id, i, md5(array_to_string(words[i + 1:i + 20], ' ')) AS h
  FROM (SELECT doc_id, words, unnest(range(len(words) - 19)) AS i FROM w WHERE len(words) >= 20)
), later AS (
  SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY h ORDER BY doc_id, i) > 1
), gone AS (
  SELECT DISTINCT doc_id, i + unnest(range(20)) AS p FROM later
), kept AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS kept
  FROM (SELECT doc_id, unnest(words) AS x, unnest(range(len(words))) AS p FROM w) ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
), counts AS (
  SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id) LEFT JOIN counts USING (doc_id)
"""


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixes.trie(prefixes.rebuilt(table(spark, sf_dir, "conversations")))


ORACLES["op13_prefix_trie"] = """
WITH RECURSIVE crc_table AS (
  SELECT list(c ORDER BY b) AS t FROM (
    SELECT b, list_reduce(list_concat([b], range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM (SELECT unnest(range(256)) AS b))
), turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(coalesce(role, '') || ':' || coalesce(text, ''))) - 1 AS p
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base,
         xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
                         lambda s, x: xor(s >> 8, t[(xor(s, x) & 255) + 1])), 4294967295) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM turns), crc_table
), again AS (
  SELECT c.conv_id, p, role, text FROM convs c JOIN turns t ON t.conv_id = c.base WHERE p < h
  UNION ALL
  SELECT c.conv_id, p + 10, role, text FROM convs c JOIN turns t USING (conv_id) WHERE p >= h
), rebuilt AS (
  SELECT conv_id, row_number() OVER w AS depth, length(text) AS n,
         list(md5(length(role) || ':' || role || text)) OVER (w ROWS UNBOUNDED PRECEDING) AS prefix
  FROM again WINDOW w AS (PARTITION BY conv_id ORDER BY p)
  UNION ALL
  SELECT conv_id, 0, 0, [] FROM convs
), members AS (
  SELECT conv_id, depth, n, md5(array_to_string(prefix, '')) AS node, md5(array_to_string(prefix[1:-2], '')) AS parent,
         depth = max(depth) OVER (PARTITION BY conv_id) AS ends
  FROM rebuilt
), nodes AS (
  SELECT node, any_value(CASE WHEN depth > 0 THEN parent END) AS parent, any_value(depth) AS depth, any_value(n) AS n,
         min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM members GROUP BY node
), children AS (
  SELECT parent, count(*) AS n_children FROM nodes GROUP BY parent
), above AS (
  SELECT node AS top, node FROM nodes
  UNION ALL
  SELECT nodes.parent, above.node FROM above JOIN nodes ON nodes.node = above.top WHERE nodes.parent IS NOT NULL
), sums AS (
  SELECT top, sum((n_convs - 1) * n) AS saved_tokens, count(*) FILTER (WHERE n_children IS NULL) AS n_leaves
  FROM above JOIN nodes USING (node) LEFT JOIN children ON children.parent = node GROUP BY top
)
SELECT a.conv_id, CAST(a.depth AS BIGINT) AS depth, b.conv_id AS parent_conv_id, a.n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, a.ends_sha256
FROM nodes a JOIN sums ON sums.top = a.node LEFT JOIN nodes b ON b.node = a.parent LEFT JOIN children ON children.parent = a.node
"""


@query
def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bpe.decoded(bpe.encoded(table(spark, sf_dir, "documents"), TOKENIZER), TOKENIZER)
    return rows.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


_TERMS_SQL = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

ORACLES["op11_lexical_search"] = f"""
WITH d AS (
  SELECT row, doc_id, terms, len(terms) AS n FROM (SELECT row_number() OVER () AS row, doc_id, {_TERMS_SQL} AS terms FROM documents)
  WHERE len(terms) > 0
), s AS (
  SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM d
), q AS (
  SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({_TERMS_SQL}) AS term FROM benchmark) GROUP BY ALL
), tf AS (
  SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL
), w AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM tf, s GROUP BY term, docs
), scored AS (
  SELECT item_id, row, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * docs) // total)))) AS BIGINT) AS score
  FROM q JOIN tf USING (term) JOIN w USING (term) JOIN d USING (row), s GROUP BY ALL
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 20
"""
