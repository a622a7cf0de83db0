"""The queries of this subpackage: name -> (spark, sf_dir) -> DataFrame, and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import load
from . import bpe, langid, pii, toxicity
from .common import ROW, held_out
from .exactdedup import exact_dedup, normalised
from .iblt import fingerprints
from .mixing import mixing_rates
from .nsbounds import clustered
from .packing import pack
from .sharding import shard
from .simhash import simhash_components
from .tokenfiles import encode_to_files
from .trie import conversation_trie

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    profiles = langid.learn(docs.filter(~held_out(F.col("doc_id"))))
    said = langid.identify(docs.select("doc_id", "text"), profiles)
    return said.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query
def op2_iblt_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(load(spark, sf_dir, "documents"))


@query
def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_to_files(load(spark, sf_dir, "documents"))


@query
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(load(spark, sf_dir, "documents"))


@query
def op5_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(load(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "vslot")


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    learning = ~held_out(F.col("doc_id"))
    model = toxicity.learn(docs.filter(learning), load(spark, sf_dir, "labels").filter(learning))
    return toxicity.score(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing_rates(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


@query
def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.find(docs, pii.learn(docs))


@query
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select(
        "doc_id", "text", F.sha2(normalised(F.col("text")).cast("binary"), 256).alias("text_sha256"))
    return exact_dedup(docs, carry=("text_sha256",)).drop(ROW)


ORACLES["op9_exact_dedup"] = """
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_chars,
         sha256(translate(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS h
  FROM documents),
g AS (
  SELECT h, count(*) AS n, arg_min(doc_id, (-n_chars, doc_id)) AS keep_id
  FROM d GROUP BY h)
SELECT d.doc_id, g.keep_id, g.n AS group_size, d.doc_id = g.keep_id AS kept, d.h AS text_sha256
FROM d JOIN g USING (h)
"""


@query
def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(load(spark, sf_dir, "documents"))


@query
def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(load(spark, sf_dir, "documents"))


@query
def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(load(spark, sf_dir, "conversations"))


# DuckDB has no crc32: its eight steps a byte, folded over the digits.
_CRC32 = """xor(4294967295, list_reduce(list_transform(string_split({0}, ''), lambda ch: CAST(ascii(ch) AS BIGINT)),
  lambda crc, b: list_reduce(range(8), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)), xor(crc, b)), 4294967295))"""

ORACLES["op12_conversation_trie"] = f"""
WITH t AS (
  SELECT conv_id, coalesce(text, '') AS text, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base, {_CRC32.format("CAST(conv_id AS VARCHAR)")} % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM t)),
g AS (
  SELECT c.conv_id, count(t.pos) AS g FROM c LEFT JOIN t ON t.conv_id = c.base AND t.pos <= c.h GROUP BY c.conv_id),
r AS (
  SELECT c.conv_id, t.pos, t.k, t.text FROM c JOIN t ON t.conv_id = c.base AND t.pos <= c.h
  UNION ALL
  SELECT t.conv_id, t.pos - c.h + g.g, t.k, t.text FROM t JOIN c USING (conv_id) JOIN g USING (conv_id) WHERE t.pos > c.h),
p AS (
  SELECT conv_id, pos, string_agg(k, '') OVER (PARTITION BY conv_id ORDER BY pos) AS node,
         len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS w
  FROM r),
n AS (
  SELECT node, pos AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(w) AS w FROM p GROUP BY node, pos
  UNION ALL SELECT '', 0, min(conv_id), count(*), 0 FROM c HAVING count(*) > 0),
k AS (SELECT left(node, (64 * (depth - 1))::BIGINT) AS node, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
u AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM n LEFT JOIN k USING (node)),
s AS (
  SELECT left(u.node, (64 * d.i)::BIGINT) AS node, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum((n_convs - 1) * w) AS saved
  FROM u, LATERAL (SELECT unnest(range(0, u.depth + 1)) AS i) d GROUP BY 1),
e AS (
  SELECT node, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends
  FROM (SELECT c.conv_id, coalesce(arg_max(p.node, p.pos), '') AS node FROM c LEFT JOIN p USING (conv_id) GROUP BY c.conv_id)
  GROUP BY node)
SELECT u.conv_id, CAST(u.depth AS BIGINT) AS depth, a.conv_id AS parent_conv_id, u.n_convs, CAST(u.n_children AS BIGINT) AS n_children,
       s.n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, coalesce(e.ends, sha256('')) AS ends_sha256
FROM u JOIN s USING (node) LEFT JOIN e USING (node)
LEFT JOIN n a ON u.depth > 0 AND a.node = left(u.node, (64 * (u.depth - 1))::BIGINT)
"""


@query
def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustered(load(spark, sf_dir, "embeddings"))


def _kmeans_sql(rounds: int = 3, width: int = 64, k: int = 16) -> str:
    """The rounds as common table expressions: a0, c1, a1, ... over the kept vectors v."""
    steps = "lambda i: (v.q[i] - c.m[i]) * (v.q[i] - c.m[i])"
    parts = [f"""
v AS (
  SELECT row_number() OVER () AS row, vec_id,
         list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE len(embedding) = {width} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {width}),
c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS c, q AS m
  FROM v ORDER BY sha256('1:' || vec_id) LIMIT {k})"""]
    for r in range(rounds + 1):
        parts.append(f"""
a{r} AS (
  SELECT row, vec_id, any_value(q) AS q, arg_min(c, (d, c)) AS cluster, min(d) AS distance
  FROM (SELECT v.*, c.c, list_sum(list_transform(range(1, {width + 1}), {steps})) AS d FROM v, c{r} c)
  GROUP BY row, vec_id)""")
        if r < rounds:
            parts.append(f"""
s{r} AS (
  SELECT cluster AS c, i, CAST(sum(q[i]) AS BIGINT) AS s, count(*) AS n
  FROM a{r}, range(1, {width + 1}) t(i) GROUP BY cluster, i),
c{r + 1} AS (
  SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS m FROM s{r} GROUP BY c
  UNION ALL SELECT c, m FROM c{r} WHERE c NOT IN (SELECT c FROM s{r}))""")
    return "WITH" + ",".join(parts) + f"""
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance,
       CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(m, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON c = cluster
"""


ORACLES["op13_centroid_clusters"] = _kmeans_sql()
