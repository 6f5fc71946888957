"""The operators and the pipeline as named queries over whole tables, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lakeconform.llm import (
    alignment,
    bpe,
    decontaminate,
    importance,
    line_dedup,
    ngram_join,
    ownership,
    pii,
    prefix_trie,
    quality_rules,
    sharding,
    toxicity,
    warc,
)
from lakeconform.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.apply_rules(table(spark, sf_dir, "documents"))


def op2_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ownership.digest(ownership.find_secrets(table(spark, sf_dir, "documents")))


def op3_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


def op4_simhash_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find_personal(table(spark, sf_dir, "documents")))


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.alike_documents(table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_and_read(table(spark, sf_dir, "pages"))


def op9_feistel_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return bpe.encode_documents(table(spark, sf_dir, "documents"), path)


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return alignment.align_documents(table(spark, sf_dir, "documents"), *paths)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def queries() -> dict[str, Query]:
    import corpus_pipeline

    found = (
        op1_quality_cascade,
        op2_ownership,
        op3_importance_resampling,
        op4_simhash_decontamination,
        op5_line_dedup,
        op6_pii,
        op7_ngram_join,
        op8_warc,
        op9_feistel_sharding,
        op10_bpe,
        op11_toxicity,
        op12_alignment,
        op13_prefix_trie,
    )
    named = {query.__name__: query for query in found}
    return named | {"pipeline": corpus_pipeline.run}


# The archives give back what was written, so plain SQL over the pages tells what they hold.
WARC_SQL = """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
firsts AS (
  SELECT sha256(payload) AS digest, min(page_id) AS first_id
  FROM payloads WHERE strlen(payload) >= 100 GROUP BY 1
)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
  sha256(payload) AS payload_digest,
  CASE WHEN first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first_id <> page_id THEN first_id END AS refers_to,
  true AS intact
FROM payloads LEFT JOIN firsts ON digest = sha256(payload)
"""


# The prefixes of every conversation spelled out; CRC-32 by its polynomial, bit by bit.
TRIE_SQL = """
WITH digests AS (
  SELECT conv_id, turn, length(coalesce(text, '')) AS chars,
    md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest
  FROM conversations WHERE conv_id IS NOT NULL
),
turns AS (
  SELECT conv_id, chars, digest,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) AS pos
  FROM digests
),
heads AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base,
    xor(4294967295::UBIGINT, list_reduce(
      list_prepend(4294967295::UBIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
        lambda c: CAST(ascii(c) AS UBIGINT))),
      lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0],
        lambda x, y: xor(x >> 1, 3988292384::UBIGINT * (x & 1))))) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM digests)
),
parts AS (
  SELECT heads.conv_id, 0 AS part, pos, chars, digest
  FROM heads JOIN turns ON turns.conv_id = base AND pos <= h
  UNION ALL
  SELECT heads.conv_id, 1, pos, chars, digest
  FROM heads JOIN turns ON turns.conv_id = heads.conv_id AND pos > h
),
rebuilt AS (
  SELECT conv_id, chars, digest, row_number() OVER (PARTITION BY conv_id ORDER BY part, pos) AS depth
  FROM parts
),
prefixes AS (
  SELECT conv_id, 0 AS depth, 0 AS chars, '' AS prefix FROM heads
  UNION ALL
  SELECT conv_id, depth, chars,
    md5(string_agg(digest, '') OVER (PARTITION BY conv_id ORDER BY depth)) FROM rebuilt
),
lengths AS (SELECT conv_id, max(depth) AS length FROM prefixes GROUP BY 1),
nodes AS (
  SELECT depth, prefix, min(prefixes.conv_id) AS conv_id, count(*) AS n, any_value(chars) AS chars,
    sha256(coalesce(string_agg(CAST(prefixes.conv_id AS VARCHAR), ',' ORDER BY prefixes.conv_id)
      FILTER (WHERE depth = length), '')) AS ends
  FROM prefixes JOIN lengths USING (conv_id) GROUP BY 1, 2
),
linked AS (
  SELECT nodes.*, above.prefix AS above
  FROM nodes LEFT JOIN prefixes above ON above.conv_id = nodes.conv_id AND above.depth = nodes.depth - 1
),
children AS (SELECT depth - 1 AS depth, above AS prefix, count(*) AS n FROM linked WHERE depth > 0 GROUP BY 1, 2),
counted AS (
  SELECT nodes.*, coalesce(children.n, 0) AS n_children FROM nodes LEFT JOIN children USING (depth, prefix)
),
subtrees AS (
  SELECT above.depth, above.prefix, sum((n - 1) * counted.chars) AS saved, count(*) FILTER (WHERE n_children = 0) AS leaves
  FROM counted JOIN prefixes above ON above.conv_id = counted.conv_id AND above.depth <= counted.depth
  GROUP BY 1, 2
)
SELECT counted.conv_id, CAST(counted.depth AS BIGINT) AS depth, parent.conv_id AS parent_conv_id,
  CAST(counted.n AS BIGINT) AS n_convs, CAST(counted.n_children AS BIGINT) AS n_children,
  CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, counted.ends AS ends_sha256
FROM counted
JOIN subtrees ON subtrees.depth = counted.depth AND subtrees.prefix = counted.prefix
JOIN linked ON linked.depth = counted.depth AND linked.prefix = counted.prefix
LEFT JOIN nodes parent ON parent.depth = counted.depth - 1 AND parent.prefix = linked.above
"""


def oracle_sql() -> dict[str, str]:
    return {"op8_warc": WARC_SQL, "op13_prefix_trie": TRIE_SQL}
