"""Registered queries of exact dedup and sharding, with oracle SQL."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewire.llm.common import table
from tidewire.llm.exact_dedup import copy_groups
from tidewire.llm.sharding import BUCKET_DIGITS, assign_shards

SHARDS = 16


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = [1.0] * SHARDS
    rows = assign_shards(table(spark, sf_dir, "documents"), weights, [*weights, 1.0])
    return rows.withColumn("law", F.lit("key"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return copy_groups(table(spark, sf_dir, "documents"), digest_all=True)


QUERIES = {"op6_sharding": op6_sharding, "op7_exact_dedup": op7_exact_dedup}


def _score(shard: str) -> str:
    """Score of a shard for key k, all weights 1."""
    return f"-1.0::DOUBLE / ln((('0x' || substr(md5(k || ':' || {shard}), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0)"


ORACLES = {
    "op6_sharding": f"""
WITH RECURSIVE steps AS (
  SELECT i, 0 AS n, i AS c FROM range(256) t(i)
  UNION ALL SELECT i, n + 1, CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END FROM steps WHERE n < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM steps WHERE n = 8),
named AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(doc_id::VARCHAR, 'text ' || md5(coalesce(text, ''))) AS k FROM documents),
scored AS (SELECT k, s, {_score("s")} AS score FROM (SELECT DISTINCT k FROM named), range({SHARDS + 1}) t(s)),
won AS (SELECT k, arg_max(s, score) FILTER (s < {SHARDS})::INT AS shard, arg_max(s, score)::INT AS grown_shard FROM scored GROUP BY k),
sized AS (SELECT *, strlen(text) + 1 AS size, xor(4294967295, list_reduce(
    list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda x: ('0x' || x)::BIGINT),
    lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8), 4294967295)) AS text_crc32 FROM named, crc)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY substr(md5(k), 1, {BUCKET_DIGITS}), doc_id, size, text_crc32) - 1 AS slot, grown_shard
FROM sized JOIN won USING (k)""",
    "op7_exact_dedup": """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept,
  sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
}
