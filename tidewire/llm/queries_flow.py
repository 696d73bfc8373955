"""Registered queries of WARC archives and source mixing, with oracle SQL."""

from pyspark.sql import DataFrame, SparkSession

from tidewire.llm import warc_chunks
from tidewire.llm.common import table
from tidewire.llm.mixing import mix
from tidewire.session import fresh_path


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_path(spark, "llm/warc")
    records = warc_chunks.plan_records(table(spark, sf_dir, "pages"))
    warc_chunks.write_archives(warc_chunks.chunk_table(records), folder)
    found = warc_chunks.read_records(spark, folder)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "complete")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).drop("content")


QUERIES = {"op4_warc": op4_warc, "op5_mixing": op5_mixing}

ORACLES = {
    "op4_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS size FROM pages),
k AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS keep FROM p)
SELECT page_id, size AS payload_bytes, sha1(html) AS payload_digest,
  CASE WHEN size >= 1000 AND page_id < keep THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN size >= 1000 AND page_id < keep THEN keep END AS refers_to, true AS complete FROM k""",
}
