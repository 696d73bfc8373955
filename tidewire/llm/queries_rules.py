"""Registered queries of secret scans and quality rules, with oracle SQL."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewire.llm.common import span_digest, table
from tidewire.llm.quality import assess, log_ratios, trusted_ids
from tidewire.llm.secret_ledger import RULES, SecretLedger
from tidewire.session import fresh_path


def op2_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    ledger = SecretLedger(spark, fresh_path(spark, "llm/secret-ledger"))
    ledger.scan(docs, "doc_id", "text")
    found = ledger.findings(docs, "doc_id", "text")
    spans = F.coalesce("spans", F.array().cast(found.schema["spans"].dataType))
    named = lambda xs: F.transform(xs, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"]))
    base = F.filter(spans, lambda x: x["rank"] < sum(r.base for r in RULES))
    count = lambda kind: F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long")
    return found.select(
        F.col("path").alias("doc_id"), *(count(r.kind).alias(f"n_{r.kind}") for r in RULES if r.base),
        span_digest(named(base))[1].alias("base_sha256"), span_digest(named(spans))[0].alias("spans"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    ratios = log_ratios(docs, trusted_ids(table(spark, sf_dir, "labels")))
    return assess(docs, ratios).drop("score")


QUERIES = {"op2_secret_ledger": op2_secret_ledger, "op3_quality": op3_quality}


def _spans_sql(rank: int, kind: str, pattern: str, group: int, least: int) -> str:
    quoted = pattern.replace("'", "''")
    return f"""
  SELECT doc_id, {rank} AS rank, '{kind}' AS kind, unnest(list_transform(range(len(m)), lambda i: {{
    'start': list_sum(list_transform(b[:i + 1], lambda x: length(x)))::INT + coalesce(list_sum(list_transform(m[:i], lambda x: length(x))), 0)::INT,
    'size': length(m[i + 1]), 'tested': length(g[i + 1])}})) AS s, {least} AS least
  FROM (SELECT doc_id, regexp_extract_all(text, '{quoted}') AS m, regexp_extract_all(text, '{quoted}', {group}) AS g,
    regexp_split_to_array(text, '{quoted}') AS b FROM docs)"""


ORACLES = {
    "op2_secret_ledger": f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
found AS ({" UNION ALL ".join(_spans_sql(i, r.kind, r.pattern, r.group, r.least) for i, r in enumerate(RULES))}),
spans AS (SELECT doc_id, rank, kind, s.start AS start, kind || ':' || s.start || ':' || (s.start + s.size) AS name FROM found WHERE s.tested >= least),
listed AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
  count(*) FILTER (kind = 'hex') AS n_hex, string_agg(name, ',' ORDER BY start, rank) FILTER (rank < 3) AS base,
  string_agg(name, ',' ORDER BY start, rank) AS spans FROM spans GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM docs LEFT JOIN listed USING (doc_id)""",
}
