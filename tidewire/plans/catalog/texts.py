"""Text, page and extraction queries over pages, documents, events and parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewire.functions import links, text
from tidewire.functions.register import register_sql_functions
from tidewire.operators import extraction
from tidewire.plans import fixtures as fx, records
from tidewire.plans.catalog import sqltext as sql

c = F.col
SIZES = [4000, 400, 40, 1]


def chunk_payload(spark, sf):
    docs = fx.table(spark, sf, "documents")
    return docs.select("doc_id", *[F.md5(text.chunk_payload(c("text"), n)).alias(f"chunk_{n}") for n in SIZES])


def shrink_ladder(spark, sf):
    docs = fx.table(spark, sf, "documents").select("doc_id", F.inline(text.shrink_ladder(c("text"), 4000, 9)))
    return docs.select("doc_id", "step", F.md5("text").alias("text"), "length")


def shrink_fit(spark, sf):
    fitted = text.fit_to_budget(text.shrink_ladder(c("text"), 4000, 3), 700)
    return fx.table(spark, sf, "documents").select("doc_id", fitted.alias("f")).select("doc_id", "f.step", "f.length")


def api_chunker(spark, sf):
    fx.derive(spark, sf, fx.HTML).createOrReplaceTempView("tw_pages")
    register_sql_functions(spark)
    return spark.sql(
        "SELECT page_id, tw_chunk_payload(tw_clean_html(html), 400) AS payload, tw_clean_name(url) AS name, "
        "md5(tw_collapse_ws(html)) AS flat FROM tw_pages"
    )


def schema_validate(spark, sf):
    judged = extraction.validate_payloads(fx.derive(spark, sf, fx.PAYLOADS))
    return judged.select(
        "rec_id", "reason", "record.schemaVersion", "record.recordType", "record.source_name", "record.entityName",
        "record.employeeCount",
    )


def tier_failover_select(spark, sf):
    return extraction.select_first_success(fx.derive(spark, sf, fx.ATTEMPTS))


def tier_exhausted(spark, sf):
    return extraction.split_outcomes(tier_failover_select(spark, sf))[1]


def plan_extract_records(spark, sf):
    """Pages through cleaning, cutting, tiers with halved texts and typed validation."""
    done = records.extracted_startups(fx.derive(spark, sf, fx.HTML), fx.derive(spark, sf, fx.EXTRACTIONS))
    return done.select(
        "page_id", "tier", "attempt", "shrinks", F.md5("sent").alias("sent"), "reason", "record.entityName", "record.employeeCount")


QUERIES = {
    "plan_extract_records": plan_extract_records,
    "clean_html": lambda s, d: fx.derive(s, d, fx.HTML).select("page_id", text.clean_html(c("html")).alias("text")),
    "collapse_ws": lambda s, d: fx.table(s, d, "documents").select("doc_id", text.collapse_ws(c("text")).alias("text")),
    "chunk_payload": chunk_payload,
    "shrink_ladder": shrink_ladder,
    "shrink_fit": shrink_fit,
    "root_domain": lambda s, d: fx.table(s, d, "pages").select("page_id", links.root_domain(c("url")).alias("domain")),
    "api_chunker": api_chunker,
    "plan_extraction": lambda s, d: records.extraction_inputs(fx.derive(s, d, fx.HTML)).select("page_id", "payload"),
    "schema_validate": schema_validate,
    "tier_failover_select": tier_failover_select,
    "tier_exhausted": tier_exhausted,
}

_H = f"({fx.oracle(fx.HTML)})"
_CLEAN = f"(SELECT page_id, url, html, {sql.clean_html('html')} AS clean FROM {_H} AS h)"
_LADDER = f"""WITH RECURSIVE ladder(doc_id, step, body) AS (
  SELECT doc_id, 0, {sql.chunk('text', '4000')} FROM documents
  UNION ALL
  SELECT doc_id, step + 1, {sql.chunk('body', 'CAST(floor(length(body) / 2) AS BIGINT)')} FROM ladder WHERE step < {{steps}}
)
"""
_ATTEMPTS = f"""WITH placed AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, tier ORDER BY attempt) AS place FROM ({fx.oracle(fx.ATTEMPTS)}) AS a
), tried AS (
  SELECT *, count(CASE WHEN status NOT IN (200, 429, 413) THEN 1 END) OVER (PARTITION BY doc_id, tier ORDER BY attempt) AS fatal
  FROM placed WHERE place <= 3
), won AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY tier, attempt) AS nth FROM tried WHERE status = 200 AND fatal = 0
)
"""

_EXTRACT = _ATTEMPTS.replace(fx.oracle(fx.ATTEMPTS), fx.oracle(fx.EXTRACTIONS)).replace("WITH placed", f"""WITH RECURSIVE rungs(page_id, step, body) AS (
  SELECT page_id, 0, {sql.chunk('clean', '4000')} FROM {_CLEAN} AS k
  UNION ALL SELECT page_id, step + 1, {sql.chunk('body', 'CAST(floor(length(body) / 2) AS BIGINT)')} FROM rungs WHERE step < 9
), placed""", 1)

ORACLES = {
    "plan_extract_records": _EXTRACT + """, first AS (SELECT * FROM won WHERE nth = 1),
shrunk AS (SELECT f.doc_id, count(t.attempt) AS shrinks FROM first AS f LEFT JOIN tried AS t
  ON t.doc_id = f.doc_id AND t.status = 413 AND t.fatal = 0 AND (t.tier < f.tier OR t.tier = f.tier AND t.attempt < f.attempt) GROUP BY 1)
SELECT p.page_id, tier, attempt, CAST(shrinks AS INTEGER) AS shrinks, md5(body) AS sent,
  CASE WHEN tier IS NULL THEN 'exhausted' WHEN attempt % 5 = 0 THEN 'corrupt' WHEN attempt % 5 = 1 THEN 'missing entityName' END AS reason,
  CASE WHEN attempt % 5 > 1 THEN concat('E', p.page_id) END AS "entityName", CASE WHEN attempt % 5 > 1 THEN CAST(attempt % 90 AS INTEGER) END AS "employeeCount"
FROM pages AS p LEFT JOIN first AS f ON f.doc_id = p.page_id LEFT JOIN shrunk AS s ON s.doc_id = p.page_id
LEFT JOIN rungs AS r ON r.page_id = p.page_id AND r.step = s.shrinks""",
    "clean_html": f"SELECT page_id, clean AS text FROM {_CLEAN} AS k",
    "collapse_ws": f"SELECT doc_id, {sql.collapse('text')} AS text FROM documents",
    "chunk_payload": "SELECT doc_id, " + ", ".join(f"md5({sql.chunk('text', str(n))}) AS chunk_{n}" for n in SIZES) + " FROM documents",
    "shrink_ladder": _LADDER.replace("{steps}", "9") + "SELECT doc_id, step, md5(body) AS text, CAST(length(body) AS INTEGER) AS length FROM ladder",
    "shrink_fit": _LADDER.replace("{steps}", "3")
    + """SELECT doc_id, coalesce(min(CASE WHEN length(body) <= 700 THEN step END), 3) AS step,
      CAST(coalesce(max(CASE WHEN length(body) <= 700 THEN length(body) END), min(length(body))) AS INTEGER) AS length FROM ladder GROUP BY doc_id""",
    "root_domain": r"SELECT page_id, regexp_extract(lower(regexp_extract(url, '^[a-zA-Z]+://([^/:?#]+)', 1)), '([^.]+\.)?[^.]+$', 0) AS domain FROM pages",
    "api_chunker": f"""SELECT page_id, {sql.chunk('clean', '400')} AS payload, {sql.clean_name('url')} AS name,
      md5({sql.collapse('html')}) AS flat FROM {_CLEAN} AS k""",
    "plan_extraction": f"SELECT page_id, {sql.chunk('clean', '4000')} AS payload FROM {_CLEAN} AS k",
    "schema_validate": """SELECT p_partkey AS rec_id,
      CASE p_partkey % 4 WHEN 2 THEN 'missing entityName' WHEN 3 THEN 'corrupt' END AS reason,
      CASE WHEN p_partkey % 4 < 2 THEN '1.0' END AS "schemaVersion", CASE WHEN p_partkey % 4 < 2 THEN 'STARTUP' END AS "recordType",
      CASE WHEN p_partkey % 4 < 2 THEN 's' END AS source_name, CASE WHEN p_partkey % 4 < 2 THEN p_name END AS "entityName",
      CASE WHEN p_partkey % 4 = 0 THEN p_size END AS "employeeCount" FROM part""",
    "tier_failover_select": _ATTEMPTS
    + """SELECT d.doc_id, tier, attempt, payload FROM (SELECT DISTINCT doc_id FROM placed) AS d
      LEFT JOIN (SELECT * FROM won WHERE nth = 1) AS w ON d.doc_id = w.doc_id""",
    "tier_exhausted": _ATTEMPTS + "SELECT DISTINCT doc_id FROM placed WHERE doc_id NOT IN (SELECT doc_id FROM won)",
}
