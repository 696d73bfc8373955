"""Startup and product queries over part-derived hub items."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewire import model
from tidewire.functions import names as fn, rules
from tidewire.operators import dedup, ranking
from tidewire.plans import fixtures as fx, records
from tidewire.plans.catalog import sqltext as sql
from tidewire.plans.catalog.signals import _plain
from tidewire.sources import hub as hub_source
from tidewire.sources.payloads import quarantined

c = F.col
ITEMS_PER_DOC = 25
ORDER = ["src_rank", "item_pos"]


def items(spark, sf):
    return fx.derive(spark, sf, fx.HUB_ITEMS).withColumn("tags", F.array("tag"))


def payloads(spark, sf):
    """JSON lists of at most ITEMS_PER_DOC items; some items lack keys, some lists failed."""
    numbered = items(spark, sf).withColumn("doc_no", F.floor(c("item_pos") / ITEMS_PER_DOC).cast("bigint"))
    # NULL fields are left out of the JSON text
    item = F.struct(
        "item_pos", "id", "author",
        F.when(c("item_pos") % 19 != 0, c("downloads")).alias("downloads"),
        F.when(c("item_pos") % 23 != 0, c("likes")).alias("likes"),
        F.when(c("item_pos") % 29 != 0, c("tags")).alias("tags"),
    )
    listed = numbered.groupBy("src_rank", "doc_no", c("list_url").alias("url")).agg(F.array_sort(F.collect_list(item)).alias("list"))
    return listed.select(
        "src_rank", "doc_no", "url", F.when(c("doc_no") % 9 == 0, 503).otherwise(200).alias("status"), F.to_json("list").alias("body")
    )


def src_hub_json(spark, sf):
    rows = records.hub_rows(payloads(spark, sf))
    return rows.select("src_rank", "doc_no", "item_pos", "list_url", "id", "author", "downloads", "likes")


def src_hub_quarantine(spark, sf):
    """Lists that can't be read, some failed, some cut off, some an object instead of a list, with the reason."""
    cut = F.when(c("doc_no") % 5 == 2, F.expr("substring(body, 1, length(body) - 3)")).when(c("doc_no") % 5 == 3, F.lit('{"error":"busy"}'))
    lists = payloads(spark, sf).withColumn("body", F.when(c("doc_no") % 5 == 4, F.lit(" ")).otherwise(F.coalesce(cut, c("body"))))
    return quarantined(hub_source.parse_lists(lists)).select("src_rank", "doc_no", "reason")


def json_fields(spark, sf):
    rows = records.hub_rows(payloads(spark, sf))
    return rows.select("src_rank", "doc_no", "item_pos", "downloads", "likes", F.array_join("tags", ",").alias("tags"))


def first_seen_orgs(spark, sf):
    return dedup.first_seen_orgs(items(spark, sf)).select("src_rank", "item_pos", "author", "downloads", "likes")


def first_seen_products(spark, sf):
    return dedup.first_seen_products(items(spark, sf)).select("src_rank", "item_pos", "id", "likes")


def limit_target(spark, sf):
    return ranking.limit_target(first_seen_products(spark, sf), 100)


def _each(name, column):
    return lambda spark, sf: items(spark, sf).select("item_pos", column().alias(name))


def valid_author(spark, sf):
    authored = items(spark, sf).withColumn("author", fn.author_from_id(c("author"), c("id")))
    return authored.where(fn.valid_author(c("author"))).select("item_pos", "author")


def plan_startups(spark, sf):
    rows = records.hub_rows(payloads(spark, sf)).withColumn("item_pos", c("doc_no") * ITEMS_PER_DOC + c("item_pos"))
    return _plain(model.to_contract(records.startups(rows, fx.NOW), "STARTUP"))


def plan_products(spark, sf):
    rows = records.hub_rows(payloads(spark, sf)).withColumn("item_pos", c("doc_no") * ITEMS_PER_DOC + c("item_pos"))
    return _plain(model.to_contract(records.products(rows, fx.NOW, target=500), "PRODUCT"))


QUERIES = {
    "src_hub_json": src_hub_json,
    "src_hub_quarantine": src_hub_quarantine,
    "json_fields": json_fields,
    "first_seen_orgs": first_seen_orgs,
    "first_seen_products": first_seen_products,
    "limit_target": limit_target,
    "author_from_id": _each("author", lambda: fn.author_from_id(c("author"), c("id"))),
    "valid_author": valid_author,
    "product_org": _each("org", lambda: fn.product_org(c("id"))),
    "clean_org_name": _each("org", lambda: fn.clean_org_name(c("author"))),
    "employee_tier": _each("employees", lambda: rules.employee_tier(c("downloads"), c("likes"))),
    "pricing_tier": _each("pricing", lambda: rules.pricing_tier(c("tags"), c("likes"))),
    "source_url_build": _each("url", lambda: rules.hub_url(c("id"), c("list_url"))),
    "tags_has": _each("paid", lambda: rules.tags_has(c("tags"), "paid")),
    "plan_startups": plan_startups,
    "plan_products": plan_products,
}

_H = f"({fx.oracle(fx.HUB_ITEMS)})"
_DEFAULTED = "* REPLACE (CASE WHEN item_pos % 19 <> 0 THEN downloads ELSE 0 END AS downloads, CASE WHEN item_pos % 23 <> 0 THEN likes ELSE 0 END AS likes, CASE WHEN item_pos % 29 <> 0 THEN tag ELSE '' END AS tag)"
# items of lists that did not fail, placed in their list
_LISTED = f"""(SELECT src_rank, doc_no, CAST(row_number() OVER (PARTITION BY src_rank, doc_no ORDER BY item_pos) - 1 AS INTEGER) AS place,
  item_pos, list_url, id, author, downloads, likes, tag FROM (
    SELECT {_DEFAULTED}, CAST(floor(item_pos / {ITEMS_PER_DOC}) AS BIGINT) AS doc_no FROM {_H} AS h) WHERE doc_no % 9 <> 0)"""
_AUTHOR = sql.author()


def _first_org(rows: str, order: str) -> str:
    return f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lower(author) ORDER BY {order}) AS nth FROM
      (SELECT * REPLACE ({_AUTHOR} AS author) FROM {rows} AS h) WHERE length(author) >= 2) WHERE nth = 1"""


def _first_product(rows: str, order: str) -> str:
    return f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY {order}) AS nth FROM {rows} AS h WHERE id <> '') WHERE nth = 1"


_PLACED = f"src_rank, doc_no * {ITEMS_PER_DOC} + place"

ORACLES = {
    "src_hub_quarantine": f"""SELECT DISTINCT src_rank, doc_no, CASE WHEN doc_no % 9 = 0 THEN 'failed' WHEN doc_no % 5 = 4 THEN 'empty' ELSE 'unreadable' END AS reason
      FROM (SELECT src_rank, CAST(floor(item_pos / {ITEMS_PER_DOC}) AS BIGINT) AS doc_no FROM {_H} AS h) WHERE doc_no % 9 = 0 OR doc_no % 5 > 1""",
    "src_hub_json": f"SELECT src_rank, doc_no, place AS item_pos, list_url, id, author, downloads, likes FROM {_LISTED} AS l",
    "json_fields": f"SELECT src_rank, doc_no, place AS item_pos, downloads, likes, tag AS tags FROM {_LISTED} AS l",
    "first_seen_orgs": f"SELECT src_rank, item_pos, author, downloads, likes FROM ({_first_org(_H, 'src_rank, item_pos')})",
    "first_seen_products": f"SELECT src_rank, item_pos, id, likes FROM ({_first_product(_H, 'src_rank, item_pos')})",
    "limit_target": f"SELECT src_rank, item_pos, id, likes FROM ({_first_product(_H, 'src_rank, item_pos')}) ORDER BY 1, 2 LIMIT 100",
    "author_from_id": f"SELECT item_pos, {_AUTHOR} AS author FROM {_H} AS h",
    "valid_author": f"SELECT item_pos, author FROM (SELECT item_pos, {_AUTHOR} AS author FROM {_H} AS h) WHERE length(author) >= 2",
    "product_org": f"SELECT item_pos, {sql.product_org()} AS org FROM {_H} AS h",
    "clean_org_name": f"SELECT item_pos, {sql.org_name('author')} AS org FROM {_H} AS h",
    "employee_tier": f"SELECT item_pos, {sql.EMPLOYEES} AS employees FROM {_H} AS h",
    "pricing_tier": f"SELECT item_pos, {sql.PRICING} AS pricing FROM {_H} AS h",
    "source_url_build": f"""SELECT item_pos, concat('https://huggingface.co/', CASE WHEN contains(list_url, 'spaces') THEN 'spaces/' ELSE '' END, id) AS url
      FROM {_H} AS h""",
    "tags_has": f"SELECT item_pos, tag = 'paid' AS paid FROM {_H} AS h",
    "plan_startups": f"""SELECT '1.0' AS "schemaVersion", 'STARTUP' AS "recordType", 'AI Ecosystem Registry' AS source_name,
      concat('https://huggingface.co/', author) AS source_url, {sql.org_name('author')} AS "content_entityName",
      {sql.EMPLOYEES} AS "content_data_employeeCount", '{fx.NOW_ISO}' AS "collectedAt" FROM ({_first_org(_LISTED, _PLACED)})""",
    "plan_products": f"""SELECT '1.0' AS "schemaVersion", 'PRODUCT' AS "recordType", 'AI Product Directory' AS source_name,
      concat('https://huggingface.co/', CASE WHEN contains(list_url, 'spaces') THEN 'spaces/' ELSE '' END, id) AS source_url,
      {sql.product_org()} AS "content_startupName", {sql.PRICING} AS "content_pricingModel", '{fx.NOW_ISO}' AS "collectedAt"
      FROM ({_first_product(_LISTED, _PLACED)} ORDER BY {_PLACED} LIMIT 500)""",
}
