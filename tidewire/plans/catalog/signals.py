"""Feed, job and freshness queries over event-derived items."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewire import fixed_values as fixed, model
from tidewire.functions import names as fn, rules, text
from tidewire.functions.dates import fmt_iso, parse_date
from tidewire.functions.once import compute_once
from tidewire.operators import ranking, signals
from tidewire.operators.counting import RunCounts
from tidewire.plans import fixtures as fx, records
from tidewire.plans.catalog import sqltext as sql
from tidewire.session import fresh_path
from tidewire.sources import feeds, payloads as landed

c = F.col
ITEMS_PER_DOC = 20

# Spark patterns of the five date forms; the last one is no date.
_DATE_FORMS = ["EEE, dd MMM yyyy HH:mm:ss '+0000'", "d MMM yyyy HH:mm:ss 'GMT'", "yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd HH:mm:ss"]


def items(spark, sf):
    """Feed items with a publication text in one of five forms; t is the truth behind it."""
    rows = fx.derive(spark, sf, fx.FEED_ITEMS)
    shown = F.lit("not a date")
    for form, pattern in enumerate(_DATE_FORMS):
        shown = F.when(c("fmt") == form, F.date_format("t", pattern)).otherwise(shown)
    return rows.withColumn("pub_str", shown)


def dated(spark, sf):
    return compute_once(items(spark, sf), "published", parse_date(c("pub_str"), fx.NOW))


def fresh(spark, sf):
    return signals.fresh_only(dated(spark, sf), "published", fx.NOW)


def payloads(spark, sf):
    """Landed documents of at most ITEMS_PER_DOC items: RSS, Atom and job JSON in turn, some failed, some cut off."""
    numbered = items(spark, sf).withColumn("doc_no", F.floor(c("event_id") / ITEMS_PER_DOC).cast("bigint"))
    link = F.concat(F.lit("https://news.example/"), c("event_id").cast("string"))
    rss = F.concat(
        F.lit("<item><title>"), c("title"), F.lit("</title><link>"), link, F.lit("</link><pubDate>"), c("pub_str"),
        F.lit("</pubDate></item>"),
    )
    atom = F.concat(
        F.lit("<entry><title>"), c("title"), F.lit('</title><link rel="alternate" href="'), link, F.lit('"/><updated>'),
        c("pub_str"), F.lit("</updated></entry>"),
    )
    job = F.to_json(
        F.struct(
            F.when(c("event_id") % 4 != 0, F.concat(F.lit("Firm "), c("event_id").cast("string"))).alias("company_name"),
            "title",
            F.when(c("event_id") % 2 == 0, c("pub_str")).otherwise("").alias("publication_date"),
            F.when(c("event_id") % 2 != 0, c("pub_str")).alias("pubDate"),
        )
    )
    kind = F.pmod(c("doc_no"), F.lit(3))
    piece = F.when(kind == 0, rss).when(kind == 1, atom).otherwise(job)
    ordered = F.array_sort(F.collect_list(F.struct(c("event_id"), piece.alias("piece"))))
    docs = numbered.groupBy("doc_no").agg(F.transform(ordered, lambda p: p["piece"]).alias("pieces"))
    # RSS items stand in the channel, half of them beside it, or all but the first one two levels deeper
    half = F.floor(F.size("pieces") / 2).cast("int")
    layout = F.pmod(F.floor(c("doc_no") / 3), F.lit(3))
    joined = lambda start, length: F.array_join(F.slice("pieces", start, length), "")
    rss_body = (
        F.when(layout == 0, F.concat(F.lit("<rss><channel>"), F.array_join("pieces", ""), F.lit("</channel></rss>")))
        .when(layout == 1, F.concat(F.lit("<rss><channel>"), joined(F.lit(1), half), F.lit("</channel>"), joined(half + 1, F.size("pieces")), F.lit("</rss>")))
        .otherwise(F.concat(
            F.lit("<rss><channel>"), joined(F.lit(1), F.lit(1)), F.lit("<section><group>"), joined(F.lit(2), F.size("pieces")),
            F.lit("</group></section></channel></rss>")))
    )
    body = (
        F.when(kind == 0, rss_body)
        .when(
            kind == 1,
            F.concat(F.lit('<feed xmlns="http://www.w3.org/2005/Atom">'), F.array_join("pieces", ""), F.lit("</feed>")),
        )
        .otherwise(F.concat(F.lit('{"jobs":['), F.array_join("pieces", ","), F.lit("]}")))
    )
    feed = F.pmod(c("doc_no"), F.lit(5)).cast("string")
    address = F.when(kind == 2, F.concat(F.lit("https://jobs.example/api/"), feed)).otherwise(
        F.concat(F.lit("https://feeds.example.org/"), feed, F.lit(".xml"))
    )
    cut = F.when(F.pmod(c("doc_no"), F.lit(11)) == 0, F.expr("substring(body, 1, length(body) - 9)")).otherwise(c("body"))
    return docs.select(
        "doc_no",
        kind.cast("int").alias("kind"),
        F.concat(F.lit("feed-"), feed).alias("source_name"),
        address.alias("url"),
        F.when(F.pmod(c("doc_no"), F.lit(7)) == 0, 500).otherwise(200).alias("status"),
        body.alias("body"),
    ).withColumn("body", cut)


def feed_payloads(spark, sf):
    return payloads(spark, sf).where("kind < 2")


def src_feed_items(spark, sf):
    rows = feeds.feed_items(landed.ok_payloads(feed_payloads(spark, sf)))
    return rows.select("doc_no", "item_pos", "source_name", "title", "link", "pub_str")


def src_jobs_json(spark, sf):
    rows = feeds.json_jobs(landed.ok_payloads(payloads(spark, sf).where("kind = 2")))
    return rows.select("doc_no", "item_pos", fn.json_company(c("company")).alias("company"), "title", "pub_str")


def src_jobs_rss(spark, sf):
    rows = feeds.rss_jobs(landed.ok_payloads(feed_payloads(spark, sf)))
    split = fn.split_company_title(c("title"))
    return rows.select("doc_no", "item_pos", split["company"].alias("company"), split["role"].alias("role"), "pub_str")


def src_isolate_bad(spark, sf):
    """RSS, Atom and job documents, each in exactly one lot."""
    landed_ = payloads(spark, sf)
    parsed = [feeds.parse_documents(landed_.where("kind < 2")), feeds.parse_jobs(landed_.where("kind = 2"))]
    lots = [part.select("doc_no", F.lit(name).alias("lot")) for one in parsed for part, name in zip(landed.split_corrupt(one), ("good", "quarantine"))]
    return signals.union_sources(*lots)


def src_registry(spark, sf):
    registry = landed.registry_frame(spark, fixed.JOB_FEEDS)
    docs = payloads(spark, sf).groupBy(F.pmod("doc_no", F.lit(5)).cast("int").alias("rank")).agg(F.count("*").alias("payloads"))
    return registry.join(docs, "rank", "left").select("rank", "source_name", "format", F.coalesce("payloads", F.lit(0)).alias("payloads"))


def count_by_source(spark, sf):
    known = items(spark, sf).select("source_name").distinct()
    registry = known.unionByName(spark.sql("SELECT 'silent' AS source_name"))
    return signals.count_by_source(fresh(spark, sf), registry)


def union_sources(spark, sf):
    both = [part.select("event_id", "title") for part in (items(spark, sf), fresh(spark, sf))]
    return signals.union_sources(*both).groupBy("event_id", "title").agg(F.count("*").alias("copies"))


def fallback_default(spark, sf):
    source = F.concat(F.lit("src:"), c("source_name"))
    return items(spark, sf).select("event_id", fn.link_or_source(c("title"), source).alias("chosen"))


def missing_key_default(spark, sf):
    given = F.when(c("event_id") % 3 == 0, F.lit(None)).otherwise(c("title"))
    return items(spark, sf).select("event_id", fn.json_company(given).alias("company"))


def envelope(spark, sf):
    rows = dated(spark, sf)
    source = model.source(c("source_name"), F.lit("https://news.example/"))
    content = model.content(title=c("title"), published_date=fmt_iso(c("published")))
    nested = rows.select(*model.head("NEWS"), source, content, model.collected_at(fx.NOW))
    return _plain(model.to_contract(nested, "NEWS"))


def _plain(flat):
    """Dotted column names with underscores."""
    return flat.toDF(*[n.replace(".", "_") for n in flat.columns])


def plan_news(spark, sf):
    return _plain(model.to_contract(records.news(feed_payloads(spark, sf), fx.NOW), "NEWS"))


def plan_jobs(spark, sf):
    return _plain(model.to_contract(records.jobs(payloads(spark, sf).where("kind <> 1"), fx.NOW), "JOB"))


def run_counts(spark, sf):
    """Counts of a run over news and quarantine, taken while both are written."""
    counts, feed = RunCounts([f"feed-{i}" for i in range(5)]), feed_payloads(spark, sf)
    records.news(feed, fx.NOW, counts).write.parquet(fresh_path(spark, "run-news"))
    lot = counts.watch(landed.quarantined(feeds.parse_documents(feed)), "news", "quarantined", "source_name")
    lot.write.parquet(fresh_path(spark, "run-quarantine"))
    return counts.report(spark)


def page_offset(spark, sf):
    return ranking.page_offset(dated(spark, sf).select("event_id", fmt_iso(c("t")).alias("t")), 200, 100, [F.desc("t"), "event_id"])


def page_after(spark, sf):
    rows = items(spark, sf).select("event_id", "t")
    page = ranking.page_after(rows, "t", "event_id", (fx.datetime_of(fx.NOW), -1), 50)
    return page.select("event_id", fmt_iso(c("t")).alias("t"))


QUERIES = {
    "src_feed_items": src_feed_items,
    "src_jobs_json": src_jobs_json,
    "src_jobs_rss": src_jobs_rss,
    "src_isolate_bad": src_isolate_bad,
    "src_registry": src_registry,
    "src_payload_ok": lambda s, d: landed.ok_payloads(payloads(s, d)).select("doc_no", "source_name", "url"),
    "parse_date": lambda s, d: dated(s, d).select("event_id", fmt_iso(c("published")).alias("published")),
    "fmt_iso": lambda s, d: fx.table(s, d, "events").select("event_id", fmt_iso(c("ts")).alias("iso")),
    "fresh_24h": lambda s, d: fresh(s, d).select("event_id", fmt_iso(c("published")).alias("published")),
    "count_by_source": count_by_source,
    "count_total": lambda s, d: signals.count_total(fresh(s, d)),
    "union_sources": union_sources,
    "fallback_default": fallback_default,
    "missing_key_default": missing_key_default,
    "role_family": lambda s, d: items(s, d).select("event_id", rules.role_family(c("title")).alias("role_family")),
    "split_company_title": lambda s, d: items(s, d).select("event_id", fn.split_company_title(c("title")).alias("p")).select("event_id", "p.*"),
    "envelope": envelope,
    "ingest_telemetry": lambda s, d: signals.telemetry(items(s, d), "t", "source_name").withColumn("hour", fmt_iso(c("hour"))),
    "sort_recent": lambda s, d: ranking.sort_recent(items(s, d).select("event_id", "t"), "t", "event_id").withColumn("t", fmt_iso(c("t"))),
    "page_offset": page_offset,
    "page_after": page_after,
    "plan_news": plan_news,
    "plan_jobs": plan_jobs,
    "run_counts": run_counts,
}

_F = f"(SELECT *, CASE WHEN fmt <> 4 THEN t END AS published FROM ({fx.oracle(fx.FEED_ITEMS)}) AS raw)"
_IS_FRESH = f"published BETWEEN TIMESTAMP '{fx.NOW}' - INTERVAL 24 HOURS AND TIMESTAMP '{fx.NOW}'"
_SHOWN = f"""CASE fmt WHEN 0 THEN strftime(t, '%a, %d %b %Y %H:%M:%S +0000') WHEN 1 THEN strftime(t, '%-d %b %Y %H:%M:%S GMT')
  WHEN 2 THEN strftime(t, {sql.ISO}) WHEN 3 THEN strftime(t, '%Y-%m-%d %H:%M:%S') ELSE 'not a date' END"""
# items with the document they land in; documents numbered 7k fail, 11k are cut off
_DOCS = f"""(SELECT *, CAST(row_number() OVER (PARTITION BY doc_no ORDER BY event_id) - 1 AS INTEGER) AS item_pos, {_SHOWN} AS pub_str,
  concat('https://news.example/', event_id) AS link, concat('feed-', ((doc_no % 5) + 5) % 5) AS source_name_doc
  FROM (SELECT *, CAST(floor(event_id / {ITEMS_PER_DOC}.0) AS BIGINT) AS doc_no FROM {_F} AS f))"""
_KIND = "((doc_no % 3) + 3) % 3"
_READ = "doc_no % 7 <> 0 AND doc_no % 11 <> 0"
_ADDRESS = f"""CASE WHEN {_KIND} = 2 THEN concat('https://jobs.example/api/', ((doc_no % 5) + 5) % 5)
  ELSE concat('https://feeds.example.org/', ((doc_no % 5) + 5) % 5, '.xml') END"""
_JSON_COMPANY = "CASE WHEN event_id % 4 <> 0 THEN concat('Firm ', event_id) ELSE 'AI Enterprise' END"
_COMPANY = sql.company("title")

ORACLES = {
    "src_feed_items": f"""SELECT doc_no, item_pos, source_name_doc AS source_name, title, link, pub_str FROM {_DOCS} AS d
      WHERE {_KIND} < 2 AND {_READ}""",
    "src_jobs_json": f"SELECT doc_no, item_pos, {_JSON_COMPANY} AS company, title, pub_str FROM {_DOCS} AS d WHERE {_KIND} = 2 AND {_READ}",
    "src_jobs_rss": f"""SELECT doc_no, item_pos, {_COMPANY} AS company,
      CASE WHEN contains(title, ':') THEN substring(title, strpos(title, ':') + 1) ELSE title END AS role, pub_str
      FROM {_DOCS} AS d WHERE {_KIND} = 0 AND {_READ}""",
    "src_isolate_bad": f"""SELECT DISTINCT doc_no, CASE WHEN doc_no % 11 = 0 THEN 'quarantine' ELSE 'good' END AS lot
      FROM {_DOCS} AS d""",
    "src_registry": "SELECT rank, source_name, format, count(doc_no) AS payloads FROM (VALUES {}) AS r(rank, source_name, format) LEFT JOIN (SELECT DISTINCT doc_no FROM {} AS d) AS docs ON rank = ((doc_no % 5) + 5) % 5 GROUP BY 1, 2, 3".format(
        ", ".join(f"({i}, '{n}', '{'json' if 'api' in u else 'rss'}')" for i, (n, u) in enumerate(fixed.JOB_FEEDS)), _DOCS
    ),
    "src_payload_ok": f"SELECT DISTINCT doc_no, source_name_doc AS source_name, {_ADDRESS} AS url FROM {_DOCS} AS d WHERE doc_no % 7 <> 0",
    "parse_date": f"SELECT event_id, strftime(published, {sql.ISO}) AS published FROM {_F} AS f",
    "fmt_iso": f"SELECT event_id, strftime(ts, {sql.ISO}) AS iso FROM events",
    "fresh_24h": f"SELECT event_id, strftime(published, {sql.ISO}) AS published FROM {_F} AS f WHERE {_IS_FRESH}",
    "count_by_source": f"""SELECT source_name, count(event_id) AS records FROM
      (SELECT DISTINCT source_name FROM {_F} AS a UNION ALL SELECT 'silent') AS r
      LEFT JOIN (SELECT source_name, event_id FROM {_F} AS b WHERE {_IS_FRESH}) AS f USING (source_name) GROUP BY 1""",
    "count_total": f"SELECT count(*) AS records FROM {_F} AS f WHERE {_IS_FRESH}",
    "union_sources": f"""SELECT event_id, title, count(*) AS copies FROM
      (SELECT event_id, title FROM {_F} AS a UNION ALL SELECT event_id, title FROM {_F} AS b WHERE {_IS_FRESH}) GROUP BY 1, 2""",
    "fallback_default": f"SELECT event_id, coalesce(nullif(title, ''), concat('src:', source_name)) AS chosen FROM {_F} AS f",
    "missing_key_default": f"SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'AI Enterprise' ELSE title END AS company FROM {_F} AS f",
    "role_family": f"SELECT event_id, {sql.role('title')} AS role_family FROM {_F} AS f",
    "split_company_title": f"""SELECT event_id, {_COMPANY} AS company,
      CASE WHEN contains(title, ':') THEN substring(title, strpos(title, ':') + 1) ELSE title END AS role FROM {_F} AS f""",
    "envelope": f"""SELECT '1.0' AS "schemaVersion", 'NEWS' AS "recordType", source_name, 'https://news.example/' AS source_url,
      title AS content_title, strftime(published, {sql.ISO}) AS content_published_date, '{fx.NOW_ISO}' AS "collectedAt" FROM {_F} AS f""",
    "ingest_telemetry": f"SELECT strftime(date_trunc('hour', t), {sql.ISO}) AS hour, source_name, count(*) AS records FROM {_F} AS f GROUP BY 1, 2",
    "sort_recent": f"SELECT event_id, strftime(t, {sql.ISO}) AS t FROM {_F} AS f ORDER BY f.t DESC, event_id",
    "page_offset": f"SELECT event_id, strftime(t, {sql.ISO}) AS t FROM {_F} AS f ORDER BY 2 DESC, 1 LIMIT 100 OFFSET 200",
    "page_after": f"""SELECT event_id, strftime(t, {sql.ISO}) AS t FROM {_F} AS f
      WHERE t < TIMESTAMP '{fx.NOW}' OR (t = TIMESTAMP '{fx.NOW}' AND event_id > -1) ORDER BY f.t DESC, event_id LIMIT 50""",
    "plan_news": f"""SELECT '1.0' AS "schemaVersion", 'NEWS' AS "recordType", source_name_doc AS source_name, link AS source_url,
      title AS content_title, strftime(published, {sql.ISO}) AS content_published_date, '{fx.NOW_ISO}' AS "collectedAt"
      FROM {_DOCS} AS d WHERE {_KIND} < 2 AND {_READ} AND {_IS_FRESH}""",
    "plan_jobs": f"""SELECT '1.0' AS "schemaVersion", 'JOB' AS "recordType",
      CASE WHEN {_KIND} = 2 THEN {_JSON_COMPANY} ELSE {_COMPANY} END AS content_company,
      strftime(published, {sql.ISO}) AS content_date, true AS content_is_remote,
      CASE WHEN {_KIND} = 2 THEN {sql.role('title')} ELSE 'Engineering' END AS content_role_family
      FROM {_DOCS} AS d WHERE {_KIND} <> 1 AND {_READ} AND {_IS_FRESH}""",
    "run_counts": f"""WITH d AS (SELECT * FROM {_DOCS} AS x WHERE {_KIND} < 2),
      of AS (SELECT source_name_doc AS source, count(*) FILTER (WHERE {_READ}) AS items, count(*) FILTER (WHERE {_READ} AND {_IS_FRESH}) AS accepted,
        count(DISTINCT doc_no) FILTER (WHERE NOT ({_READ})) AS quarantined FROM d GROUP BY GROUPING SETS ((source_name_doc), ())),
      named AS (SELECT CAST(NULL AS VARCHAR) AS source UNION ALL SELECT concat('feed-', i) FROM range(5) AS r(i)),
      full_ AS (SELECT n.source, coalesce(items, 0) AS items, coalesce(accepted, 0) AS accepted, coalesce(quarantined, 0) AS quarantined
        FROM named AS n LEFT JOIN of ON n.source IS NOT DISTINCT FROM of.source)
      SELECT 'news' AS kind, step, source, CAST(n AS BIGINT) AS rows FROM (
        SELECT source, 'items' AS step, items AS n FROM full_ UNION ALL SELECT source, 'accepted', accepted FROM full_
        UNION ALL SELECT source, 'rejected', items - accepted FROM full_ UNION ALL SELECT source, 'quarantined', quarantined FROM full_)""",
}
