"""Payloads to records: one lazy plan per record type."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidewire import fixed_values as fixed, model
from tidewire.functions import names, rules, text
from tidewire.functions.dates import fmt_iso, parse_date
from tidewire.functions.links import search_text
from tidewire.functions.once import compute_once
from tidewire.operators import dedup, extraction, linking, ranking, resolve, signals
from tidewire.operators.counting import RunCounts
from tidewire.sources import feeds, hub
from tidewire.sources.payloads import feed_format, ok_payloads

_ARRIVAL = ("src_rank", "item_pos")


def papers(
    payloads: DataFrame, links: DataFrame, repos: DataFrame, target: int | None = None, compat: bool = False
) -> DataFrame:
    """Atom payloads (src_rank, body, ...) to RESEARCH_PAPER records, in page order up to the target."""
    rows = feeds.atom_papers(ok_payloads(payloads))
    if target is not None:
        rows = ranking.limit_target(rows, target, _ARRIVAL)
    searched = rows.withColumn("search_text", search_text(F.col("summary"), F.col("comment"))).drop("summary", "comment")
    linked = linking.link_repos(searched, links, repos, compat=compat)
    content = model.content(
        title=F.col("title"), authors=F.col("authors"), paper_url=F.col("paper_url"), github_url=F.col("github_url"),
        github_stars=F.col("github_stars"), published_date=F.col("published"),
    )
    return linked.select(*model.head("RESEARCH_PAPER"), content)


def _dated(items: DataFrame, now) -> DataFrame:
    return signals.fresh_only(compute_once(items, "published", parse_date(F.col("pub_str"), now)), "published", now)


def _counted(rows: DataFrame, counts: RunCounts | None, kind: str, step: str, source: str | None = None) -> DataFrame:
    return counts.watch(rows, kind, step, source) if counts else rows


def news(payloads: DataFrame, now, counts: RunCounts | None = None) -> DataFrame:
    """Feed payloads to NEWS records of the last 24 hours. counts takes note of the items and of the accepted ones."""
    items = _counted(feeds.feed_items(ok_payloads(payloads)), counts, "news", "items", "source_name")
    fresh = _counted(_dated(items, now), counts, "news", "accepted", "source_name")
    content = model.content(title=F.col("title"), published_date=fmt_iso(F.col("published")))
    source = model.source(F.col("source_name"), names.link_or_source(F.col("link"), F.col("url")))
    return fresh.select(*model.head("NEWS"), source, content, model.collected_at(now))


def jobs(payloads: DataFrame, now, counts: RunCounts | None = None) -> DataFrame:
    """Job-board payloads to JOB records of the last 24 hours; the address tells JSON boards from RSS ones. counts as for news."""
    ok = ok_payloads(payloads)
    is_json = feed_format(F.col("url")) == "json"
    from_json = feeds.json_jobs(ok.where(is_json)).select(
        names.json_company(F.col("company")).alias("company"), rules.role_family(F.col("title")).alias("role"), "pub_str", "source_name"
    )
    from_rss = feeds.rss_jobs(ok.where(~is_json)).select(
        names.split_company_title(F.col("title"))["company"].alias("company"), F.lit("Engineering").alias("role"), "pub_str", "source_name"
    )
    items = _counted(signals.union_sources(from_json, from_rss), counts, "jobs", "items", "source_name")
    fresh = _counted(_dated(items, now), counts, "jobs", "accepted", "source_name")
    content = model.content(
        company=F.col("company"), date=fmt_iso(F.col("published")), is_remote=F.lit(True), role_family=F.col("role")
    )
    return fresh.select(*model.head("JOB"), content)


def startups(items: DataFrame, now, target: int | None = None) -> DataFrame:
    """Hub items (src_rank, item_pos, id, author, downloads, likes) to STARTUP records, one per author."""
    first = dedup.first_seen_orgs(items)
    if target is not None:
        first = ranking.limit_target(first, target, _ARRIVAL)
    content = F.struct(
        names.clean_org_name(F.col("author")).alias("entityName"),
        F.struct(rules.employee_tier(F.col("downloads"), F.col("likes")).alias("employeeCount")).alias("data"),
    ).alias("content")
    source = model.source(F.lit(fixed.STARTUP_SOURCE), F.concat(F.lit(fixed.HUB_URL), F.col("author")))
    return first.select(*model.head("STARTUP"), source, content, model.collected_at(now))


def products(items: DataFrame, now, target: int | None = None) -> DataFrame:
    """Hub items (+ list_url, tags) to PRODUCT records, one per id."""
    first = dedup.first_seen_products(items)
    if target is not None:
        first = ranking.limit_target(first, target, _ARRIVAL)
    content = model.content(
        startupName=names.product_org(F.col("id")), pricingModel=rules.pricing_tier(F.col("tags"), F.col("likes"))
    )
    source = model.source(F.lit(fixed.PRODUCT_SOURCE), rules.hub_url(F.col("id"), F.col("list_url")))
    return first.select(*model.head("PRODUCT"), source, content, model.collected_at(now))


def hub_rows(payloads: DataFrame) -> DataFrame:
    """Hub payloads (src_rank, url, body) to items; the list address is list_url."""
    return hub.hub_items(ok_payloads(payloads)).withColumnRenamed("url", "list_url")


def entity_mapping(
    sources: Sequence[DataFrame], dictionary: DataFrame, threshold: float = fixed.FUZZY_THRESHOLD, variants: bool = True
) -> DataFrame:
    """ENTITY_MAPPING rows of the distinct names of all sources, sorted by name."""
    named = list(sources)
    if variants:
        spark = dictionary.sparkSession
        named.append(spark.createDataFrame([(v,) for v in fixed.NAME_VARIANTS], "raw_name string"))
    mapping = resolve.resolve_entities(resolve.distinct_names(*named), dictionary, threshold)
    return ranking.sort_names(mapping)


def extraction_inputs(pages: DataFrame, html: str = "html", max_chars: int = fixed.CHUNK_CHARS) -> DataFrame:
    """pages + payload: the cleaned text, cut to the chunk size."""
    cleaned = pages.withColumn("_clean", text.clean_html(F.col(html)))
    return cleaned.withColumn("payload", text.chunk_payload(F.col("_clean"), max_chars)).drop("_clean")


def extracted_startups(pages: DataFrame, attempts: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """One row per page: key, tier, attempt, shrinks, sent (the text as shortened for the winning try), record, reason.

    Pages are cleaned and cut; attempts(doc_id, tier, attempt, status, payload) tell how each page fared. record is NULL
    where reason says why: exhausted, corrupt or what is missing. A text is halved as often as its chain of tries asks for.
    """
    outcomes = extraction.failover_chain(attempts).withColumnRenamed("doc_id", "_doc")
    inputs = extraction_inputs(pages, html).select(key, F.col("payload").alias("_text"))
    joined = inputs.join(outcomes, F.col(key) == F.col("_doc"), "left")
    judged = extraction.validate_payloads(joined)
    rung = F.element_at(text.shrink_ladder(F.col("_text"), fixed.CHUNK_CHARS, F.col("shrinks")), -1)
    reason = F.when(F.col("tier").isNull(), "exhausted").otherwise(F.col("reason"))
    return judged.select(key, "tier", "attempt", "shrinks", F.when(F.col("shrinks").isNotNull(), rung["text"]).alias("sent"), "record", reason.alias("reason"))
