"""Paper, repository and star queries over document-derived papers."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewire import fixed_values as fixed, model
from tidewire.functions import links as fn, names
from tidewire.functions.dates import fmt_iso
from tidewire.operators import dedup, linking
from tidewire.plans import fixtures as fx, records
from tidewire.plans.catalog import sqltext as sql
from tidewire.plans.catalog.signals import _plain
from tidewire.sources import feeds

c = F.col
ENTRIES_PER_DOC = 10


def papers(spark, sf):
    rows = fx.derive(spark, sf, fx.PAPERS)
    return rows.withColumn("search_text", fn.search_text(c("summary"), c("comment")))


def links(spark, sf):
    return fx.derive(spark, sf, fx.LINKS)


def repos(spark, sf):
    return fx.derive(spark, sf, fx.REPOS)


def _named(row_id):
    """Up to three author names, one of them blank at times."""
    ident = row_id.cast("string")
    third = F.when(row_id % 4 == 0, "").otherwise(F.concat(F.lit("C "), ident))
    return F.filter(
        F.array(F.concat(F.lit("A "), ident), F.when(row_id % 3 == 0, F.concat(F.lit(" B "), ident)), third),
        lambda n: n.isNotNull(),
    )


def payloads(spark, sf):
    """Atom pages of at most ENTRIES_PER_DOC papers; failed pages are among them."""
    rows = fx.derive(spark, sf, fx.PAPERS)
    escaped = lambda text: F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    ident = c("doc_id").cast("string")
    authors = F.array_join(
        F.transform(_named(c("doc_id")), lambda n: F.concat(F.lit("<author><name>"), n, F.lit("</name></author>"))), ""
    )
    entry = F.concat(
        F.lit("<entry><id>"), c("paper_url"), F.lit("</id>"),
        F.when(c("doc_id") % 8 != 0, F.concat(F.lit("<title>On\n  item "), ident, F.lit("</title>"))).otherwise(""),
        F.lit("<published>2024-01-01T00:00:00Z</published>"), authors,
        F.lit("<summary>"), escaped(F.coalesce("summary", F.lit(""))), F.lit("</summary>"),
        F.when(c("comment").isNotNull(), F.concat(F.lit("<arxiv:comment>"), escaped(c("comment")), F.lit("</arxiv:comment>"))).otherwise(""),
        F.lit("</entry>"),
    )
    numbered = rows.withColumn("src_rank", F.floor(c("doc_id") / ENTRIES_PER_DOC).cast("bigint"))
    pages = numbered.groupBy("src_rank").agg(F.array_sort(F.collect_list(F.struct("doc_id", entry.alias("entry")))).alias("list"))
    head = '<feed xmlns="http://www.w3.org/2005/Atom" xmlns:arxiv="http://arxiv.org/schemas/atom">'
    body = F.concat(F.lit(head), F.array_join(F.transform("list", lambda e: e["entry"]), ""), F.lit("</feed>"))
    return pages.select("src_rank", F.when(c("src_rank") % 13 == 5, 502).otherwise(200).alias("status"), body.alias("body"))


def src_atom_papers(spark, sf):
    rows = feeds.atom_papers(payloads(spark, sf).where("status = 200"))
    return rows.select("src_rank", "item_pos", "title", "published", "authors", "paper_url", "summary", "comment")


def _link(compat=False, owners=None):
    def query(spark, sf):
        found = fn.extract_repo_link(c("search_text"), *([owners] if owners else []), compat=compat)
        return papers(spark, sf).select("doc_id", found.alias("github_url"))

    return query


def owner_blocklist(spark, sf):
    """Owner and verdict of every first link: the long and the short list of site pages."""
    owner = fn.repo_parts(c("search_text"))["owner"]
    found = papers(spark, sf).select("doc_id", owner.alias("owner")).where(c("owner").isNotNull())
    return found.select(
        "doc_id", "owner", fn.generic_owner(c("owner")).alias("generic"), fn.generic_owner(c("owner"), fixed.SHORT_OWNERS).alias("generic_short")
    )


def lookup_code_link(spark, sf):
    keyed = papers(spark, sf).select("doc_id", fn.arxiv_id(c("paper_url")).alias("arxiv_id"))
    return linking.lookup_code_link(keyed, links(spark, sf)).select("doc_id", "arxiv_id", "repository_url")


def enrich_stars(spark, sf):
    found = papers(spark, sf).select("doc_id", fn.extract_repo_link(c("search_text")).alias("github_url"))
    return linking.enrich_stars(found, repos(spark, sf)).select("doc_id", "github_url", "github_stars")


def _resolved(**options):
    def query(spark, sf):
        rows = papers(spark, sf).select("doc_id", "paper_url", "search_text")
        found = linking.link_repos(rows, links(spark, sf), repos(spark, sf), **options)
        return found.select("doc_id", "github_url", "github_stars")

    return query


def seen_anti(spark, sf):
    """Papers that the stored link snapshot does not know yet."""
    keyed = papers(spark, sf).select("doc_id", fn.arxiv_id(c("paper_url")).alias("arxiv_id"))
    return dedup.seen_anti(keyed, links(spark, sf), "arxiv_id").select("doc_id", "arxiv_id")


def star_history(spark, sf):
    snapshots = fx.derive(spark, sf, fx.STAR_SNAPSHOTS)
    changed = dedup.change_between(snapshots, "repo", "snapshot_ts", "snap_id", "stars", bucket="month", name="gained")
    return changed.select("repo", "snap_id", "stars", "gained")


def plan_papers(spark, sf):
    records_ = records.papers(payloads(spark, sf), links(spark, sf), repos(spark, sf))
    return _plain(model.to_contract(records_, "RESEARCH_PAPER"))


QUERIES = {
    "src_atom_papers": src_atom_papers,
    "authors_join": lambda s, d: papers(s, d).select("doc_id", names.join_authors(_named(c("doc_id"))).alias("authors")),
    "search_text": lambda s, d: papers(s, d).select("doc_id", "search_text"),
    "arxiv_id": lambda s, d: papers(s, d).select("doc_id", fn.arxiv_id(c("paper_url")).alias("arxiv_id")),
    "extract_repo_link": _link(),
    "extract_repo_link_compat": _link(compat=True),
    "owner_blocklist": owner_blocklist,
    "lookup_code_link": lookup_code_link,
    "enrich_stars": enrich_stars,
    "resolve_and_enrich": _resolved(),
    "api_matcher": _resolved(owners=fixed.SHORT_OWNERS, compat=True),
    "repo_search_topk": lambda s, d: linking.search_repos(repos(s, d), "Repo-1"),
    "seen_anti": seen_anti,
    "star_history": star_history,
    "plan_papers": plan_papers,
}

_TEXT = "concat(coalesce(summary, ''), ' ', coalesce(comment, ''))"
_P = f"(SELECT *, {_TEXT} AS search_text, regexp_extract(paper_url, '([0-9.]+)v[0-9]+$', 1) AS arxiv_id FROM ({fx.oracle(fx.PAPERS)}) AS raw)"
_FIRST = f"(SELECT arxiv_id, repository_url FROM ({fx.oracle(fx.LINKS)}) AS l WHERE rank = 1 AND repository_url <> '')"
_STARS = f"({fx.oracle(fx.REPOS)})"
_AUTHORS = "concat('A ', doc_id, CASE WHEN doc_id % 3 = 0 THEN concat(', B ', doc_id) ELSE '' END, CASE WHEN doc_id % 4 <> 0 THEN concat(', C ', doc_id) ELSE '' END)"


def _starred(rows: str, columns: str) -> str:
    owner = "lower(split_part(github_url, '/', 4))"
    return f"""SELECT {columns}, github_url, coalesce(stars, 0) AS github_stars FROM ({rows}) AS p
      LEFT JOIN {_STARS} AS s ON {owner} = lower(s.owner) AND lower(split_part(github_url, '/', 5)) = lower(s.repo)"""


def _linked(text: str, columns: str, compat: bool = False, owners=None) -> str:
    return _starred(
        f"""SELECT t.*, coalesce(text_link, repository_url) AS github_url FROM
        (SELECT *, {sql.link(text, compat, owners)} AS text_link FROM {_P} AS raw) AS t LEFT JOIN {_FIRST} AS f USING (arxiv_id)""",
        columns,
    )


_OWNER = "regexp_extract(search_text, '(?i)https?://github\\.com/([a-zA-Z0-9_-]+)/[a-zA-Z0-9_.-]+', 1)"
_TITLE = "CASE WHEN doc_id % 8 <> 0 THEN concat('On item ', doc_id) ELSE '' END"
_PAGED = f"SELECT *, CAST(floor(doc_id / {ENTRIES_PER_DOC}) AS BIGINT) AS page FROM {_P} AS paged"

ORACLES = {
    "src_atom_papers": f"""SELECT page AS src_rank, CAST(row_number() OVER (PARTITION BY page ORDER BY doc_id) - 1 AS INTEGER) AS item_pos, {_TITLE} AS title,
      '2024-01-01T00:00:00Z' AS published, {_AUTHORS} AS authors, paper_url, coalesce(summary, '') AS summary,
      coalesce(comment, '') AS comment FROM ({_PAGED}) WHERE page % 13 <> 5""",
    "authors_join": f"SELECT doc_id, {_AUTHORS} AS authors FROM {_P} AS p",
    "search_text": f"SELECT doc_id, search_text FROM {_P} AS p",
    "arxiv_id": f"SELECT doc_id, arxiv_id FROM {_P} AS p",
    "extract_repo_link": f"SELECT doc_id, {sql.link('search_text')} AS github_url FROM {_P} AS p",
    "extract_repo_link_compat": f"SELECT doc_id, {sql.link('search_text', True)} AS github_url FROM {_P} AS p",
    "owner_blocklist": f"""SELECT doc_id, owner, lower(owner) IN ('topics', 'features', 'about', 'pricing', 'explore', 'site') AS generic,
      lower(owner) IN ('topics', 'features', 'about', 'pricing', 'explore') AS generic_short
      FROM (SELECT doc_id, {_OWNER} AS owner FROM {_P} AS p) WHERE owner <> ''""",
    "lookup_code_link": f"SELECT doc_id, arxiv_id, repository_url FROM {_P} AS p LEFT JOIN {_FIRST} AS f USING (arxiv_id)",
    "enrich_stars": _starred(f"SELECT doc_id, {sql.link('search_text')} AS github_url FROM {_P} AS raw", "doc_id"),
    "resolve_and_enrich": _linked("search_text", "doc_id"),
    "api_matcher": _linked("search_text", "doc_id", True, fixed.SHORT_OWNERS),
    "repo_search_topk": f"""SELECT concat(owner, '/', repo) AS full_name, stars FROM {_STARS} AS s WHERE contains(lower(repo), 'repo-1')
      ORDER BY stars DESC, 1 LIMIT 5""",
    "seen_anti": f"SELECT doc_id, arxiv_id FROM {_P} AS p WHERE arxiv_id NOT IN (SELECT arxiv_id FROM ({fx.oracle(fx.LINKS)}) AS l)",
    "star_history": f"""SELECT repo, snap_id, stars, stars - lag(stars) OVER (PARTITION BY repo ORDER BY snapshot_ts, snap_id) AS gained
      FROM ({fx.oracle(fx.STAR_SNAPSHOTS)}) AS s""",
    "plan_papers": f"""SELECT '1.0' AS "schemaVersion", 'RESEARCH_PAPER' AS "recordType", {_TITLE} AS content_title, {_AUTHORS} AS content_authors,
      paper_url AS content_paper_url, github_url AS content_github_url, github_stars AS content_github_stars,
      '2024-01-01T00:00:00Z' AS content_published_date FROM ({_linked('search_text', 'doc_id, paper_url')}) WHERE floor(doc_id / {ENTRIES_PER_DOC}) % 13 <> 5""",
}
